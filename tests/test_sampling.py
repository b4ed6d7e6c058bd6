import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.random import uniform, uniform_py
from tessera.operators import sampling


def frame(spark, ds):
    return spark.createDataFrame([(i, float(d)) for i, d in enumerate(ds)], "id long, d double")


def brute_race(ds, seed, r, ws=None):
    best = None
    for i, d in enumerate(ds):
        w = 1.0 if ws is None else ws[i]
        if w * d <= 0:
            continue
        key = (math.log(uniform_py(i, seed, r)) / (w * d), -i)
        if best is None or key > best[0]:
            best = (key, i)
    return None if best is None else best[1]


def test_uniform_matches_python(spark):
    df = spark.range(20).select("id", uniform(F.col("id"), 42, 3).alias("u"))
    for row in df.collect():
        assert row["u"] == uniform_py(row["id"], 42, 3)
        assert 0.0 < row["u"] < 1.0


@pytest.mark.parametrize("seed", [1, 7, 42])
def test_race_matches_brute_force(spark, seed):
    ds = [0.0, 1.0, 2.5, 0.0, 4.0, 0.5, 3.0]
    got = sampling.race_pick(frame(spark, ds), seed, 2).first()["id"]
    assert got == brute_race(ds, seed, 2)


def test_race_skips_zero_distance_and_empty(spark):
    assert sampling.race_pick(frame(spark, [0.0, 0.0]), 1, 1).count() == 0
    assert sampling.race_pick(frame(spark, [0.0, 5.0]), 1, 1).first()["id"] == 1


def test_race_distribution(spark):
    # one job: 4000 independent races (one per seed) over points with w·d = 1, 2, 3, 4
    ds = [1.0, 2.0, 3.0, 4.0]
    cand = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(d).alias("d")) for i, d in enumerate(ds)])
    grid = spark.range(4000).select(F.col("id").alias("seed"), F.explode(cand).alias("p")).select("seed", "p.*")
    key = sampling.race_key(uniform(F.col("id"), F.col("seed"), 1), F.lit(1.0), F.col("d"))
    won = grid.groupBy("seed").agg(F.max_by("id", F.struct(key, -F.col("id"))).alias("id"))
    freq = Counter(r["id"] for r in won.collect())
    for i, d in enumerate(ds):
        assert freq[i] / 4000 == pytest.approx(d / 10, abs=0.03)


@pytest.mark.parametrize("frac", [0.0, 0.1, 0.37, 0.5, 0.9, 0.999])
def test_prefix_pick_matches_scan(spark, frac):
    rng = np.random.default_rng(5)
    ds = list(np.round(rng.uniform(0, 3, size=200), 3))
    ds[10] = 0.0
    total = sum(d for d in ds if d > 0)
    run, want = 0.0, None
    for i, d in enumerate(ds):
        if d <= 0:
            continue
        run += d
        if run > frac * total:
            want = i
            break
    got = sampling.prefix_pick(frame(spark, ds), frac, fan_bits=4).first()["id"]
    assert got == want


def brute_seeds(X, k, seed):
    n = len(X)
    first = max(range(n), key=lambda i: (math.log(uniform_py(i, seed, 0)), -i))
    chosen = [first]
    d = np.sqrt(((X - X[first]) ** 2).sum(1))
    for r in range(1, k):
        cand = [i for i in range(n) if d[i] > 0]
        if not cand:
            break
        i = max(cand, key=lambda i: (math.log(uniform_py(i, seed, r)) / d[i], -i))
        chosen.append(i)
        d = np.minimum(d, np.sqrt(((X - X[i]) ** 2).sum(1)))
    return chosen


@pytest.mark.parametrize("carry", [False, True])
def test_seeding_matches_brute_force(spark, carry):
    rng = np.random.default_rng(3)
    X = rng.integers(0, 20, size=(60, 3)).astype(float)
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(X)], "id long, x array<double>")
    got = [i for i, _ in sampling.seed_centers(df, 5, 11, carry=carry)]
    assert got == brute_seeds(X, 5, 11)


@pytest.mark.parametrize("carry", [False, True])
def test_seeding_fewer_distinct_points_than_k(spark, carry):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(3)], "id long, x array<double>")
    assert len(sampling.seed_centers(df, 2, 1, carry=carry)) == 1
    assert len(sampling.seed_centers(df, 1, 1, carry=carry)) == 1


def test_seeding_is_repeatable(spark):
    df = spark.createDataFrame([(i, [float(i), float(i % 7)]) for i in range(40)], "id long, x array<double>")
    a = sampling.seed_centers(df, 4, 9)
    b = sampling.seed_centers(df.repartition(3), 4, 9)
    assert a == b and len({i for i, _ in a}) == 4


@pytest.mark.parametrize("carry", [False, True])
def test_weighted_seeding_draws_by_weight_times_distance(spark, carry):
    # D2 option: with w·d = 0 for every point but one, round 1 must pick that point
    rows = [(i, [float(i)], 0.0) for i in range(10)] + [(10, [100.0], 1.0)]
    df = spark.createDataFrame(rows, "id long, x array<double>, w double")
    for seed in (1, 2, 3):
        seeds = sampling.seed_centers(df, 2, seed, weight="w", carry=carry)
        if seeds[0][0] != 10:
            assert seeds[1][0] == 10


@pytest.mark.parametrize("frac", [0.05, 0.3, 0.6, 0.95])
def test_prefix_pick_with_a_hot_id(spark, frac):
    # a third of the rows share id 7: they collapse before the ordered pass
    rng = np.random.default_rng(9)
    rows = [(7 if i % 3 == 0 else i, float(np.round(rng.uniform(0.1, 2), 3))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, d double")
    mass = {}
    for i, d in rows:
        mass[i] = mass.get(i, 0.0) + d
    total, run, want = sum(mass.values()), 0.0, None
    for i in sorted(mass):
        run += mass[i]
        if run > frac * total:
            want = i
            break
    assert sampling.prefix_pick(df, frac, fan_bits=6).first()["id"] == want


@pytest.mark.parametrize("ids", [
    [2**53 - 1, 2**53, 2**53 + 1, 2**53 + 2],
    [2**61 - 3, 2**61 - 2, 2**61 - 1],
    [-2**61, -2**53 - 1, -2**53, -5, -1, 0, 3],
    [hash(("x", i)) % 2**60 - 2**59 for i in range(300)],
    [-2**63, 2**63 - 1],
    [7, 7, 7, 8, 8],
])
def test_prefix_pick_is_exact_for_any_ids(spark, ids):
    df = spark.createDataFrame([(i, 1.0) for i in ids], "id long, d double")
    for frac in (0.0, 0.4, 0.8):
        want = sorted(ids)[next(k for k in range(len(ids)) if k + 1 > frac * len(ids))]
        assert sampling.prefix_pick(df, frac).first()["id"] == want


def test_prefix_pick_reads_the_points_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def d(i):
        seen.add(1)
        return float(i % 7)

    df = spark.range(5000).select("id", d("id").alias("d"))
    run, total, want = 0.0, sum(i % 7 for i in range(5000)), None
    for i in range(5000):
        run += i % 7
        if i % 7 and run > 0.6 * total:
            want = i
            break
    assert sampling.prefix_pick(df, 0.6, fan_bits=4).first()["id"] == want
    assert seen.value == 5000


def brute_rejection(X, k, seed, proposals):
    n = len(X)
    dist = lambda a, b: float(np.sqrt(((X[a] - X[b]) ** 2).sum()))
    chosen, passes = [max(range(n), key=lambda i: (math.log(uniform_py(i, seed, 0)), -i))], 1
    while len(chosen) < k:
        D = [min(dist(i, c) for c in chosen) for i in range(n)]
        cand, fresh = [i for i in range(n) if D[i] > 0], []
        for t in range(proposals if cand else 0):
            i = max(cand, key=lambda i: (math.log(uniform_py(i, seed, passes, t)) / D[i], -i))
            d = min([D[i], *(dist(i, c) for c in fresh)])
            if len(chosen) < k and uniform_py(i, seed, passes, t, "accept") * D[i] < d:
                fresh.append(i)
                chosen.append(i)
        passes += 1
        if not fresh:
            break
    return chosen, passes


@pytest.mark.parametrize("proposals", [1, 4])
def test_seeding_by_rejection_matches_brute_force(spark, proposals):
    X = np.random.default_rng(3).integers(0, 20, size=(60, 3)).astype(float)
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(X)], "id long, x array<double>")
    got, passes = sampling.seed_by_rejection(df, 7, 11, proposals=proposals)
    assert ([i for i, _ in got], passes) == brute_rejection(X, 7, 11, proposals)
    assert passes == 7 if proposals == 1 else passes < 6


def test_seeding_by_rejection_has_the_distribution_of_the_race():
    """Third centres over 6,000 seeds, by the two brute forces (which match the operators draw by draw)."""
    X = np.array([[0.0], [1.0], [3.0], [7.0], [8.0]])
    seeds = range(6000)
    race = Counter(brute_seeds(X, 3, s)[2] for s in seeds)
    rejection = Counter(brute_rejection(X, 3, s, 4)[0][2] for s in seeds)
    for i in range(len(X)):
        assert race[i] / 6000 == pytest.approx(rejection[i] / 6000, abs=0.025)


def test_seeding_by_rejection_of_few_points(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(3)], "id long, x array<double>")
    assert len(sampling.seed_by_rejection(df, 2, 1)[0]) == 1
    assert sampling.seed_by_rejection(df.limit(0), 2, 1)[0] == []


def test_registered_rejection_seeding_on_the_driver_table(spark):
    import os

    from tessera.plans import catalog
    from tessera.sources import tables

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    rows = sorted((r["id"], r["x"]) for r in tables.points(spark, sf).collect())
    assert [i for i, _ in rows] == list(range(len(rows)))
    want, passes = brute_rejection(np.array([x for _, x in rows]), catalog.SEED_K, catalog.SEED, sampling.PROPOSALS)
    assert [r["vec_id"] for r in sorted(catalog.seed_rejection(spark, sf).collect())] == want
    assert passes < catalog.SEED_K / 2
