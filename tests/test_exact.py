import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tessera.functions import exact
from tessera.operators import kmeans
from tessera.operators import vectors as V


def frame(spark, rows, schema="id long, x array<double>, w double"):
    return spark.createDataFrame([(i, [float(v) for v in x], float(w)) for i, (x, w) in enumerate(rows)], schema)


def wide_rows(n, dim, seed):
    """Weighted vectors whose coordinates span many orders of magnitude, with heavy cancellation."""
    rng = np.random.default_rng(seed)
    big = rng.normal(size=(n // 2, dim)) * 10.0 ** rng.integers(-6, 7, size=(n // 2, dim))
    x = np.vstack([big, -big + rng.normal(size=big.shape) * 1e-3])
    return list(zip(x, rng.integers(1, 4, size=len(x))))


def test_digits_give_the_value_back():
    rng = random.Random(1)
    values = np.array([rng.uniform(-1, 1) * 2.0 ** rng.randint(-38, 0) for _ in range(2000)] + [0.0, -0.0, 1 - 2 ** -53, -1 + 2 ** -53]) * 2.0 ** 17
    cut = exact.digits(values, 17)
    for i, v in enumerate(values):
        got = sum(Fraction(int(d)) * Fraction(2) ** (17 - exact.DIGIT * (k + 1)) for k, d in enumerate(cut[:, i]))
        assert got == Fraction(float(v))


def test_sums_equal_fractions_in_any_order(spark):
    rows = wide_rows(400, 5, 3)
    want = [float(sum(Fraction(float(w)) * Fraction(float(x[j])) for x, w in rows)) for j in range(5)]
    seen = set()
    for parts, seed in ((1, 0), (3, 1), (7, 2)):
        own = list(rows)
        random.Random(seed).shuffle(own)
        df = frame(spark, own).repartition(parts)
        got = exact.group_sums(df.selectExpr("1 AS g", "x", "w"), exact.exponents(df, "x", df["w"])).first()
        assert got["sw"] == sum(float(w) for _, w in rows)
        seen.add(tuple(got["s"]))
        top = max(abs(float(w) * float(x[j])) for x, w in rows for j in range(5))
        assert all(abs(a - b) <= 2 ** -80 * top * len(rows) + 4e-16 * abs(b) for a, b in zip(got["s"], want))
    assert len(seen) == 1


def test_groups_nulls_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(exact, "_CELLS", 7)
    rows = [(None, [1.0, 2.0], 1.0), (None, [3.0, 4.0], 2.0), ("a", [5.0, 6.0], 1.0), ("a", None, 1.0), ("b", None, 1.0), ("a", [0.5, 0.5], None)]
    df = spark.createDataFrame(rows, "g string, x array<double>, w double")
    got = {r["g"]: (r["s"], r["sw"]) for r in exact.group_sums(df, exact.exponents(df, "x", df["w"])).collect()}
    assert got == {None: ([7.0, 10.0], 3.0), "a": ([5.0, 6.0], 1.0)}
    none = df.limit(0)
    assert exact.group_sums(none, exact.exponents(none, "x", none["w"])).collect() == []
    zero = spark.createDataFrame([(1, [0.0, 0.0], 1.0)], "g int, x array<double>, w double")
    assert exact.group_sums(zero, exact.exponents(zero, "x", zero["w"])).first()["s"] == [0.0, 0.0]


def test_a_task_hands_on_held_sums_in_time(spark):
    """More groups than a task may hold: every group still gets all its rows."""
    df = spark.range(60000).selectExpr("id % 9000 AS g", "array_repeat(double(id), 64) AS x", "1D AS w").coalesce(1)
    got = exact.group_sums(df, exact.exponents(df, "x", df["w"])).selectExpr("count(*)", "sum(s[0])", "sum(s[63])", "sum(sw)").first()
    assert tuple(got) == (9000, 59999 * 30000.0, 59999 * 30000.0, 60000.0)


def test_rejects_what_is_not_finite(spark):
    df = frame(spark, [([1.0, math.inf], 1.0)])
    with pytest.raises(ValueError):
        exact.exponents(df, "x", df["w"])


def test_weighted_mean_and_fit_have_the_same_bits_in_any_order(spark):
    rows = wide_rows(300, 4, 9)
    means, centers = set(), set()
    for parts, seed in ((1, 5), (4, 6), (9, 7)):
        own = [(i, [float(v) for v in x], float(w)) for i, (x, w) in enumerate(rows)]
        random.Random(seed).shuffle(own)
        df = spark.createDataFrame(own, "id long, x array<double>, w double").repartition(parts)
        means.add(tuple(sorted((r["g"], *r["mean"]) for r in V.weighted_mean(df.selectExpr("id % 3 AS g", "x", "w"), "g", w="w", exact=True).collect())))
        centers.add(tuple(map(tuple, kmeans.fit(df, 4, 3, 11, weight="w", exact=True))))
    assert len(means) == len(centers) == 1
    plain = {r["g"]: r["mean"] for r in V.weighted_mean(df.selectExpr("id % 3 AS g", "x", "w"), "g", w="w").collect()}
    for g, *mean in next(iter(means)):
        assert np.allclose(plain[g], mean, rtol=1e-6, atol=1e-2)


@pytest.mark.parametrize("k", [1, 2, 8])
def test_bounds_give_the_same_centres_with_fewer_distances(spark, k):
    rng = np.random.default_rng(4)
    rows = [(rng.normal(size=6) + 12 * (i % 8), 1 + i % 3) for i in range(1200)]
    df = frame(spark, rows)
    want = kmeans.fit(df, k, 6, 3, weight="w", exact=True)
    got, counts = kmeans.fit_by_bounds(df.repartition(5), k, 6, 3, weight="w")
    assert got == want
    assert counts[0] == 1200 * k and all(c <= 1200 * (k + 1) for c in counts)
    if k == 8:
        assert sum(counts[1:]) < 0.5 * 5 * 1200 * k


def test_bounds_keep_ties_and_repeated_centres(spark):
    """Points on a grid: many lie on borders, and there are more centres than places."""
    rows = [([float(i % 3), float(i // 3 % 3)], 1.0) for i in range(90)]
    df = frame(spark, rows)
    for k in (4, 9, 12):
        assert kmeans.fit_by_bounds(df, k, 5, 2)[0] == kmeans.fit(df, k, 5, 2, exact=True)
    assert kmeans.fit_by_bounds(df.limit(0), 3, 2, 1) == ([], [])


def test_blocks_of_centres_give_the_doubles_of_the_kernel(spark):
    rng = np.random.default_rng(8)
    rows = [(rng.normal(size=5), 1.0) for _ in range(200)]
    C = [list(map(float, c)) for c in rng.normal(size=(23, 5))]
    C[17], C[22] = C[3], C[3]  # a tie goes to the lowest number, whatever the block
    df = frame(spark, rows + [(rows[0][0], 1.0), (C[3], 1.0)])
    want = sorted((r["id"], r["c"], r["d"]) for r in V.assign(df, C).collect())
    centers = V.centers_frame(spark, C).repartition(3)
    for bytes_ in (1, 3 * 5 * 8, 1 << 20):
        assert sorted((r["id"], r["c"], r["d"]) for r in V.assign_by_blocks(df, centers, block_bytes=bytes_).collect()) == want
    with pytest.raises(ValueError):  # the kernel refuses a set of this size
        V.collect_centers(centers, max_bytes=23 * 5 * 8 - 1)
    null = spark.createDataFrame([(1, None), (2, C[5])], "id long, x array<double>")
    assert sorted(map(tuple, V.assign_by_blocks(null, centers, block_bytes=80).collect())) == [(1, None, None), (2, 5, 0.0)]
    with pytest.raises(ValueError):
        V.assign_by_blocks(df, centers.filter("c <> 4"))


def test_lloyd_step_by_blocks(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, [(rng.normal(size=3), 1 + i % 4) for i in range(150)])
    C = [list(map(float, c)) for c in rng.normal(size=(9, 3))] + [[99.0, 99.0, 99.0]]
    got = [r["y"] for r in kmeans.lloyd_step_by_blocks(df, V.centers_frame(spark, C), weight="w", block_bytes=2 * 24).orderBy("c").collect()]
    assert np.allclose(got, kmeans.lloyd_step(df, C, weight="w"), rtol=1e-13) and got[9] == C[9]


def test_tables_of_a_run_go_with_it(spark):
    import os

    from tessera.session import ensure_checkpoint_dir, run_tables, written

    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    kept = written(spark.range(3))
    with run_tables(spark) as folder:
        own = written(spark.range(5))
        assert own.count() == 5 and all(f.removeprefix("file://").startswith(folder.removeprefix("file:")) for f in own.inputFiles())
    assert not os.path.exists(folder.removeprefix("file:")) and folder.removeprefix("file:").startswith(top) and kept.count() == 3
