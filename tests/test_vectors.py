import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tessera.functions.vector import distance, distance_matrix, nearest
from tessera.operators import kmeans
from tessera.operators import vectors as V
from tessera.sources.text import checked_vectors, read_vectors, vector_dimension


def pts(spark, rows, weights=None):
    if weights is None:
        return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(rows)],
                                     "id long, x array<double>")
    return spark.createDataFrame([(i, [float(v) for v in x], float(w))
                                  for i, (x, w) in enumerate(zip(rows, weights))],
                                 "id long, x array<double>, w double")


def test_read_vectors_space_and_whitespace(spark, fixture_path):
    got = read_vectors(spark, fixture_path("vectors.txt"), sep=" ").orderBy("id").collect()
    assert [r["x"] for r in got] == [[1.0, 2.5, 30.0], [0.0, 0.0, 0.0]]
    got_ws = read_vectors(spark, fixture_path("vectors.txt"), sep=None).orderBy("id").collect()
    assert [r["x"] for r in got_ws] == [[1.0, 2.5, 30.0], [0.0, 0.0, 0.0]]
    assert vector_dimension(read_vectors(spark, fixture_path("vectors.txt"))) == 3


@pytest.mark.parametrize("bad", [[], [1.0, float("nan")], [float("inf")]])
def test_rejects_invalid_vectors(spark, bad):
    df = spark.createDataFrame([(0, bad)], "id long, x array<double>")
    with pytest.raises(PySparkException):
        checked_vectors(df).collect()


def test_rejects_mixed_dimension(spark):
    with pytest.raises(ValueError):
        vector_dimension(pts(spark, [[1, 2], [1, 2, 3]]))


def test_distance_forms_agree(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(50, 7))
    C = rng.normal(size=(3, 7))
    df = pts(spark, rows)
    jvm = [r["d"] for r in df.orderBy("id").select(distance("x", list(C[1])).alias("d")).collect()]
    kern = distance_matrix(rows, C)[1]
    assert jvm == list(kern)  # same summation order → identical doubles
    ref = np.sqrt(((rows - C[1]) ** 2).sum(axis=1))
    assert np.allclose(kern, ref)


def test_blocked_kernel_matches_loop():
    rng = np.random.default_rng(2)
    X, C = rng.normal(size=(300, 90)), rng.normal(size=(60, 90))  # k·dim above the loop limit
    assert np.allclose(distance_matrix(X, C), np.sqrt(((X[None] - C[:, None]) ** 2).sum(-1)))


def test_equidistant_point_goes_to_lowest_centre(spark):
    df = pts(spark, [[0]])
    row = V.assign(df, [[-1.0], [1.0]]).first()
    assert row["c"] == 0 and row["d"] == 1.0


def test_duplicate_centres_weights(spark):
    w = {r["c"]: r["w"] for r in V.cluster_weights(pts(spark, [[0], [1]]), [[0.0], [0.0]]).collect()}
    assert w == {0: 2, 1: 0}


def test_weights_per_part_keep_zero_rows(spark):
    df = pts(spark, [[0], [10], [0.5], [11]]).selectExpr("id", "x", "id % 2 AS part")
    got = {(r["part"], r["c"]): r["w"] for r in V.cluster_weights(df, [[0.0], [10.0], [99.0]], part="part").collect()}
    assert got == {(0, 0): 2, (0, 1): 0, (0, 2): 0, (1, 0): 0, (1, 1): 2, (1, 2): 0}


def test_empty_cluster_keeps_centre(spark):
    new = kmeans.lloyd_step(pts(spark, [[0.1], [-0.1]]), [[0.0], [100.0]])
    assert new[1] == [100.0] and new[0] == [0.0]


def test_damped_update(spark):
    assert kmeans.lloyd_step(pts(spark, [[2], [4]]), [[0.0]]) == [[2.0]]
    # textbook Lloyd when the old centre has no weight
    assert kmeans.lloyd_step(pts(spark, [[2], [4]]), [[0.0]], damping=0.0) == [[3.0]]


def test_weighted_lloyd(spark):
    df = pts(spark, [[1, 2], [4, 4]], weights=[2, 1])
    # (old·1 + 2·(1,2) + 1·(4,4)) / (1 + 3)
    assert kmeans.lloyd_step(df, [[0.0, 0.0]], weight="w") == [[1.5, 2.0]]


def test_weighted_mean(spark):
    df = pts(spark, [[1, 2], [4, 4]], weights=[2, 1]).selectExpr("0 AS g", "x", "w")
    mean = V.weighted_mean(df, "g", w="w").first()["mean"]
    assert mean == pytest.approx([2.0, 8 / 3])


def test_objective_and_pairwise(spark):
    df = pts(spark, [[0, 0], [3, 4], [6, 8]])
    assert V.objective(df, [[0.0, 0.0]]).first()["objective"] == pytest.approx(5.0)
    pairs = {(r["id"], r["c"]): r["d"] for r in V.pairwise_distances(df, [[0.0, 0.0], [3.0, 4.0]]).collect()}
    assert pairs[(2, 0)] == 10.0 and pairs[(2, 1)] == 5.0 and len(pairs) == 6


def test_min_distance_update(spark):
    df = V.update_min_distance(pts(spark, [[0], [5]]), [4.0])
    df = V.update_min_distance(df, [1.0])
    assert [r["d"] for r in df.orderBy("id").collect()] == [1.0, 1.0]


def test_center_budget():
    with pytest.raises(ValueError):
        V.check_center_budget(10_000_000, 64)
    V.check_center_budget(1000, 64)


def test_null_vector_gives_null_assignment(spark):
    df = spark.createDataFrame([(0, None), (1, [1.0])], "id long, x array<double>")
    rows = {r["id"]: (r["c"], r["d"]) for r in V.assign(df, [[0.0]]).collect()}
    assert rows[0] == (None, None) and rows[1] == (0, 1.0)
    assert not math.isnan(rows[1][1])
    pairs = [(r["id"], r["c"], r["d"]) for r in V.pairwise_distances(df, [[0.0], [3.0]]).orderBy("c").collect()]
    assert pairs == [(1, 0, 1.0), (1, 1, 2.0)]  # a NULL vector has no distances


def test_zero_weight_points_do_not_move_centres(spark):
    # A coreset row with w = 0 takes part in the assignment but not in the mean
    df = pts(spark, [[2], [4], [1000]], weights=[1, 1, 0])
    assert kmeans.lloyd_step(df, [[0.0]], weight="w") == [[2.0]]


def _python_evals(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("ArrowEvalPython")


def test_kernel_runs_once_per_row(spark):
    # a filter on the kernel's output (e.g. an inferred isnotnull from a join) would be
    # pushed below it and make Spark evaluate the kernel twice
    df = pts(spark, [[0], [1], [5], [9]]).selectExpr("id", "x", "id % 2 AS part")
    assert _python_evals(kmeans.lloyd_step_frame(df, [[0.0], [8.0]])) == 1
    assert _python_evals(V.cluster_weights(df, [[0.0], [8.0]])) == 1
    assert _python_evals(V.cluster_weights(df, [[0.0], [8.0]], part="part")) == 1
    assert _python_evals(V.pairwise_distances(df, [[0.0], [8.0]])) == 1


def test_kernel_rejects_mixed_dimensions(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "id long, x array<double>").coalesce(1)
    with pytest.raises(PySparkException):
        V.assign(df, [[0.0, 0.0]]).collect()


def test_vector_operators_match_numpy_on_random_data(spark):
    rng = np.random.default_rng(11)
    X = rng.integers(-5, 6, size=(120, 4)).astype(float)  # small integers: exact distances, real ties
    W = rng.integers(0, 4, size=120).astype(float)
    C = [list(map(float, c)) for c in rng.integers(-5, 6, size=(5, 4))]
    df = pts(spark, X, weights=W).repartition(3)
    D = np.sqrt(((X[:, None, :] - np.array(C)[None]) ** 2).sum(-1))
    a = D.argmin(axis=1)  # first minimum = lowest centre index
    got = {r["id"]: (r["c"], r["d"]) for r in V.assign(df, C).collect()}
    assert all(got[i] == (a[i], D[i, a[i]]) for i in range(len(X)))
    w = {r["c"]: r["w"] for r in V.cluster_weights(df, C).collect()}
    assert w == {c: int((a == c).sum()) for c in range(5)}
    assert V.objective(df, C).first()["objective"] == pytest.approx(D.min(axis=1).mean())
    new = kmeans.lloyd_step(df, C, weight="w")
    for c in range(5):
        m = a == c
        want = (np.array(C[c]) + (W[m, None] * X[m]).sum(0)) / (1 + W[m].sum())
        assert np.allclose(new[c], want)


@pytest.mark.parametrize("k", [15, 16, 17, 40])
def test_distances_do_not_depend_on_the_number_of_centres(k):
    rng = np.random.default_rng(k)
    X, C = rng.normal(size=(500, 256)), rng.normal(size=(k, 256))
    one = np.stack([distance_matrix(X, C[i:i + 1])[0] for i in range(k)])
    assert (distance_matrix(X, C) == one).all()


def test_mixed_dimensions_and_bad_coordinates_raise(spark):
    with pytest.raises(ValueError, match="dimension"):
        distance_matrix(np.zeros((2, 3)), np.zeros((1, 2)))
    for x in ([3.0, 4.0, 12.0], [float("nan"), 1.0], [None, 1.0], [float("inf"), 1.0]):
        df = spark.createDataFrame([(0, x)], "id long, x array<double>")
        with pytest.raises(Exception, match="dimension|vector"):
            V.assign(df, [[0.0, 0.0]]).collect()


def test_files_with_mixed_dimensions_or_bad_numbers_are_rejected(spark, tmp_path):
    (tmp_path / "mixed.txt").write_text("1 2\n1 2 3\n")
    (tmp_path / "bad.txt").write_text("1.0 abc\n2.0 3.0\n")
    with pytest.raises(ValueError, match="mixed"):
        read_vectors(spark, str(tmp_path / "mixed.txt"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="malformed"):
                read_vectors(spark, str(tmp_path / "bad.txt")).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_distance_to_own_centre(spark):
    df = spark.createDataFrame([(0, [0.0], 1), (1, [5.0], 0), (2, [1.0], None)], "id long, x array<double>, c int")
    got = sorted(tuple(r) for r in V.distance_to_center(df, [[1.0], [4.0]]).select("id", "d").collect())
    assert got == [(0, 4.0), (1, 4.0), (2, None)]
