import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import numeric
from tessera.sources.text import read_numbers


@pytest.fixture
def nums(spark, fixture_path):
    return read_numbers(spark, fixture_path("numbers.txt"))


def test_read_numbers_skips_blank(nums):
    assert sorted(r["value"] for r in nums.collect()) == [float(i) for i in range(1, 11)]


def test_crlf_blank_and_no_final_newline(spark, fixture_path):
    vals = [r["value"] for r in read_numbers(spark, fixture_path("numbers_crlf.txt")).collect()]
    assert sorted(vals) == [1.0, 2.0, 12.0]


def test_golden_statistics(nums):
    assert numeric.sum_of_squares(nums).first()["sum_sq"] == 385.0
    assert numeric.max_value(nums).first()["max_value"] == 10.0
    z = sorted(r["z"] for r in numeric.normalize(nums).collect())
    assert z == pytest.approx([i / 10 for i in range(1, 11)])
    s = numeric.normalized_summary(nums, threshold=0.5).first()
    assert s["n"] == 10
    assert s["mean"] == pytest.approx(0.55)
    assert s["m2"] == pytest.approx(0.825)
    assert s["stddev_pop"] == pytest.approx(0.2872281323)
    assert s["max_value"] == pytest.approx(1.0)
    assert s["min_value"] == pytest.approx(0.1)
    assert s["n_over"] == 5  # 0.5 itself is excluded


def test_count_above_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.50001,), (0.2,)], "value double")
    assert numeric.count_above(df, threshold=0.5).first()["n"] == 1


def test_zero_max_raises(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "value double")
    with pytest.raises(PySparkException):
        numeric.normalize(df).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            numeric.normalize(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_empty_input_gives_null_aggregates(spark):
    df = spark.createDataFrame([], "value double")
    s = numeric.normalized_summary(df).first()
    assert s["n"] == 0 and s["n_over"] == 0 and s["mean"] is None and s["max_value"] is None


def test_normalize_plan_scans_twice_without_join(nums):
    plan = numeric.normalize(nums)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan


def test_negative_max_flips_sign(spark):
    df = spark.createDataFrame([(-2.0,), (-4.0,)], "value double")
    z = sorted(r["z"] for r in numeric.normalize(df).select(F.col("z")).collect())
    assert z == [1.0, 2.0]


def test_report_matches_numpy_on_random_values(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.uniform(-10, 1000, size=2000).round(2)
    df = spark.createDataFrame([(float(x),) for x in v], "value double").repartition(4)
    z = v / v.max()
    s = numeric.normalized_summary(df, threshold=0.5).first()
    assert s["n"] == len(v) and s["n_over"] == int((z > 0.5).sum())
    assert s["mean"] == pytest.approx(z.mean(), rel=1e-12)
    assert s["m2"] == pytest.approx(((z - z.mean()) ** 2).sum(), rel=1e-9)
    assert s["stddev_pop"] == pytest.approx(z.std(), rel=1e-9)
    assert (s["max_value"], s["min_value"]) == (z.max(), z.min())
    assert numeric.sum_of_squares(df).first()["sum_sq"] == pytest.approx((v * v).sum(), rel=1e-12)
