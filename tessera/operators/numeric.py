"""Numeric column statistics.

The global maximum is a scalar subquery: Spark runs the one-row aggregate once
and substitutes its value into the projection, so normalising costs one extra
scan of the (pruned) column and no join. Everything else is one aggregate pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sum_of_squares(df: DataFrame, col: str = "value") -> DataFrame:
    """P1 + A1: ``sum_sq`` = Σ v²."""
    v = _c(col)
    return df.agg(F.sum(v * v).alias("sum_sq"))


def max_value(df: DataFrame, col: str = "value") -> DataFrame:
    """A2/A3: ``max_value``."""
    return df.agg(F.max(_c(col)).alias("max_value"))


def global_max(df: DataFrame, col: str = "value") -> Column:
    """The column maximum as a scalar-subquery column (computed once per query)."""
    return df.agg(F.max(_c(col))).scalar()


def normalize(df: DataFrame, col: str = "value", out: str = "z") -> DataFrame:
    """``out = col / max(col)``.

    A zero maximum raises, as in the reference, whatever the session's ANSI
    setting (the scalar subquery is computed once and reused).
    """
    m = global_max(df, col)
    return df.withColumn(out, F.when(m == 0, F.raise_error(F.lit("division by zero: the maximum is 0")))
                         .otherwise(_c(col) / m))


def summary(df: DataFrame, col: str = "value", threshold: float | None = None) -> DataFrame:
    """A4 (+A6): ``n, mean, m2, stddev_pop, max_value, min_value`` [``, n_over``] in one pass.

    ``m2`` is the sum of squared deviations from the mean. ``n_over`` counts
    values strictly greater than ``threshold``.
    """
    v = _c(col)
    aggs = [
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
        F.stddev_pop(v).alias("stddev_pop"),
        F.max(v).alias("max_value"),
        F.min(v).alias("min_value"),
    ]
    if threshold is not None:
        aggs.append(F.count_if(v > F.lit(float(threshold))).alias("n_over"))
    return df.agg(*aggs)


def count_above(df: DataFrame, col: str = "value", threshold: float = 0.5) -> DataFrame:
    """P3 + A6: ``n`` = number of values strictly greater than ``threshold``."""
    return df.agg(F.count_if(_c(col) > F.lit(float(threshold))).alias("n"))


def normalized_summary(df: DataFrame, col: str = "value", threshold: float = 0.5) -> DataFrame:
    """The whole numeric report of the reference: stats of ``col / max`` plus the
    count above ``threshold``, in two scans (max, then one aggregate)."""
    return summary(normalize(df, col, "_z"), "_z", threshold)
