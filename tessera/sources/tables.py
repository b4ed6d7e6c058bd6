"""Adapters from the driver's Parquet test tables to the library's inputs.

Roles (see FIXTURES.md): numbers = ``lineitem.l_extendedprice``, documents =
``documents(doc_id, text)``, points = ``embeddings(vec_id, embedding)`` cast to
``array<double>``. Only the needed columns are selected, so the Parquet scan
reads just those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import as_vector


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, l_linenumber, value`` from lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def points(spark: SparkSession, sf_dir: str, with_label: bool = False) -> DataFrame:
    """``id, x`` (and ``label``) from embeddings; float32 widened to double."""
    cols = [F.col("vec_id").alias("id"), as_vector("embedding").alias("x")]
    if with_label:
        cols.append(F.col("label"))
    return table(spark, sf_dir, "embeddings").select(*cols)
