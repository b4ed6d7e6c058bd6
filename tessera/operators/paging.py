"""Row index (P6), range predicate on it (P7) and chunked pulls (K2).

The index is 0-based and consecutive in the order of ``order_by`` (which must
be a unique key for a repeatable result). It is built without a global
single-partition ``row_number()``: rows are range-partitioned, sorted and written
once, each partition is counted, and the counts (one row per partition) are
turned into running offsets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path, written


def running_offsets(small: DataFrame, order_cols: Sequence[str], count_col: str,
                    out_col: str) -> DataFrame:
    """Exclusive running sum of ``count_col`` in ``order_cols`` order.

    Only for *small* frames (one row per partition or input block): the window
    has no partition key and runs in one task.
    """
    w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return small.withColumn(out_col, F.coalesce(F.sum(count_col).over(w), F.lit(0)).cast("long"))


def with_row_index(df: DataFrame, order_by: Sequence[str], index_col: str = "idx",
                   num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based consecutive ``index_col`` in ``order_by`` order.

    One range shuffle. The sorted rows are written once to the shared folder with their
    partition and their place in it, so the counts that give the offsets (one row per
    partition) and the index describe the same rows, whatever is lost or asked for later;
    nothing stays cached.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Tiebreaker: a hash of the row's (hashable) columns. With a unique key it never
    # decides anything; when one key value holds many rows it spreads them over
    # several range partitions instead of one, and fixes their order.
    hashable = [c for c, t in df.dtypes if not t.startswith("map")]
    keys = [F.col(c) for c in order_by] + [F.xxhash64(*[F.col(c) for c in hashable])]
    # An explicit partition count keeps AQE from coalescing the range partitions.
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = written(ordered.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = running_offsets(counts, ["_pid"], "_n", "_offset").select("_pid", "_first", "_offset")
    return tagged.join(written(offsets), "_pid").select(
        (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("long").alias(index_col), *df.columns)


def page(indexed: DataFrame, start: int, end: int, index_col: str = "idx") -> DataFrame:
    """Rows with ``start <= idx < end`` (half-open)."""
    return indexed.where((F.col(index_col) >= start) & (F.col(index_col) < end))


def iter_pages(df: DataFrame, order_by: Sequence[str], page_size: int,
               index_col: str = "idx") -> Iterator[DataFrame]:
    """K2: yield consecutive pages as DataFrames; the caller collects one at a time.

    One job writes the indexed rows to the shared folder with a folder per page; a page's job then
    lists and reads its own folder only, whatever the size of the table. The driver never holds
    more than one page.
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    indexed = with_row_index(df, order_by, index_col)
    schema, path = indexed.schema, fresh_path(df.sparkSession)
    pages = indexed.withColumn("_page", F.floor(F.col(index_col) / page_size).cast("long"))
    pages.write.partitionBy("_page").parquet(path)
    n = df.sparkSession.read.schema("_page long").parquet(path).agg(F.max("_page").alias("last")).first()["last"]  # from the folders' names
    for i in range(0 if n is None else n + 1):
        yield df.sparkSession.read.schema(schema).parquet(f"{path}/_page={i}").orderBy(index_col)
