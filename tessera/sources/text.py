"""Text-line sources: lines, numbers, documents and dense vectors.

All readers stay distributed: ``spark.read.text`` splits files into blocks and
every parse step is a column expression. Nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import VECTOR_TYPE
from ..session import written

# Fixed value: characters Python's float()/str.split() treat as surrounding blanks.
BLANKS = " \t\r\n\f\v"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line (``value: string``); '\\n' and '\\r\\n' removed, blank lines kept."""
    return spark.read.text(path)


def with_line_number(lines: DataFrame, col: str = "line_no") -> DataFrame:
    """0-based line number of a ``spark.read.text`` frame, in file and line order.

    The lines are read once and written to the shared folder with their input block and their place
    in it; the counts of the blocks (one row each) become running offsets, and a line's number is
    its block's offset plus its place. Counts and places come from the same written rows, so
    a later change of the split size or of the executors cannot make them disagree. No shuffle of the
    text; Spark broadcasts the offsets (four longs per block) if its own threshold allows.
    """
    from ..operators.paging import running_offsets

    tagged = written(lines.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    ))
    blocks = tagged.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = written(running_offsets(blocks, ["_path", "_block"], "_n", "_offset").select("_path", "_block", "_offset", "_first"))
    return tagged.join(offsets, ["_path", "_block"]).select(*lines.columns, (F.col("_offset") + F.col("_mid") - F.col("_first")).alias(col))


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def parse_numbers(lines: DataFrame, value_col: str = "value", strict: bool = True) -> DataFrame:
    """Non-blank lines parsed as doubles (``value: double``).

    ``strict`` fails the job on a malformed line, whatever the session's ANSI setting;
    otherwise malformed lines become NULL and are dropped.
    """
    t = _trimmed(F.col(value_col))
    out = lines.where(t != "").select((_strict_double(t) if strict else t.try_cast("double")).alias("value"))
    return out if strict else out.where(F.col("value").isNotNull())


def _strict_double(text: Column) -> Column:
    """The number in ``text``; anything else fails the job under any ANSI setting."""
    value = text.try_cast("double")
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit("malformed number: "), text)).cast("double")).otherwise(value)


def read_numbers(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_numbers(read_lines(spark, path), strict=strict)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One document per line: ``doc_id: long`` (0-based line number), ``text: string``."""
    lines = read_lines(spark, path)
    return with_line_number(lines, "doc_id").select("doc_id", F.col("value").alias("text"))


def parse_vectors(lines: DataFrame, value_col: str = "value", sep: str = " ") -> Column:
    """Column expression: a text line → ``array<double>``.

    ``sep=' '`` (S3) splits on single spaces and drops empty tokens;
    ``sep=None`` (S4) splits on any run of whitespace.
    """
    raw = F.col(value_col)
    if sep is None:
        tokens = F.split(_trimmed(raw), "[ \\t\\r\\n\\f\\u000B]+", -1)
    else:
        tokens = F.split(raw, sep, -1)
    kept = F.filter(tokens, lambda e: e != "")
    return F.transform(kept, lambda e: _strict_double(_trimmed(e))).cast(VECTOR_TYPE)


def read_vectors(spark: SparkSession, path: str | list[str], sep: str | None = " ",
                 validate: bool = True) -> DataFrame:
    """One dense vector per line → ``id: long, x: array<double>``.

    ``validate`` rejects empty vectors, non-finite coordinates and mixed dimensions (one aggregate).
    """
    lines = with_line_number(read_lines(spark, path), "id")
    vecs = lines.select("id", parse_vectors(lines, sep=sep).alias("x"))
    if not validate:
        return vecs
    sizes = vecs.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if sizes["lo"] != sizes["hi"]:
        raise ValueError(f"mixed vector dimensions: {sizes['lo']} .. {sizes['hi']}")
    return checked_vectors(vecs)


def checked_vectors(points: DataFrame, x: str = "x") -> DataFrame:
    """Rejects empty vectors and NULL, NaN or infinite coordinates (D10) by a lazy ``raise_error`` per row;
    :func:`vector_dimension` checks the dimension."""
    bad = (F.size(x) == 0) | F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return points.withColumn(
        x, F.when(bad, F.raise_error(F.lit("invalid vector: empty or non-finite coordinate")))
        .otherwise(F.col(x))
    )


def vector_dimension(points: DataFrame, x: str = "x") -> int:
    """The common dimension of all vectors; raises if they differ (one aggregate job)."""
    row = points.agg(F.min(F.size(x)).alias("lo"), F.max(F.size(x)).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("empty point set")
    if row["lo"] != row["hi"]:
        raise ValueError(f"mixed vector dimensions: {row['lo']} .. {row['hi']}")
    return int(row["lo"])
