"""A corpus pipeline of five training-data operators over ``documents``.

    quality rules -> line dedup -> SimHash near-dedup -> benchmark decontamination -> BPE encoding and decoding

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept; its result is
written as Parquet and reread as the next one's ``docs``. All but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.

Defined results, in every stage: an empty table gives an empty result; other columns pass through
unchanged, whatever their names; very long texts are worked on whole. A NULL or empty text has no words:
quality rules reject it, line dedup, decontamination and encoding keep it, and near-dedup keeps one of
all texts without words. A NULL id is an id like any other. Repeated rows are documents of their own: quality
rules, decontamination and encoding treat them alike, line dedup deletes the runs of the later one,
and near-dedup keeps one of them. As the dealt near-dedup links fingerprints of three-word shingles at two
differing bits, near copies that differ in more than a few words stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, lines, quality, simhash
from tessera.llm.common import table, written
from tessera.llm.vocab import tokenizer_path


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that too many documents of their source hold."""
    return _sized(quality.apply_quality(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing is left."""
    out = lines.dedup_lines(docs).filter((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    return _sized(out.select(*docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, their number, and the text decoded from them."""
    return bpe.encode_decode(docs, tokenizer_path()).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: XXH64 and byte-pair merges are beyond SQL; tests compare each stage with SQL or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
