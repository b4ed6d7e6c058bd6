"""Queries of the training-data operators over the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, html, jaccard, lines, quality, search, simhash, suffixes, toxicity, trie, wordpiece
from .common import table
from .oracle import SQL as _SQL
from .vocab import tokenizer_path

QueryFn = Callable[[SparkSession, str], DataFrame]

#: conversation -1 of operator 9: two turns full of control strings
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    out = chat.format_chats(rows.unionByName(probe))
    read = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("segments")).alias("loss"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turn_text, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, tokenizer_path())
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("first.id").alias("component_id"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    code = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label"))
    labelled = docs.filter(code % 5 != 0).join(labels, F.col("doc_id") == F.col("_id"))
    model = toxicity.fit(labelled.select("text", "label", "doc_id"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    return model.score(docs).select("doc_id", (code % 5 == 0).alias("held_out"), "score",
                                    (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path()).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", F.col("n_gone").alias("n_removed_words"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences, _ = trie.encode(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    turns = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4, F.lit(0)).cast("int")
    nodes, ends = trie.prefix_trie(trie.rebase(sequences, F.col("conv_id") - F.col("conv_id") % 20, turns, 3))
    digests = trie.ends_digests(ends).select(F.col("conv_id").alias("_id"), F.col("depth").alias("_depth"), "ends_sha256")
    out = nodes.join(digests, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("depth") == F.col("_depth")), "left").drop("_id", "_depth")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


QUERIES: dict[str, QueryFn] = {
    "op1_bpe_encoding": op1_bpe_encoding,
    "op2_decontamination": op2_decontamination,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_html_extraction": op6_html_extraction,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_jaccard_join": op13_jaccard_join,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {**_SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
