"""Quality rules with cross-document line frequency, in Spark expressions only (operator 8).

Base rules look at one text: word and symbol counts, repeated lines, and words in repeated 8-word
windows. The cross-document rule hashes normalised lines (white space trimmed and collapsed, case
folded, each number as 0), counts the distinct documents of a host that hold each line, removes lines above the
host's limit, and rejects documents that keep too little.

Documents of one host with the same text count once, so a popular document does not turn its own
lines into boilerplate. A host's limit is ``max(min_docs, max_share * distinct documents)``; lines
in more documents than that are removed. A document is depleted when fewer than ``min_words``
words or less than ``min_kept`` of its words remain.

Defined results: NULL text has no words and fails the base rules; NULL hosts are one host; repeated
rows give repeated results; a very long text is one row of one task; other columns pass through
``apply_quality`` and ``judge``, whose own columns replace old ones of the same name, and are ignored elsewhere; empty tables give empty results.

Plan: one pass counts lines. Lines are made distinct within a document, then per (host, line,
text) - the key spreads a hot line over the partitions - then counted. Lines above the limit are
few (their number per host is at most the host's mean lines per document over ``max_share``);
they are written to the shared folder, so Spark knows their size when it plans the second pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, row_key, written

SPACE = r"[\x20\x09-\x0D]"
MIN_WORDS = 20        # base rule and depletion: fewest words
MAX_REPEAT_PCT = 30   # base rule: most words in repeated windows, per cent
WINDOW = 8            # words in a window
MIN_DOCS = 10         # a line in no more documents of a host is never removed
MAX_SHARE = 0.1       # ... nor one in no more than this share of the host's documents
MIN_KEPT = 0.5        # depletion: least share of words kept


def words_of(text: Column) -> Column:
    """``array<string>`` of the words ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_hash(line: Column) -> Column:
    """Hash of a line's words, case folded; the line's normal form."""
    return F.xxhash64(F.lower(F.regexp_replace(F.trim(F.regexp_replace(line, SPACE + "+", " ")), "\\p{Nd}+", "0")))


def base_columns(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    Windows are hashed from word hashes; only a text that holds a repeated window (by a linear
    distinct count) sorts its windows. Every step is linear in the text, the sort aside.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words, hashes, windows, in_order, at, lines = (free_prefix(docs) + c for c in ("words", "hashes", "windows", "sorted", "at", "lines"))
    a = docs.withColumn(words, words_of(F.col(text)))
    a = a.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    a = a.withColumn(windows, F.when(
        F.size(hashes) >= window,
        F.transform(F.sequence(F.lit(1), F.size(hashes) - window + 1),
                    lambda i: F.xxhash64(F.slice(F.col(hashes), i, window)))).otherwise(F.array().cast("array<bigint>")))
    # (hash, position) in order; a window is repeated when a neighbour has its hash
    a = a.withColumn(in_order, F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.size(in_order) - 1
    hit = F.filter(in_order, lambda x, k: (
        (k > 0) & (F.col(in_order)[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])
        | (k < last) & (F.col(in_order)[F.least(k + 1, last)]["h"] == x["h"])))
    a = a.withColumn(at, F.array_sort(F.transform(hit, lambda x: x["i"])))
    # words covered by windows at the sorted positions: each adds what the next does not reach
    a = a.withColumn(lines, F.filter(lines_of(F.col(text)), _has_word))
    covered = F.aggregate(
        F.transform(F.col(at), lambda i, k: F.when(
            k < F.size(at) - 1, F.least(F.lit(window), F.col(at)[F.least(k + 1, F.size(at) - 1)] - i)).otherwise(window)),
        F.lit(0), lambda x, y: x + y)
    n_words, n_repeat = F.size(words).cast("long"), F.coalesce(covered, F.lit(0)).cast("long")
    out = a.withColumns({
        "n_words": n_words,
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.size(F.split(t, r"[#*$%&|<>]")) - 1).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": n_repeat,
    })
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    return out.drop(words, hashes, windows, in_order, at, lines)


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text",
                   min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``host, line`` (hash) of the lines in too many distinct documents of their host."""
    own = docs.select(F.col(host).alias("host"), F.xxhash64(text).alias("doc"),
                      F.array_distinct(F.transform(F.filter(lines_of(F.col(text)), _has_word), line_hash)).alias("lines"))
    n_docs = (own.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n")))
    held = own.select("host", "doc", F.explode("lines").alias("line")).distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > min_docs)
    return (counts.alias("c").join(n_docs.alias("d"), F.col("c.host").eqNullSafe(F.col("d.host")))
            .filter(F.col("docs") > F.greatest(F.lit(float(min_docs)), max_share * F.col("n")))
            .select(F.col("c.host").alias("host"), "line"))


def removed_lines(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id",
                  host: str = "source", text: str = "text") -> DataFrame:
    """``_id, _key, positions (0-based, of \\n-split lines), n_gone (words)`` of documents with frequent lines."""
    lines = docs.select(F.col(id_col).alias("_id"), row_key(text).alias("_key"), F.col(host).alias("_host"),
                        F.posexplode(lines_of(F.col(text))).alias("_pos", "_line")).filter(_has_word(F.col("_line")))
    lines = lines.select("_id", "_key", "_host", "_pos", line_hash(F.col("_line")).alias("_hash"),
                         F.size(words_of(F.col("_line"))).alias("_n"))
    f = frequent.select(F.col("host").alias("_fhost"), F.col("line").alias("_fline"))
    hits = lines.join(f, (F.col("_hash") == F.col("_fline")) & F.col("_host").eqNullSafe(F.col("_fhost")))
    # a repeated row gives each of its positions again: made distinct before they are counted
    return (hits.select("_id", "_key", "_host", "_pos", "_n").distinct().groupBy("_id", "_key", "_host")
            .agg(F.sort_array(F.collect_list("_pos")).alias("positions"), F.sum("_n").alias("n_gone")))


def judge(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_kept: float = MIN_KEPT) -> DataFrame:
    """``docs`` with the base columns, ``gone`` (positions of removed lines), ``n_gone`` (their words), ``kept``."""
    gone = removed_lines(docs, written(frequent_lines(docs, host, text, min_docs, max_share)), id_col, host, text)
    own, id_, key, host_ = (free_prefix(docs) + c for c in ("own", "id", "key", "host"))
    docs = docs.select(*[c for c in docs.columns if c not in ("gone", "n_gone", "kept")])
    base = base_columns(docs, text).withColumn(own, row_key(text))
    out = base.join(gone.toDF(id_, key, host_, "gone", "n_gone"),
                    F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key))
                    & F.col(host).eqNullSafe(F.col(host_)), "left").drop(id_, key, host_, own)
    left = F.col("n_words") - F.coalesce("n_gone", F.lit(0))
    return out.withColumn("n_gone", F.coalesce("n_gone", F.lit(0)).cast("long")).withColumn(
        "kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= min_kept * F.col("n_words")))


def apply_quality(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text", **limits) -> DataFrame:
    """The documents kept, without their removed lines; the columns of ``docs``."""
    own, id_, host_, key, gone, lines = (free_prefix(docs) + c for c in ("own", "id", "host", "key", "gone", "lines"))
    verdict = judge(docs.select(id_col, host, text), id_col, host, text, **limits).select(
        F.col(id_col).alias(id_), F.col(host).alias(host_), row_key(text).alias(key), "kept", F.col("gone").alias(gone))
    # written, so that the filter is on a stored column and not on all that leads to it
    verdict = written(verdict).filter("kept").select(id_, host_, key, gone).dropDuplicates([id_, host_, key])
    out = docs.withColumn(own, row_key(text)).join(
        verdict.hint("merge"),
        F.col(id_col).eqNullSafe(F.col(id_)) & F.col(host).eqNullSafe(F.col(host_)) & (F.col(own) == F.col(key)))
    out = out.withColumn(lines, lines_of(F.col(text)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(left, lambda i: F.col(lines)[i]), "\n")
    return out.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(rest)).select(*docs.columns)
