"""Line dedup by winnowing over line hashes, in Spark expressions only (operator 7).

A document is its sequence of lines with a word, each hashed after trimming. Every window of
``run`` consecutive lines marks its smallest hash (the leftmost of equals), so any stretch of
``run`` or more equal lines in two places marks the same lines in both: a guaranteed fingerprint.
Marked lines are joined on their hash with the hashes marked in more than one place; each joined
position is then extended both ways, to all windows of ``run`` lines around it that mark it. A
window is a later repeat when the same ``run`` lines start at an earlier place, in the order (first
document id, content key, position). The lines of later repeats are deleted: overlapping windows
make up the maximal run, whatever its length.

Shorter runs that hold at least ``words`` words count too: each window of fewer than ``run`` lines
with so many words is compared whole (None: off).

So a line is deleted exactly when it lies in a run of at least ``run`` lines or ``words`` words that
occurs earlier, in another document or in its own; the first occurrence stays.

Defined results: NULL or empty texts have no lines and stay as they are; lines without a word are
not part of runs and go or stay with the line with a word before them (leading ones, after them);
documents with fewer than ``run`` lines lose nothing but passages of ``words`` words; a very long text
is one row of one task and linear work; a repeated row (same id, same text) is the
same document and is treated alike; NULL ids sort first; other columns pass through; an empty
table gives an empty result.

Plan: positions never meet in pairs. Repeats are found by minima per hash, combined before the
shuffle, and joined back by hash, where adaptive execution splits a hot hash's rows. Marks first
thin the rows: unique lines, the great majority, leave after one small aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, row_key, written
from .quality import words_of

RUN = 3     # least lines of a repeated run
WORDS = 50  # ... or least words, on fewer lines


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(" \t\n\x0b\f\r")))


def _sequences(docs: DataFrame, id_col: str, text: str, run: int, *more: Column) -> DataFrame:
    """``id, key, hashes`` (lines with a word, in order) and ``more``, one row per document long enough."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (docs.filter(F.col(text).isNotNull())
            .select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.transform(lines, _line_hash).alias("hashes"), *more)
            .filter(F.size("hashes") >= run))


def _marks(seq: DataFrame, run: int) -> DataFrame:
    """``id, key, at, mark, windows``: a marked line and the windows (``start, h1, h2``) that mark it."""
    starts = F.sequence(F.lit(1), F.size("hashes") - run + 1)
    windows = seq.select("id", "key", "hashes", F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.xxhash64(F.slice("hashes", i, run)).alias("h1"), F.hash(F.slice("hashes", i, run)).alias("h2"),
        (i - 1 + F.array_position(F.slice("hashes", i, run), F.array_min(F.slice("hashes", i, run)))).cast("int").alias("at"),
    )).alias("windows"))
    marked = windows.select("id", "key", "hashes", "windows",
                            F.explode(F.array_distinct(F.transform("windows", lambda w: w["at"]))).alias("at"))
    return marked.select("id", "key", "at", F.col("hashes")[F.col("at") - 1].alias("mark"), F.filter(
        F.slice("windows", F.greatest(F.col("at") - run + 1, F.lit(1)), run),
        lambda w: w["at"] == F.col("at")).alias("windows"))


def repeated_windows(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, start`` (1-based, among the lines with a word) of windows that occur earlier."""
    marks = _marks(_sequences(docs, id_col, text, run), run)
    place = F.struct("id", "key", "at")
    often = (marks.groupBy("mark").agg(F.min(place).alias("a"), F.max(place).alias("b"))
             .filter(~F.col("a").eqNullSafe(F.col("b"))).select("mark"))
    near = written(marks.join(written(often), "mark").select("id", "key", F.explode("windows").alias("w"))
                   .select("id", "key", "w.start", "w.h1", "w.h2"))
    place = F.struct("id", "key", "start")
    first = (near.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .filter(~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first"))
    return (near.join(first, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
            .select("id", "key", "start").distinct())


def repeated_passages(docs: DataFrame, words: int, run: int = RUN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, start, n`` of windows of ``n < run`` lines with at least ``words`` words that occur earlier."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    seq = _sequences(docs, id_col, text, 1, F.transform(lines, lambda x: F.size(words_of(x))).alias("counts"))
    sized = [F.transform(F.sequence(F.lit(1), F.size("hashes")), lambda i: F.struct(
        i.alias("start"), F.lit(n).alias("n"), F.aggregate(F.slice("counts", i, n), F.lit(0), lambda a, b: a + b).alias("held"),
        F.xxhash64(F.slice("hashes", i, n)).alias("h1"), F.hash(F.slice("hashes", i, n)).alias("h2"))) for n in range(1, run)]
    windows = written(seq.select("id", "key", F.explode(F.filter(F.flatten(F.array(*sized)), lambda w: (w["held"] >= words)
                                 & (w["start"] + w["n"] - 1 <= F.size("hashes")))).alias("w"))
                      .select("id", "key", "w.start", "w.n", "w.h1", "w.h2"))
    place = F.struct("id", "key", "start")
    first = (windows.groupBy("n", "h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .filter(~F.col("first").eqNullSafe(F.col("last"))).select("n", "h1", "h2", "first"))
    return (windows.join(first, ["n", "h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
            .select("id", "key", "start", "n").distinct())


def deleted_lines(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text: str = "text",
                  words: int | None = WORDS) -> DataFrame:
    """``_id, _key, gone``: sorted 1-based positions among the lines with a word to delete, per document."""
    starts = repeated_windows(docs, run, id_col, text).withColumn("n", F.lit(run))
    if words is not None and run > 1:
        starts = starts.unionByName(repeated_passages(docs, words, run, id_col, text))
    return (starts.select("id", "key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos"))
            .groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
            .agg(F.sort_array(F.collect_set("pos")).alias("gone")))


def dedup_lines(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text: str = "text",
                words: int | None = WORDS) -> DataFrame:
    """``docs`` with later repeated runs taken out of ``text``, and ``n_lines``, ``n_deleted`` (lines with a word)."""
    keep = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_deleted")])
    own, id_, key, gone, lines, worded, starts, stay = (free_prefix(docs) + c for c in ("own", "id", "key", "gone", "lines", "worded", "from", "stay"))
    deleted = deleted_lines(docs, run, id_col, text, words).toDF(id_, key, gone).hint("merge")  # one plan at every size
    out = keep.withColumn(own, row_key(text)).join(
        deleted, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key)), "left")
    out = out.withColumn(lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    # a line's number is that of the last line with a word up to it: a running count by position lists
    out = out.withColumn(worded, F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i)),
                                          lambda i: i.isNotNull()))
    # stretches of \n-split lines: from one line with a word up to the next
    later = F.slice(worded, F.lit(2), F.greatest(F.size(worded) - 1, F.lit(0)))
    out = out.withColumn(starts, F.when(F.size(worded) > 0, F.concat(F.array(F.lit(0)), later, F.array(F.size(lines)))))
    out = out.withColumn(stay, F.array_except(F.sequence(F.lit(1), F.size(worded)), F.col(gone)))
    rest = F.array_join(F.flatten(F.transform(stay, lambda p: F.slice(
        F.col(lines), F.col(starts)[p - 1] + 1, F.col(starts)[p] - F.col(starts)[p - 1]))), "\n")
    out = out.withColumns({"n_lines": F.size(worded).cast("long"),
                           "n_deleted": F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long"),
                           text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(rest)})
    return out.select(*keep.columns, "n_lines", "n_deleted")
