"""Benchmark decontamination by a prefix-filtered set join (operator 2).

Words are runs of ASCII digits and letters (A-Z lowered) and of all characters from U+0080 on. A
benchmark item's windows are its stretches of ``window`` consecutive words; a shorter item is one
window. A window is the set of its shingles (``SHINGLE`` words, or the whole item where that is
shorter), and since all of them must be found, its necessary prefix is one shingle: the rarest.

1. Count the benchmark's shingles in all documents (partial counts per task). A shingle that no
   document has rules out its windows.
2. For every window take its rarest shingle; these are the prefix tokens, each with its place in
   its item and the item's words around it, as far as windows reach.
3. Documents give (prefix token, words around it) and are joined with the items on the token. A
   pair is in bounds when enough words stand before and after (position and length bounds).
4. Verify word by word: the run of equal words around the token. A run of a window's length or
   more is covered by windows; every occurring window is found through its own rarest shingle.

Only filters of bounded size are broadcast (``hashing.filter_of``); they thin the document side
before the joins. A passage shared by many documents makes a row for each of them and item that
holds it; adaptive execution splits such a token's rows.

Defined results: NULL texts have no words; items without words are ignored, NULL item ids mark
words but are not listed; repeated rows of documents give repeated results; repeated items count
once; a very long text is one row of one task, read whole; other columns are ignored
(``decontaminate`` passes them through, whatever their names); empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_buffers, free_prefix, row_key, slices, written
from .hashing import PrefixHash, filter_of, mix, passes

WINDOW = 13   # words of a window
SHINGLE = 4   # words of a shingle
MIN_PCT = 5   # a document is contaminated from this percentage of hit words on

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


class Words:
    """Words of the texts in a buffer: their places, hashes and text numbers."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = _LOWER[data]
        inside = _IN_WORD[self.low]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1] | self._at(offsets[:-1], len(data))[1:]
            last[:-1] &= ~inside[1:] | self._at(offsets[:-1], len(data))[1:]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.cumsum(self.count) - self.count  # first word of each text
        self.hash = PrefixHash(self.low).of(self.start, self.end)

    @staticmethod
    def _at(places: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, bool)
        out[places[places < n]] = True
        return out

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all shingles of ``size`` words."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[size - 1:])
        h = np.full(len(at), size, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + self.hash[at + j]
        return at, mix(h)

    def around(self, word: int, size: int, window: int) -> tuple[str, int]:
        """The words that windows with the shingle at ``word`` can reach, joined by spaces; words before it."""
        t = self.text[word]
        a = max(self.first[t], word - (window - size))
        b = min(self.first[t] + self.count[t], word + window)
        return b" ".join([self.low[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b])]).decode(), int(word - a)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for b in slices(batches, "text"):
        yield b, Words(*byte_buffers(b.column(b.schema.get_field_index("text"))))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _item_shingles(benchmark: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """``item, key, pos, size, hash, need, words, before``: every shingle of every item."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), row_key(text).alias("key"), F.col(text).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, w in _words(batches):
            rows = []
            size_of = np.minimum(w.count, shingle)
            for size in range(1, shingle + 1):
                at, h = w.shingles(size)
                own = size_of[w.text[at]] == size
                for i, x in zip(at[own].tolist(), h[own].view(np.int64).tolist()):
                    t = int(w.text[i])
                    rows.append((b.column(0)[t].as_py(), b.column(1)[t].as_py(), i - int(w.first[t]), size, x,
                                 min(window, int(w.count[t])), *w.around(i, size, window)))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    schema = pa.schema([("item", pa.string()), ("key", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()),
                        ("hash", pa.int64()), ("need", pa.int32()), ("words", pa.string()), ("before", pa.int32())])
    return items.mapInArrow(run, "item string, key long, pos int, size int, hash long, need int, words string, before int")


def _count_shingles(docs: DataFrame, bitmap, sizes: list[int]) -> DataFrame:
    """``hash, n``: how often documents (``id, key, text``) have each shingle that passes the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w in _words(batches):
            for size in sizes:
                _, h = w.shingles(size)
                found, n = np.unique(h[passes(bitmap.value, h)], return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return docs.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _prefixes(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows of ``shingles`` that are the rarest of some window; windows with an absent shingle have none."""
    counted = shingles.select("item", "key", "pos", "size", "hash", "need").join(counts, "hash", "left")
    items = counted.groupBy("item", "key", "size", "need").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "hash"))).alias("s"))
    per = F.col("need") - F.col("size") + 1  # shingles of a window
    windows = items.select("item", "key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("s") - per + 1),
        lambda i: F.array_min(F.transform(F.slice("s", i, per), lambda x: F.struct(
            F.coalesce(x["n"], F.lit(0)).alias("n"), x["hash"].alias("hash"), x["pos"].alias("pos")))))).alias("rarest"))
    chosen = windows.filter("rarest.n > 0").select("item", "key", F.col("rarest.pos").alias("pos")).distinct()
    return (shingles.alias("s").join(chosen.alias("c"), F.col("s.item").eqNullSafe(F.col("c.item")) & (F.col("s.key") == F.col("c.key"))
                                     & (F.col("s.pos") == F.col("c.pos"))).select("s.*"))


def _scan(docs: DataFrame, bitmap, sizes: list[int], window: int) -> DataFrame:
    """``id, key, n_words, tokens``: for each row its words and the prefix tokens that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, w in _words(batches):
            tokens: list[list] = [[] for _ in range(b.num_rows)]
            for size in sizes:
                at, h = w.shingles(size)
                hit = passes(bitmap.value, h)
                for i, x in zip(at[hit].tolist(), h[hit].view(np.int64).tolist()):
                    words, before = w.around(i, size, window)
                    tokens[w.text[i]].append({"hash": x, "at": i - int(w.first[w.text[i]]), "words": words, "before": before})
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(w.count.astype(np.int64)), pa.array(tokens, kind)],
                                             names=["id", "key", "n_words", "tokens"])

    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("words", pa.string()), ("before", pa.int32())]))
    schema = T.StructType(docs.select("id", "key").schema.fields + T.StructType.fromDDL(
        "n_words long, tokens array<struct<hash: bigint, at: bigint, words: string, before: int>>").fields)
    return docs.mapInArrow(run, schema)


def _verified(found: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``id, key, item, a, b``: words ``a`` to ``b`` (exclusive) of a document are a run of item words, long enough."""
    d = found.select("id", "key", F.explode("tokens").alias("t")).select(
        "id", "key", F.col("t.hash").alias("hash"), F.col("t.at").alias("at"), F.col("t.before").alias("d_before"), F.split("t.words", " ").alias("d"))
    p = prefixes.select("hash", "item", "size", "need", F.col("before").alias("p_before"), F.split("words", " ").alias("p"))
    # position and length bounds: no run is longer than the words both have on each side
    before = F.least("d_before", "p_before")
    after = F.least(F.size("d") - F.col("d_before"), F.size("p") - F.col("p_before"))
    j = d.join(p, "hash").withColumns({"before": before, "after": after}).filter(F.col("before") + F.col("after") >= F.col("need"))
    same = F.zip_with(F.slice("d", F.col("d_before") - F.col("before") + 1, F.col("before") + F.col("after")),
                      F.slice("p", F.col("p_before") - F.col("before") + 1, F.col("before") + F.col("after")), lambda x, y: x == y)
    j = j.withColumn("same", same)
    back = F.array_position(F.reverse(F.slice("same", 1, F.col("before"))), F.lit(False))
    on = F.array_position(F.slice("same", F.col("before") + 1, F.col("after")), F.lit(False))
    j = j.withColumns({"left": F.when(back == 0, F.col("before")).otherwise(back - 1),
                       "right": F.when(on == 0, F.col("after")).otherwise(on - 1)})
    return (j.filter((F.col("right") >= F.col("size")) & (F.col("left") + F.col("right") >= F.col("need")))
            .select("id", "key", "item", (F.col("at") - F.col("left")).alias("a"), (F.col("at") + F.col("right")).alias("b")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, min_pct: int = MIN_PCT,
                  id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, key, n_words, n_hit, items`` (sorted ids as strings), ``contaminated`` for each row of ``docs``."""
    sc, shingle = docs.sparkSession.sparkContext, min(shingle, window)
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    shingles = written(_item_shingles(benchmark, item_id, item_text, window, shingle))
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())  # at most ``shingle``
    counts = _count_shingles(rows, sc.broadcast(filter_of(shingles, "hash")), sizes)
    prefixes = written(_prefixes(shingles, counts))
    found = written(_scan(rows, sc.broadcast(filter_of(prefixes, "hash")), sizes, window))
    runs = _verified(found, prefixes).distinct()

    def cover(state, r):
        return F.struct((state["n"] + F.greatest(r["b"] - F.greatest(r["a"], state["to"]), F.lit(0))).alias("n"),
                        F.greatest(state["to"], r["b"]).alias("to"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    hit = runs.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("runs"),
                                        F.sort_array(F.collect_set("item")).alias("items"))
    hit = hit.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.aggregate("runs", zero, cover)["n"].alias("n_hit"), "items")
    out = found.select("id", "key", "n_words").join(hit, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("id", "key", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * min_pct)).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = contamination(docs, benchmark, id_col=id_col, text=text, **rule).filter("contaminated")
    own, id_, key = (free_prefix(docs) + c for c in ("own", "id", "key"))
    bad = bad.select(F.col("id").alias(id_), F.col("key").alias(key)).distinct()
    return (docs.withColumn(own, row_key(text))
            .join(bad.hint("merge"), F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key)), "left_anti").drop(own))
