"""Ranked lexical search over bit-sliced Bloom signatures (operator 12).

Terms are runs of ASCII digits and letters (A-Z lowered) and of all characters from U+0080 on. A
document's score for a query is the sum over the query's terms, repeats included, of
``w * ((1e9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))``
and ``m = 25 + (75 * n * N) div L`` (N documents with a term, L their terms, n the document's).

1. Index. Each document has a Bloom signature of its terms, ``BITS`` bits a key; a term that occurs
   2, 4, 8, ... times is a key of each of these tiers too. Documents are gathered into tiles of one
   signature width, and a tile is stored by bit: one row bitmap over its documents for every bit of
   the signature. The index is written to the shared folder and knows nothing of the queries.
2. Document frequencies of the queries' terms are counted exactly, term by term.
3. Bounds. The row bitmaps of a term's bits, and-ed, hold every document with the term and some
   others. Their sums, weighted by ``w`` and by what each tier can add at the document's length,
   are never below the score. The documents with the highest bounds of each query are scored
   exactly; the last place among them is a floor under the query's last place.
4. All documents whose bound reaches the floor are scored exactly from their whole texts; the
   others are proven to be out. A weak bound only adds work.

Only narrow rows are shuffled: counts per term, (query, document) candidates. Candidates meet the
texts by a semi-join on the document, broadcast up to ``BROADCAST_ROWS`` counted rows and merged
beyond. Queries go in blocks of ``BLOCK`` items, and only a block reaches the driver and the tasks.

Defined results: NULL and empty texts have no terms, are not counted and never found; NULL ids come
last among equal scores; every row is a document, so repeated rows each take a place; repeated
items are one query, and items of one id with different texts are queries of their own; items
without terms find nothing; a very long text is read whole in one task; other columns are ignored;
empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappush, heapreplace
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.paging import with_row_index
from .common import byte_buffers, row_key, slices, written
from .decontam import _IN_WORD, Words
from .hashing import mix

PLACES = 10
BITS = 12            # signature bits per key
PROBES = 3           # bits set by a key
TIERS = 7            # a key for each of tf >= 1, 2, 4, ... 64
TILE = 4096          # documents gathered at a time
TILE_BITS = 1 << 25  # most bits of a tile
FIRST = 32           # documents per query that are scored to find its floor
BLOCK = 512          # items handled in one pass
BROADCAST_ROWS = 1 << 20


def term_strings(w: Words) -> pa.Array:
    """The terms of a buffer as one Arrow array, without a Python object per term."""
    ends = np.concatenate(([0], np.cumsum(w.end - w.start))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(w.start), pa.py_buffer(ends), pa.py_buffer(w.low[_IN_WORD[w.low]]))


def _tier(hashes: np.ndarray, tier: int) -> np.ndarray:
    return hashes if tier == 0 else mix(hashes + np.uint64(tier))


def _slots(keys: np.ndarray, probe: int, width: int) -> np.ndarray:
    return ((keys + np.uint64(probe) * (keys >> np.uint64(32) | np.uint64(1))) & np.uint64(width - 1)).astype(np.int64)


# --------------------------------------------------------------------------- index

def _keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(text, key)`` of all signature keys of a buffer, ordered by text."""
    order = np.lexsort((w.hash, w.text))
    text, h = w.text[order], w.hash[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    text, h = text[at], h[at]
    texts, keys = [text], [h]
    for t in range(1, TIERS):
        often = tf >= 1 << t
        if often.any():
            texts.append(text[often])
            keys.append(_tier(h[often], t))
    return np.concatenate(texts), np.concatenate(keys)


def _tiles(rows: list[tuple], texts: np.ndarray, keys: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Tiles of the given documents (``id, key, n``; ``texts`` number them), by signature width."""
    n_keys = np.bincount(texts, minlength=len(rows))
    widths = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(1, n_keys * BITS)))).astype(np.int64)
    order = np.argsort(texts, kind="stable")
    keys, ends = keys[order], np.cumsum(n_keys)
    for width in np.unique(widths).tolist():
        all_of = np.flatnonzero(widths == width)
        step = max(8, TILE_BITS // width)
        for a in range(0, len(all_of), step):
            own = all_of[a: a + step]
            held = np.concatenate([keys[ends[i] - n_keys[i]: ends[i]] for i in own])
            row = np.repeat(np.arange(len(own)), n_keys[own])
            bits = np.zeros((width, -(-len(own) // 8) * 8), bool)
            for p in range(PROBES):
                bits[_slots(held, p, width), row] = True
            yield pa.RecordBatch.from_arrays([
                pa.array([[rows[i][0] for i in own]], pa.list_(kind)), pa.array([[rows[i][1] for i in own]], pa.list_(pa.int64())),
                pa.array([[rows[i][2] for i in own]], pa.list_(pa.int64())), pa.array([width], pa.int64()),
                pa.array([np.packbits(bits, axis=1).tobytes()], pa.binary())], names=["ids", "keys", "sizes", "width", "slices"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The signatures of all documents with a term: tiles ``ids, keys, sizes, width, slices``, not yet written."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
                           *T.StructType.fromDDL("keys array<bigint>, sizes array<bigint>, width bigint, slices binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, keys, kind = [], [], [], None
        for b in slices(batches, "text"):
            kind = b.schema.field(0).type
            w = Words(*byte_buffers(b.column(2)))
            some = np.flatnonzero(w.count)
            number = np.full(b.num_rows, -1)
            number[some] = np.arange(len(some)) + len(held)
            t, k = _keys(w)
            texts.append(number[t])
            keys.append(k)
            ids, row_keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            held += [(ids[i], row_keys[i], int(w.count[i])) for i in some]
            if len(held) >= TILE or sum(map(len, keys)) >= TILE_BITS // 16:
                yield from _tiles(held, np.concatenate(texts), np.concatenate(keys), kind)
                held, texts, keys = [], [], []
        if held:
            yield from _tiles(held, np.concatenate(texts), np.concatenate(keys), kind)

    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------------------- queries

@dataclass
class Block:
    """Queries of one block: number of documents and terms, the block's vocabulary, its weights and postings."""
    n_docs: int
    n_terms: int
    vocabulary: list[str]
    hashes: np.ndarray   # of each vocabulary term
    weights: np.ndarray  # of each vocabulary term
    items: np.ndarray    # postings by item: item number, term number, repeats
    terms: np.ndarray
    repeats: np.ndarray

    def bounds(self, width: int, sizes: np.ndarray, blob: bytes) -> np.ndarray:
        """``(items, documents)`` upper bounds of the scores in one tile."""
        q, n = int(self.items.max()) + 1, len(sizes)
        data = np.frombuffer(blob, np.uint8).reshape(width, -1)
        m = 25 + 75 * sizes * self.n_docs // self.n_terms
        out, reached = np.zeros((q, n), np.int64), np.zeros(n, np.int64)
        order = np.argsort(self.terms, kind="stable")
        per = np.bincount(self.terms, minlength=len(self.hashes))
        first = np.cumsum(per) - per
        for t in range(TIERS):
            keys = _tier(self.hashes, t)
            found = data[_slots(keys, 0, width)]
            for p in range(1, PROBES):
                found = found & data[_slots(keys, p, width)]
            term, doc = np.nonzero(np.unpackbits(found, axis=1, count=n))
            if not len(term):
                break  # nothing in this tier, and what is in a higher one is in this
            k = per[term]
            posting = order[np.repeat(first[term] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
            held = np.bincount(self.items[posting] * n + np.repeat(doc, k), minlength=q * n,
                               weights=(self.weights[self.terms[posting]] * self.repeats[posting]).astype(np.float64))
            most = np.minimum(sizes, (2 << t) - 1) if t < TIERS - 1 else sizes
            factor = 1_000_000_000 * most // (1000 * most + 8 * m)
            out += held.astype(np.int64).reshape(q, n) * (factor - reached)
            reached = factor
        return out

    def scores(self, tf: np.ndarray, n: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of one document of ``n`` terms for the wanted items (sorted numbers)."""
        m = 25 + 75 * n * self.n_docs // self.n_terms
        own = self.weights * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        first, last = np.searchsorted(self.items, wanted), np.searchsorted(self.items, wanted, side="right")
        return np.array([int((own[self.terms[a:z]] * self.repeats[a:z]).sum()) for a, z in zip(first, last)], np.int64)


def document_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How many rows of ``docs`` hold each term of a vocabulary of bounded size."""
    terms = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms.value, pa.large_string())
        n = np.zeros(len(known), np.int64)
        for b in slices(batches, "text"):
            w = Words(*byte_buffers(b.column(0)))
            at = pc.fill_null(pc.index_in(term_strings(w), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = np.unique(w.text[at >= 0] * len(known) + at[at >= 0])
            n += np.bincount(pairs % len(known), minlength=len(known))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["term", "n"])

    counts = (docs.select(F.col(text).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")))
    return {vocabulary[r["term"]]: r["n"] for r in counts.collect()}  # at most the vocabulary


def _block(docs: DataFrame, rows: list, n_docs: int, n_terms: int) -> Block | None:
    """The queries ``rows`` (``number, text``) with the weights of their terms."""
    w = Words(*byte_buffers(pa.array([r["text"] for r in rows], pa.string())))
    strings = term_strings(w).to_pylist()
    if not strings:
        return None
    vocabulary = sorted(set(strings))
    number = {t: i for i, t in enumerate(vocabulary)}
    df = document_frequencies(docs, vocabulary)
    pairs, repeats = np.unique(w.text * len(vocabulary) + np.array([number[t] for t in strings]), return_counts=True)
    v = Words(*byte_buffers(pa.array(vocabulary)))
    weights = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in vocabulary], np.int64)
    return Block(n_docs, n_terms, vocabulary, v.hash, weights, pairs // len(vocabulary), pairs % len(vocabulary), repeats)


def _with_bounds(index: DataFrame, block, least: np.ndarray | None, id_type: T.DataType) -> DataFrame:
    """``item, id, key`` of documents whose bound reaches ``least``, or of the ``FIRST`` highest bounds of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        kind = None
        for b in batches:
            kind = b.schema.field(0).type.value_type
            for i in range(b.num_rows):
                ids, keys = b.column(0)[i].values, b.column(1)[i].values
                bound = block.value.bounds(b.column(3)[i].as_py(), b.column(2)[i].values.to_numpy(), b.column(4)[i].as_py())
                if least is not None:
                    q, doc = np.nonzero(bound >= np.maximum(least, 1)[: len(bound), None])
                    yield pa.RecordBatch.from_arrays([pa.array(q), ids.take(pa.array(doc)), keys.take(pa.array(doc)), pa.array(bound[q, doc])], names=names)
                    continue
                lowest = np.array([best[q][0][0] if len(best.get(q, ())) == FIRST else 0 for q in range(len(bound))])
                for q, doc in zip(*(x.tolist() for x in np.nonzero(bound > lowest[:, None]))):
                    heap, entry = best.setdefault(q, []), (int(bound[q, doc]), keys[doc].as_py(), str(ids[doc].as_py()), ids[doc].as_py())
                    if len(heap) < FIRST:
                        heappush(heap, entry)
                    elif entry[:3] > heap[0][:3]:
                        heapreplace(heap, entry)
        if best:
            rows = [(q, e[3], e[1], e[0]) for q, heap in best.items() for e in heap]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), kind, pa.int64(), pa.int64()))], names=names)

    names = ["item", "id", "key", "bound"]
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("id", id_type), *T.StructType.fromDDL("key long, bound long").fields])
    return index.mapInArrow(run, schema)


def _exact(docs: DataFrame, pairs: DataFrame, block) -> DataFrame:
    """``item, id, score`` of the given pairs (``item, id, key``), from the whole texts of ``docs`` (``id, key, text``)."""
    wanted = written(pairs.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.sort_array(F.collect_set("item")).alias("items")))
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted.hint("merge")
    both = docs.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("id", "text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = block.value
        known = pa.array(q.vocabulary, pa.large_string())
        for b in slices(batches, "text"):
            w = Words(*byte_buffers(b.column(1)))
            at = pc.fill_null(pc.index_in(term_strings(w), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            item, row, score = [], [], []
            for i in range(b.num_rows):
                a = w.first[i]
                own = at[a: a + w.count[i]]
                numbers = b.column(2)[i].values.to_numpy()
                item.append(numbers)
                row.append(np.full(len(numbers), i))
                score.append(q.scores(np.bincount(own[own >= 0], minlength=len(known)), int(w.count[i]), numbers))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(item)), b.column(0).take(pa.array(np.concatenate(row))),
                                              pa.array(np.concatenate(score))], names=["item", "id", "score"])

    schema = T.StructType([T.StructField("item", T.LongType()), docs.schema["id"], T.StructField("score", T.LongType())])
    return both.mapInArrow(run, schema).filter("score > 0")


def _top(rows: DataFrame, places: int, *order) -> DataFrame:
    """The first ``places`` rows of each item; Spark cuts them inside the tasks first."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= places)


def search(docs: DataFrame, queries: DataFrame, places: int = PLACES, index: DataFrame | None = None, id_col: str = "doc_id",
           text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, id, score``: each query's highest-scoring documents. ``index`` is one of ``build_index`` over ``docs``, written."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    index = written(build_index(docs, id_col, text)) if index is None else index
    sizes = index.agg(F.sum(F.size("sizes").cast("long")).alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("l")).first()
    items = queries.select(F.col(item_id).alias("item_id"), row_key(item_text).alias("key"), F.col(item_text).alias("text")).distinct()
    items = written(with_row_index(items, ["item_id", "key"], "number"))
    kinds = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), rows.schema["id"], T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], kinds)
    id_type = rows.schema["id"].dataType
    best = (F.col("score").desc(), F.col("id").asc_nulls_last())
    for first in range(0, items.count() if sizes["n"] else 0, BLOCK):
        own = items.filter((F.col("number") >= first) & (F.col("number") < first + BLOCK))
        queries_of = _block(rows, own.select("number", "text").orderBy("number").collect(), sizes["n"], sizes["l"])
        if queries_of is None:
            continue
        block = spark.sparkContext.broadcast(queries_of)
        likely = _top(_with_bounds(index, block, None, id_type), FIRST, F.col("bound").desc())
        floors = _top(_exact(rows, likely, block), places, *best).filter(F.col("rank") == places).select("item", "score").collect()  # a row per item
        least = np.zeros(BLOCK, np.int64)
        for r in floors:
            least[r["item"]] = r["score"]
        found = _top(_exact(rows, _with_bounds(index, block, least, id_type), block), places, *best)
        out = out.unionByName(found.join(own.select((F.col("number") - first).alias("item"), "item_id"), "item")
                              .select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
    return out
