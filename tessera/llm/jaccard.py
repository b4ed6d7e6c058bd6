"""N-gram Jaccard join of documents (operator 13).

A document is the set of its distinct shingles of ``shingle`` words (words between ASCII white
space, A-Z lowered; a shorter text is one shingle). Two documents link when
``100 * intersection >= percent * union``. Shingles are 64-bit hashes. Documents of equal sets are
one node from the start; everything below is about distinct sets.

1. Tiles. Sizes are cut into bands, each ``100 / percent`` times wider than the one before, so a
   set's partners lie in its own band and the two beside it. Sets linked within a band, or with the
   next one, differ in at most D shingles, D fixed by the band. The hash range is cut into D + 1
   parts: a linked pair agrees in all shingles of some part. A tile holds the sets of one band pair
   that agree in one part (about nine shingles). A part without shingles is a tile only for sets
   that could have a partner with which they agree in empty parts alone; few can.
2. Hubs. Every set of a tile is compared with the tile's first by the two sorted arrays, so a tile of n sets gives n
   pairs. The shingles that only one of the two has are kept: the set's difference. Links make components. Where a tile
   is then one component, nothing is left to find in it.
3. Other tiles are compared within themselves, in blocks of ``TILE`` sets, but for sets already
   connected: hashed bitmap signatures first, whose bit counts bound the overlap from above
   (each bit set on one side only is a shingle that is not shared), then the sets.
4. There a pair is verified exactly by the two differences: a shingle is in one set only if it is in one difference only.
   A link joins the components of its two sets within the block, so a block gives fewer links than it has sets,
   however many of its pairs are near or over the limit.

No link between different sets is lost, whatever a tile's size: one that is not listed joins sets that listed links
connect. Only sets that share a tile with a different set
have their shingles read again, stored and shuffled. Two sets with one 64-bit node hash would be
taken for copies; a second hash is compared for every node, and the job fails if they differ.

Defined results: NULL and empty texts have no shingles and link with nothing, each its own
component; a component is named by its smallest id, NULL only if all its ids are NULL; repeated
rows are copies; other columns are ignored; very long texts are one set in one task; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_buffers, list_column, ragged_arange, row_key, slices, written
from .components import components
from .hashing import PrefixHash, mix

SHINGLE = 3          # words
PERCENT = 90         # least intersection, per cent of the union
TILE = 256           # sets compared at a time in step 3
BLOCK_SHINGLES = 1 << 20  # a block of sets of many shingles is smaller
MAX_SIGNATURE = 1 << 16  # bits
BROADCAST_ROWS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[9:14] = _IN_WORD[32] = False
_SALTS = tuple(np.uint64(s) for s in (0x51ED270B6F3A94C5, 0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, hash)`` of the distinct shingles of each text of a buffer, sorted by text, then hash."""
    low = _LOWER[data]
    inside = _IN_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1] if len(low) else inside
    after = np.concatenate((inside[1:], [False])) & ~edge[1:] if len(low) else inside
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    count = np.bincount(text, minlength=len(offsets) - 1)
    word = PrefixHash(low).of(start, end)

    def joined(at: np.ndarray, size: int) -> np.ndarray:
        h = np.full(len(at), size, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + word[at + j]
        return mix(h)

    n = len(word) - shingle + 1
    at = np.flatnonzero(text[:n] == text[shingle - 1:]) if n > 0 else np.zeros(0, np.int64)
    texts, hashes = [text[at]], [joined(at, shingle)]
    first = np.cumsum(count) - count
    for size in range(1, shingle):
        short = np.flatnonzero(count == size)
        texts.append(short)
        hashes.append(joined(first[short], size))
    text, h = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


@lru_cache(8)
def _bands(percent: int) -> np.ndarray:
    """First sizes of the bands, up to 2 ** 40 shingles."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return np.array(out)


def _summed(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2 ** 64 per group; ``groups`` ascend."""
    out = np.zeros(n, np.uint64)
    if len(values):
        new = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        out[groups[new]] = np.add.reduceat(values, new)
    return out


def _tile_keys(text: np.ndarray, h: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, key)`` of the tiles of each set, as the smaller or equal (its own band) and the larger (the band before)."""
    lows, texts, keys = _bands(percent), [], []
    band = np.searchsorted(lows, sizes, side="right") - 1
    for back in (0, 1):
        of = band - back
        last = np.where(of >= 0, lows[np.maximum(of, 0) + 1] - 1, 0)  # largest size in the band
        differ = last * (100 - percent) // percent                    # most that any pair of the tile differs in
        parts = np.where((sizes > 0) & (differ > 0), differ + 1, 0)
        first = np.cumsum(parts) - parts
        part = ((h >> np.uint64(32)) * parts[text].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        place = (first[text] + part)[parts[text] > 0]
        total = int(parts.sum())
        held = np.bincount(place, minlength=total)
        owner = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(total) - first[owner]
        tile = mix(of[owner].astype(np.uint64) << np.uint64(40) | number.astype(np.uint64))
        key = mix(_summed(mix(h[parts[text] > 0] ^ _SALTS[0]), place, total) ^ tile)
        # most that this set and a partner in the tile can differ in
        own = sizes * (100 - percent) // percent if back == 0 else (np.minimum(sizes, last) + sizes) * (100 - percent) // (100 + percent)
        empty = np.bincount(owner[held == 0], minlength=len(sizes))
        some = (held > 0) | (empty + own >= parts)[owner]
        texts.append(owner[some])
        keys.append(key[some])
    return np.concatenate(texts), np.concatenate(keys)


def profiles(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, n, node, check, tiles``: size and two hashes of each row's set, and the keys of its tiles."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            t, h = shingle_sets(*byte_buffers(b.column(2)), shingle)
            n = np.bincount(t, minlength=b.num_rows)
            of, keys = _tile_keys(t, h, n, percent)
            order = np.argsort(of, kind="stable")
            ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=b.num_rows))))
            hashes = [pa.array(_summed(mix(h ^ s), t, b.num_rows).view(np.int64)) for s in _SALTS[1:]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), *hashes, list_column(keys[order].view(np.int64), ends, pa.int64())],
                                             names=schema.names)

    schema = T.StructType([*rows.schema.fields[:2], *T.StructType.fromDDL("n long, node long, check long, tiles array<bigint>").fields])
    return rows.mapInArrow(run, schema)


def _features(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``node, n, shingles, bits``: sorted shingle hashes and signature of each node (``node, id, key``), from ``docs`` (``id, key, text``)."""
    few = nodes.count() <= BROADCAST_ROWS
    n = nodes.select("node", F.col("id").alias("_id"), F.col("key").alias("_key"))
    rows = docs.join(F.broadcast(n) if few else n.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            t, h = shingle_sets(*byte_buffers(b.column(1)), shingle)
            n = np.bincount(t, minlength=b.num_rows)
            ends = np.concatenate(([0], np.cumsum(n)))
            bits = [signature(h[a:z]).tobytes() for a, z in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), list_column(h.view(np.int64), ends, pa.int64()), pa.array(bits, pa.binary())],
                                             names=["node", "n", "shingles", "bits"])

    found = rows.select("node", "text").mapInArrow(run, "node long, n long, shingles array<bigint>, bits binary")
    return found.dropDuplicates(["node"])  # repeated rows of the chosen document


def signature(h: np.ndarray) -> np.ndarray:
    """Bitmap of a set, four to eight bits a shingle: uint8, at least 64 bits. Half of it folded on the other is the narrower bitmap."""
    width = 1 << min(MAX_SIGNATURE.bit_length() - 1, max(6, int(4 * max(1, len(h)) - 1).bit_length()))
    bits = np.zeros(width, bool)
    bits[(mix(h ^ _SALTS[0]) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, width), axis=-2)


def overlap_bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b):
    """Most shingles that two sets can share, by the bits that only one of the signatures has. ``b`` and ``n_b`` may be rows of others."""
    width = min(len(a), b.shape[-1])
    a, b = _folded(a, width), _folded(b, width)
    return np.minimum(n_a - np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64), n_b - np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64))


def _linked(shared, n_a, n_b, percent: int):
    return 100 * shared >= percent * (n_a + n_b - shared)


def compared(pairs: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked, apart`` of the pairs ``a, b`` (nodes): whether they link, and the sorted shingles that only one of them has."""
    def side(x: str) -> DataFrame:
        return features.select(*[F.col(c).alias(n) for c, n in (("node", x), ("shingles", f"s_{x}"))]).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(at, 512) for x in batches for at in range(0, x.num_rows, 512)):
            hit, apart = [], []
            for s, t in zip(b.column(2), b.column(3)):
                s, t = s.values.to_numpy(), t.values.to_numpy()
                apart.append(np.setxor1d(s, t, assume_unique=True))
                hit.append(_linked((len(s) + len(t) - len(apart[-1])) // 2, len(s), len(t), percent))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in apart])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hit, pa.bool_()),
                                              list_column(np.concatenate([*apart, np.zeros(0, np.int64)]), ends, pa.int64())],
                                             names=["a", "b", "linked", "apart"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")
    return both.mapInArrow(run, "a long, b long, linked boolean, apart array<bigint>")


def _rest(members: DataFrame, roots: DataFrame, features: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between sets of one tile (``tile, hub, node, n``) that are in different components, enough to connect all that links connect.

    ``apart`` (``node, hub, apart``) holds the differences of the sets from their tiles' hubs.
    """
    m = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = (m.groupBy("tile").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"),
                                   F.bit_xor(F.xxhash64("node")).alias("same")).filter("x <> y"))
    # tiles of the same sets are one
    split = split.groupBy("sets", "shingles", "same", "x", "y").agg(F.min("tile").alias("tile"))
    blocks = F.ceil(F.least(F.col("sets"), F.greatest(F.col("sets") / TILE, F.col("shingles") / BLOCK_SHINGLES)))
    m = m.join(split.select("tile", blocks.alias("blocks")), "tile").withColumn("i", F.pmod(F.xxhash64("node"), "blocks"))
    m = m.join(features.select("node", "bits"), "node").join(apart.hint("merge"), ["node", "hub"])
    # block i meets every block from itself on
    cols = ["tile", "node", "root", "n", "bits", "apart"]
    m = m.select(*cols, "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"))
    m = m.select(*cols, F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), (F.col("i") <= F.col("j")).alias("left"),
                 (F.col("i") >= F.col("j")).alias("right"))

    def run(table: pa.Table) -> pa.Table:
        nodes, n = (table.column(c).to_numpy() for c in ("node", "n"))
        part = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]  # components, joined as links are found
        bits = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
        width = min(map(len, bits))
        flat = np.stack([_folded(x, width) for x in bits])
        own = table.column("apart").combine_chunks()
        differ = own.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(differ) - differ
        held, place = np.unique(own.flatten().to_numpy(), return_inverse=True)
        mark = np.zeros(len(held), bool)
        left, right = (np.flatnonzero(table.column(c).to_numpy()) for c in ("left", "right"))
        a, b = [], []
        for i in left:
            other = right[part[right] != part[i]]
            if not len(other):
                continue
            other = other[_linked(overlap_bound(flat[i], n[i], flat[other], n[other]), n[i], n[other], percent)]
            mine = place[start[i]: start[i] + differ[i]]
            mark[mine] = True
            total = np.concatenate(([0], np.cumsum(mark[place[ragged_arange(start[other], differ[other])]])))
            mark[mine] = False
            ends = np.cumsum(differ[other])
            only = differ[i] + differ[other] - 2 * (total[ends] - total[ends - differ[other]])  # shingles that one of the two sets has
            for j in other[_linked((n[i] + n[other] - only) // 2, n[i], n[other], percent)]:
                if part[j] != part[i]:
                    a.append(nodes[i])
                    b.append(nodes[j])
                    part[part == part[j]] = part[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return m.groupBy("tile", "p", "q").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component`` for each row: the smallest id reachable by links."""
    texts = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    rows = written(profiles(docs, shingle, percent, id_col, text))
    some = rows.filter("n > 0")
    first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "key"))
    nodes = some.groupBy("node").agg(first.alias("first"), F.min("check").alias("x"), F.max("check").alias("y"))
    nodes = written(nodes.select("node", F.when(F.col("x") == F.col("y"), F.col("first")).otherwise(
        F.raise_error(F.lit("two shingle sets share a 64-bit hash")).cast(nodes.schema["first"].dataType)).alias("first")))
    places = some.select("node", "n", F.explode("tiles").alias("tile"))
    shared = places.groupBy("tile").agg(F.min("node").alias("hub"), F.max("node").alias("y")).filter("hub <> y").select("tile", "hub")
    members = written(places.join(written(shared), "tile").distinct())
    held = members.select("node").distinct().join(nodes, "node").select("node", "first.id", "first.key")
    features = written(_features(texts, written(held), shingle))
    hubs = written(compared(members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), features, percent))
    links = hubs.filter("linked").select("a", "b")
    apart = hubs.select(F.col("a").alias("node"), F.col("b").alias("hub"), "apart").unionByName(
        members.filter("node = hub").select("node", "hub", F.array().cast("array<bigint>").alias("apart")).distinct())
    more = _rest(members, components(links), features, apart, percent)
    roots = components(links.union(more))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first.id").alias("component"))
    named = written(rooted.select("node", "root").join(least, "root").select("node", "component"))
    linked = some.select("id", "n", "node").join(named.hint("merge"), "node").select("id", F.col("n").alias("n_shingles"), "component")
    return linked.unionByName(rows.filter("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component")))
