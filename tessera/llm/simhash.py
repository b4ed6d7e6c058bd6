"""SimHash near-duplicates by pigeonhole blocks (operator 3).

Fingerprint: the words of a text between ASCII white space, A-Z lowered, give shingles of
``shingle`` words (repeats included; a text with fewer words is one shingle), hashed by XXH64 with
seed 42. A bit is set when it is set in over half the hashes. A text without words has
fingerprint 0 and is linked like any other.

Linking: equal fingerprints are one node from the start. Distinct fingerprints are cut into
``max_distance + 2`` blocks of bits; two that differ in at most ``max_distance`` bits agree in at
least two blocks, so they meet in one of the joins on two blocks (32 bits at distance 2), where
their Hamming distance is verified. A bucket of more than ``BUCKET`` fingerprints isn't joined with
itself. There each fingerprint goes to the points reached by flipping up to half the distance of
its other bits; two within the distance share a point, and all at a point are linked to its
smallest fingerprint, itself within the distance. So a bucket of n makes O(n) rows, none of its
links' components are lost, and no group is ever held by one task.

Defined results: NULL texts are empty; ties go to the smallest id; NULL ids come after all others
and a group of NULL ids only has component NULL; repeated rows are copies of each other; other
columns are ignored (``dedup`` passes them through); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, row_key, slices, written
from .components import components

SHINGLE = 3        # words
MAX_DISTANCE = 2   # bits
BUCKET = 16        # largest bucket that is joined with itself
SEED = 42
PIECE = 1 << 20    # bytes of one text handled at a time
_SPACE = re.compile(rb"[ \t-\r]")


def _bit_counts(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the shingles of ``words`` (at least ``shingle`` words)."""
    import xxhash

    digest, text = xxhash.xxh64_intdigest, b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = len(words) - shingle + 1
    at = zip((ends - size)[:n].tolist(), ends[shingle - 1:].tolist())
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in at), np.uint64, n)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), n


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    counts, n, words, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = _SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        words += text[at:end].lower().split()
        at = end
        if len(words) >= shingle:
            more, m = _bit_counts(words, shingle)
            counts, n = counts + more, n + m
            words = words[len(words) - shingle + 1:]
    if n == 0:
        if not words:
            return 0
        counts, n = _bit_counts([b" ".join(words)], 1)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, fp`` (signed 64-bit) for each row."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    schema = rows.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) if t else 0 for t in b.column(2).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "key", "fp"])

    return rows.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect all within ``max_distance`` bits."""
    n = max_distance + 2
    edge = [64 * i // n for i in range(n + 1)]
    masks = [sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in two) for two in combinations(range(n), 2)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("c", "block"))
    sizes = keyed.groupBy("c", "block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(keyed.join(sizes, ["c", "block"]))

    def distance(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b))

    small = members.filter(F.col("n") <= bucket).select("c", "block", "fp")
    pairs = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["c", "block"])
             .filter((F.col("a") < F.col("b")) & (distance(F.col("a"), F.col("b")) <= max_distance)).select("a", "b"))

    near, far = max_distance // 2, (max_distance + 1) // 2
    flips = [[(_signed(sum(1 << i for i in bits)), r <= near)
              for r in range(far + 1) for bits in combinations([i for i in range(64) if not m >> i & 1], r)] for m in masks]
    table = F.array(*[F.array(*[F.struct(F.lit(x).alias("x"), F.lit(close).alias("close")) for x, close in f]) for f in flips])
    points = (members.filter(F.col("n") > bucket)
              .select("c", "block", "fp", F.explode(F.element_at(table, F.col("c") + 1)).alias("f"))
              .select("c", "block", "fp", F.col("fp").bitwiseXOR(F.col("f.x")).alias("point"), F.col("f.close").alias("close")))
    hubs = (points.groupBy("c", "block", "point").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"),
                                                     F.count(F.lit(1)).alias("k")).filter("hub IS NOT NULL AND k > 1").drop("k"))
    spokes = (points.join(hubs, ["c", "block", "point"])
              .filter((F.col("fp") != F.col("hub")) & (distance(F.col("fp"), F.col("hub")) <= max_distance))
              .select(F.col("hub").alias("a"), F.col("fp").alias("b")))
    return pairs.union(spokes).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, fp, first``: for each row the first (``null, id, key``) of its component, NULL ids last."""
    rows = written(fingerprints(docs, shingle, id_col, text))
    order = F.struct(F.col("id").isNull().alias("null"), "id", "key")
    fps = rows.groupBy("fp").agg(F.min(order).alias("first"))
    roots = components(links(fps.select("fp"), max_distance))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted)
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(rooted.select("fp", "root").join(groups, "root").select("fp", "first"), "fp")


def dedup(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
          id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each component; repeated rows of it count as one. The columns of ``docs``."""
    found = near_duplicates(docs, shingle, max_distance, id_col, text)
    own, id_, key = (free_prefix(docs) + c for c in ("own", "id", "key"))
    kept = (found.filter(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")))
            .select(F.col("id").alias(id_), F.col("key").alias(key)).distinct())
    return (docs.withColumn(own, row_key(text))
            .join(kept.hint("merge"), F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key)), "left_semi")
            .dropDuplicates([id_col, own]).select(*docs.columns))
