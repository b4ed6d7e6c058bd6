"""Removal of repeated byte strings by hash grouping of sampled suffixes (operator 10).

A byte goes when it is covered by a string of ``length`` bytes that also starts anywhere else, in
another document or its own. That asks which suffixes share a prefix of ``length`` bytes with
another one, so equal prefixes must come together in one group.

Sorting all suffixes, as a difference cover of period three does (two thirds of all positions in
the first pass, each a shuffled row, then the recursion and the merge), writes over twenty times
the input to shuffles. The cover here is chosen by content instead of by residue, which needs about
one position in ``SAMPLE / 2``, and works as a cover for the same reason: any two equal strings of
``length`` bytes hold sampled positions at the same places.

1. Sample. The window that starts at p takes the position in [p, p + SAMPLE) whose next ``GRAM``
   bytes have the smallest hash (the leftmost of equals). It depends on the window's bytes only.
   The windows with one sampled position a are a block; all of them hold the ``length + 1 - SAMPLE``
   bytes from a on. The sampled suffix's name is a hash of these bytes.
2. Group sampled suffixes by name. Blocks whose name is alone hold no repeat.
3. Among blocks of one name, blocks of equal bytes form a class. All windows of a class with two
   members or more are repeats.
4. Merge the remaining suffixes: where a name has several classes, every window of one member of
   each class is grouped by (name, hash of its bytes); windows that share a group are repeats.
5. The repeated windows of a document, as byte ranges, are taken out of its text.

Each step is exact up to two 64-bit hashes: bytes are compared by a hash within a name, which is one too. Only
filters of bounded size are broadcast. A name shared by many documents is counted before it is shuffled and its rows are
joined by hash, where adaptive execution splits them; no step lists pairs.

The same steps over residues (``residues``, off by default): the sampled positions are those whose place
in their text is, modulo ``RESIDUES[0]``, in a difference cover, so that any two places have a common shift to
sampled ones. A window then has several sampled positions, and a block is the windows before one of them. It is
exact as well and needs several times the rows; README has the figures.

Defined results: texts are their UTF-8 bytes, NULL is empty; a repeated row is a document of its
own, so it repeats the other; texts shorter than ``length`` lose nothing; the bytes that stay may
cut a character, so they are binary; other columns pass through, and new columns replace old ones
of the same name; an empty table gives an empty result. Long texts are read in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_buffers, row_key, slices, written
from .hashing import PrefixHash, filter_of, passes

LENGTH = 400    # bytes of a repeated string
SAMPLE = 96     # a position is sampled from every so many
GRAM = 16       # bytes that decide which
SLICE = 1 << 18  # bytes of texts handled at a time (numpy holds about a hundred times that)
PIECE = 1 << 20  # window starts of one long text handled at a time
#: fixed values: a period and residues whose differences are all numbers below it
RESIDUES = (133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121))
_PLACE = np.uint64((1 << 26) - 1)


def _sampled(h: PrefixHash, n: int, sample: int, gram: int) -> np.ndarray:
    """For each place p of a buffer of ``n`` bytes: the sampled position of the window at p."""
    at = np.arange(n - gram + 1)
    key = (h.of(at, at + gram) & ~_PLACE) | at.astype(np.uint64)
    # smallest of each stretch of ``sample`` keys, by minima from both ends of fixed blocks
    rows = -(-len(key) // sample) + 1
    padded = np.full(rows * sample, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    padded = padded.reshape(rows, sample)
    to = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:len(key)], to[sample - 1: sample - 1 + len(key)]) & _PLACE).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(batch, bytes, offsets, rows, place)``: texts long enough; a very long one in overlapping pieces."""
    for b in slices(batches, "text", SLICE):
        data, off = byte_buffers(b.column(b.schema.get_field_index("text")))
        if b.num_rows == 1:
            for at in range(0, max(1, len(data) - length + 1), PIECE):
                part = data[at: at + PIECE + length - 1]
                yield b, part, np.array([0, len(part)]), np.array([0]), at
        else:
            yield b, data, off, np.arange(b.num_rows), 0


def _blocks(data: np.ndarray, off: np.ndarray, length: int, sample: int, gram: int):
    """``(text, start, stop, at, name, bytes)`` of all blocks: first window, after the last, sampled position, two hashes."""
    n = len(data)
    sizes = np.diff(off)
    if n == 0 or sizes.max() < length:
        return None
    h = PrefixHash(data)
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(np.arange(n) + length <= off[1:][text])
    at = _sampled(h, n, sample, gram)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    start, stop, at = starts[first], starts[last] + 1, at[first]
    return text[start], start, stop, at, h.of(at, at + length + 1 - sample), h.of(start, stop - 1 + length)


def _residue_blocks(data: np.ndarray, off: np.ndarray, length: int, place: int, residues: tuple[int, tuple[int, ...]]):
    """As ``_blocks``, for the positions whose place in the text is in the cover (``place``: that of the texts' first bytes here)."""
    period, cover = residues
    sizes = np.diff(off)
    if len(data) == 0 or sizes.max() < length:
        return None
    h = PrefixHash(data)
    text = np.repeat(np.arange(len(sizes)), sizes)
    own = np.arange(len(data)) - off[text]
    sampled = np.zeros(period, bool)
    sampled[list(cover)] = True
    at = np.flatnonzero(sampled[(own + place) % period])
    text = text[at]
    start = np.maximum(off[text], at - period + 1)
    stop = np.minimum(at, off[text + 1] - length) + 1
    some = np.flatnonzero(start < stop)
    text, at, start, stop = text[some], at[some], start[some], stop[some]
    # all its windows hold the length + 1 - period bytes from a sampled position on
    name, bytes_ = h.of(at, at + length + 1 - period), h.of(start, stop - 1 + length)
    order = np.lexsort((name, stop, start))
    same = np.zeros(len(order), bool)
    same[1:] = (start[order][1:] == start[order][:-1]) & (stop[order][1:] == stop[order][:-1]) & (name[order][1:] == name[order][:-1])
    order = order[~same]  # short periodic texts: one block under several sampled positions
    return text[order], start[order], stop[order], at[order], name[order], bytes_[order]


def _names(rows: DataFrame, length: int, blocks) -> DataFrame:
    """``name``: of sampled suffixes that are not alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, off, _, place in _pieces(batches, length):
            found = blocks(data, off, length, place)
            if found:
                name, n = np.unique(found[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))], names=["name", "n"])

    return rows.select("text").mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name")


def _members(rows: DataFrame, bitmap, length: int, blocks) -> DataFrame:
    """``id, key, start, stop, name, bytes`` of blocks whose name passes the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off, rows_, place in _pieces(batches, length):
            found = blocks(data, off, length, place)
            if found:
                keep = passes(bitmap.value, found[4])
                text, start, stop, _, name, bytes_ = (x[keep] for x in found)
                row = pa.array(rows_[text])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), pa.array(start - off[text] + place), pa.array(stop - off[text] + place),
                     pa.array(name.view(np.int64)), pa.array(bytes_.view(np.int64))], names=names)

    names = ["id", "key", "start", "stop", "name", "bytes"]
    schema = T.StructType(rows.select("id", "key").schema.fields + [T.StructField(c, T.LongType()) for c in names[2:]])
    return rows.mapInArrow(run, schema)


def _passing(rows: DataFrame, key: Column, bitmap, wanted: bool = True) -> DataFrame:
    """Rows whose key passes the filter, or the others. Python gets the keys alone, the rows stay in the JVM."""
    @F.arrow_udf("boolean")
    def hit(key: pa.Array) -> pa.Array:
        return pa.array(passes(bitmap.value, key.to_numpy().view(np.uint64)) == wanted)

    return rows.filter(hit(key))


def _windows(rows: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """``id, key, start, name, window, single``: every window of the given blocks of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary())
            blocks = b.column(b.schema.get_field_index("blocks"))
            for i in range(b.num_rows):
                data = np.frombuffer(texts[i].as_buffer(), np.uint8)
                for x in blocks[i].as_py():
                    part = PrefixHash(data[x["start"]: x["stop"] - 1 + length])
                    n = x["stop"] - x["start"]
                    at = np.arange(n)
                    h = part.of(at, at + length)
                    one = pa.array([i] * n)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(one), b.column(1).take(one), pa.array(at + x["start"]), pa.array(np.full(n, x["name"])),
                         pa.array(h.view(np.int64)), pa.array([x["single"]] * n)], names=names)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= 20_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    names = ["id", "key", "start", "name", "window", "single"]
    schema = T.StructType(rows.select("id", "key").schema.fields + [T.StructField(c, T.LongType()) for c in names[2:5]]
                          + [T.StructField("single", T.BooleanType())])
    both = rows.join(ranges.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    return both.select("id", "key", "text", "blocks").mapInArrow(gathered, schema)


def repeated_ranges(rows: DataFrame, length: int = LENGTH, sample: int = SAMPLE, gram: int = GRAM, residues=None) -> DataFrame:
    """``_id, _key, ranges``: sorted first and after-last starts of runs of repeated windows of each text (``id, key, text``)."""
    if residues is None and not gram <= sample <= length + 1 - gram:
        raise ValueError("gram <= sample <= length + 1 - gram is needed")
    if residues is not None and ({(a - b) % residues[0] for a in residues[1] for b in residues[1]} != set(range(residues[0])) or residues[0] > length):
        raise ValueError("residues are a period of at most length and a difference cover of it")

    def found(data: np.ndarray, off: np.ndarray, length: int, place: int):
        if residues is None:
            return _blocks(data, off, length, sample, gram)
        return _residue_blocks(data, off, length, place, residues)

    sc = rows.sparkSession.sparkContext
    names = written(_names(rows, length, found))
    blocks = written(_members(rows, sc.broadcast(filter_of(names, "name")), length, found).join(names.hint("merge"), "name"))
    place = F.struct("id", "key", "start", "stop")
    classes = written(blocks.groupBy("name", "bytes").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")))
    whole = blocks.join(classes.filter("n > 1").select("name", "bytes").hint("merge"), ["name", "bytes"]).select("id", "key", "start", "stop")
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("name")
    mixed = classes.join(several.hint("merge"), "name").select("one.*", "name", (F.col("n") == 1).alias("single"))
    ranges = written(mixed.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
                     .agg(F.collect_list(F.struct("start", "stop", "name", "single")).alias("blocks")))
    # a repeated row (same id and text) is one member of a class: its windows are taken once
    some = _passing(rows, F.col("key"), sc.broadcast(filter_of(ranges, "_key"))).dropDuplicates(["id", "key"])
    windows = _windows(some, ranges, length)
    # blocks of one text overlap under residues: a window counts once under a name
    windows = written(windows if residues is None else windows.dropDuplicates(["id", "key", "start", "name"]))
    equal = windows.groupBy("name", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name", "window")
    parts = (windows.filter("single").join(equal.hint("merge"), ["name", "window"])
             .select("id", "key", "start", (F.col("start") + 1).alias("stop")))
    return (whole.unionByName(parts).groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
            .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("ranges")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text", **cover) -> DataFrame:
    """``docs`` with ``kept`` (binary) and ``spans``: array<struct<start, stop>> of the maximal removed byte runs."""
    sc = docs.sparkSession.sparkContext
    keep = docs.select(*[c for c in docs.columns if c not in ("kept", "spans")])
    rows = docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.col(text).alias("text"))
    ranges = written(repeated_ranges(rows, length, **cover))
    all_rows = keep.select(F.struct(*keep.columns).alias("row"), F.col(id_col).alias("id"), row_key(text).alias("key"))
    bitmap = sc.broadcast(filter_of(ranges, "_key"))
    hit = _passing(all_rows, F.col("key"), bitmap)
    hit = hit.join(ranges.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").select("row", "ranges")
    field = keep.columns.index(text)
    span = "array<struct<start: bigint, stop: bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(at, 128) for x in batches for at in range(0, x.num_rows, 128)):
            own = b.column(0).flatten()
            texts, kept, spans = own[field].cast(pa.binary()), [], []
            for t, r in zip(texts, b.column(1)):
                if not r.is_valid:
                    kept.append(t.as_py() or b"")
                    spans.append([])
                    continue
                gone: list[list[int]] = []
                for x in r.as_py():
                    if gone and x["start"] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], x["stop"] - 1 + length)
                    else:
                        gone.append([x["start"], x["stop"] - 1 + length])
                whole = t.as_py()
                ends = [0, *(e for g in gone for e in g), len(whole)]
                kept.append(b"".join(whole[a:z] for a, z in zip(ends[::2], ends[1::2])))
                spans.append([{"start": a, "stop": z} for a, z in gone])
            yield pa.RecordBatch.from_arrays([*own, pa.array(kept, pa.binary()), pa.array(spans, kind)], names=names)

    names = [*keep.columns, "kept", "spans"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = T.StructType([*keep.schema.fields, *T.StructType.fromDDL(f"kept binary, spans {span}").fields])
    rest = _passing(keep, row_key(text), bitmap, False).select(
        *keep.columns, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("kept"), F.array().cast(span).alias("spans"))
    return hit.mapInArrow(run, schema).unionByName(rest)
