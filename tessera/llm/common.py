"""Helpers shared by the training-data operators: tables, shared-folder writes, Arrow text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written  # noqa: F401

SLICE_BYTES = 1 << 20  # text handled at a time inside a task; one longer text is handled alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """64-bit key of a row's content. Rows that share it with their id are repeats of one row."""
    return F.xxhash64(*cols)


def free_prefix(df: DataFrame) -> str:
    """Underscores with which no column of ``df`` begins: internal columns named by it clash with none."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def byte_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of an Arrow string column; NULL counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece holds about ``most`` bytes of ``column``."""
    for b in batches:
        if b.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield b.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def ragged_arange(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + n)`` for each pair; the gather index of an offset table."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
