"""Sums of doubles that do not depend on the order of their rows.

Every addend is cut into three integer digits of 31 bits below a common exponent, the largest
of all rows, and the digits are added as integers: in 64 bits inside a task, as decimals between
tasks. Integer sums are the same in any order, so a retried task or another partitioning gives the
same bits. An addend keeps 93 bits below the largest one, so its own 53 bits are whole down to
``2 ** -40`` of the largest; what lies below is rounded per addend, not per sum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vector import matrix

DIGIT, DIGITS = 31, 3
HELD_BYTES = 1 << 25   # sums that a task holds before it hands them on
HELD_ROWS = 1 << 30    # addends of a 64-bit sum of digits
_CELLS = 1 << 20       # coordinates cut at a time


def digits(values: np.ndarray, exponent) -> np.ndarray:
    """``(DIGITS, *values.shape)``: integers whose sum over ``a[i] * 2 ** (exponent - DIGIT * (i + 1))`` is the value."""
    out = np.empty((DIGITS, *values.shape), np.int64)
    rest = np.ldexp(values, DIGIT - exponent)
    for i in range(DIGITS):
        whole = np.rint(rest)
        out[i] = whole
        rest = np.ldexp(rest - whole, DIGIT)
    return out


def exponents(points: DataFrame, x: str, weight: Column) -> tuple[int, int]:
    """Exponents above all ``weight`` and all ``weight * x``: one aggregate of maxima."""
    largest = F.aggregate(x, F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    row = points.agg(F.max(F.abs(weight)).alias("w"), F.max(largest).alias("x")).first()
    if any(v is not None and not math.isfinite(v) for v in row):
        raise ValueError("invalid vector or weight: non-finite")
    w, v = (math.frexp(row[c] or 0.0)[1] for c in ("w", "x"))
    return w, w + v


def group_sums(rows: DataFrame, exponent: tuple[int, int]) -> DataFrame:
    """``g, s, sw``: Σ w·x (``array<double>``) and Σ w of the rows ``g, x, w`` of each ``g``, NULL included.

    Rows without a vector or weight add nothing; a group of such rows is left out. A task holds
    at most ``HELD_BYTES`` of sums and hands on one row per group, so a group of any size sends a
    row per task; between tasks the coordinates of a group are added apart.
    """
    above_w, above_x = exponent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        n = 0

        def flushed() -> pa.RecordBatch:
            sums = np.stack(list(held.values()))  # group, digit, coordinate
            at = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[2])
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), kind), *(pa.ListArray.from_arrays(at, pa.array(sums[:, i].ravel())) for i in range(DIGITS))],
                names=names)

        for b in batches:
            kind = b.schema.field("g").type
            b = b.filter(pc.and_(b.column(1).is_valid(), b.column(2).is_valid()))
            if not b.num_rows:
                continue
            X, _ = matrix(b.column(1))
            w = b.column(2).to_numpy(zero_copy_only=False)
            if not np.isfinite(w).all():
                raise ValueError("invalid weight: non-finite")
            coded = b.column(0).dictionary_encode(null_encoding="encode")
            groups, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            above = np.array([above_w] + [above_x] * X.shape[1])
            step = max(1, _CELLS // len(above))
            for s in range(0, len(w), step):
                order = np.argsort(code[s:s + step], kind="stable")
                own = code[s:s + step][order]
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                some = w[s:s + step, None]
                cut = digits(np.hstack([some, some * X[s:s + step]])[order], above)
                sums = np.add.reduceat(cut, first, axis=1)
                for i, c in enumerate(own[first]):
                    before = held.get(groups[c])
                    if before is not None and before.shape[1] != sums.shape[2]:
                        raise ValueError("mixed vector dimensions")
                    held[groups[c]] = sums[:, i] if before is None else before + sums[:, i]
            n += len(w)
            if n >= HELD_ROWS or len(held) * len(above) * 8 * DIGITS >= HELD_BYTES:
                yield flushed()
                held, n = {}, 0
        if held:
            yield flushed()

    names = ["g", *(f"a{i}" for i in range(DIGITS))]
    schema = T.StructType([T.StructField("g", rows.schema["g"].dataType)] + [T.StructField(c, T.ArrayType(T.LongType())) for c in names[1:]])
    parts = rows.select("g", "x", F.col("w").cast("double").alias("w")).mapInArrow(run, schema)
    apart = parts.select("g", F.posexplode(F.arrays_zip(*names[1:])).alias("pos", "a"))
    sums = apart.groupBy("g", "pos").agg(*[F.sum(F.col(f"a.{c}").cast("decimal(20,0)")).alias(c) for c in names[1:]])
    value = F.lit(0.0)
    for i in reversed(range(DIGITS)):  # the smallest first
        value = value + F.col(f"a{i}").cast("double") * F.lit(2.0 ** (-DIGIT * (i + 1)))
    value = value * F.when(F.col("pos") == 0, F.lit(2.0 ** above_w)).otherwise(F.lit(2.0 ** above_x))
    vectors = sums.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("pos", value.alias("v")))).alias("all"))  # dim + 1 rows
    return vectors.select("g", F.transform(F.slice("all", 2, F.size("all") - 1), lambda e: e["v"]).alias("s"), F.col("all")[0]["v"].alias("sw"))
