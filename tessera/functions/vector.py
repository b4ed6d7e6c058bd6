"""Dense-vector column expressions (``array<double>``).

Distances against a *literal centre set* (a small list of vectors held by the
driver, size-checked by the caller) run in an Arrow-batched numpy kernel
(``arrow_udf``). Measured on 200k 64-dim points with 10 centres: 0.65 s, against
4.0 s for the JVM higher-order-function form and 5.7 s for an unrolled JVM
expression (which outgrows the 64 KB method limit at k·dim ≈ 640 and
recompiles for every new centre set).

Distances between two *columns* use ``aggregate(zip_with(...))``.

Both add the squared differences in coordinate order 0..dim-1 starting from
0.0, so they give the same double.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VECTOR_TYPE = "array<double>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(c: Column | str) -> Column:
    """Cast any numeric array to ``array<double>``."""
    return _col(c).cast(VECTOR_TYPE)


def is_literal_vector(y) -> bool:
    """True for a Python/numpy vector; Column has a catch-all ``__getattr__``, so test it first."""
    if isinstance(y, (Column, str)):
        return False
    return isinstance(y, (list, tuple)) or hasattr(y, "tolist")


def sq_distance(x: Column | str, y: Column | str | Sequence[float]) -> Column:
    """Squared Euclidean distance between ``x`` and ``y`` (JVM higher-order functions)."""
    x = _col(x)
    y = vector_literal(_as_floats(y)) if is_literal_vector(y) else _col(y)
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: (a - b) * (a - b)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def distance(x: Column | str, y: Column | str | Sequence[float]) -> Column:
    """Euclidean distance (not squared)."""
    return F.sqrt(sq_distance(x, y))


def _as_floats(y) -> list[float]:
    return [float(v) for v in (y.tolist() if hasattr(y, "tolist") else y)]


# Largest centre set (k·dim·8 bytes) shipped to the tasks; k is the caller's choice.
MAX_CENTER_BYTES = 64 * 1024 * 1024
_BLOCK_CELLS = 1 << 20


def check_center_budget(k: int, dim: int, max_bytes: int = MAX_CENTER_BYTES) -> None:
    size = int(k) * int(dim) * 8
    if size > max_bytes:
        raise ValueError(
            f"centre set of k={k} x dim={dim} ({size} bytes) exceeds the broadcast budget "
            f"of {max_bytes} bytes; reduce k or raise MAX_CENTER_BYTES"
        )


def distance_matrix(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """``(k, n)`` Euclidean distances between the rows of C and the rows of X.

    One summation order for every size: squared differences are added in
    coordinate order, over blocks of rows. The dimensions must agree.
    """
    (k, dim), n = C.shape, X.shape[0]
    if X.shape[1] != dim:
        raise ValueError(f"points have dimension {X.shape[1]}, centres {dim}")
    D = np.empty((k, n))
    step = max(1, _BLOCK_CELLS // max(1, k))
    for s in range(0, n, step):
        block = np.ascontiguousarray(X[s:s + step].T)
        acc = np.zeros((k, block.shape[1]))
        for j in range(dim):
            diff = block[j] - C[:, j:j + 1]
            acc += diff * diff
        D[:, s:s + step] = np.sqrt(acc)
    return D


def matrix(xs) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ``pyarrow`` list array as an (n_valid, d) matrix, plus the non-null mask.

    No per-row Python objects: the list values are flattened in one call and
    reshaped. Mixed lengths, NULL, NaN and infinite coordinates are rejected (D10, D13).
    """
    import pyarrow.compute as pc

    if isinstance(xs, pa.ChunkedArray):
        xs = xs.combine_chunks()
    valid = xs.is_valid().to_numpy(zero_copy_only=False)
    if not valid.any():
        return np.empty((0, 0)), valid
    lengths = pc.list_value_length(xs).to_numpy(zero_copy_only=False)[valid]
    dim = int(lengths[0])
    if (lengths != dim).any():
        raise ValueError(f"mixed vector dimensions: {int(lengths.min())} .. {int(lengths.max())}")
    flat = pc.list_flatten(xs)
    if flat.null_count:
        raise ValueError("invalid vector: NULL coordinate")
    X = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)
    if not np.isfinite(X).all():
        raise ValueError("invalid vector: non-finite coordinate")
    return X, valid


def _center_matrix(centers: Sequence[Sequence[float]]) -> np.ndarray:
    rows = [_as_floats(y) for y in centers]
    if len({len(y) for y in rows}) > 1:
        raise ValueError("centres have mixed dimensions")
    C = np.asarray(rows, dtype=np.float64).reshape(len(rows), -1)
    check_center_budget(*C.shape)
    return C


def nearest_udf(centers: Sequence[Sequence[float]]):
    """Kernel UDF: ``array<double>`` → ``struct<d: double, c: int>`` (ties → lowest c)."""
    C = _center_matrix(centers)

    @F.arrow_udf("struct<d: double, c: int>")
    def nearest_center_arrow(xs: pa.Array) -> pa.Array:
        n = len(xs)
        d = np.zeros(n)
        c = np.zeros(n, dtype=np.int32)
        X, valid = matrix(xs)
        if len(X):
            D = distance_matrix(X, C)
            a = np.argmin(D, axis=0)
            d[valid] = D[a, np.arange(len(a))]
            c[valid] = a
        null = None if valid.all() else pa.array(~valid)
        return pa.StructArray.from_arrays([pa.array(d, mask=~valid), pa.array(c, mask=~valid)],
                                          names=["d", "c"], mask=null)

    return nearest_center_arrow


def distances_udf(centers: Sequence[Sequence[float]]):
    """Kernel UDF: ``array<double>`` → ``array<double>`` of the k centre distances."""
    C = _center_matrix(centers)
    k = len(C)

    @F.arrow_udf("array<double>")
    def center_distances_arrow(xs: pa.Array) -> pa.Array:
        n = len(xs)
        X, valid = matrix(xs)
        values = np.zeros((n, k))
        if len(X):
            values[valid] = distance_matrix(X, C).T
        offsets = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32))
        null = None if valid.all() else pa.array(~valid)
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()), mask=null)

    return center_distances_arrow


def center_distance_udf(centers: Sequence[Sequence[float]]):
    """Kernel UDF: ``array<double>, int`` → distance to the centre of that number; NULL where it names none."""
    C = _center_matrix(centers)

    @F.arrow_udf("double")
    def own_distance_arrow(xs: pa.Array, cs: pa.Array) -> pa.Array:
        X, valid = matrix(xs)
        c = cs.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        named = valid & (c >= 0) & (c < len(C))
        d = np.zeros(len(xs))
        if named.any():
            if X.shape[1] != C.shape[1]:
                raise ValueError(f"points have dimension {X.shape[1]}, centres {C.shape[1]}")
            rows, own = X[named[valid]], c[named]
            acc = np.zeros(len(rows))
            for j in range(C.shape[1]):  # in coordinate order, as in distance_matrix
                diff = rows[:, j] - C[own, j]
                acc += diff * diff
            d[named] = np.sqrt(acc)
        return pa.array(d, mask=~named)

    return own_distance_arrow


def nearest(x: Column | str, centers) -> Column:
    """``struct<d: double, c: int>`` of the nearest centre; ties go to the lowest index.

    ``centers`` is either a list of literal vectors (numpy kernel) or an
    ``array<array<double>>`` column (higher-order functions; structs order by
    ``d`` then ``c``).
    """
    if isinstance(centers, (list, tuple)) or (hasattr(centers, "shape") and not isinstance(centers, Column)):
        if len(centers) == 0:
            raise ValueError("nearest() needs at least one centre")
        return nearest_udf(centers)(_col(x))
    cs = _col(centers)
    return F.array_min(
        F.transform(cs, lambda y, i: F.struct(distance(x, y).alias("d"), i.cast("int").alias("c")))
    )


def min_distance(x: Column | str, centers) -> Column:
    """Distance to the nearest centre (V3)."""
    return nearest(x, centers).getField("d")


def vector_literal(y: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in y])


def vector_sum_agg(x: Column | str, weight: Column | str | None = None) -> Column:
    """Aggregate: coordinate-wise (weighted) sum Σ wᵢ·xᵢ as ``array<double>``.

    Uses ML's ``Summarizer`` (a JVM aggregate with partial aggregation), so a
    group of any size is combined map-side before the shuffle.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vec = array_to_vector(_col(x))
    summ = Summarizer.sum(vec) if weight is None else Summarizer.sum(vec, _col(weight))
    return vector_to_array(summ)
