"""Per-part weighted coresets (V10) and 3-round MapReduce k-median.

Round 1  points are dealt round-robin into L parts (``repartition(L)``; Spark
         sorts each input partition first, so a retried task gets the same
         rows). Parts are even whatever the keys — copies of one id or one hot
         value cannot pile up in one part. Each part is clustered independently
         by a numpy kernel inside ``mapInArrow`` — seeding, Lloyd steps and the
         per-centre point counts — and emits at most k weighted centres. With an
         explicit part column the parts are the user's groups
         (``groupBy(part).applyInArrow``). Vectors reach the kernel as Arrow
         lists, flattened into a matrix in one call.
Round 2  the L·k weighted centres stay a DataFrame and go through the distributed
         fit (V8); they are never gathered into one task.
Round 3  the mean distance of every point to the final centres (one aggregate).

The kernel draws its random numbers from md5(id:seed:part:round) for the round in hand, so
round 1 is repeatable on retry and reproducible in SQL, and points cross a shuffle without
them. Memory: in :func:`coreset` one part is one Arrow table in one Python worker, so choose
L ≥ n·(dim + k)·8 bytes / (target part size); :func:`suggest_parts` does this, and
:func:`hashed_part` makes even parts. :func:`coreset_by_blocks` takes parts of any size: it
clusters blocks of a sorted part and merges their weighted coresets two by two, so a worker's memory follows
the block and k.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.random import uniform, uniform_py
from ..functions.vector import distance_matrix, matrix
from ..session import written
from . import kmeans
from . import vectors as V

CORESET_SCHEMA = "part long, c int, y array<double>, w double"
CORESET_ARROW = pa.schema([("part", pa.int64()), ("c", pa.int32()), ("y", pa.list_(pa.float64())), ("w", pa.float64())])
TARGET_PART_BYTES = 128 * 1024 * 1024
BLOCK = 4096  # points clustered at a time by merge-and-reduce


def suggest_parts(n_points: int, dim: int, k: int, min_parts: int = 1,
                  target_bytes: int = TARGET_PART_BYTES) -> int:
    """Smallest L whose parts hold about ``target_bytes`` of vectors and k distances."""
    per_row = (dim + k + 2) * 8
    return max(int(min_parts), int(math.ceil(n_points * per_row / target_bytes)))


# --------------------------------------------------------------------------- numpy kernel

def _assign(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre per row (ties → lowest index) and its distance."""
    D = distance_matrix(X, C)
    a = np.argmin(D, axis=0)
    return a, D[a, np.arange(X.shape[0])]


def _cluster_part(X: np.ndarray, u: Callable[[int], np.ndarray], k: int, iterations: int,
                  weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Seeding + damped Lloyd + final weights for one part. Rows must be in id order; ``u(r)`` are
    their uniforms of round r. With ``weights`` all draws, means and final weights go by them."""
    n = X.shape[0]
    W = np.ones(n) if weights is None else weights

    def draw(mass: np.ndarray, r: int) -> int:
        cand = mass > 0
        key = np.full(n, -np.inf)
        key[cand] = np.log(u(r)[cand]) / mass[cand]
        return int(np.argmax(key))  # ties → lowest id

    first = draw(W, 0)
    C = [X[first]]
    d = distance_matrix(X, X[first:first + 1])[0]
    for r in range(1, k):
        if not (W * d > 0).any():
            break
        i = draw(W * d, r)
        C.append(X[i])
        d = np.minimum(d, distance_matrix(X, X[i:i + 1])[0])
    C = np.array(C)
    for _ in range(iterations):
        a, _ = _assign(X, C)
        cnt = np.bincount(a, weights=W, minlength=len(C))
        sums = np.stack([np.bincount(a, weights=W * X[:, j], minlength=len(C)) for j in range(X.shape[1])],
                        axis=1)
        C = (C + sums) / (1.0 + cnt)[:, None]
    a, _ = _assign(X, C)
    return C, np.bincount(a, weights=W, minlength=len(C))


def _cluster_table(table: pa.Table, k: int, iterations: int, seed: int) -> pa.Table:
    """Kernel over one part's rows ``part, id, x`` → ``part, c, y, w``; NULL vectors are ignored."""
    X, valid = matrix(table.column("x"))
    ids = table.column("id").to_numpy()[valid]
    if len(X) == 0:
        return CORESET_ARROW.empty_table()
    part = int(table.column("part")[0].as_py())
    # total, repeatable row order: id, then the coordinates (rows arrive from a
    # shuffle in fetch order; only exact copies remain tied, and they are equal)
    order = np.lexsort(tuple(X[:, j] for j in range(X.shape[1] - 1, -1, -1)) + (ids,))
    ids = ids[order].tolist()
    C, w = _cluster_part(X[order], lambda r: np.array([uniform_py(i, seed, part, r) for i in ids]), k, iterations)
    kc, dim = C.shape
    offsets = pa.array(np.arange(0, (kc + 1) * dim, dim, dtype=np.int32))
    return pa.table({
        "part": pa.array(np.full(kc, part, dtype=np.int64)),
        "c": pa.array(np.arange(kc, dtype=np.int32)),
        "y": pa.ListArray.from_arrays(offsets, pa.array(C.ravel())),
        "w": pa.array(w),
    })


def coreset_kernel(k: int, iterations: int, seed: int):
    """Grouped form (``applyInArrow``): one call per part group."""
    def run(table: pa.Table) -> pa.Table:
        return _cluster_table(table, k, iterations, seed)
    return run


def coreset_partition_kernel(k: int, iterations: int, seed: int):
    """Partition form (``mapInArrow``): the record batches of one partition are one part."""
    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if kept:
            yield from _cluster_table(pa.Table.from_batches(kept), k, iterations, seed).to_batches()
    return run


class MergeReduce:
    """The coreset of one part from a stream of its points, in memory for one block and a few coresets.

    Every ``block`` points in a row are clustered to a weighted coreset of at most ``size`` centres:
    leaf j of a binary tree. Two coresets side by side are put together and clustered, by weight, to at
    most ``size`` centres: their parent. A coreset without a right neighbour goes up as it is. Of the
    whole, k weighted centres are made. So a part of n points needs log2(n / block) coresets at a
    time, and weights add up to n at every level. Draws are hashes of (id, seed, part, level, node, round);
    in a parent, a point's id is its place among its coreset's centres, plus ``size`` on the right.
    """

    def __init__(self, part: int, k: int, iterations: int, seed: int, block: int, size: int):
        self.part, self.k, self.iterations, self.seed, self.block, self.size = part, k, iterations, seed, block, size
        self.held: list[tuple[np.ndarray, np.ndarray]] = []  # ids and vectors not yet in a block
        self.n_held = self.n_blocks = 0
        self.stack: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # level, node, centres, weights

    def _cluster(self, X, w, ids, k: int, level: int, node: int):
        def u(r: int) -> np.ndarray:
            return np.array([uniform_py(i, self.seed, self.part, level, node, r) for i in ids])

        return _cluster_part(X, u, k, self.iterations, w)

    def _parent(self, left, right, level: int, node: int):
        X, w = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
        ids = [*range(len(left[0])), *range(self.size, self.size + len(right[0]))]
        return level, node, *self._cluster(X, w, ids, self.size, level, node)

    def _leaf(self, ids: np.ndarray, X: np.ndarray) -> None:
        top = 0, self.n_blocks, *self._cluster(X, None, ids.tolist(), self.size, 0, self.n_blocks)
        self.n_blocks += 1
        while self.stack and self.stack[-1][0] == top[0]:
            left = self.stack.pop()
            top = self._parent(left[2:], top[2:], top[0] + 1, top[1] >> 1)
        self.stack.append(top)

    def add(self, ids: np.ndarray, X: np.ndarray) -> None:
        """Points in (id, coordinates) order."""
        while len(ids):
            take = self.block - self.n_held
            self.held.append((ids[:take], X[:take]))
            self.n_held += len(self.held[-1][0])
            ids, X = ids[take:], X[take:]
            if self.n_held == self.block:
                self._flush()

    def _flush(self) -> None:
        ids, X = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.n_held = [], 0
        self._leaf(ids, X)

    def finish(self) -> tuple[np.ndarray, np.ndarray] | None:
        """``(centres, weights)``, at most k; None for a part without points."""
        if self.n_held:
            self._flush()
        if not self.stack:
            return None
        level, node, C, w = self.stack.pop()
        while self.stack:  # goes up alone to the level of the coreset on its left
            left = self.stack.pop()
            level, node, C, w = self._parent(left[2:], (C, w), left[0] + 1, left[1] >> 1)
        return self._cluster(C, w, range(len(C)), self.k, -1, 0)


def merge_reduce_kernel(k: int, iterations: int, seed: int, block: int, size: int):
    """Partition form (``mapInArrow``) over rows ``part, id, x`` sorted by part, id and coordinates."""
    def rows(tree: MergeReduce) -> pa.RecordBatch:
        C, w = tree.finish()
        kc, dim = C.shape
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(kc, tree.part, np.int64)), pa.array(np.arange(kc, dtype=np.int32)),
            pa.ListArray.from_arrays(pa.array(np.arange(0, (kc + 1) * dim, dim, dtype=np.int32)), pa.array(C.ravel())), pa.array(w)],
            names=CORESET_ARROW.names)

    def run(batches):
        tree = None
        for b in batches:
            X, valid = matrix(b.column(2))
            part, ids = (b.column(i).to_numpy(zero_copy_only=False)[valid] for i in (0, 1))
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                if a == z:
                    continue
                if tree is None or tree.part != int(part[a]):
                    if tree is not None:
                        yield rows(tree)
                    tree = MergeReduce(int(part[a]), k, iterations, seed, block, size)
                tree.add(ids[a:z], X[a:z])
        if tree is not None:
            yield rows(tree)

    return run


# --------------------------------------------------------------------------- operators

def coreset_by_blocks(points: DataFrame, k: int, parts: int | None, iterations: int, seed: int, x: str = "x", id: str = "id",
                      part_col: str | None = None, block: int = BLOCK, size: int | None = None) -> DataFrame:
    """V10 for parts of any size: ``part, c, y, w`` as :func:`coreset`, by merge-and-reduce (:class:`MergeReduce`).

    A task holds one block and a few coresets of ``size`` centres (``2 * k`` by default), not its part, so a
    part column may put any share of the points into one part. Spark sorts each part on (id, coordinates), on disk where
    it must, so a retried task reads the same stream. ``parts`` and ``part_col`` are as in :func:`coreset`.
    """
    size = 2 * int(k) if size is None else int(size)
    if not (0 < int(k) <= size <= block):
        raise ValueError("0 < k <= size <= block is needed")
    data = points.select(*([F.col(part_col).cast("long").alias("part")] if part_col else []), F.col(id).alias("id"), F.col(x).alias("x"))
    if part_col:
        data = data.repartition("part")
    elif parts is not None:
        data = data.repartition(int(parts))
    if not part_col:
        data = data.select(F.spark_partition_id().cast("long").alias("part"), "id", "x")
    return (data.sortWithinPartitions("part", "id", "x").mapInArrow(
        merge_reduce_kernel(int(k), int(iterations), int(seed), int(block), size), CORESET_SCHEMA))


def coreset(points: DataFrame, k: int, parts: int | None, iterations: int, seed: int,
            x: str = "x", id: str = "id", part_col: str | None = None) -> DataFrame:
    """``part, c, y, w`` — at most k weighted centres per part.

    ``parts=L`` deals the points round-robin into L even parts (one shuffle of
    the points, as the reference's ``repartition(L)``); ``part`` is the
    partition index. ``parts=None`` uses the input partitions themselves as the
    parts — file splits are already even (``spark.sql.files.maxPartitionBytes``)
    and deterministic — so round 1 shuffles nothing: the recommended form on a
    large input. ``part_col`` names an existing part column instead (its groups
    are the parts, whatever their sizes).
    """
    args = int(k), int(iterations), int(seed)

    def prepared(df: DataFrame, part) -> DataFrame:
        return df.select(part.alias("part"), F.col(id).alias("id"), F.col(x).alias("x"))

    if part_col:
        return (prepared(points, F.col(part_col).cast("long")).groupBy("part")
                .applyInArrow(coreset_kernel(*args), CORESET_SCHEMA))
    dealt = points.select(id, x)
    if parts is not None:
        dealt = dealt.repartition(int(parts))
    return prepared(dealt, F.spark_partition_id().cast("long")).mapInArrow(coreset_partition_kernel(*args), CORESET_SCHEMA)


def hashed_part(id: str, parts: int, seed: int) -> Column:
    """Part of a point in ``[0, parts)``: a portable hash of its id, so the parts are even whatever the ids."""
    return F.least(F.floor(uniform(F.col(id), seed) * F.lit(int(parts))), F.lit(int(parts) - 1)).cast("long")


def coreset_points(core: DataFrame, k: int) -> DataFrame:
    """Round-2 input: coreset rows as weighted points ``id = part·k + c, x, w``."""
    return core.select((F.col("part") * F.lit(int(k)) + F.col("c")).alias("id"),
                       F.col("y").alias("x"), F.col("w"))


def mr_kmedian_centers(points: DataFrame, k: int, parts: int | None, iterations: int, seed: int,
                       x: str = "x", id: str = "id", part_col: str | None = None, block: int | None = None):
    """Rounds 1 and 2 of V11: the final k centres (driver list, size-checked).

    With ``block`` round 1 goes by merge-and-reduce, so parts may have any size.

    The coreset is written to the shared folder: round 1 runs once, and a lost executor does not
    bring it back; round 2 reads as many splits as its L·k rows fill.
    """
    core = written(coreset(points, k, parts, iterations, seed, x, id, part_col) if block is None
                   else coreset_by_blocks(points, k, parts, iterations, seed, x, id, part_col, block))
    if core.limit(1).count() == 0:
        raise ValueError("empty point set")
    return kmeans.fit(coreset_points(core, k), k, iterations, seed, weight="w")


def mr_kmedian(points: DataFrame, k: int, parts: int | None, iterations: int, seed: int,
               x: str = "x", id: str = "id", part_col: str | None = None, block: int | None = None) -> DataFrame:
    """``objective`` — mean distance of all points to the k-median centres."""
    centers = mr_kmedian_centers(points, k, parts, iterations, seed, x, id, part_col, block)
    return V.objective(points, centers, x)
