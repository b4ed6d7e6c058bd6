"""Damped weighted Lloyd iterations (V7) and the seeded fit (V8).

One Lloyd step is one pass over the points: the Arrow distance kernel assigns
each point to its nearest centre, then ``groupBy(c)`` sums w·x (ML's
``Summarizer``) and w with partial aggregation — at most k rows leave each task,
whatever the cluster sizes, so a cluster holding a third of the points costs the
same shuffle as any other. Only the ≤ k aggregated rows come back to the driver.

Update rule (D3, kept from the reference): the old centre takes part in the
mean with weight ``damping`` (1 by default):

    new = (damping·old + Σ wᵢxᵢ) / (damping + Σ wᵢ)

so a centre that receives no point stays where it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions.vector import distance_matrix, matrix, nearest, vector_sum_agg
from ..session import written
from . import sampling
from . import vectors as V


def lloyd_step_frame(points: DataFrame, centers, x: str = "x", weight: str | None = None,
                     damping: float = 1.0) -> DataFrame:
    """V7 as a DataFrame: ``c, y`` of the k updated centres."""
    cs = V.as_center_list(centers)
    w = F.col(weight) if weight else F.lit(1.0)
    assigned = points.select(nearest(x, cs).getField("c").alias("c"), F.col(x).alias("x"),
                             w.cast("double").alias("w"))
    sums = assigned.groupBy("c").agg(vector_sum_agg("x", "w").alias("s"), F.sum("w").alias("sw"))
    old = V.centers_frame(points.sparkSession, cs)
    # k rows on both sides. Null-safe keys: an inferred isnotnull(c) would be pushed
    # below the kernel's projection and make Spark run the kernel twice.
    joined = F.broadcast(old).join(sums, old["c"].eqNullSafe(sums["c"]), "left").drop(sums["c"])
    dmp = F.lit(float(damping))
    denom = dmp + F.coalesce(F.col("sw"), F.lit(0.0))
    new_y = F.when(
        F.col("s").isNull() | (denom == 0), F.col("y")
    ).otherwise(F.zip_with("y", "s", lambda o, s: (dmp * o + s) / denom))
    return joined.select("c", new_y.alias("y"))


def lloyd_step(points: DataFrame, centers, x: str = "x", weight: str | None = None,
               damping: float = 1.0, exact: tuple[int, int] | None = None) -> list[list[float]]:
    """V7: the k updated centres as a driver list — one job per step.

    The distributed part is the same as :func:`lloyd_step_frame` (assignment +
    per-centre Σ w·x and Σ w, combined map-side); the at most k aggregated rows
    come back and the damped mean of each centre is finished on the driver,
    k·dim arithmetic with the same operations (so the same doubles). ``exact`` (the exponents of the
    points, :func:`tessera.functions.exact.exponents`) makes the sums, and so the bits of the
    centres, independent of the order of the tasks.
    """
    cs = V.as_center_list(centers)
    if not cs:
        return []
    V.check_center_budget(len(cs), len(cs[0]))
    w = F.col(weight) if weight else F.lit(1.0)
    assigned = points.select(nearest(x, cs).getField("c").alias("c"), F.col(x).alias("x"),
                             w.cast("double").alias("w"))
    if exact:
        sums = X.group_sums(assigned.withColumnRenamed("c", "g"), exact).withColumnRenamed("g", "c")
    else:
        sums = assigned.groupBy("c").agg(vector_sum_agg("x", "w").alias("s"), F.sum("w").alias("sw"))
    return _updated(cs, sums, damping)


def _updated(cs: list[list[float]], sums: DataFrame, damping: float) -> list[list[float]]:
    """The damped means of the centres, from at most k rows ``c, s, sw``."""
    new = [list(y) for y in cs]
    for row in sums.collect():  # at most k rows
        if row["c"] is None:
            continue
        denom = float(damping) + float(row["sw"])
        if denom != 0:
            old = cs[row["c"]]
            new[row["c"]] = [(float(damping) * o + s) / denom for o, s in zip(old, row["s"])]
    return new


def lloyd_step_by_blocks(points: DataFrame, centers: DataFrame, id: str = "id", x: str = "x", weight: str | None = None,
                         damping: float = 1.0, block_bytes: int = V.MAX_CENTER_BYTES) -> DataFrame:
    """V7 for a centre set of any size, as ``c, y`` rows in and out; ids must be unique.

    Points are assigned by blocks of centres (:func:`tessera.operators.vectors.assign_by_blocks`), joined
    with their centre's number by id, and summed with a combine before the shuffle; the sums meet the old
    centres in a join on c. No centre but those of one block comes to the driver.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    best = V.assign_by_blocks(points, centers, id, x, block_bytes).select(id, "c")
    rows = points.select(id, F.col(x).alias("_x"), w.cast("double").alias("_w")).join(best, id)
    sums = rows.groupBy("c").agg(vector_sum_agg("_x", "_w").alias("s"), F.sum("_w").alias("sw"))
    dmp = F.lit(float(damping))
    denom = dmp + F.coalesce(F.col("sw"), F.lit(0.0))
    new_y = F.when(F.col("s").isNull() | (denom == 0), F.col("y")).otherwise(F.zip_with("y", "s", lambda o, s: (dmp * o + s) / denom))
    return centers.select(F.col("c").cast("int").alias("c"), "y").join(sums, "c", "left").select("c", new_y.alias("y"))


def fit(points: DataFrame, k: int, iterations: int, seed: int, x: str = "x", id: str = "id",
        weight: str | None = None, weighted_seeding: bool = False, damping: float = 1.0,
        persist: bool = False, proposals: int | None = None, exact: bool = False) -> list[list[float]]:
    """V8: seeding (V6) then exactly ``iterations`` Lloyd steps; no convergence test.

    Seeding uses unit weights unless ``weighted_seeding`` (D2); the Lloyd steps
    use ``weight``. 0 iterations returns the seeds. ``proposals`` seeds by rejection, with so many
    proposals per pass, in place of one race per centre (same distribution, other draws). ``persist`` keeps the point set on the
    executors between rounds; without it every round reads its source. Partial sums are added in
    the order in which tasks end, so a retried task may change the last bits, unless ``exact`` adds them
    as integers on a common exponent (one more pass for the maxima, the same bits in any order).
    """
    data = points.select(id, x, *([weight] if weight else []))
    if persist:
        data = data.persist()
    try:
        by = weight if weighted_seeding else None
        if proposals:
            seeds, _ = sampling.seed_by_rejection(data, k, seed, x=x, id=id, weight=by, proposals=proposals)
        else:
            seeds = sampling.seed_centers(data, k, seed, x=x, id=id, weight=by)
        centers = [y for _, y in seeds]
        above = X.exponents(data, x, F.col(weight) if weight else F.lit(1.0)) if exact and iterations else None
        for _ in range(iterations):
            centers = lloyd_step(data, centers, x, weight, damping, above)
        return centers
    finally:
        if persist:
            data.unpersist()


def _with_bounds(state: DataFrame, centers: list[list[float]], before: list[list[float]] | None) -> DataFrame:
    """``state`` (x, w, c, u, l, n) with the nearest of ``centers``; ``n`` counts the distances that took.

    u is at least the distance to centre c and l at most the distance to any other one. Both move by what the
    centres moved since ``before``. A point whose u lies under l, or under half the way from
    its centre to the next one, keeps its centre without a distance; else u is measured, and only
    if that is not enough all k distances are. Bounds are widened by far more than their rounding, and a
    point on a border is always measured, so ties go to the lowest index as in :func:`tessera.operators.vectors.assign`.
    """
    C = np.array(centers)
    moved = np.sqrt(((C - np.array(before)) ** 2).sum(axis=1)) if before else np.zeros(len(C))
    half = np.full(len(C), np.inf)
    for at in range(0, len(C), 1024):
        D = distance_matrix(C[at:at + 1024], C)
        own = np.arange(D.shape[1])
        D[own + at, own] = np.inf
        half[at:at + 1024] = D.min(axis=0) / 2
    first, names = before is None, state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            if not b.num_rows:
                continue
            P, _ = matrix(b.column(0))
            c, u, l = (b.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4))
            n = np.zeros(len(P), np.int64)
            if first:
                ask = np.arange(len(P))
            else:
                slack = 1e-10 * (u + np.where(np.isfinite(l), l, 0.0) + moved.max() + 1e-300)
                u += moved[c] + slack
                l -= moved.max() + slack
                bound = np.maximum(l, half[c] * (1 - 1e-10))
                near = np.flatnonzero(~(u < bound))
                acc = np.zeros(len(near))
                for j in range(C.shape[1]):
                    diff = P[near, j] - C[c[near], j]
                    acc += diff * diff
                u[near] = np.sqrt(acc) * (1 + 1e-10)
                n[near] += 1
                ask = near[~(u[near] < bound[near])]
            step = max(1, (1 << 20) // len(C))
            for s in range(0, len(ask), step):
                some = ask[s:s + step]
                D = distance_matrix(P[some], C)
                at = np.arange(len(some))
                c[some] = np.argmin(D, axis=0)
                u[some] = D[c[some], at]
                D[c[some], at] = np.inf
                l[some] = D.min(axis=0)
                n[some] += len(C)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(c), pa.array(u), pa.array(l), pa.array(n)], names=names)

    return state.mapInArrow(run, state.schema)


def fit_by_bounds(points: DataFrame, k: int, iterations: int, seed: int, x: str = "x", id: str = "id", weight: str | None = None,
                  weighted_seeding: bool = False, damping: float = 1.0) -> tuple[list[list[float]], list[int]]:
    """V8 with bounds carried from one iteration to the next: the centres of ``fit(exact=True)``, bit for bit,
    and the number of distances of each iteration (n·k without bounds).

    The points, their centre and two bounds are written to the shared folder per iteration, so an iteration reads
    what the last one wrote and a lost executor costs its running tasks only. That pays where k is large: a
    skipped point saves k distances and costs one row of input and output.
    """
    seeds = sampling.seed_centers(points, k, seed, x=x, id=id, weight=weight if weighted_seeding else None)
    centers, before, counts = [y for _, y in seeds], None, []
    if not centers:
        return [], []
    w = F.col(weight) if weight else F.lit(1.0)
    above = X.exponents(points, x, w) if iterations else None
    state = points.select(F.col(x).alias("x"), w.cast("double").alias("w"), F.lit(0).cast("long").alias("c"), F.lit(0.0).alias("u"),
                          F.lit(0.0).alias("l"), F.lit(0).cast("long").alias("n"))
    for _ in range(iterations):
        state = written(_with_bounds(state, centers, before))
        counts.append(int(state.agg(F.sum("n")).first()[0] or 0))
        sums = X.group_sums(state.select(F.col("c").alias("g"), "x", "w"), above).withColumnRenamed("g", "c")
        centers, before = _updated(centers, sums, damping), centers
    return centers, counts


def fit_frame(points: DataFrame, k: int, iterations: int, seed: int, x: str = "x",
              id: str = "id", weight: str | None = None, weighted_seeding: bool = False,
              damping: float = 1.0) -> DataFrame:
    """V8 returning the final centres as a ``c, y`` DataFrame (last step left lazy)."""
    if iterations == 0:
        seeds = sampling.seed_centers(points, k, seed, x=x, id=id,
                                      weight=weight if weighted_seeding else None)
        return V.centers_frame(points.sparkSession, [y for _, y in seeds])
    before = fit(points, k, iterations - 1, seed, x, id, weight, weighted_seeding, damping)
    return lloyd_step_frame(points, before, x, weight, damping)
