"""Distance-weighted random draws (V5) and k-means++-style seeding (V6).

V5(a), the *exponential race*: every candidate (d > 0) gets the key
ln(u) / (w·d) with u a hash-uniform of (id, seed, round); the largest key wins,
ties to the lowest id. The winner is drawn with probability wᵢdᵢ / Σ wⱼdⱼ
(Efraimidis & Spirakis 2006), exactly the distribution of the reference's
prefix scan, but it is one aggregate with partial aggregation: no sort, no
global window, no ordered pass.

V5(b), the *prefix pick*, reproduces the reference's scan for an explicit
x ∈ [0, 1): the first point, in id order, whose running sum of w·d exceeds
x·Σ w·d. (id, w·d) is written once; a table of about ``2 ** FAN_BITS`` ids then cuts
it into buckets of about equally many ids, and the bucket that holds the target is
cut again until its buckets are single ids.

V6 draws every centre by a race (one pass per centre), or by rejection from bounds
of an earlier pass (several centres per pass), with the same distribution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.random import uniform, uniform_py
from ..session import written
from . import vectors as V


def race_key(u: Column, weight: Column, d: Column) -> Column:
    """ln(u)/(w·d) for candidates (w·d > 0), NULL otherwise (never divides by 0)."""
    wd = weight * d
    return F.when(wd > 0, F.ln(u) / wd)


def race_pick(points: DataFrame, seed: int, round_no: int, id: str = "id", d: str | None = "d",
              weight: str | None = None, x: str | None = None, key_parts=None) -> DataFrame:
    """V5(a): one row ``id`` (and ``x`` when given) of the race winner; no row if no candidate.

    ``d=None`` draws uniformly (w·d = 1), as for the first centre.
    ``key_parts`` overrides the hash key (default ``id, seed, round``).
    """
    parts = key_parts if key_parts is not None else (F.col(id), seed, round_no)
    u = uniform(*parts)
    w = F.col(weight) if weight else F.lit(1.0)
    dd = F.col(d) if d else F.lit(1.0)
    key = race_key(u, w, dd)
    order = F.when(key.isNotNull(), F.struct(key.alias("k"), (-F.col(id)).alias("nid")))
    payload = F.struct(F.col(id).alias("id"), *( [F.col(x).alias("x")] if x else []))
    best = points.agg(F.max_by(payload, order).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.*")


FAN_BITS = 12


def _bucket_udf(cuts: list[int]):
    """Number of cuts at or below an id."""
    at = np.array(cuts, np.int64)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(at, ids.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    return bucket


def prefix_pick(points: DataFrame, frac: float, id: str = "id", d: str = "d",
                weight: str | None = None, fan_bits: int = FAN_BITS) -> DataFrame:
    """V5(b): one row ``id``: first point in id order with running Σ w·d > frac · Σ w·d.

    One pass over the points writes (id, w·d), so whatever ``d`` is made of is computed once. All
    else reads these two columns. A table of about ``2 ** fan_bits`` ids, drawn by hash from the
    distinct ids, cuts the id range into buckets of about equally many ids, however the ids lie; one aggregate sums
    w·d per bucket and finds the bucket in which the running sum passes the target. That bucket is
    cut again, until every distinct id is a cut: one level for 4,000 ids, two for 16 million, three for 6e10. Rows sharing an id are summed. If
    rounding leaves no running sum above the target, the last candidate of the range is taken (D9
    clamp). Points with w·d = 0 are never returned; no candidate gives no row.
    """
    if not 0.0 <= frac < 1.0:
        raise ValueError("frac must be in [0, 1)")
    spark = points.sparkSession
    w = F.col(weight) if weight else F.lit(1.0)
    mass = w * F.col(d)
    # No filter on `mass` itself: a predicate on a kernel output would be pushed
    # below it and evaluate the kernel twice; the filter is on the written column.
    cand = written(points.select(F.col(id).cast("long").alias("id"), F.when(mass > 0, mass).alias("m"))).where("m IS NOT NULL AND id IS NOT NULL")
    before, target, level = 0.0, None, 0
    while True:
        ids = cand.agg(F.approx_count_distinct("id").alias("n")).first()["n"]
        if not ids:
            return spark.createDataFrame([], "id long")
        most = 1 << fan_bits
        share = min(1.0, most / ids) if 2 * ids > most else 1.0
        # distinct ids are drawn, so an id that many rows share comes once
        drawn = F.lit(True) if share == 1.0 else uniform(F.col("id"), F.lit("cut"), level) < share
        cuts = sorted(r["id"] for r in cand.where(drawn).select("id").distinct().collect())  # about 2 ** fan_bits
        sums = cand.groupBy(_bucket_udf(cuts)("id").alias("b")).agg(F.sum("m").alias("m")).collect()
        sums = sorted((r["b"], r["m"]) for r in sums)
        if target is None:
            target = frac * sum(m for _, m in sums)
        for bucket, m in sums:
            if before + m > target:
                break
            before += m
        else:  # rounding: stay in the last bucket that has candidates
            before -= m
        if share == 1.0:
            return spark.createDataFrame([(cuts[bucket - 1],)], "id long")
        if bucket:
            cand = cand.where(F.col("id") >= cuts[bucket - 1])
        if bucket < len(cuts):
            cand = cand.where(F.col("id") < cuts[bucket])
        level += 1


def seed_centers(points: DataFrame, k: int, seed: int, x: str = "x", id: str = "id",
                 weight: str | None = None,
                 carry: bool = False) -> list[tuple[int, list[float]]]:
    """V6: k-means++-style seeding with D¹ sampling; returns ``[(id, vector), …]``.

    Round 0 draws a point uniformly; round r ≥ 1 draws ∝ w·d, d being the
    distance to the nearest centre chosen so far. Each round is one pass over
    the points ending in one race aggregate. ``d`` is either

    * recomputed over the r chosen centres inside the distance kernel (the
      default): no per-round copy of the point set, plan size constant; or
    * with ``carry=True`` carried as (id, d) beside the points and updated
      against the newest centre only (V4, O(n·k) distance work): one join by id
      per round, so ids must be unique; the pair table is written to the shared
      folder every round, which also cuts lineage.

    Both give the same doubles: the kernel has one summation order. Stops early
    when no point has d > 0 (fewer distinct points than k).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    base = points.select(id, x, *([weight] if weight else []))

    def pick(frame: DataFrame, r: int, dcol: str | None):
        row = race_pick(frame, seed, r, id=id, d=dcol, weight=weight if dcol else None, x=x).first()
        return None if row is None else (int(row["id"]), list(row["x"]))

    first = pick(base, 0, None)
    if first is None:
        return []
    chosen = [first]
    V.check_center_budget(k, len(first[1]))
    if not carry:
        for r in range(1, k):
            won = pick(base.withColumn("d", V.min_distance_col(x, [y for _, y in chosen])), r, "d")
            if won is None:
                break
            chosen.append(won)
        return chosen
    state = None
    for r in range(1, k):
        src = base if state is None else base.join(state.hint("merge"), id)
        state = written(V.update_min_distance(src, chosen[-1][1], x=x, d="d").select(id, "d"))
        won = pick(base.join(state.hint("merge"), id), r, "d")
        if won is None:
            break
        chosen.append(won)
    return chosen


PROPOSALS = 8


def seed_by_rejection(points: DataFrame, k: int, seed: int, x: str = "x", id: str = "id", weight: str | None = None,
                      proposals: int = PROPOSALS) -> tuple[list[tuple[int, list[float]]], int]:
    """V6 with several centres per pass: ``([(id, vector), …], passes over the points)``.

    A pass computes D, the distance to the nearest centre chosen before it, and draws ``proposals`` independent
    points ∝ w·D, each by a race of its own, all in one aggregate. D is an upper bound of the distance d to the
    centres chosen since, so a proposal is taken with probability d / D, d being worked out on the driver from the
    proposal and the new centres. A taken proposal is distributed ∝ w·d exactly, as a race over all points would draw it:
    ∝ w·D · d / D, independent of the proposals refused before it. The first proposal of a pass is always taken, so there are at most k
    passes. Distances are computed to at most k centres per pass. Stops early when no point has d > 0.
    """
    if k < 1 or proposals < 1:
        raise ValueError("k and proposals must be >= 1")
    base = points.select(id, x, *([weight] if weight else []))
    first = race_pick(base, seed, 0, id=id, d=None, x=x).first()
    if first is None:
        return [], 1
    chosen, passes = [(int(first["id"]), list(first["x"]))], 1
    V.check_center_budget(k, len(chosen[0][1]))
    w = F.col(weight) if weight else F.lit(1.0)
    while len(chosen) < k:
        data = base.withColumn("_d", V.min_distance_col(x, [y for _, y in chosen]))
        row = F.struct(F.col(id).alias("id"), F.col(x).alias("x"), F.col("_d").alias("d"))
        races = []
        for t in range(proposals):
            key = race_key(uniform(F.col(id), seed, passes, t), w, F.col("_d"))
            races.append(F.max_by(row, F.when(key.isNotNull(), F.struct(key.alias("k"), (-F.col(id)).alias("nid")))).alias(f"p{t}"))
        drawn = data.agg(*races).first()
        fresh: list[list[float]] = []
        for t, p in enumerate(drawn):
            if p is None or len(chosen) == k:
                break
            d = min([p["d"], *(float(np.sqrt(sum((a - b) * (a - b) for a, b in zip(p["x"], y)))) for y in fresh)])
            if uniform_py(p["id"], seed, passes, t, "accept") * p["d"] < d:
                chosen.append((int(p["id"]), list(p["x"])))
                fresh.append(list(p["x"]))
        passes += 1
        if not fresh:  # no point is left away from the centres
            break
    return chosen, passes
