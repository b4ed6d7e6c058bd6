"""Distances, nearest-centre assignment and cluster aggregates.

Points are a DataFrame with an id, an ``array<double>`` column and optionally a
weight. A *centre set* is a small list of vectors held by the driver; its size
is k·dim doubles, fixed by the caller's ``k`` and the data's dimension and
checked against ``MAX_CENTER_BYTES`` before it is shipped to the tasks inside
the Arrow-batched distance kernel. A pass over the points is then a single
narrow stage: no join, no shuffle, whatever the number of points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact as X
from ..functions.vector import MAX_CENTER_BYTES, center_distance_udf, check_center_budget, distances_udf, min_distance, nearest, vector_sum_agg
from ..session import fresh_path, written

CENTERS_SCHEMA = T.StructType([
    T.StructField("c", T.IntegerType(), False),
    T.StructField("y", T.ArrayType(T.DoubleType(), False), False),
])


def as_center_list(centers) -> list[list[float]]:
    return [[float(v) for v in (y.tolist() if hasattr(y, "tolist") else y)] for y in centers]


def centers_frame(spark: SparkSession, centers: Sequence[Sequence[float]]) -> DataFrame:
    """``c, y`` frame of a small centre set (row c = centre index)."""
    rows = [(i, y) for i, y in enumerate(as_center_list(centers))]
    return spark.createDataFrame(rows, CENTERS_SCHEMA)


def collect_centers(frame: DataFrame, c: str = "c", y: str = "y",
                    max_bytes: int = MAX_CENTER_BYTES) -> list[list[float]]:
    """Bring a centre frame (k rows) to the driver, ordered by ``c``, after a size check.

    The frame is computed once, into the shared folder; its rows are sized there and then read.
    """
    kept = written(frame.select(F.col(c).alias("c"), F.col(y).alias("y")))
    size = kept.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("y")).alias("dim")).first()
    check_center_budget(int(size["k"]), int(size["dim"] or 0), max_bytes)
    return [list(r["y"]) for r in kept.orderBy("c").collect()]


def distance_to_center(points: DataFrame, centers, c: str = "c", x: str = "x", out: str = "d") -> DataFrame:
    """V1 for one centre per point: ``out`` is the distance to centre number ``c``; NULL without one."""
    return points.withColumn(out, center_distance_udf(as_center_list(centers))(F.col(x), F.col(c).cast("int")))


def pairwise_distances(points: DataFrame, centers, x: str = "x", id: str = "id") -> DataFrame:
    """V1: ``id, c, d`` for every point and every centre (n·k rows, k small)."""
    ds = distances_udf(as_center_list(centers))(F.col(x))
    # posexplode_outer: a plain posexplode makes Catalyst infer size(_ds) > 0 and push
    # it below the kernel's projection, which would run the kernel twice. The rows of
    # NULL vectors are dropped on the generator's own output instead.
    return (points.select(F.col(id), ds.alias("_ds"))
            .select(id, F.posexplode_outer("_ds").alias("c", "d"))
            .where(F.col("c").isNotNull())
            .select(id, F.col("c").cast("int").alias("c"), "d"))


def assign(points: DataFrame, centers, x: str = "x") -> DataFrame:
    """V2: add ``c`` (nearest centre, ties → lowest index) and ``d`` (its distance)."""
    best = nearest(x, as_center_list(centers))
    return points.withColumn("_best", best).select(
        *points.columns, F.col("_best.c").alias("c"), F.col("_best.d").alias("d"))


def assign_by_blocks(points: DataFrame, centers: DataFrame, id: str = "id", x: str = "x",
                     block_bytes: int = MAX_CENTER_BYTES) -> DataFrame:
    """V2 for a centre set of any size: ``id, c, d`` of every point; the doubles and ties of :func:`assign`.

    ``centers`` has a row ``c, y`` per centre, c = 0..k-1, and is cut into blocks of at most ``block_bytes``.
    One narrow pass over the points per block appends every point's nearest centre of that block to the
    shared folder; the smallest (d, c) of a point, combined before the shuffle, is its nearest of all. Driver and
    tasks hold one block at a time, and 20 bytes per point and block are written in place of
    the vectors. Rows that repeat one id and vector give one row; other rows of one id stay apart. A NULL vector
    has neither c nor d.
    """
    spark = points.sparkSession
    kept = written(centers.select(F.col("c").cast("long").alias("c"), "y").repartitionByRange("c").sortWithinPartitions("c"))
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi"),
                    F.min(F.size("y")).alias("least"), F.max(F.size("y")).alias("dim")).first()
    k = int(size["n"])
    if k == 0:
        raise ValueError("at least one centre is needed")
    if (size["k"], size["lo"], size["hi"]) != (k, 0, k - 1) or size["least"] != size["dim"]:
        raise ValueError("centres must be numbered 0..k-1 and have one dimension")
    step, path = max(1, block_bytes // (8 * max(1, int(size["dim"])))), fresh_path(spark)
    for at in range(0, k, step):
        block = [list(r["y"]) for r in kept.filter((F.col("c") >= at) & (F.col("c") < at + step)).orderBy("c").collect()]
        best = nearest(x, block)
        part = points.select(F.col(id).alias("id"), F.xxhash64(x).alias("key"), best.alias("best"))
        part.select("id", "key", F.col("best.d").alias("d"), (F.col("best.c") + at).cast("long").alias("c")).write.mode("append").parquet(path)
    merged = spark.read.parquet(path).groupBy("id", "key").agg(F.min(F.struct("d", "c")).alias("best"))
    return merged.select(F.col("id").alias(id), F.col("best.c").cast("int").alias("c"), F.col("best.d").alias("d"))


def update_min_distance(points: DataFrame, newest: Sequence[float], x: str = "x",
                        d: str = "d") -> DataFrame:
    """V4: ``d = least(d, dist(x, newest))``; a NULL ``d`` (no centre yet) becomes the distance."""
    dn = nearest(x, as_center_list([newest])).getField("d")
    return points.withColumn(d, F.least(F.col(d), dn) if d in points.columns else dn)


def min_distance_col(x: str, centers):
    """V3 as a column: distance to the nearest of ``centers``."""
    return min_distance(x, as_center_list(centers))


def objective(points: DataFrame, centers, x: str = "x") -> DataFrame:
    """Mean distance of the points to their nearest centre, ``objective``."""
    best = nearest(x, as_center_list(centers))
    return points.agg(F.avg(best.getField("d")).alias("objective"))


def cluster_weights(points: DataFrame, centers, x: str = "x", part: str | None = None) -> DataFrame:
    """Number of points nearest to each centre; centres with no point get 0.

    The per-centre counts are combined map-side (at most k rows per task leave a
    task), then right-joined to the k-row centre index so empty clusters stay.
    """
    k = len(centers)
    assigned = assign(points, centers, x)
    # one row per centre with points (combined map-side), then the centres of a part as a map of at most k
    keys = [part] if part else []
    counts = assigned.groupBy(*keys, "c").agg(F.count(F.lit(1)).alias("w"))
    held = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("c").isNotNull(), F.struct("c", "w")))).alias("m"))
    every = held.select(*keys, "m", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("c"))
    return every.select(*keys, F.col("c").cast("int").alias("c"),
                        F.coalesce(F.try_element_at("m", F.col("c").cast("int")), F.lit(0)).cast("long").alias("w"))


def weighted_mean(points: DataFrame, group: str, x: str = "x", w: str | None = None, exact: bool = False) -> DataFrame:
    """``group, mean`` with mean = Σ wᵢxᵢ / Σ wᵢ per group (``array<double>``).

    ``exact`` adds the rows as integers on a common exponent (one more pass, for the maxima): the same bits
    in any order of the tasks.
    """
    weight = F.col(w) if w else F.lit(1.0)
    if exact:
        rows = points.select(F.col(group).alias("g"), F.col(x).alias("x"), weight.cast("double").alias("w"))
        agg = X.group_sums(rows, X.exponents(points, x, weight)).withColumnRenamed("g", group)
    else:
        agg = points.groupBy(group).agg(vector_sum_agg(x, weight).alias("s"),
                                        F.sum(weight).alias("sw"))
    return agg.select(group, F.transform("s", lambda v: v / F.col("sw")).alias("mean"))


def explode_vector(df: DataFrame, keys: Sequence[str], y: str, pos: str = "pos",
                   v: str = "v") -> DataFrame:
    """Long form of a vector column: one row per coordinate ``keys…, pos, v``."""
    return df.select(*keys, F.posexplode(y).alias(pos, v))
