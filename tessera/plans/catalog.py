"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables (or data Spark derives from them).
Float outputs are rounded to 6 decimals so the DuckDB oracle can compare them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import kmeans, kmedian, numeric, paging, sampling, words
from ..operators import vectors as V
from ..session import fresh_path, written
from ..sources import tables
from ..sources.text import parse_numbers, parse_vectors, read_lines, with_line_number

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
THRESHOLD = 0.5          # P3: strict "greater than"
SALT_BUCKETS = 8         # P5: K
SUM_SQ_SCALE = 1e12      # sum of squares is ~1e14: scaled so 6 decimals are meaningful
SEED = 42
RACE_ROUND = 1           # V5(a): round number in the uniform's key
PREFIX_FRAC = 0.37       # V5(b): x
KPP_K = 4                # V6 / V8: k
FIT_ITERATIONS = 2       # V8: Lloyd steps after seeding
WEIGHT_PARTS = 4         # A15: part = vec_id mod 4
CORESET_K = 3            # V10 / V11: k
CORESET_MIN_PARTS = 2    # V10 / V11: L = max(2, parts of ~128 MB), part = hash of vec_id
CORESET_ITERATIONS = 1   # V10 / V11: Lloyd steps in rounds 1 and 2
CORESET_BLOCK = 128      # V10 by merge-and-reduce: points clustered at a time
SEED_K = 12              # V6 by rejection: k
PAGE_SIZE = 200          # K2: rows of a page of page_sums
PULL_SIZE = 1000         # K2: rows of a pulled page
BLOCK_CENTERS = 2        # V2 by blocks: centres of a block
PAGE_START, PAGE_END = 100, 200   # P7 / K2: one page of the row index


def _r(c, digits: int = 6):
    return F.round(c, digits)


# --------------------------------------------------------------------------- numeric

def num_sum_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = numeric.sum_of_squares(tables.numbers(spark, sf_dir))
    return df.select(_r(F.col("sum_sq") / SUM_SQ_SCALE).alias("sum_sq"))


def num_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric.max_value(tables.numbers(spark, sf_dir))


def num_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = numeric.normalize(tables.numbers(spark, sf_dir))
    return df.select("l_orderkey", "l_linenumber", _r(F.col("z")).alias("z"))


def num_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = numeric.normalized_summary(tables.numbers(spark, sf_dir), threshold=THRESHOLD)
    return s.select("n", *[_r(F.col(c)).alias(c)
                           for c in ("mean", "m2", "stddev_pop", "max_value", "min_value")])


def num_over_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = numeric.normalized_summary(tables.numbers(spark, sf_dir), threshold=THRESHOLD)
    return s.select(F.col("n_over").alias("n"))


# --------------------------------------------------------------------------- words

def wc_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count_per_doc(tables.documents(spark, sf_dir), arrow=True)


def _wc(variant: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return words.word_count(tables.documents(spark, sf_dir), variant, SALT_BUCKETS, arrow=True)
    run.__name__ = f"wc_{variant}"
    return run


def wc_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.distinct_word_count(tables.documents(spark, sf_dir))


def wc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.token_count(tables.documents(spark, sf_dir))


def doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.document_count(tables.documents(spark, sf_dir))


def wc_avg_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    wc = words.word_count(tables.documents(spark, sf_dir))
    return words.mean_distinct_word_length(wc).select(_r(F.col("avg_len")).alias("avg_len"))


# --------------------------------------------------------------------------- vectors

def _points(spark: SparkSession, sf_dir: str, with_label: bool = False) -> DataFrame:
    return tables.points(spark, sf_dir, with_label)


def label_centers(spark: SparkSession, sf_dir: str) -> list[list[float]]:
    """Centre set derived from the data: the mean embedding of each label, in label order."""
    means = V.weighted_mean(_points(spark, sf_dir, True), "label")
    return V.collect_centers(means.select(F.col("label").alias("c"), F.col("mean").alias("y")))


def _with_min_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.assign(_points(spark, sf_dir), label_centers(spark, sf_dir))


def vec_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors rendered as single-space text lines and parsed back."""
    text = _points(spark, sf_dir).select(
        "id", F.array_join(F.transform("x", lambda e: e.cast("string")), " ").alias("value"))
    parsed = text.select("id", parse_vectors(text, sep=" ").alias("x"))
    return parsed.select(F.col("id").alias("vec_id"), F.size("x").alias("dim"),
                         _r(F.aggregate("x", F.lit(0.0), lambda a, b: a + b)).alias("sum_x"))


def vec_scan_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with tab / repeated-space separators, split on any whitespace run."""
    text = _points(spark, sf_dir).select(
        "id", F.concat(F.lit(" \t"), F.array_join(F.transform("x", lambda e: e.cast("string")), " \t  "),
                       F.lit("  ")).alias("value"))
    parsed = text.select("id", parse_vectors(text, sep=None).alias("x"))
    return parsed.select(F.col("id").alias("vec_id"), F.size("x").alias("dim"),
                         _r(F.aggregate("x", F.lit(0.0), lambda a, b: a + b)).alias("sum_x"))


def vec_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: the distance of every point to the centre of its own label."""
    means = V.weighted_mean(_points(spark, sf_dir, True), "label")
    labels = written(paging.with_row_index(means.select("label", "mean"), ["label"], "c"))
    centers = V.collect_centers(labels, "c", "mean")
    own = _points(spark, sf_dir, True).join(labels.select("label", F.col("c").cast("int").alias("c")), "label")
    out = V.distance_to_center(own, centers)
    return out.select(F.col("id").alias("vec_id"), "c", _r(F.col("d")).alias("d"))


def vec_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_min_distance(spark, sf_dir).select(F.col("id").alias("vec_id"), "c",
                                                    _r(F.col("d")).alias("d"))


def vec_min_distance_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 folded over the centres one at a time (each step looks at the newest centre only)."""
    df = _points(spark, sf_dir)
    for y in label_centers(spark, sf_dir):
        df = V.update_min_distance(df, y)
    return df.select(F.col("id").alias("vec_id"), _r(F.col("d")).alias("d"))


def vec_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = _points(spark, sf_dir).withColumn("part", F.pmod(F.col("id"), F.lit(WEIGHT_PARTS)))
    return V.cluster_weights(pts, label_centers(spark, sf_dir), part="part")


def vec_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    obj = V.objective(_points(spark, sf_dir), label_centers(spark, sf_dir))
    return obj.select(_r(F.col("objective")).alias("objective"))


def vec_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = _points(spark, sf_dir, True).withColumn(
        "w", (F.pmod(F.col("id"), F.lit(5)) + 1).cast("double"))
    means = V.weighted_mean(pts, "label", w="w")
    return V.explode_vector(means, ["label"], "mean").select("label", "pos", _r(F.col("v")).alias("v"))


def pick_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    won = sampling.race_pick(_with_min_distance(spark, sf_dir), SEED, RACE_ROUND)
    return won.select(F.col("id").alias("vec_id"))


def pick_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    won = sampling.prefix_pick(_with_min_distance(spark, sf_dir), PREFIX_FRAC)
    return won.select(F.col("id").alias("vec_id"))


def seed_kpp(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = sampling.seed_centers(_points(spark, sf_dir), KPP_K, SEED)
    rows = [(i, vid) for i, (vid, _) in enumerate(seeds)]
    return spark.createDataFrame(rows, "step int, vec_id long")


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = kmeans.lloyd_step_frame(_points(spark, sf_dir), label_centers(spark, sf_dir))
    return V.explode_vector(new, ["c"], "y").select("c", "pos", _r(F.col("v")).alias("v"))


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = kmeans.fit_frame(_points(spark, sf_dir), KPP_K, FIT_ITERATIONS, SEED)
    return V.explode_vector(final, ["c"], "y").select("c", "pos", _r(F.col("v")).alias("v"))


def kmeans_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded fit (V8) followed by the mean distance to the fitted centres (V9)."""
    pts = _points(spark, sf_dir)
    centers = kmeans.fit(pts, KPP_K, FIT_ITERATIONS, SEED)
    return V.objective(pts, centers).select(_r(F.col("objective")).alias("objective"))


def coreset_parts(spark: SparkSession, sf_dir: str) -> int:
    """L sized from the data: parts of about 128 MB, at least 2. The rows come from the files' footers."""
    t = tables.table(spark, sf_dir, "embeddings")
    first = t.select(F.size("embedding").alias("dim")).first()
    return kmedian.suggest_parts(t.count(), int(first["dim"]) if first else 0, CORESET_K, min_parts=CORESET_MIN_PARTS)


def _coreset_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    parts = coreset_parts(spark, sf_dir)
    return _points(spark, sf_dir).withColumn("part", kmedian.hashed_part("id", parts, SEED)), parts


def kmedian_coreset(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, parts = _coreset_points(spark, sf_dir)
    core = kmedian.coreset(pts, CORESET_K, parts, CORESET_ITERATIONS, SEED, part_col="part")
    return core.select("part", "c", _r(F.col("w")).alias("w"),
                       _r(F.aggregate("y", F.lit(0.0), lambda a, b: a + b)).alias("sum_y"))


def mr_kmedian(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, parts = _coreset_points(spark, sf_dir)
    obj = kmedian.mr_kmedian(pts, CORESET_K, parts, CORESET_ITERATIONS, SEED, part_col="part")
    return obj.select(_r(F.col("objective")).alias("objective"))


def kmedian_coreset_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10 by merge-and-reduce: a worker holds one block, whatever the part's size."""
    pts, parts = _coreset_points(spark, sf_dir)
    core = kmedian.coreset_by_blocks(pts, CORESET_K, parts, CORESET_ITERATIONS, SEED, part_col="part", block=CORESET_BLOCK)
    return core.select("part", "c", _r(F.col("w")).alias("w"),
                       _r(F.aggregate("y", F.lit(0.0), lambda a, b: a + b)).alias("sum_y"))


def mr_kmedian_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 with its first round by merge-and-reduce."""
    pts, parts = _coreset_points(spark, sf_dir)
    obj = kmedian.mr_kmedian(pts, CORESET_K, parts, CORESET_ITERATIONS, SEED, part_col="part", block=CORESET_BLOCK)
    return obj.select(_r(F.col("objective")).alias("objective"))


def seed_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 by rejection: several centres per pass over the points."""
    seeds, _ = sampling.seed_by_rejection(_points(spark, sf_dir), SEED_K, SEED)
    return spark.createDataFrame([(i, vid) for i, (vid, _) in enumerate(seeds)], "step int, vec_id long")


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = tables.table(spark, sf_dir, "embeddings").select("vec_id")
    return paging.with_row_index(ids, ["vec_id"])


def num_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers rendered as text lines with blanks around them and parsed back."""
    lines = tables.numbers(spark, sf_dir).select(F.concat(F.lit(" \t"), F.col("value").cast("string"), F.lit(" ")).alias("value"))
    return parse_numbers(lines).groupBy(F.col("value").alias("x")).agg(F.count(F.lit(1)).alias("n"))


def page_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the pages of the row index in one aggregate; one row per page with its first id and the sum of its ids."""
    ids = tables.table(spark, sf_dir, "embeddings").select("vec_id")
    page = F.floor(F.col("idx") / PAGE_SIZE).cast("long")
    return (paging.with_row_index(ids, ["vec_id"]).groupBy(page.alias("page"))
            .agg(F.min("vec_id").alias("first_id"), F.sum("vec_id").alias("sum_id"), F.count(F.lit(1)).alias("n")))


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = tables.table(spark, sf_dir, "embeddings").select("vec_id")
    return paging.page(paging.with_row_index(ids, ["vec_id"]), PAGE_START, PAGE_END)


def page_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the pages pulled one after the other. Each is a job that reads its own files and appends its row to the
    shared folder, so neither the driver nor a job holds more than a page."""
    ids = tables.table(spark, sf_dir, "embeddings").select("vec_id")
    path, schema = fresh_path(spark), "page long, first_id long, sum_id long, n long"
    spark.createDataFrame([], schema).write.parquet(path)
    for i, rows in enumerate(paging.iter_pages(ids, ["vec_id"], PULL_SIZE)):
        one = rows.agg(F.min("vec_id").alias("first_id"), F.sum("vec_id").alias("sum_id"), F.count(F.lit(1)).alias("n"))
        one.select(F.lit(i).cast("long").alias("page"), "first_id", "sum_id", "n").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a text file of a line each, scanned and numbered."""
    path = fresh_path(spark)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]+", " ")
    tables.documents(spark, sf_dir).select(text.alias("value")).write.text(path)
    lines = with_line_number(read_lines(spark, path))
    return lines.agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_no"), F.sum("line_no").alias("sum_no"),
                     F.count_distinct("line_no").alias("n_no"), F.sum(F.char_length("value")).cast("long").alias("n_chars"),
                     F.count_distinct("value").alias("n_texts"))


def vec_mean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 with sums that do not depend on the order of the tasks."""
    pts = _points(spark, sf_dir, True).withColumn("w", (F.pmod(F.col("id"), F.lit(5)) + 1).cast("double"))
    means = V.weighted_mean(pts, "label", w="w", exact=True)
    return V.explode_vector(means, ["label"], "mean").select("label", "pos", _r(F.col("v")).alias("v"))


def vec_assign_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 by blocks of centres, merged by the smallest (d, c)."""
    centers = label_centers(spark, sf_dir)
    out = V.assign_by_blocks(_points(spark, sf_dir), V.centers_frame(spark, centers), block_bytes=BLOCK_CENTERS * len(centers[0]) * 8)
    return out.select(F.col("id").alias("vec_id"), "c", _r(F.col("d")).alias("d"))


def lloyd_step_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 by blocks of centres."""
    centers = label_centers(spark, sf_dir)
    new = kmeans.lloyd_step_by_blocks(_points(spark, sf_dir), V.centers_frame(spark, centers), block_bytes=BLOCK_CENTERS * len(centers[0]) * 8)
    return V.explode_vector(new, ["c"], "y").select("c", "pos", _r(F.col("v")).alias("v"))


def kmeans_fit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 with carried bounds and exact sums."""
    centers, _ = kmeans.fit_by_bounds(_points(spark, sf_dir), KPP_K, FIT_ITERATIONS, SEED)
    return V.explode_vector(V.centers_frame(spark, centers), ["c"], "y").select("c", "pos", _r(F.col("v")).alias("v"))


def kmeans_fit_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: V8 over points kept on the executors between rounds."""
    centers = kmeans.fit(_points(spark, sf_dir), KPP_K, FIT_ITERATIONS, SEED, persist=True)
    return V.explode_vector(V.centers_frame(spark, centers), ["c"], "y").select("c", "pos", _r(F.col("v")).alias("v"))


QUERIES: dict[str, QueryFn] = {
    "num_sum_squares": num_sum_squares,
    "num_max": num_max,
    "num_normalized": num_normalized,
    "num_stats": num_stats,
    "num_over_half": num_over_half,
    "wc_per_doc": wc_per_doc,
    "wc_direct": _wc("direct"),
    "wc_salted": _wc("salted"),
    "wc_partition": _wc("partition"),
    "wc_grouped": _wc("grouped"),
    "wc_distinct": wc_distinct,
    "wc_tokens": wc_tokens,
    "doc_count": doc_count,
    "wc_avg_len": wc_avg_len,
    "vec_scan": vec_scan,
    "vec_scan_ws": vec_scan_ws,
    "vec_distance": vec_distance,
    "vec_assign": vec_assign,
    "vec_min_distance_update": vec_min_distance_update,
    "vec_weights": vec_weights,
    "vec_objective": vec_objective,
    "vec_weighted_mean": vec_weighted_mean,
    "pick_race": pick_race,
    "pick_prefix": pick_prefix,
    "seed_kpp": seed_kpp,
    "lloyd_step": lloyd_step,
    "kmeans_fit": kmeans_fit,
    "kmeans_objective": kmeans_objective,
    "kmedian_coreset": kmedian_coreset,
    "mr_kmedian": mr_kmedian,
    "kmedian_coreset_blocks": kmedian_coreset_blocks,
    "mr_kmedian_blocks": mr_kmedian_blocks,
    "seed_rejection": seed_rejection,
    "row_index": row_index,
    "num_scan": num_scan,
    "page_sums": page_sums,
    "page_rows": page_rows,
    "page_pull": page_pull,
    "text_lines": text_lines,
    "vec_mean_exact": vec_mean_exact,
    "vec_assign_blocks": vec_assign_blocks,
    "lloyd_step_blocks": lloyd_step_blocks,
    "kmeans_fit_bounds": kmeans_fit_bounds,
    "kmeans_fit_cached": kmeans_fit_cached,
}
