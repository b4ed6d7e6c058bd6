"""Run by tests/test_fault_tolerance.py in its own JVM (local mode with task retries).

Injects one failure into the first attempt of a task — on the map side of the
coreset's round-robin shuffle, and in the kernel stage after it — and checks
that the retried jobs return exactly what a clean run returns.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def passthrough(batches):
    # same plan shape as `flaky`, never fails: the baseline for map-side injection
    yield from batches


def main():
    spark = (SparkSession.builder.master("local[4,3]").appName("retry")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from tessera.operators import kmeans, kmedian
    from tessera.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    rows = [(i, [float((i * 7) % 23), float((i * 3) % 11)]) for i in range(400)]
    pts = spark.createDataFrame(rows, "id long, x array<double>").repartition(4)

    def core_rows(df, after=False):
        core = kmedian.coreset(df, 3, 4, 2, seed=5)
        if after:
            core = core.mapInPandas(flaky, core.schema)
        return sorted((r["part"], r["c"], tuple(r["y"]), r["w"]) for r in core.collect())

    clean = core_rows(pts)
    baseline = core_rows(pts.mapInPandas(passthrough, pts.schema))
    map_side = core_rows(pts.mapInPandas(flaky, pts.schema))
    reduce_side = core_rows(pts, after=True)
    fit_clean = kmeans.fit(pts, 3, 2, seed=9, persist=True)
    fit_flaky = kmeans.fit(pts.mapInPandas(flaky, pts.schema), 3, 2, seed=9, persist=True)
    print(json.dumps({
        "map_side_equal": baseline == map_side,
        "reduce_side_equal": clean == reduce_side,
        "fit_equal": fit_clean == fit_flaky,
        "weights": sum(r[3] for r in clean),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
