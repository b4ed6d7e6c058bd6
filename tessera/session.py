"""Session helpers.

The library never builds its own cluster session: every operator takes the
caller's ``SparkSession``. ``local_session`` exists for tests, the bench and the
smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tessera", driver_memory: str = "8g") -> SparkSession:
    """A ``local[cores]`` session tuned for small test data (UI off, AQE on)."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder on a cluster and
    is used as is. Where it is unset (a bare test session) the folder lies in the
    session's warehouse on a local master; a cluster must name one, as its executors need not share
    the driver's warehouse path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_RUN: ContextVar[str | None] = ContextVar("tessera_run", default=None)


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[str]:
    """The tables that the library writes inside the block lie in a folder of their own, which goes at its end.

    A result must be read or written inside the block; nothing else in the shared folder is touched.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession) -> str:
    """A new name in the shared checkpoint folder, or in the folder of the run (:func:`run_tables`)."""
    return f"{_RUN.get() or ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}.parquet"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again: computed once,
    of known size, and safe from lost executors."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
