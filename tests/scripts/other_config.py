"""Run by tests/test_config_robustness.py: every registered query under an unusual
session configuration, compared with its DuckDB oracle on the smallest tables."""

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


def main():
    import duckdb

    import __spark_entry__ as se
    from check_oracle import TABLES, digest
    from tessera.plans.catalog import QUERIES

    spark = (SparkSession.builder.master("local[2]").appName("config")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "37")
             .config("spark.sql.adaptive.enabled", "false")
             .config("spark.sql.ansi.enabled", "false")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = []
    for name, fn in QUERIES.items():
        df = fn(spark, SF)
        rows = [tuple(r) for r in df.collect()]
        if name not in se.oracle_sql():  # it ran; its own test compares it with brute force
            continue
        cur = con.execute(se.oracle_sql()[name])
        ocols = [d[0] for d in cur.description]
        if digest(df.columns, rows)[0] != digest(ocols, cur.fetchall())[0]:
            bad.append(name)
    print(json.dumps({"mismatches": bad, "n": len(QUERIES)}))
    spark.stop()


if __name__ == "__main__":
    main()
