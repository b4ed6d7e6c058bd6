from tessera.sources import tables
from tessera.sources.text import parse_numbers


def test_tolerant_number_parse(spark):
    lines = spark.createDataFrame([(" 1.5 ",), ("x",), ("",), ("2e3",), ("\t-4\r",)], "value string")
    got = sorted(r["value"] for r in parse_numbers(lines, strict=False).collect())
    assert got == [-4.0, 1.5, 2000.0]


def test_table_adapters_prune_columns(spark):
    import os
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    plan = tables.numbers(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
