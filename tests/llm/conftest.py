import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of (doc_id, text) rows, with columns whose names clash with internal ones."""
    def make(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(rows), schema)
        return df.withColumns({c: F.lit("x") for c in ("key", "id", "fp", "hashes", "gone", "first", "n", "mark")})
    return make


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF
