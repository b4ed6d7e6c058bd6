import pytest
from pyspark.sql import functions as F

from tessera.operators import paging
from tessera.sources.text import read_lines, with_line_number


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_index_is_consecutive_in_order(spark, parts):
    df = spark.range(0, 1000, 7).selectExpr("id * 13 % 1009 AS key").repartition(5)
    got = paging.with_row_index(df, ["key"], num_partitions=parts).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(len(got)))
    assert [r["key"] for r in got] == sorted(r["key"] for r in got)


def test_page_is_half_open(spark):
    idx = paging.with_row_index(spark.range(50).selectExpr("id AS key"), ["key"])
    assert sorted(r["key"] for r in paging.page(idx, 10, 20).collect()) == list(range(10, 20))


def test_iter_pages_covers_everything_once(spark):
    df = spark.range(23).selectExpr("id AS key")
    seen = []
    for pg in paging.iter_pages(df, ["key"], 5):
        seen.extend(r["key"] for r in pg.collect())
    assert seen == list(range(23))
    with pytest.raises(ValueError):
        next(paging.iter_pages(df, ["key"], 0))


def test_line_numbers_across_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a0\na1\n\na3\n")
    (tmp_path / "b.txt").write_text("b0\nb1")
    lines = with_line_number(read_lines(spark, str(tmp_path)), "n").orderBy("n").collect()
    assert [(r["n"], r["value"]) for r in lines] == [(0, "a0"), (1, "a1"), (2, ""), (3, "a3"),
                                                    (4, "b0"), (5, "b1")]


def test_line_numbers_when_one_file_has_many_splits(spark, tmp_path):
    lines = [f"line {i:05d} " + "x" * (i % 40) for i in range(3000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_lines(spark, str(tmp_path / "big.txt"))
        assert df.rdd.getNumPartitions() > 5
        got = with_line_number(df, "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["n"] for r in got] == list(range(3000))
    assert [r["value"] for r in got] == lines


def test_line_numbers_survive_a_change_of_split_size(spark, tmp_path):
    lines = [f"line {i:05d}" for i in range(20000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for built, read in (("65536", "4096"), ("4096", "65536"), ("10000", "7001")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", built)
            df = with_line_number(read_lines(spark, str(tmp_path / "big.txt")), "n")
            spark.conf.set("spark.sql.files.maxPartitionBytes", read)
            got = [(r["n"], r["value"]) for r in df.orderBy("n").collect()]
            assert got == list(enumerate(lines))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_read_vectors_from_several_files(spark, tmp_path):
    from tessera.sources.text import read_vectors
    (tmp_path / "p1.txt").write_text("1 2\n3 4\n")
    (tmp_path / "p2.txt").write_text("5 6\n")
    got = [(r["id"], r["x"]) for r in read_vectors(spark, str(tmp_path)).orderBy("id").collect()]
    assert got == [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])]


def test_row_index_spreads_a_hot_key(spark):
    # a third of the rows share key 5: the hash tiebreaker spreads them over several partitions
    rows = [(5 if i % 3 == 0 else i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "key long, payload long")
    idx = paging.with_row_index(df, ["key"], num_partitions=6)
    got = idx.orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(900))
    assert [r["key"] for r in got] == sorted(k for k, _ in rows)


def test_row_index_needs_and_leaves_no_cache(spark):
    spark.catalog.clearCache()
    idx = paging.with_row_index(spark.range(50000).selectExpr("id * 7919 % 50021 AS key"), ["key"], num_partitions=7)
    spark.catalog.clearCache()
    assert idx.selectExpr("min(idx)", "max(idx)", "count(DISTINCT idx)").first()[:] == (0, 49999, 50000)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_page_sums_pulls_no_pages_and_agrees_with_them(spark, monkeypatch):
    from tessera.plans import catalog
    from tessera.sources import tables

    ids = spark.range(0, 3500, 7).selectExpr("id * 13 % 3511 AS vec_id").repartition(3)
    monkeypatch.setattr(tables, "table", lambda *_: ids)
    pull, pages = paging.iter_pages, []
    for i, pg in enumerate(pull(ids, ["vec_id"], catalog.PAGE_SIZE)):
        own = [r["vec_id"] for r in pg.collect()]
        pages.append((i, own[0], sum(own), len(own)))

    def no_pull(*_):
        raise AssertionError("a job per page")
    monkeypatch.setattr(paging, "iter_pages", no_pull)
    got = catalog.page_sums(spark, "")
    assert got.dtypes == [(c, "bigint") for c in ("page", "first_id", "sum_id", "n")]
    assert sorted(map(tuple, got.collect())) == pages and len(pages) == 3


def test_a_page_reads_its_own_files_only(spark):
    df = spark.range(4000).selectExpr("id * 13 % 4001 AS key", "uuid() AS pad")
    sizes = []
    for n in (400, 4000):
        pages = list(paging.iter_pages(df.limit(n), ["key"], 100))
        assert len(pages) == n // 100
        files = [f for pg in pages for f in pg.inputFiles()]
        assert len(files) == len(set(files))  # no file in two pages
        sizes.append(max(len(pg.inputFiles()) for pg in pages))
        assert [r["idx"] for r in pages[2].collect()] == list(range(200, 300))
    assert sizes[1] <= sizes[0] + 1
    assert list(paging.iter_pages(df.limit(0), ["key"], 100)) == []
