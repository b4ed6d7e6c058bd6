"""Every stage against SQL or brute force on its own input."""

import os
import subprocess
import sys

import duckdb
import pytest

from tessera.llm import oracle

from .test_simhash import brute_components, brute_fingerprint

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    import corpus_pipeline

    top, path, out = tmp_path_factory.mktemp("stages"), f"{sf}/documents.parquet", []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, spark.read.parquet(path), sf).write.parquet(str(top / str(k)))
        out.append((path, str(top / str(k))))
        path = str(top / str(k))
    return out


def sql(query, documents, sf):
    con = duckdb.connect()
    pattern = documents if documents.endswith(".parquet") else documents + "/*.parquet"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{pattern}')")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{sf}/benchmark.parquet')")
    return con.execute(query).fetchall()


def rows(path, columns="doc_id, text"):
    pattern = path if path.endswith(".parquet") else path + "/*.parquet"
    return duckdb.connect().execute(f"SELECT {columns} FROM read_parquet('{pattern}') ORDER BY doc_id").fetchall()


def test_columns(spark, stages):
    want = spark.read.parquet(stages[0][0]).columns
    assert [spark.read.parquet(out).columns for _, out in stages[:-1]] == [want] * 4
    for _, out in stages[:-1]:
        assert all(n == len(t) for t, n in ((r[1], r[2]) for r in rows(out, "doc_id, text, n_chars")))


def test_quality_stage(stages, sf):
    kept = sorted(r[0] for r in sql(f"SELECT doc_id FROM ({oracle.OP8}) WHERE kept", stages[0][0], sf))
    assert [r[0] for r in rows(stages[0][1])] == kept
    words = dict(sql(f"SELECT doc_id, n_words - n_removed_words FROM ({oracle.OP8}) WHERE kept", stages[0][0], sf))
    assert all(len(t.split()) == words[i] for i, t in rows(stages[0][1]))


def test_line_stage(stages, sf):
    import hashlib

    want = sql(f"SELECT doc_id, text_sha256 FROM ({oracle.OP7}) WHERE n_deleted = 0 OR n_deleted < n_lines ORDER BY 1", stages[1][0], sf)
    assert [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows(stages[1][1])] == want


def test_near_dedup_stage(stages):
    before = rows(stages[2][0])
    fps = [brute_fingerprint(t) for _, t in before]
    comp = brute_components(lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 2, len(before))
    assert rows(stages[2][1]) == [r for k, r in enumerate(before) if comp[k] == k]


def test_decontamination_stage(stages, sf):
    bad = {r[0] for r in sql(f"SELECT doc_id FROM ({oracle.OP2}) WHERE contaminated", stages[3][0], sf)}
    assert rows(stages[3][1]) == [r for r in rows(stages[3][0]) if r[0] not in bad]


def test_bpe_stage(stages):
    from tokenizers import Tokenizer

    from tessera.llm.vocab import tokenizer_path

    t = Tokenizer.from_file(tokenizer_path())
    got = rows(stages[4][1], "doc_id, text, token_ids, decoded, n_tokens")
    assert [r[0] for r in got] == [r[0] for r in rows(stages[4][0])]
    for (_, text, ids, decoded, n), e in zip(got, t.encode_batch([r[1] for r in got], add_special_tokens=False)):
        assert ids == e.ids and n == len(ids) and decoded == t.decode(e.ids, skip_special_tokens=False)


def test_run_equals_the_stages(spark, sf, stages):
    import corpus_pipeline

    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()) == [r[0] for r in rows(stages[4][1])]


def test_the_rest_imports_without_this_subpackage():
    code = """
import sys
class Hide:
    def find_spec(self, name, *_):
        if name == 'corpus_pipeline' or name.startswith('tessera.llm'):
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
assert 'wc_direct' in e.queries() and 'pipeline' not in e.queries() and 'wc_direct' in e.oracle_sql()
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def odd_documents(spark, sf):
    """Rows of the driver table beside nulls, empty and repeated rows, one long text, and columns with internal names."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    one = docs.limit(1)
    long = " ".join(f"word{i}" + ("\n" if i % 12 == 11 else "") for i in range(150_000))
    odd = [one.withColumns({"doc_id": F.lit(i).cast("long"), "text": F.lit(t).cast("string")})
           for i, t in ((-1, None), (-2, ""), (-3, long), (-4, " \n\n "), (None, "a text without an id, of few words"))]
    nulls = one.select(*[F.lit(None).cast(t).alias(c) for c, t in one.dtypes])
    for f in (*odd, nulls, one):
        docs = docs.unionByName(f)
    return docs.withColumns({c: F.lit(c) for c in ("_k", "_id", "_gone", "fp", "key", "n_words")})


def test_odd_rows_and_columns_in_every_stage(spark, sf):
    import corpus_pipeline
    from tessera.llm.common import written

    docs = written(odd_documents(spark, sf))
    extra = ["_k", "_id", "_gone", "fp", "key", "n_words"]
    out = {}
    for name, f in corpus_pipeline.STAGES:
        done = written(f(spark, docs, sf))
        assert done.columns[:len(docs.columns)] == docs.columns, name
        assert all(tuple(r) == tuple(extra) for r in done.select(*extra).collect()), name
        out[name] = sorted(((r.doc_id, r.text) for r in done.select("doc_id", "text").collect()), key=str)
        none = f(spark, docs.limit(0), sf)
        assert none.columns == done.columns and none.count() == 0, name
    before = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    by_id = {name: [i for i, _ in kept] for name, kept in out.items()}
    quality = by_id["quality rules"]
    assert not {-1, -2, -4, None} & set(quality) and -3 in quality   # under 20 words
    lines = out["line dedup"]
    assert {(-1, None), (-2, ""), (-4, " \n\n "), (None, None)} <= set(lines) and -3 in by_id["line dedup"]
    near = by_id["SimHash near-dedup"]
    assert sum(i in (-1, -2, -4) for i in near) == 1 and -3 in near   # texts without words are one group
    assert len(near) < len(before)
    assert out["benchmark decontamination"] == [r for r in before if r[0] in set(by_id["benchmark decontamination"])]
    assert {-1, -2, -3, -4, None} <= set(by_id["benchmark decontamination"])
    assert out["BPE encoding and decoding"] == before
