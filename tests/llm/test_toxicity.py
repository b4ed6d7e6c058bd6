import zlib

from pyspark.sql import functions as F

from tessera.llm import toxicity


def test_obfuscation_is_undone():
    at = toxicity.FEATURES.index
    lex = {"idiot": 3.0, "stupid": 2.0}
    plain = toxicity.features("you idiot, what a STUPID thing!", lex)
    assert plain[at("hits")] > 0 and plain[at("near")] == 1.0 and plain[at("exclaimed")] > 0 and plain[at("capitals")] > 0
    for text in ("you 1d10t go", "such an i d i o t here", "an i.d.i.o.t", "idiooooot", "st*upid it is"):
        f = toxicity.features(text, lex)
        assert f[at("hits")] == 0 and f[at("undone")] > 0, text
    assert toxicity.features("", lex) == [0.0] * len(toxicity.FEATURES)


def test_held_out_accuracy_of_the_query(spark):
    import os

    import pytest
    from tessera.llm.registry import QUERIES

    big = "/root/testdata/sf0.1"
    if not os.path.isdir(big):
        pytest.skip("driver test data not present")
    out = QUERIES["op4_toxicity"](spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id", "left").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert len(rows) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out and r.toxic is not None]
    pos, neg = [r.score for r in test if r.toxic], [r.score for r in test if not r.toxic]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.95 and sum(r.predicted == r.toxic for r in test) / len(test) > 0.95


def test_edge_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "you idiot"), (3, "x" * 5000)])
    one = docs.select("text", F.lit(0).alias("label"))
    for labelled in (one, one.limit(0), one.withColumn("label", F.lit(None).cast("int"))):
        out = toxicity.fit(labelled, F.lit(5).cast("long")).score(docs)
        assert out.columns == docs.columns + ["score"] and [r.score for r in out.collect()] == [0.0] * 5
    model = toxicity.fit(spark.createDataFrame(
        [(f"word{i % 7} you {'idiot' if i % 3 == 0 else 'friend'} and more", int(i % 3 == 0)) for i in range(300)], "text string, label int"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40)))
    got = model.score(docs)
    assert got.columns == docs.columns + ["score"] and got.count() == 5
    assert model.score(docs.limit(0)).count() == 0


def test_the_z_value_decides_what_is_in_the_lexicon(spark):
    # 300 words in six toxic texts each and no other; a word in toxic texts a little more often than elsewhere; one that is common
    rows = [(" ".join(["all", *("bad" + "abcdefghij"[w // 100] + "abcdefghij"[w // 10 % 10] + "abcdefghij"[w % 10] for w in range(300) if (w + i) % 50 < 6)]
                      + ["weak"] * (i < 10)), 1) for i in range(50)]
    rows += [("all " + "weak" * (i < 38), 0) for i in range(450)]
    labelled = spark.createDataFrame(rows, "text string, label int")
    got = toxicity.learn_lexicon(labelled)
    assert len(got) == 300 and all(w.startswith("bad") for w in got)
    assert "weak" in toxicity.learn_lexicon(labelled, least=2.0)
    assert len(toxicity.learn_lexicon(labelled, size=7)) == 7
