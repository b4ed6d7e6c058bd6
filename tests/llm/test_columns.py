"""Columns whose names look internal, and one very long text, through the operators that pass rows on."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, lines, quality, simhash, suffixes
from tessera.llm.vocab import tokenizer_path

NAMES = ("_k", "_id", "_key", "_words", "_lines", "_all", "_gone", "_host", "_own", "_hashes", "_windows", "_sorted", "_at", "_worded", "_from", "_stay", "__own")
WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(WORDS[i % 3:]) + f"\nline of {i} ending\nshared one\nshared two\nshared three", "src") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in NAMES})


def unchanged(out):
    rows = out.select("doc_id", *NAMES).collect()
    assert rows
    for r in rows:
        assert [r[c] for c in NAMES] == [f"{c}{r.doc_id}" for c in NAMES]


def test_underscore_columns_come_back_as_they_were(spark, docs):
    items = spark.createDataFrame([("a", "nothing of it here")], "item_id string, text string")
    out = lines.dedup_lines(docs)
    unchanged(out)
    assert [r.n_deleted for r in out.orderBy("doc_id").collect()] == [0, 3, 3, 4, 4, 4]
    unchanged(quality.apply_quality(docs))
    unchanged(quality.judge(docs))
    unchanged(simhash.dedup(docs))
    unchanged(decontam.decontaminate(docs, items))
    unchanged(suffixes.remove_repeats(docs))
    unchanged(bpe.encode_decode(docs, tokenizer_path()))


def test_one_text_of_five_megabytes(spark):
    text = "\n".join(" ".join(f"t{i * 7919 % 1_000_003}" for i in range(a, a + 9)) for a in range(0, 640_000, 9))
    assert len(text) > 5_000_000 - 200_000
    df = spark.createDataFrame([(1, text, "s"), (2, text + "\nmore of it", "s")], "doc_id long, text string, source string")
    item = spark.createDataFrame([("a", " ".join(text.split()[-20:]))], "item_id string, text string")
    n = len(text.split())
    got = {r.id: r for r in decontam.contamination(df, item).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1]["items"]) == (n, 20, ["a"])
    out = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert out[1].text == text and out[2].text == "more of it"
    assert {r.doc_id: r.n_words for r in quality.judge(df).collect()} == {1: n, 2: n + 3}
    assert {r.id: r["first"].id for r in simhash.near_duplicates(df).collect()} == {1: 1, 2: 1}
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(df).collect()}
    assert kept[1] == b"" and len(kept[2]) < 12
