import pytest
from pyspark.sql import functions as F

from tessera.operators import words
from tessera.sources.text import read_documents

GOLDEN = {"ciao": 8, "e": 5, "bene": 4, "riga": 3, "lunga": 3, "anche": 2, "se": 2, "questa": 2,
          "molto": 2, "non": 2, "si": 2, "sa": 2, "quando": 2, "finisce": 2, "come": 1, "va": 1,
          "qui": 1, "tutto": 1}


@pytest.fixture
def docs(spark, fixture_path):
    return read_documents(spark, fixture_path("documents.txt"))


def _counts(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_read_documents_line_numbers(docs):
    rows = docs.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 2, 3]
    assert rows[0]["text"] == "ciao come va bene riga"
    assert rows[3]["text"].endswith("ciao ciao ciao")  # last line without newline


@pytest.mark.parametrize("variant", words.VARIANTS)
def test_variants_golden(docs, variant):
    assert _counts(words.word_count(docs, variant, buckets=3)) == GOLDEN


@pytest.mark.parametrize("variant", words.VARIANTS)
def test_variants_with_k_partitions(docs, variant):
    assert _counts(words.word_count(docs, variant, buckets=2, partitions=3)) == GOLDEN


def test_distinct_tokens_and_mean_length(docs):
    assert words.distinct_word_count(docs).first()["n"] == 18
    assert words.token_count(docs).first()["n"] == 45
    assert words.document_count(docs).first()["n"] == 4
    wc = words.word_count(docs)
    avg = words.mean_distinct_word_length(wc).first()["avg_len"]
    assert avg == pytest.approx(70 / 18)


def test_per_doc_counts(docs):
    rows = {(r["doc_id"], r["word"]): r["n"] for r in words.word_count_per_doc(docs).collect()}
    assert rows[(2, "ciao")] == 3 and rows[(0, "ciao")] == 1 and rows[(1, "e")] == 1
    assert sum(rows.values()) == 45


@pytest.mark.parametrize("text,expected", [
    ("", {"": 1}),
    (" ", {"": 2}),
    ("a  b", {"a": 1, "": 1, "b": 1}),
    ("a ", {"a": 1, "": 1}),
    ("a\tb", {"a\tb": 1}),
    ("A a a.", {"A": 1, "a": 1, "a.": 1}),
])
def test_tokenizer_edge_cases(spark, text, expected):
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    for variant in words.VARIANTS:
        assert _counts(words.word_count(df, variant)) == expected, variant


def test_null_text_has_no_tokens(spark):
    df = spark.createDataFrame([(0, None), (1, "x")], "doc_id long, text string")
    for variant in words.VARIANTS:
        assert _counts(words.word_count(df, variant)) == {"x": 1}


def test_hot_word_salted_spreads(spark):
    # one word holds most tokens; salting splits it over the buckets, totals stay exact
    rows = [(i, "hot " * 50 + f"w{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    first = (words.tokens(df).withColumn("salt", words.salt(buckets=8))
             .where(F.col("word") == "hot").select("salt").distinct().count())
    assert first == 8
    counts = _counts(words.word_count(df, "salted", buckets=8))
    assert counts["hot"] == 200 * 50 and "" not in counts and len(counts) == 201


def test_unknown_variant(docs):
    with pytest.raises(ValueError):
        words.word_count(docs, "nope")


def test_variants_match_python_split_on_random_texts(spark):
    import random
    from collections import Counter

    rng = random.Random(7)
    alphabet = ["a", "b", "ciao", "É", "ß", "日本", " ", " ", " ", "\t", "\n", "x.", ""]
    rows = []
    for i in range(300):
        if i % 50 == 0:
            rows.append((i, None))
            continue
        rows.append((i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))))
    want = Counter(w for _, t in rows if t is not None for w in t.split(" "))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for variant in words.VARIANTS:
        assert _counts(words.word_count(df, variant, buckets=3)) == dict(want), variant
    per_doc = {(r["doc_id"], r["word"]): r["n"] for r in words.word_count_per_doc(df).collect()}
    assert per_doc == {(i, w): n for i, t in rows if t is not None for w, n in Counter(t.split(" ")).items()}
    assert words.token_count(df).first()["n"] == sum(want.values())
    avg = words.mean_distinct_word_length(words.word_count(df)).first()["avg_len"]
    assert avg == pytest.approx(sum(len(w) for w in want) / len(want))


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return plan.count("Exchange hashpartitioning"), "Arrow" in plan or "Python" in plan or "Pandas" in plan


def test_exchanges_of_the_variants(spark):
    df = spark.range(100).selectExpr("id AS doc_id", "concat('a b ', id) AS text")
    want = {"direct": 1, "salted": 2, "partition": 2, "grouped": 1}
    assert {v: _exchanges(words.word_count(df, v)) for v in want} == {v: (n, False) for v, n in want.items()}
    assert _exchanges(words.word_count_per_doc(df)) == (0, False)


def test_counts_by_arrow_equal_the_native_ones(spark, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(words, "SLICE_BYTES", 40)
    texts = [None, "", " ", "a  b a", "é ü é", "tab\tin word\n x", "z" * 100 + " z", "a b " * 60, "\x00 q"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "a a"), (3, "a")], "doc_id long, text string").coalesce(2)
    want = Counter(tuple(r) for r in words.word_count_per_doc(df).collect())
    got = words.word_count_per_doc(df, arrow=True)
    assert Counter(tuple(r) for r in got.collect()) == want and got.dtypes == words.word_count_per_doc(df).dtypes
    assert words.word_count_per_doc(df.limit(0), arrow=True).collect() == []
    grouped = {r["word"]: r["n"] for r in words.word_count(df, "grouped", arrow=True).collect()}
    assert grouped == {r["word"]: r["n"] for r in words.word_count(df).collect()}
    assert _exchanges(words.word_count_per_doc(df, arrow=True))[0] == 0 and _exchanges(words.word_count(df, "grouped", arrow=True))[0] == 1
    long = spark.createDataFrame([(1, "word other " * 450_000)], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in words.word_count_per_doc(long, arrow=True).collect()) == [("", 1), ("other", 450_000), ("word", 450_000)]
