import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import search
from tessera.llm.common import byte_buffers

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return PATTERN.findall((text or "").translate(LOW))


def brute(docs, items, places=10):
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n, total = len(rows), sum(k for _, _, k in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c, k in rows:
            m = 25 + 75 * k * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in Counter(terms(text)).items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:places])]
    return sorted(out, key=str)


def found(docs, items, **args):
    return sorted(map(tuple, search.search(docs, items, **args).collect()), key=str)


@pytest.fixture
def rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ü9", "Zz"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([1, 3, 20, 200])))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "...!"), (7, docs[7][1]), (7, docs[7][1]), (None, "w3 w4 w50"), (500, "w3, W4-w50 " * 30_000)]
    docs += [(600 + i, "rare tied words") for i in range(40)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 30])))) for i in range(25)]
    return docs, items + [(30, None), (31, "absent"), (32, "w3 w3 w3 rare"), (32, "w3 w3 w3 rare"), (32, "w4"), (None, "w9 w50")]


def test_places_equal_brute_force(spark, docs_of, rows, monkeypatch):
    docs, items = rows
    items_df = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert found(docs_of(docs), items_df) == want
    monkeypatch.setattr(search, "BLOCK", 7)            # several blocks of queries
    monkeypatch.setattr(search, "BROADCAST_ROWS", -1)  # candidates by merge join
    assert found(docs_of(docs), items_df) == want


def test_a_written_index_serves_any_queries(spark, docs_of, rows):
    docs, items = rows
    df = docs_of(docs)
    index = search.written(search.build_index(df))
    for own in (items[:3], items[20:]):
        assert found(df, spark.createDataFrame(own, "item_id long, text string"), index=index, places=3) == brute(docs, own, 3)


def test_bounds_are_never_below_scores(spark, docs_of, rows):
    docs, _ = rows
    docs = [d for d in docs if terms(d[1])]
    texts = [t for _, t in docs]
    w = search.Words(*byte_buffers(pa.array(texts)))
    vocabulary = sorted(set(search.term_strings(w).to_pylist()))
    v = search.Words(*byte_buffers(pa.array(vocabulary)))
    every = np.arange(len(vocabulary))
    block = search.Block(len(docs), len(w.start), vocabulary, v.hash, every + 1, np.zeros(len(every), np.int64), every, every % 3 + 1)
    out = {}
    for r in search.build_index(docs_of(docs)).collect():
        bound = block.bounds(r.width, np.array(r["sizes"]), r.slices)
        out.update({(i, k, n): b for i, k, n, b in zip(r.ids, r["keys"], r["sizes"], bound[0].tolist())})
    assert out
    for (i, k, n), b in out.items():
        for d, t in docs:
            if d == i and len(terms(t)) == n:
                c = Counter(terms(t))
                s = block.scores(np.array([c[x] for x in vocabulary]), n, np.array([0]))[0]
                assert 0 < s <= b


def test_empty_tables(spark, docs_of):
    none = docs_of([(1, "a")]).limit(0)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(none, items) == [] and found(docs_of([(1, "a")]), items.limit(0)) == []
    assert found(docs_of([(1, None), (2, "")]), items) == []
