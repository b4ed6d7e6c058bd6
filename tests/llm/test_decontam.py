import random
import re
from collections import Counter

import pytest

from tessera.llm import decontam


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = []
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item, t in items:
            v = words_of(t)
            m = min(window, len(v))
            own = {tuple(v[k:k + m]) for k in range(len(v) - m + 1)} if m else set()
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in own:
                    hit |= set(range(k, k + m))
                    found.add(item)
        found.discard(None)
        out.append((i, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,shingle", [(13, 4), (5, 2), (3, 4), (4, 1)])
def test_equals_brute_force(spark, docs_of, window, shingle):
    rng = random.Random(window)
    vocab = ["The", "a", "É", "x1", "of", "b", "c", "d"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 6, 15, 30])))) for k in range(12)]
    items += [(None, "null item words here one two three four five six seven eight nine ten"), (20, ""), (21, None), (22, "..."), items[0]]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 12)))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(items)[1] or ""
            w = t.split()
            a = rng.randint(0, max(0, len(w) - 1))
            parts += [" ".join(w[a:a + rng.randint(1, 20)]), rng.choice(["zz, ", "\n", " - "])]
        docs.append((i, rng.choice([" ", "; "]).join(parts)))
    docs += [(100, None), (101, ""), (None, items[3][1]), docs[5], docs[5]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs_of(docs), bench, window=window, shingle=shingle)
    assert sorted(((r.id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()), key=str) == brute(docs, items, window)
    kept = decontam.decontaminate(docs_of(docs), bench, window=window, shingle=shingle)
    assert kept.columns == docs_of(docs).columns
    bad = Counter(r[0] for r in brute(docs, items, window) if r[4])
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in docs) - bad


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    docs = docs_of([(1, "one two three")])
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    r = decontam.contamination(docs, bench.limit(0)).first()
    assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (3, 0, [], False)
