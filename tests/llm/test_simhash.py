import random
import re

import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components


def brute_fingerprint(text, k=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs_ok, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if pairs_ok(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_of_whole_texts(monkeypatch):
    rng = random.Random(1)
    vocab = ["Aa", "b", "É", "ü x", "dd", "e,", "\x1cq"]
    texts = ["", " \t\n", "one", "One two", "ÀB c d e"] + [
        "".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\x0b"]) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    want = [brute_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t.encode()) for t in texts] == want
    monkeypatch.setattr(simhash, "PIECE", 17)  # long texts are read in pieces
    assert [simhash.fingerprint(t.encode()) for t in texts] == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, distance):
    rng = random.Random(distance)
    centre = rng.getrandbits(64)
    fps = {0, (1 << 64) - 1, centre}
    while len(fps) < 90:  # one crowded ball, larger than a bucket that is joined with itself
        fps.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.choice([1, 1, 2, 3]))) % (1 << 64))
    while len(fps) < 150:
        base = rng.choice(sorted(fps))
        fps.add(base ^ 1 << rng.randrange(64) if rng.random() < 0.5 else rng.getrandbits(64))
    fps = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = simhash.links(df, distance)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= distance for r in found.collect())
    roots = {r.node: r.root for r in components(found).collect()}
    order = sorted(fps)
    want = brute_components(lambda i, j: bin((order[i] ^ order[j]) & (1 << 64) - 1).count("1") <= distance, len(order))
    assert [order[w] for w in want] == [roots.get(f, f) for f in order]


def test_components_of_a_long_chain(spark):
    n = 60
    df = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_query_on_the_driver_table(spark, sf):
    from tessera.llm.registry import QUERIES

    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fingerprint(r.text) for r in rows]
    comp = brute_components(lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 2, len(rows))
    got = sorted(QUERIES["op3_simhash_near_dedup"](spark, sf).collect())
    assert [(r.doc_id, r.fingerprint, r.component_id) for r in got] == [
        (r.doc_id, f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, comp)]


def test_edge_rows(spark, docs_of):
    docs = docs_of([(5, None), (3, ""), (3, ""), (None, "a b c d"), (8, "A B c d"), (9, "other words are here now"), (None, None)])
    got = sorted(((r.id, r["first"].id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 8), (8, 8), (9, 9), (None, 3)], key=str)
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 8, 9]
    assert simhash.dedup(docs.limit(0)).count() == 0
    alone = simhash.dedup(docs_of([(None, "x y z w")]))
    assert [r.doc_id for r in alone.collect()] == [None]
