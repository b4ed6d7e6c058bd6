import hashlib
import os
import random
import re
from collections import Counter

import pytest

from tessera.llm import suffixes


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, kept))
    return out


def texts_with_repeats(rng, n, length):
    letters = "abcé "
    passages = ["".join(rng.choices(letters, k=rng.randint(length // 2, 4 * length))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts.append(rng.choice([p, p[a:], p[:a], "a" * rng.randint(0, 3 * length), "".join(rng.choices(letters, k=rng.randint(0, length)))]))
        out.append("".join(parts))
    return out + out[:3]


def test_pieces_of_a_long_text_give_each_window_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffixes, "PIECE", 70)
    rng = random.Random(5)
    text = "".join(rng.choices("abc", k=500)) + "a" * 300
    batch = pa.record_batch({"id": [1], "key": [2], "text": [text]})
    found = []
    for _, data, off, _, place in suffixes._pieces(iter([batch]), 40):
        _, start, stop, at, name, bytes_ = suffixes._blocks(data, off, 40, 16, 4)
        for a, b, x in zip(start, stop, at):
            found += [(int(p) + place, int(x - p)) for p in range(a, b)]
    assert [p for p, _ in found] == list(range(len(text) - 39))
    seen = {}
    for p, shift in found:  # equal windows sample the same place
        assert seen.setdefault(text[p:p + 40], shift) == shift


@pytest.mark.parametrize("length,sample,gram", [(40, 16, 4), (12, 4, 2), (60, 40, 8)])
def test_equals_brute_force(spark, docs_of, length, sample, gram):
    texts = texts_with_repeats(random.Random(length + sample), 60, length)
    docs = docs_of(enumerate(texts))
    out = suffixes.remove_repeats(docs, length, sample=sample, gram=gram)
    got = sorted((r.doc_id, bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in out.collect())
    want = brute([t.encode() for t in texts], length)
    assert any(w[1] for w in want) and any(w[1] == 0 < w[0] for w in want)
    assert [(len(texts[i].encode()), sum(b - a for a, b in s), len(s), k) for i, k, s in got] == want


def test_edge_rows(spark, docs_of):
    p = "x1y2z3" * 10
    rows = [(1, None), (2, ""), (3, "short"), (None, p + "tail"), (4, "head" + p), (5, "only here, nowhere else, at all, really not"), (6, "twin " * 9), (6, "twin " * 9)]
    out = suffixes.remove_repeats(docs_of(rows), 30, sample=8, gram=4)
    got = Counter((r.doc_id, bytes(r.kept)) for r in out.collect())
    assert got == Counter([(1, b""), (2, b""), (3, b"short"), (None, b"tail"), (4, b"head"),
                           (5, rows[5][1].encode()), (6, b""), (6, b"")])
    assert set(docs_of(rows).columns) < set(out.columns)
    assert suffixes.remove_repeats(docs_of(rows).limit(0)).count() == 0


def test_query_on_the_driver_table(spark, sf):
    from tessera.llm.registry import QUERIES

    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = brute([(r.text or "").encode() for r in rows], 400)
    got = sorted(QUERIES["op10_suffix_dedup"](spark, sf).collect())
    assert [(g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got] == [
        (r.doc_id, *w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, want)]


@pytest.mark.parametrize("length,residues", [(40, (13, (0, 1, 3, 9))), (12, (7, (1, 2, 4))), (9, (3, (1, 2)))])
def test_residues_equal_brute_force(spark, docs_of, length, residues):
    texts = texts_with_repeats(random.Random(length), 60, length) + ["a" * length, "ab" * (length // 2) + "a", "b" * (length + 5)]
    out = suffixes.remove_repeats(docs_of(enumerate(texts)), length, residues=residues)
    got = sorted((r.doc_id, bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in out.collect())
    assert [(len(texts[i].encode()), sum(b - a for a, b in s), len(s), k) for i, k, s in got] == brute([t.encode() for t in texts], length)
    with pytest.raises(ValueError):
        suffixes.remove_repeats(docs_of([(1, "a")]), 40, residues=(13, (0, 1, 3)))


def test_residues_in_pieces_share_a_shift_for_any_two_windows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffixes, "PIECE", 70)
    text = "".join(random.Random(6).choices("abc", k=300))
    shifts = [set() for _ in range(len(text) - 39)]
    for _, data, off, _, place in suffixes._pieces(iter([pa.record_batch({"id": [1], "key": [2], "text": [text]})]), 40):
        _, start, stop, at, _, _ = suffixes._residue_blocks(data, off, 40, place, (13, (0, 1, 3, 9)))
        for a, b, x in zip(start, stop, at):
            for p in range(a, b):
                shifts[p + place].add(int(x - p))
    assert all(a & b for a in shifts for b in shifts) and max(map(max, shifts)) < 13


def test_query_at_a_larger_size(spark):
    """All rows of sf0.01, by both covers."""
    from tessera.llm.registry import QUERIES

    top = "/root/testdata/sf0.01"
    if not os.path.isdir(top):
        pytest.skip("driver test data not present")
    docs = spark.read.parquet(f"{top}/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect())
    want = brute([(r.text or "").encode() for r in rows], 400)
    got = sorted(QUERIES["op10_suffix_dedup"](spark, top).collect())
    assert [(g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got] == [
        (r.doc_id, *w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, want)]
    out = suffixes.remove_repeats(docs, 400, residues=suffixes.RESIDUES)
    assert {r.doc_id: bytes(r.kept) for r in out.collect()} == {r.doc_id: w[3] for r, w in zip(rows, want)}


def test_the_filter_grows_with_its_keys_up_to_a_bound(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    from tessera.llm import hashing

    monkeypatch.setattr(hashing, "FILTER_BITS", (10, 14))
    for n, bits in ((0, 10), (1, 10), (128, 10), (129, 11), (2000, 14), (9000, 14)):
        df = spark.range(n).select(F.xxhash64("id").alias("h"))
        bitmap = hashing.filter_of(df, "h")
        held = np.array([r.h for r in df.collect()], np.int64).view(np.uint64)
        assert len(bitmap) == 1 << bits - 6 and hashing.passes(bitmap, held).all()
        other = np.array([r.h for r in spark.range(10**6, 10**6 + 2000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
        assert hashing.passes(bitmap, other).mean() < (0.2 if n < 2000 else 0.75)


def test_texts_skip_python_unless_something_is_removed(spark, docs_of):
    """The filters get the keys alone, and no task holds two Python workers with the texts in both."""
    p = "x1y2z3" * 10
    rows = [(1, p + "tail"), (2, "head" + p), (3, None), (4, "only here"), (4, "only here")]
    out = suffixes.remove_repeats(docs_of(rows), 30, sample=8, gram=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    texts = [i for i, x in enumerate(plan) if "MapInArrow" in x]
    union = [i for i, x in enumerate(plan) if x.lstrip(" :+-").startswith("Union")]
    assert len(texts) == len(union) == 1 and union[0] < texts[0]
    filters = [x for x in plan if "ArrowEvalPython" in x]
    assert filters and all(re.search(r"\[hit\((xxhash64\(text#\d+, 42\)|_?key#\d+L?)\)", x) for x in filters)
    got = Counter((r.doc_id, bytes(r.kept), len(r.spans)) for r in out.collect())
    assert got == Counter([(1, b"tail", 1), (2, b"head", 1), (3, b"", 0), (4, b"only here", 0), (4, b"only here", 0)])
