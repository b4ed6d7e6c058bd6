import random
import re

import numpy as np
import pytest

from tessera.llm import jaccard
from tests.llm.test_simhash import brute_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, percent=90):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [shingles(t) for _, t in rows]
    comp = brute_components(lambda i, j: bool(sets[i] and sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]), len(rows))
    return sorted(((i, len(s), rows[c][0] if s else i) for (i, _), s, c in zip(rows, sets, comp)), key=str)


def found(docs, **args):
    return sorted(map(tuple, jaccard.near_duplicates(docs, **args).collect()), key=str)


def family(rng, vocab, size, copies, changes):
    base = [rng.choice(vocab) for _ in range(size)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], [rng.choice(vocab)], [w[at], rng.choice(vocab)]])
        yield " ".join(w)


@pytest.mark.parametrize("percent,seed", [(90, 1), (80, 2), (95, 3)])
def test_components_equal_brute_force(spark, docs_of, monkeypatch, percent, seed):
    monkeypatch.setattr(jaccard, "TILE", 4)             # crowded tiles are compared in blocks
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", -1)  # features by merge join
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = [t for size, copies, changes in [(9, 12, 1), (12, 20, 1), (13, 30, 1), (22, 25, 2), (60, 40, 3), (200, 30, 9), (400, 12, 30)]
             for t in family(rng, vocab, size, copies, changes)]
    docs = list(enumerate(texts))
    got = found(docs_of(docs), percent=percent)
    assert got == brute(docs, percent)
    assert len({c for _, _, c in got}) < len(docs)


def test_a_chain_links_its_ends(spark, docs_of):
    words = [f"v{i}" for i in range(400)]
    docs = [(i, " ".join(words[5 * i: 5 * i + 120])) for i in range(50)]  # neighbours share most, the ends nothing
    assert {c for _, _, c in found(docs_of(docs))} == {0}


def test_one_template_with_one_slot(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 16)
    words = "the same short notice for every one of our customers named".split()
    docs = [(i, " ".join([*words, f"x{i}"])) for i in range(120)] + [(500, " ".join(words))]  # many share a tile, some pairs link
    assert found(docs_of(docs)) == brute(docs)


def test_edge_rows(spark, docs_of):
    long_text = " ".join(f"t{i}" for i in range(200_000))
    docs = [(5, None), (3, ""), (3, ""), (4, " \t"), (None, "a b c d"), (8, "A B\nc d"), (8, "A B\nc d"), (9, "one"), (10, "ONE"), (11, "one two"),
            (None, None), (None, "only null"), (20, long_text), (21, long_text + " more")]
    assert found(docs_of(docs)) == brute(docs)
    assert found(docs_of(docs).limit(0)) == []


def test_tiles_hold_every_linked_pair():
    """Sets that differ as much as they may share a tile, empty parts included."""
    rng = np.random.default_rng(4)
    for _ in range(3000):
        n = int(rng.integers(9, 60))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
        gone, new = (int(x) for x in rng.integers(0, 4, 2))
        b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)])
        if 100 * (n - gone) < 90 * (n + new):
            continue
        h = np.concatenate([np.sort(a), np.sort(b)])
        text = np.repeat([0, 1], [len(a), len(b)])
        of, keys = jaccard._tile_keys(text, h, np.bincount(text), 90)
        assert gone + new == 0 or set(keys[of == 0]) & set(keys[of == 1])


def test_the_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 62, rng.integers(1, 900)).astype(np.uint64)]))
        assert jaccard.overlap_bound(jaccard.signature(a), len(a), jaccard.signature(b), len(b)) >= len(np.intersect1d(a, b))


def test_a_family_gives_fewer_links_than_sets_and_tiles(spark, docs_of, monkeypatch):
    """Copies on both sides of the limit: the step over what hubs leave lists no pairs."""
    made = []
    rest = jaccard._rest

    def counted(*args):
        out = rest(*args)
        made.append((out.count(), args[0].count()))
        return out

    monkeypatch.setattr(jaccard, "_rest", counted)
    words = [f"w{i}" for i in range(57)]
    docs = [(i, " ".join([*words[:28], f"x{i}", *words[28:]])) for i in range(200)]  # two share 53 of 59 shingles
    assert {c for _, _, c in found(docs_of(docs))} == set(range(200))
    docs.append((500, " ".join(words)))                                              # and each 53 of 58 with this one
    assert {c for _, _, c in found(docs_of(docs))} == {0}
    assert made[0][0] == 0 < made[1][0] < made[1][1]  # fewer than places of sets in tiles


def test_long_sets_are_compared_in_smaller_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 500)
    rng = random.Random(9)
    docs = list(enumerate(t for size in (60, 300) for t in family(rng, [f"w{i}" for i in range(900)], size, 30, size // 25)))
    assert found(docs_of(docs)) == brute(docs)
