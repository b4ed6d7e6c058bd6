import hashlib
import random

import pytest

from tessera.llm import bpe
from tessera.llm.vocab import Vocabulary, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

ODD = ["", " ", "a", "It's we'LL they'd 'RE ΑΣΑΣ ΣΣ İIJ ǅ", "<|endoftext|>x <|startoftext|>y<|endoftext|><|endof",
       "é é ﬁ ½²Ⅷ五", "\x1c\x1da\x85b​c d﻿e⁠", "👍🏽👨‍👩‍👧 a" + "b" * 300,
       "aaaa" * 50 + "!!!!???...", "�\x00\x01", "__x__ 12.5e3 ßẞ", "h" * 3000 + "a" * 3000]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(Vocabulary(open(tokenizer_path(), "rb").read()))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def ids_of(encoder, text):
    import numpy as np

    return np.frombuffer(encoder.text_ids(text.encode()), np.int32).tolist()


def test_ids_equal_the_library(encoder, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices("abcdeth'in re0 1é!.<|>ßйх中", k=rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("antheirs", k=40)) for _ in range(1500)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(encoder, text) == want.ids, text


def test_a_pair_is_compatible_if_merging_its_text_gives_the_pair(encoder):
    """Against merging in rank order, leftmost first, on a table full of ties."""
    rng = random.Random(4)
    vocab = Vocabulary.__new__(Vocabulary)
    for _ in range(40):
        tokens, merges = list("ab"), []
        while len(merges) < 12:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens and len(a + b) < 9:
                tokens.append(a + b)
                merges.append((a, b))
        vocab.ids, vocab.merges = {t: i for i, t in enumerate(tokens)}, merges
        small = bpe.Encoder(vocab)

        def merge(parts):
            for a, b in merges:
                out = []
                for p in parts:
                    if out and out[-1] == a and p == b and out[-1] is not None:
                        out[-1:] = [a + b, None]  # a merged token takes no further part in this round
                    else:
                        out.append(p)
                parts = [p for p in out if p is not None]
            return parts

        whole = [i for i, t in enumerate(tokens) if merge(list(t)) == [t]]
        for i in whole:
            for j in whole:
                assert small.compatible(i, j) == (merge(list(tokens[i] + tokens[j])) == [tokens[i], tokens[j]]), (merges, tokens[i], tokens[j])


def test_query_on_the_driver_table(spark, sf, library):
    from tessera.llm.registry import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op1_bpe_encoding"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_every_token_encodes_to_itself(encoder):
    from tessera.llm.vocab import symbols

    for token in random.Random(2).sample(sorted(encoder.vocab.ids), 3000):
        assert encoder.encode(symbols(token)) == [encoder.vocab.ids[token]]


def test_small_caches_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    small = bpe.Encoder(encoder.vocab)
    text = " ".join(ODD[3:] * 2)
    assert ids_of(small, text) == ids_of(encoder, text)


def test_round_trip_of_rows(spark, docs_of, library):
    rows = [(1, None), (2, "")] + [(i + 3, t) for i, t in enumerate(ODD)] + [(3, ODD[0]), (None, "null id")]
    docs = docs_of(rows).withColumnRenamed("n", "token_ids")  # a column of the new column's name
    both = bpe.encode_decode(docs, tokenizer_path())
    two = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path())
    assert both.columns == two.columns and both.count() == len(rows)
    got = sorted(map(str, both.select("doc_id", "token_ids", "decoded").collect()))
    assert got == sorted(map(str, two.select("doc_id", "token_ids", "decoded").collect()))
    for r in both.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(docs.limit(0), tokenizer_path()).count() == 0
