import random

from tessera.llm.vocab import Vocabulary, symbols, word_symbols, words_of
from tessera.llm.wordpiece import LongestMatch


def greedy(word, first, rest):
    n, at = 0, 0
    while at < len(word):
        vocab = rest if at else first
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in vocab), 0)
        if not size:
            return 1
        n, at = n + 1, at + size
    return n


def test_counts_equal_greedy_matching():
    rng = random.Random(3)
    for _ in range(300):
        first = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))}
        rest = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 8))}
        two, one = LongestMatch(first, rest), LongestMatch(first)
        for _ in range(30):
            w = "".join(rng.choices("abcd" if rng.random() < 0.1 else "abc", k=rng.randint(0, 12)))
            assert two.count(w) == greedy(w, first, rest), (w, first, rest)
            assert one.count(w) == greedy(w, first, first), (w, first)


def test_query_on_the_driver_table(spark, sf):
    from tessera.llm.registry import QUERIES
    from tessera.llm.vocab import tokenizer_path

    vocab = Vocabulary(open(tokenizer_path(), "rb").read())
    tokens = {symbols(t) for t in vocab.ids}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    sizes = {}
    for i, t in texts.items():
        words = words_of(t or "")
        for w in words:
            if w not in sizes:
                sizes[w] = greedy(word_symbols(w), tokens, tokens)
        assert got[i].n_words == len(words)
        assert got[i].n_tokens == sum(sizes[w] for w in words)


def test_edge_rows(spark, docs_of):
    from tessera.llm.vocab import tokenizer_path
    from tessera.llm.wordpiece import token_counts

    docs = docs_of([(1, None), (2, ""), (3, " \n"), (4, "the"), (4, "the"), (5, "x" * 5000)])
    got = sorted((r.doc_id, r.n_words, r.n_tokens) for r in token_counts(docs, tokenizer_path()).collect())
    assert got[:5] == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 1), (4, 1, 1)] and got[5][1] == 1 and got[5][2] > 1
    assert token_counts(docs.limit(0), tokenizer_path()).count() == 0
