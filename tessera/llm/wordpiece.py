"""Token counts by a linear longest-match automaton (operator 5).

Greedy word pieces take, again and again, the longest vocabulary token that begins the rest of a
word. The automaton finds how many that makes in one pass over the word, without building pieces:
the trie of the tokens has at each node a failure link - the node of what remains of its string
once the tokens that greedy matching is then bound to take are cut off its front - and the number
of these tokens. A step without a child pops the node's tokens, follows its link and tries again.

Tokens that begin a word and tokens that continue one may be two vocabularies; here both may be
one, for a token file that marks word ends has tokens that fit anywhere. A word that can't be cut
into tokens is one unknown token.

Defined results: NULL and empty texts have no words and no tokens; repeated rows are counted again;
other columns pass through, and new columns replace old ones of the same name; an empty table gives
an empty result. Tasks hold about 1 MB of text and a cache of bounded size, which affects speed only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices
from .vocab import Vocabulary, symbols, word_symbols, words_of

CACHE_WORDS = 250_000


class LongestMatch:
    """Counts of greedy longest-match tokens. ``continuing`` None: the beginning tokens also continue."""

    def __init__(self, beginning: Iterable[str], continuing: Iterable[str] | None = None):
        # node 0 begins a word, node 1 continues one; they are the same where the vocabularies are
        self.child: dict[tuple[int, str], int] = {}
        self.fail, self.pops = [-1, -1], [0, 0]
        ends = [False, False]
        self.begin, self.go_on = 0, 0 if continuing is None else 1
        for start, tokens in ((self.begin, beginning), (self.go_on, continuing or ())):
            for token in tokens:
                at = start
                for c in token:
                    if (at, c) not in self.child:
                        self.child[at, c] = len(ends)
                        ends.append(False)
                        self.fail.append(-1)
                        self.pops.append(0)
                    at = self.child[at, c]
                ends[at] = bool(token)
        children: dict[int, list[tuple[str, int]]] = {}
        for (at, c), to in self.child.items():
            children.setdefault(at, []).append((c, to))
        queue = deque({self.begin, self.go_on})
        while queue:  # by depth, so links of shorter strings are there
            at = queue.popleft()
            for c, to in children.get(at, ()):
                if ends[to]:
                    self.fail[to], self.pops[to] = self.go_on, 1
                else:
                    link, popped = self.fail[at], self.pops[at]
                    while link >= 0 and (link, c) not in self.child:
                        link, popped = self.fail[link], popped + self.pops[link]
                    if link >= 0:
                        self.fail[to], self.pops[to] = self.child[link, c], popped
                queue.append(to)

    def count(self, word: str) -> int:
        """Tokens of a word; 1 if it can't be cut into tokens, 0 if it is empty."""
        at, n = self.begin, 0
        for c in word:
            to = self.child.get((at, c))
            while to is None:
                if self.fail[at] < 0:
                    return 1
                n += self.pops[at]
                at = self.fail[at]
                to = self.child.get((at, c))
            at = to
        while at != self.go_on and at != self.begin:
            if self.fail[at] < 0:
                return 1
            n += self.pops[at]
            at = self.fail[at]
        return n


class _Counts(dict):
    """Stretch of a text between ASCII white space -> (words, tokens); counted on first use."""

    def __init__(self, data: bytes):
        super().__init__()
        vocab = Vocabulary(data)
        self.match = LongestMatch(symbols(t) for t in vocab.ids)

    def __missing__(self, stretch: bytes) -> tuple[int, int]:
        words = words_of(stretch.decode())
        found = len(words), sum(self.match.count(word_symbols(w)) for w in words)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(stretch) <= 64:
            self[stretch] = found
        return found


@lru_cache(2)
def _counts(data: bytes) -> _Counts:
    return _Counts(data)


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", n_words: str = "n_words", n_tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with the words and greedy tokens of each whole text, with the vocabulary of a tokenizer file."""
    data = docs.sparkSession.sparkContext.broadcast(open(tokenizer, "rb").read())
    keep = docs.select(*[c for c in docs.columns if c not in (n_words, n_tokens)])
    names = keep.columns
    schema = T.StructType([*keep.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(n_tokens, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _counts(data.value).__getitem__
        for b in slices(batches, text):
            words, tokens = [], []
            for t in b.column(b.schema.get_field_index(text)).cast(pa.binary()).to_pylist():
                each = list(map(get, t.split())) if t else ()
                words.append(sum(w for w, _ in each))
                tokens.append(sum(n for _, n in each))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=[*names, n_words, n_tokens])

    return keep.mapInArrow(run, schema)
