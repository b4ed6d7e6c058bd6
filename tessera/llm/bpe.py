"""BPE encoding by backtracking over longest matches, and decoding by an offset table (operator 1).

Encoding: an Aho-Corasick automaton over the vocabulary finds the longest token at each place of a
word. From left to right the longest token is taken if the pair it makes with the token before is
compatible, that is, if merging their joined text in merge order gives these two tokens again;
otherwise the next shorter token is tried, and without one the token before is taken back and its
end marked as dead. Each place is left at most once, so a word takes linear time, and the tokens
are those of merging pairs in order. Compatibility of a pair follows from the merge table by
replaying the merges next to the border (``compatible``).

Decoding: the pieces of all ids lie in one byte string; an offset table gives each id's stretch,
and a text is one gather.

Tasks are independent (no shuffle), hold about 1 MB of text at a time (one longer text at a time),
and keep a bounded cache of encoded words, which affects speed only.

Defined results: NULL and empty texts give no ids and an empty text; special strings of the file in
a text become their ids; a repeated row is encoded again; other columns pass through; new columns
replace old ones of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import list_column, ragged_arange, slices
from .vocab import Vocabulary, symbols, word_symbols, words_of

CACHE_WORDS = 250_000  # entries kept in each cache of a Python worker
LONGEST_KEPT = 64      # bytes of a stretch that is kept


class Encoder(dict):
    """Stretch of a text between ASCII white space -> its ids as int32 bytes; encoded on first use."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        super().__init__()
        self.vocab = vocab
        self.words: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # tokens by merge order: single symbols first, then each merge's result
        base = [t for t in vocab.ids if len(symbols(t)) == 1]
        order = base + [a + b for a, b in vocab.merges]
        rank = {t: i for i, t in enumerate(order)}
        if len(rank) != len(order):
            raise ValueError("two merges make the same token; pair compatibility needs one way for each")
        self.id_of = [vocab.ids[t] for t in order]
        self.halves = [(i, i) for i in range(len(base))] + [(rank[a], rank[b]) for a, b in vocab.merges]
        self.n_base = len(base)
        self.edges: tuple[dict[int, list[tuple[int, int]]], ...] = ({}, {})
        self.merged = {pair: i for i, pair in enumerate(self.halves) if i >= len(base)}
        texts = [symbols(t) for t in order]
        self.length = [len(t) for t in texts]
        known = {t: i for i, t in enumerate(texts)}
        self.shorter = [next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1) for t in texts]
        self.find = ahocorasick.Automaton()
        for t, i in known.items():
            self.find.add_word(t, (i, len(t) - 1))
        self.find.make_automaton()
        self.pairs: dict[int, bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that end (``side`` 1) or begin (0) the text of ``token`` while it is merged, each with the moment it is merged away.

        Merges of one rank go from left to right: inside the left token, over the border, inside the
        right one. So a merge of rank r in the left token is at 3r, over the border at 3r + 1, in the right one at 3r + 2.
        """
        found = self.edges[side].get(token)
        if found is None:
            chain = [token]
            while chain[-1] >= self.n_base:
                chain.append(self.halves[chain[-1]][side])
            chain.reverse()
            late = 0 if side else 2
            found = [*((t, 3 * parent + late) for t, parent in zip(chain, chain[1:])), (token, 3 * len(self.halves))]
            if len(self.edges[side]) >= CACHE_WORDS:
                self.edges[side].clear()
            self.edges[side][token] = found
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Does merging the text of ``a`` and ``b`` in order keep the border between them?

        The merges of both sides are replayed by rank. At each moment one token ends the left side and
        one begins the right; the border is lost if these two have a merge that comes before either is merged away.
        """
        ends, starts = iter(self.edge(a, 1)), iter(self.edge(b, 0))
        (left, left_until), (right, right_until) = next(ends), next(starts)
        never = 3 * len(self.halves)
        ok = True
        while True:
            until = min(left_until, right_until)
            over = self.merged.get((left, right))
            if over is not None and 3 * over + 1 < until:
                ok = False
                break
            if until == never:
                break
            if left_until == until:
                left, left_until = next(ends)
            else:
                right, right_until = next(starts)
        if len(self.pairs) >= CACHE_WORDS:
            self.pairs.clear()
        self.pairs[a * len(self.length) + b] = ok
        return ok

    def encode(self, s: str) -> list[int]:
        """Ids of one word given as symbols."""
        longest, length, last = [-1] * (len(s) + 1), self.length, len(s)
        for end, (i, n) in self.find.iter(s):  # later matches from a place are longer
            longest[end - n] = i
        out: list[int] = []
        dead: set[int] = set()
        at, token, before = 0, longest[0], -1
        pairs, many, shorter = self.pairs, len(length), self.shorter
        while at < last:
            while token >= 0:
                end = at + length[token]
                if end not in dead:
                    if before < 0:
                        break
                    ok = pairs.get(before * many + token)
                    if self.compatible(before, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, before, token = end, token, longest[end]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                before = out[-1] if out else -1
        return [self.id_of[i] for i in out]

    def word_ids(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            ids = self.words[word] = array("i", self.encode(word_symbols(word))).tobytes()
        return ids

    def __missing__(self, stretch: bytes) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            parts = self.vocab.parts(stretch.decode())
            ids = b"".join([array("i", [self.vocab.special[p]]).tobytes() if k % 2 else b"".join(map(self.word_ids, words_of(p)))
                            for k, p in enumerate(parts)])
        if len(stretch) <= LONGEST_KEPT:
            if len(self) >= CACHE_WORDS:  # what was used since the last change stays for another round
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids

    def text_ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


class OffsetTable:
    """Bytes of the pieces of all ids, each followed by ``sep``; texts are gathered from them."""

    def __init__(self, pieces: list[str], sep: str = " "):
        data = [p.encode() + sep.encode() for p in pieces]
        self.sep = len(sep.encode())
        self.size = np.array([len(d) for d in data], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(data), np.uint8)

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """One string for each ``ids[offsets[i]:offsets[i + 1]]``, pieces with ``sep`` between."""
        size = self.size[ids]
        data = self.bytes[ragged_arange(self.start[ids], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        return pa.array([data[a: max(a, b - self.sep)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
                        pa.binary()).cast(pa.string())


@lru_cache(2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(Vocabulary(data))


@lru_cache(2)
def _decoder(data: bytes) -> OffsetTable:
    return OffsetTable(Vocabulary(data).texts())


def _with(batch: pa.RecordBatch, schema: pa.Schema, **new: pa.Array) -> pa.RecordBatch:
    old = {f.name: c for f, c in zip(batch.schema, batch.columns)}
    return pa.RecordBatch.from_arrays([new[f.name] if f.name in new else old[f.name] for f in schema], schema=schema)


def _output(df: DataFrame, **new: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in new] + [T.StructField(n, t) for n, t in new.items()])


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids``: array<int> of each whole text. ``tokenizer`` is the path of its file."""
    return _mapped(docs, tokenizer, text, ids, None)


def decode(df: DataFrame, tokenizer: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded``: the pieces of ``ids``, one space between, special ones included."""
    data = df.sparkSession.sparkContext.broadcast(open(tokenizer, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _decoder(data.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                col = part.column(part.schema.get_field_index(ids))
                values = col.flatten().to_numpy(zero_copy_only=False)  # NULL lists hold none
                n = np.array([0 if x is None else x for x in pa.compute.list_value_length(col).to_pylist()], np.int64)
                out = table.texts(values, np.concatenate([[0], np.cumsum(n)]))
                yield _with(part, part.schema.append(pa.field(decoded, pa.string())), **{decoded: out})

    keep = df.select(*[c for c in df.columns if c != decoded])
    return keep.mapInArrow(run, _output(keep, **{decoded: T.StringType()}))


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "token_ids",
                  decoded: str = "decoded") -> DataFrame:
    """``decode(encode(docs))`` in one pass over the data."""
    return _mapped(docs, tokenizer, text, ids, decoded)


def _mapped(docs: DataFrame, tokenizer: str, text: str, ids: str, decoded: str | None) -> DataFrame:
    data = docs.sparkSession.sparkContext.broadcast(open(tokenizer, "rb").read())
    new = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})
    keep = docs.select(*[c for c in docs.columns if c not in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        for b in slices(batches, text):
            texts = b.column(b.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            each = [encoder.text_ids(t) if t else b"" for t in texts]
            values = np.frombuffer(b"".join(each), np.int32)
            offsets = np.cumsum([0, *(len(x) // 4 for x in each)])
            out = {ids: list_column(values, offsets, pa.int32())}
            schema = b.schema.append(pa.field(ids, pa.list_(pa.int32())))
            if decoded:
                out[decoded] = _decoder(data.value).texts(values, offsets)
                schema = schema.append(pa.field(decoded, pa.string()))
            yield _with(b, schema, **out)

    return keep.mapInArrow(run, _output(keep, **new))
