"""A word-level byte BPE tokenizer file: its tokens, merges, and how a text becomes words.

The file's bytes travel to the tasks in a broadcast (a vocabulary file's size does not grow with
the data), so executors need no access to its path.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import regex

END = "</w>"


@lru_cache(1)
def byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 is itself, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def symbols(token: str) -> str:
    """A token's bytes as characters 0-255; the last one is raised by 256 where a word ends with it."""
    table = byte_chars()
    ends = token.endswith(END) and len(token) > len(END)
    s = "".join(chr(table[c]) for c in (token[: -len(END)] if ends else token))
    return s[:-1] + chr(ord(s[-1]) + 256) if ends else s


def word_symbols(word: str) -> str:
    s = word.encode("utf-8", "replace").decode("latin-1")
    return s[:-1] + chr(ord(s[-1]) + 256)


@lru_cache(1)
def _word_pattern() -> re.Pattern:
    """Words of a text: clitics, letters, single digits, runs of other characters; white space separates."""
    space = "\t-\r \x85\xa0  -     　"

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))

    def ranges(kind: str) -> str:
        return "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in regex.findall(rf"\p{{{kind}}}+", every))

    letters, numbers = ranges("L"), ranges("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")


_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Normalised (NFC, lower case) words. Capital sigma lowers to the medial form wherever it stands.

    Words and normalisation never reach over ASCII white space, so a text's words are those of its
    stretches between white space.
    """
    if text.isascii():
        low = text.lower()
        return [low] if low.isalpha() else _ASCII_WORDS.findall(low)
    return _word_pattern().findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


class Vocabulary:
    """Tokens, merges in order and special strings of a tokenizer file (its bytes)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def parts(self, text: str) -> list[str]:
        """Stretches of plain text at even places, special strings at odd ones."""
        return self._special.split(text) if self._special and any(t in text for t in self.special) else [text]

    def texts(self) -> list[str]:
        """Each id's token as written in the file; ids without one are empty."""
        out = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for table in (self.ids, self.special):
            for token, i in table.items():
                out[i] = token
        return out


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of one of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)
