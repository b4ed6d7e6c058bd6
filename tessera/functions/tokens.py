"""Tokenisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words are separated by exactly one ASCII space. Repeated, leading
# or trailing spaces give empty tokens, which count as words; an empty text is
# one empty token. Tabs, newlines, case and punctuation stay inside words.
WORD_SEPARATOR = " "


def split_words(text: Column | str) -> Column:
    """``array<string>`` of the space-separated tokens of ``text`` (limit -1 keeps empties)."""
    col = F.col(text) if isinstance(text, str) else text
    # split() takes a regex; a single space is not a metacharacter.
    return F.split(col, WORD_SEPARATOR, -1)


def word_length(word: Column | str) -> Column:
    """Length in Unicode code points."""
    col = F.col(word) if isinstance(word, str) else word
    return F.length(col)
