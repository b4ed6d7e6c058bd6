"""Portable, repeatable pseudo-random numbers.

Every random choice in the library is a pure function of row content and a seed,
so a retried task, a recomputed cache block or another engine (the SQL oracle)
gets the same value. Nothing depends on ``rand()``, partition order or
``monotonically_increasing_id``.

u(key) = (int(first 13 hex digits of md5(key)) + 0.5) / 2**52, strictly in (0, 1).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the uniform: 13 hex digits = 52 bits, scaled by 2**52.
HEX_DIGITS = 13
SCALE = 4503599627370496.0  # 2**52


def uniform_key(*parts: Column | str | int) -> Column:
    """``'a:b:c'`` string built from columns or literals, joined by ':'."""
    cols = []
    for p in parts:
        if isinstance(p, Column):
            cols.append(p.cast("string"))
        elif isinstance(p, str):
            cols.append(F.col(p).cast("string"))
        else:
            cols.append(F.lit(str(p)))
    return F.concat_ws(":", *cols)


def uniform(*parts: Column | str | int) -> Column:
    """Hash-uniform double in (0, 1) for the key ``parts`` joined by ':'."""
    h = F.conv(F.substring(F.md5(uniform_key(*parts)), 1, HEX_DIGITS), 16, 10)
    return (h.cast("bigint").cast("double") + F.lit(0.5)) / F.lit(SCALE)


def uniform_py(*parts) -> float:
    """Same uniform computed in Python (used inside the grouped numpy kernel tests)."""
    key = ":".join(str(p) for p in parts)
    h = int(hashlib.md5(key.encode("utf-8")).hexdigest()[:HEX_DIGITS], 16)
    return (h + 0.5) / SCALE


def uniform_sql(*parts: str) -> str:
    """DuckDB SQL text of the same uniform; ``parts`` are SQL expressions."""
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return (f"((CAST(('0x' || substr(md5({key}), 1, {HEX_DIGITS})) AS BIGINT))::DOUBLE + 0.5)"
            f" / {SCALE}")
