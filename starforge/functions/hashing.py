"""Change hash over tracked columns (D-01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of the hashed text and the token standing for NULL.
SEPARATOR = "|"
NULL_TOKEN = "\\N"


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def packed(c) -> Column:
    """A hex digest as a struct of half its bytes, for shuffles; any other text is kept as it is."""
    c = F.col(c) if isinstance(c, str) else c
    hexed = F.lower(F.hex(F.unhex(c))).eqNullSafe(c)
    return F.struct(F.when(hexed, F.unhex(c)).alias("bytes"), F.when(~hexed, c).alias("text"))


def unpacked(name: str) -> Column:
    """The text of a :func:`packed` column."""
    return F.coalesce(F.lower(F.hex(F.col(f"{name}.bytes"))), F.col(f"{name}.text"))


def change_hash(cols: Sequence, mode: str = "safe") -> Column:
    """md5 hex digest of the tracked columns.

    ``mode='compat'`` is the plain ``md5(concat_ws('|', cols))`` formula. It
    skips NULLs and does not escape the separator, so ``('a', null, 'b')`` and
    ``('a', 'b', null)`` collide, as do ``('a|b', 'c')`` and ``('a', 'b|c')``.
    ``mode='safe'`` (default) prefixes every value with its length and writes a
    token for NULL, so each distinct tuple hashes differently.
    """
    if not cols:
        raise ValueError("change_hash needs at least one column")
    if mode == "compat":
        return F.md5(F.concat_ws(SEPARATOR, *[_text(c) for c in cols]))
    if mode != "safe":
        raise ValueError(f"mode must be 'safe' or 'compat', not {mode!r}")
    parts = [F.coalesce(F.concat(F.length(_text(c)).cast("string"), F.lit(":"), _text(c)),
                        F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
