"""Predicates and safe arithmetic (P-06..P-11, A-09)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c) -> Column:
    return _c(c).isNull()


def out_of_range(c, lo, hi) -> Column:
    """``c < lo OR c > hi``. NULL is neither, so it is not counted (kept as is)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.coalesce((_c(c) < lo_c) | (_c(c) > hi_c), F.lit(False))


def hash_differs(a, b, null_safe: bool = True) -> Column:
    """True when the two hashes differ; with ``null_safe`` a NULL counts as a value."""
    if null_safe:
        return ~_c(a).eqNullSafe(_c(b))
    return _c(a) != _c(b)


def members(c, values: Iterable | None) -> Column:
    """IN-list; ``None`` means no restriction (an unset slicer)."""
    if values is None:
        return F.lit(True)
    return _c(c).isin(list(values))


def since(ts, as_of, interval: str) -> Column:
    """Rows newer than ``as_of - interval`` (P-10), e.g. ``interval='7 days'``."""
    anchor = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return _c(ts) > anchor - F.expr(f"INTERVAL {interval}")


def divide(a, b, alt=0) -> Column:
    """``a / b``, or ``alt`` when ``b`` is 0 or NULL (the BI DIVIDE semantics)."""
    q = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.coalesce(q, F.lit(alt).cast("double"))
