"""Surrogate key lookups and star joins (J-02..J-12, J-16..J-19)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key as _date_key

# Largest dimension (rows) broadcast after a size check. Above it the lookup
# falls back to a shuffle join (AQE still re-plans from runtime sizes).
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      broadcast: bool | None = None) -> DataFrame:
    """Broadcast ``dim`` only behind a size check.

    ``broadcast=True``: the caller vouches for a bound (a calendar, a seed).
    ``broadcast=False``: never. ``None``: count at most ``max_rows + 1`` rows;
    broadcast when within the bound, otherwise return the frame unchanged so
    the planner uses a shuffle join.
    """
    if broadcast is True:
        return F.broadcast(dim)
    if broadcast is False:
        return dim
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str, out: str | None = None,
           unknown=None, active_only: bool = False, broadcast: bool | None = None,
           max_rows: int = BROADCAST_MAX_ROWS, extra: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` = ``dim.key`` matched on ``{df column: dim column}`` (J-06).

    Left join: unmatched rows keep a NULL key, or ``unknown`` when given.
    Only the key, the match columns and ``extra`` columns of the dimension are
    shipped (column pruning reaches the scan); they keep their own names until
    after the join. The dimension must be unique on the match columns
    (checked by ``check_scd2``), otherwise rows multiply.
    """
    out = out or key
    if active_only:
        dim = dim.filter(F.col("is_active"))
    cols = list(dict.fromkeys([*on.values(), key, *extra]))
    d = bounded_broadcast(dim.select(*cols), max_rows, broadcast).alias("_lk_dim")
    left = df.alias("_lk_fact")
    cond = None
    for fc, dc in on.items():
        c = F.col(f"_lk_fact.{fc}") == F.col(f"_lk_dim.{dc}")
        cond = c if cond is None else cond & c
    res = left.join(d, cond, "left").select(
        "_lk_fact.*", F.col(f"_lk_dim.{key}").alias(out), *[F.col(f"_lk_dim.{c}") for c in extra])
    if unknown is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(unknown)))
    return res


def lookup_date(df: DataFrame, d_date: DataFrame, col: str, out: str,
                broadcast: bool | None = True, span: tuple[str, str] | None = None) -> DataFrame:
    """Role-playing date key lookup (J-02): ``to_date(col) = d_date.date_value``.

    The calendar is bounded by its day span, so it is broadcast by default.
    When the caller passes ``span`` — the calendar was generated without
    gaps by ``build_d_date`` over ``[start, end]`` — the key is computed
    (``yyyyMMdd``) for dates inside the span and NULL outside: the same
    result as the join, with no join.
    """
    if span is not None:
        d = F.to_date(F.col(col))
        inside = (d >= F.lit(span[0]).cast("date")) & (d <= F.lit(span[1]).cast("date"))
        return df.withColumn(out, F.when(inside, _date_key(d)))
    tmp = f"_lkd_{out}"
    res = df.withColumn(tmp, F.to_date(col))
    res = lookup(res, d_date, {tmp: "date_value"}, "date_key", out, broadcast=broadcast)
    return res.drop(tmp)


def lookup_code(df: DataFrame, d_code: DataFrame, d_code_category: DataFrame, category: str,
                col: str, out: str, broadcast: bool | None = None) -> DataFrame:
    """Code key of ``col`` within one category (J-03), active versions only.

    The category is matched by its id (e.g. ``REG_STATUS``), not by a code
    value, so a status column finds the status codes. The match is an
    equi-join on (category id, value); Catalyst pushes the category into the
    shipped side, so each lookup broadcasts only that category's codes.
    """
    cat = d_code_category.filter(F.col("is_active")).select("code_category_key", "code_category_id")
    codes = d_code.filter(F.col("is_active")).join(F.broadcast(cat), "code_category_key") \
        .select("code_category_id", "code_value", "code_key")
    tmp = f"_lkc_{out}"
    res = df.withColumn(tmp, F.lit(category))
    res = lookup(res, codes, {tmp: "code_category_id", col: "code_value"}, "code_key", out,
                 broadcast=broadcast)
    return res.drop(tmp)


def hierarchy(base: DataFrame, levels: Sequence[tuple[DataFrame, str, Sequence[str]]],
              how: str = "left", broadcast: bool | None = None) -> DataFrame:
    """Walk a snowflake (J-16): for each ``(dim, key, columns)`` join on ``key``
    and bring ``columns`` (which may include the next level's key)."""
    out = base
    for dim, key, cols in levels:
        d = bounded_broadcast(dim.select(key, *cols), broadcast=broadcast)
        out = out.join(d, key, how)
    return out


def star(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str, Sequence[str]]],
         how: str = "inner", broadcast: bool | None = None) -> DataFrame:
    """Star join (J-11): ``{role: (dim, fact_key, dim_key, columns)}``.

    Each dimension brings ``columns`` renamed ``<role>_<column>`` unless the
    column name already starts with the role. Only the key and the requested
    columns of each dimension are shipped.
    """
    out = fact
    for role, (dim, fk, pk, cols) in dims.items():
        names = {c: (c if c.startswith(role) else f"{role}_{c}") for c in cols}
        d = bounded_broadcast(dim.select(*dict.fromkeys([pk, *cols])), broadcast=broadcast).alias("_st_dim")
        left = out.alias("_st_fact")
        out = left.join(d, F.col(f"_st_fact.{fk}") == F.col(f"_st_dim.{pk}"), how).select(
            "_st_fact.*", *[F.col(f"_st_dim.{c}").alias(n) for c, n in names.items()])
    return out


def with_role(fact: DataFrame, roles: Mapping[str, str], role: str, as_name: str) -> DataFrame:
    """Pick which fact key plays a role (J-17, the inactive relationship):
    ``roles={'registration': 'registration_date_key', 'birth': 'birth_date_key'}``."""
    if role not in roles:
        raise ValueError(f"unknown role {role!r}; have {sorted(roles)}")
    return fact.withColumn(as_name, F.col(roles[role]))


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no dimension row (J-12)."""
    keys = dim.select(F.col(pk).alias("_orph_pk")).distinct()
    return fact.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_orph_pk"), "left_anti")


def enrich(df: DataFrame, ref: DataFrame, on: Sequence[str], year: str | None = None,
           broadcast: bool | None = None) -> DataFrame:
    """Left join reference data on ``on`` (J-18); with ``year``, only the latest
    year per key is kept first (T-04), so the join cannot multiply rows."""
    if year is not None:
        ref = (ref.groupBy(*on).agg(F.max_by(F.struct(*[c for c in ref.columns if c not in on]),
                                                  F.col(year)).alias("_r"))
               .select(*on, "_r.*"))
    return df.join(bounded_broadcast(ref, broadcast=broadcast), list(on), "left")


def key_of(dim: DataFrame, where: Column, key: str) -> DataFrame:
    """Scalar-subquery style lookup (J-19): one-row frame with the key."""
    return dim.filter(where).agg(F.max(key).alias(key))
