"""Staging steps: stamp, conform, strip personal data, filters, dedup (P-01..P-05, P-14, A-13, A-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ts(v) -> Column:
    if v is None:
        return F.current_timestamp()
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def stamp(df: DataFrame, batch_ts=None) -> DataFrame:
    """Metadata columns of a fresh staging load (P-01)."""
    return df.withColumns({
        "load_timestamp": _ts(batch_ts),
        "processing_status": F.lit("PENDING"),
        "dq_is_valid": F.lit(True),
    })


def conform(df: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None,
            defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Project to ``schema``: rename, cast, add missing columns as NULL or a default (P-02)."""
    renames = renames or {}
    defaults = defaults or {}
    src = {renames.get(c, c): c for c in df.columns}
    cols = []
    for fld in schema.fields:
        if fld.name in src:
            c = F.col(src[fld.name]).cast(fld.dataType)
            if fld.name in defaults:
                c = F.coalesce(c, F.lit(defaults[fld.name]).cast(fld.dataType))
        elif fld.name in defaults:
            c = F.lit(defaults[fld.name]).cast(fld.dataType)
        else:
            c = F.lit(None).cast(fld.dataType)
        cols.append(c.alias(fld.name))
    return df.select(*cols)


def strip_pii(df: DataFrame, pii_cols: Sequence[str]) -> DataFrame:
    """Drop personal columns; fail if one survives (P-03)."""
    out = df.drop(*pii_cols)
    left = [c for c in out.columns if c in set(pii_cols)]
    if left:
        raise ValueError(f"personal columns remain: {left}")
    return out


def current(dim: DataFrame) -> DataFrame:
    """Active versions of an SCD2 dimension (P-04)."""
    return dim.filter(F.col("is_active"))


def valid(df: DataFrame) -> DataFrame:
    """Rows that passed the quality checks (P-05)."""
    return df.filter(F.col("dq_is_valid"))


def invalid(df: DataFrame, order: Sequence | None = None, n: int | None = None) -> DataFrame:
    """Rows that failed, newest first when an order is given; ``n`` is a report size."""
    out = df.filter(~F.coalesce(F.col("dq_is_valid"), F.lit(False)))
    if order:
        out = out.orderBy(*order)
    return out.limit(n) if n else out


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of tracked columns; add the column when it is absent (P-14)."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    return out


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (newest first, full tie-break) (A-13, T-04).

    A ``row_number`` window partitioned by the key: the shuffle is by key and
    each task sorts only its own keys. For a key holding a large share of the
    rows prefer :func:`latest_per_key_agg`, which combines map-side.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key_agg(df: DataFrame, key: Sequence[str], by: str, tie: Sequence[str] = ()) -> DataFrame:
    """Same result as :func:`latest_per_key` (descending ``by`` then ``tie``) via
    ``max_by`` over a struct: partial aggregation before the shuffle, so a hot
    key sends one row per map task instead of all its rows."""
    rest = [c for c in df.columns if c not in key]
    order = F.struct(F.col(by), *[F.col(t) for t in tie])
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r"))
            .select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def latest_known(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """:func:`latest_rows` without the rows that have no key; they lie by key."""
    order = list(dict.fromkeys([*by, *df.columns]))
    best = F.max(F.struct(*[c for c in order if c != key]))
    one = df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_best")).select(key, "_best.*")
    return one.select(*df.columns)


def latest_rows(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """One row per ``key``: the greatest by ``by``, then by all other columns, so
    the choice does not depend on the order of rows. Rows without a key are not
    copies of each other and all stay. Copies are combined map-side."""
    return latest_known(df, key, by).unionByName(df.filter(F.col(key).isNull()))


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of ``cols`` (A-14); hash aggregate with map-side combine."""
    return df.select(*cols).distinct()
