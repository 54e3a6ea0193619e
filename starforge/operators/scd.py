"""Slowly changing dimensions: classify, SCD2 diff/apply, SCD1, point in time (D-02..D-06, J-01, J-13..J-15, W-09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import change_hash
from ..session import materialize
from .keys import assign_keys
from .lookup import bounded_broadcast
from .segments import carry_last

NEW, CHANGED, UNCHANGED, MISSING = "NEW", "CHANGED", "UNCHANGED", "MISSING"


def _ts(v) -> Column:
    if v is None:
        return F.current_timestamp()
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def dedup_source(source: DataFrame, natural_key: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """One source row per natural key (D6). ``order`` picks the survivor (first
    wins); by default all columns ascending, so the choice is deterministic."""
    order = order or [F.col(c).asc_nulls_last() for c in source.columns if c not in natural_key]
    if not order:
        return source.dropDuplicates(list(natural_key))
    w = Window.partitionBy(*natural_key).orderBy(*order)
    return source.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys whose parts may be NULL (NULL equals NULL); one set of key
    columns remains. Spark plans it as an equi-join; both sides grow with the
    dimension, so neither is broadcast, however small its files look."""
    r = right.withColumnsRenamed({k: f"_k_{k}" for k in keys}).hint("merge")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    j = left.join(r, cond, how)
    if how == "full":
        j = j.withColumns({k: F.coalesce(F.col(k), F.col(f"_k_{k}")) for k in keys})
    return j.drop(*[f"_k_{k}" for k in keys])


def _hashed_pair(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
                 hash_mode: str, hash_col: str | None):
    src = source.withColumn("_h_src", change_hash(tracked, hash_mode))
    cur = dim.filter(F.col("is_active"))
    if hash_col and hash_col in dim.columns:
        cur = cur.withColumn("_h_cur", F.col(hash_col))
    else:
        cur = cur.withColumn("_h_cur", change_hash(tracked, hash_mode))
    return src, cur


def classify(source: DataFrame, current: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
             hash_mode: str = "safe", include_missing: bool = False) -> DataFrame:
    """Tag each source row NEW / CHANGED / UNCHANGED against the active dimension (D-05, J-01).

    Left join on the natural key with a literal match flag on the current side
    (not a NULL test on a key column, which breaks when a key part may be NULL).
    With ``include_missing``, active keys absent from the source come back as
    MISSING (full outer join).
    """
    src = source.withColumns({"_h_src": change_hash(tracked, hash_mode), "_src": F.lit(True)})
    cur = current.filter(F.col("is_active")) if "is_active" in current.columns else current
    cur = cur.select(*natural_key, change_hash(tracked, hash_mode).alias("_h_cur"),
                     F.lit(True).alias("_hit"))
    j = _join(src, cur, natural_key, "full" if include_missing else "left")
    action = (F.when(F.col("_src").isNull(), F.lit(MISSING))
              .when(F.col("_hit").isNull(), F.lit(NEW))
              .when(~F.col("_h_src").eqNullSafe(F.col("_h_cur")), F.lit(CHANGED))
              .otherwise(F.lit(UNCHANGED)))
    return j.withColumn("action", action).drop("_h_src", "_src", "_h_cur", "_hit")


def scd2_diff(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
              surrogate_key: str, batch_ts=None, hash_mode: str = "safe",
              hash_col: str | None = None):
    """Inserts and keys to expire (D-02), as two lazy frames.

    ``inserts``: source rows of new keys and new versions of changed keys,
    with ``effective_start_dt = batch_ts``, open end, active. Helper columns
    are dropped. ``expire_keys``: surrogate keys of the versions to close.
    Use :func:`scd2_apply` to get the whole next state as one frame instead.
    """
    src, cur = _hashed_pair(source, dim, natural_key, tracked, hash_mode, hash_col)
    j = _join(src, cur.select(*natural_key, surrogate_key, "_h_cur", F.lit(True).alias("_hit")), natural_key, "left")
    differs = ~F.col("_h_src").eqNullSafe(F.col("_h_cur"))
    ins = j.filter(F.col("_hit").isNull() | differs)
    inserts = ins.select(*source.columns).withColumns({
        "effective_start_dt": _ts(batch_ts), "effective_end_dt": F.lit(None).cast("timestamp"),
        "is_active": F.lit(True)})
    expire = j.filter(F.col("_hit") & differs).select(surrogate_key).distinct()
    return inserts, expire


def scd2_diff_frame(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
                    surrogate_key: str, batch_ts=None, hash_mode: str = "safe") -> DataFrame:
    """:func:`scd2_diff` as one frame with ``action`` INSERT / EXPIRE (for reports and checks).

    One left join (source ⟕ active) feeds both parts.
    """
    src, cur = _hashed_pair(source, dim, natural_key, tracked, hash_mode, None)
    j = _join(src, cur.select(*natural_key, surrogate_key, "_h_cur", F.lit(True).alias("_hit")), natural_key, "left")
    changed = F.col("_hit") & ~F.col("_h_src").eqNullSafe(F.col("_h_cur"))
    ins = j.filter(F.col("_hit").isNull() | changed).select(
        F.lit("INSERT").alias("action"), *natural_key,
        F.lit(None).cast(dim.schema[surrogate_key].dataType).alias(surrogate_key),
        *[c for c in tracked], _ts(batch_ts).alias("effective_start_dt"))
    exp = j.filter(changed).select(
        F.lit("EXPIRE").alias("action"), *natural_key, F.col(surrogate_key),
        *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in tracked],
        F.lit(None).cast("timestamp").alias("effective_start_dt"))
    return ins.unionByName(exp)


def scd2_apply(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
               surrogate_key: str, batch_ts=None, hash_mode: str = "safe",
               expire_missing: bool = False, type1_columns: Sequence[str] = (),
               dedup: bool = True, hash_col: str | None = None,
               key_checkpoint: bool = True) -> DataFrame:
    """Next full state of an SCD2 dimension (D-03) as one lazy plan, no driver collect.

    * inactive history rows: unchanged;
    * active rows: closed (``effective_end_dt = batch_ts``, inactive) when
      the source has a different hash, or when missing from the source and
      ``expire_missing``; otherwise kept, with ``type1_columns`` overwritten
      in place from the source;
    * new keys and new versions: appended with keys after the current maximum,
      numbered in natural-key order (:func:`assign_keys`).

    Active rows and the source meet in a full outer join on the natural key.
    Catalyst specializes it per output (an outer join keeping the current
    versions for the kept/closed rows, another for the new versions), each
    shuffling both sides once by the key; no row reaches the driver. Write the
    result as a new table version (see ``tables``).
    """
    ts = _ts(batch_ts)
    if dedup:
        source = dedup_source(source, natural_key)
    src, cur = _hashed_pair(source, dim, natural_key, tracked, hash_mode, hash_col)
    inactive = dim.filter(~F.col("is_active"))
    s_cols = [c for c in source.columns if c not in natural_key]
    j = _join(cur, src.select(*natural_key, *[F.col(c).alias(f"_s_{c}") for c in s_cols], "_h_src",
                              F.lit(True).alias("_s_hit")), natural_key, "full")
    j = j.withColumn("_cur_hit", F.col(surrogate_key).isNotNull())
    changed = F.col("_cur_hit") & F.col("_s_hit") & ~F.col("_h_src").eqNullSafe(F.col("_h_cur"))
    gone = F.col("_cur_hit") & F.col("_s_hit").isNull() & F.lit(bool(expire_missing))
    close = F.coalesce(changed | gone, F.lit(False))

    old_cols = []
    for c in dim.columns:
        if c == "effective_end_dt":
            old_cols.append(F.when(close, ts).otherwise(F.col(c)).alias(c))
        elif c == "is_active":
            old_cols.append(F.when(close, F.lit(False)).otherwise(F.col(c)).alias(c))
        elif c == "updated_dt":
            old_cols.append(F.when(close, ts).otherwise(F.col(c)).alias(c))
        elif c in type1_columns:
            old_cols.append(F.when(F.col("_s_hit") & ~close, F.col(f"_s_{c}")).otherwise(F.col(c))
                            .cast(dim.schema[c].dataType).alias(c))
        elif hash_col and c == hash_col:
            old_cols.append(F.col(c))
        else:
            old_cols.append(F.col(c))
    old = j.filter(F.col("_cur_hit")).select(*old_cols)

    new_src = j.filter(F.col("_s_hit") & (~F.col("_cur_hit") | changed))
    new_cols = []
    for c in dim.columns:
        dt = dim.schema[c].dataType
        if c == surrogate_key:
            continue
        if c in natural_key:
            new_cols.append(F.col(c).cast(dt).alias(c))
        elif c == "effective_start_dt":
            new_cols.append(ts.cast(dt).alias(c))
        elif c == "effective_end_dt":
            new_cols.append(F.lit(None).cast(dt).alias(c))
        elif c == "is_active":
            new_cols.append(F.lit(True).alias(c))
        elif hash_col and c == hash_col:
            new_cols.append(F.col("_h_src").alias(c))
        elif c in s_cols:
            new_cols.append(F.col(f"_s_{c}").cast(dt).alias(c))
        elif c in ("created_dt", "updated_dt"):
            new_cols.append(ts.cast(dt).alias(c))
        else:
            new_cols.append(F.lit(None).cast(dt).alias(c))
    start = dim.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long")).scalar()
    new = assign_keys(new_src.select(*new_cols), surrogate_key, natural_key, start,
                      checkpoint=key_checkpoint)
    new = new.withColumn(surrogate_key, F.col(surrogate_key).cast(dim.schema[surrogate_key].dataType))
    return inactive.unionByName(old).unionByName(new.select(*dim.columns))


def scd1_apply(dim: DataFrame, source: DataFrame, key: Sequence[str], surrogate_key: str | None = None,
               batch_ts=None, stamp_col: str = "last_updated_dt") -> DataFrame:
    """Type 1 overwrite (D-04): source values replace matched rows in place,
    new keys are appended, untouched rows stay. Existing surrogate keys are
    kept; new rows get keys after the current maximum. Of repeated source
    rows one stays (:func:`dedup_source`)."""
    ts = _ts(batch_ts)
    source = dedup_source(source, key)
    keep = dim.join(source.select(*key), list(key), "left_anti")
    attrs = [c for c in dim.columns if c not in key and c not in (surrogate_key, stamp_col)]
    src = source.select(*key, *[F.col(c).cast(dim.schema[c].dataType).alias(c)
                               for c in attrs if c in source.columns])
    for c in attrs:
        if c not in source.columns:
            src = src.withColumn(c, F.lit(None).cast(dim.schema[c].dataType))
    if stamp_col in dim.columns:
        src = src.withColumn(stamp_col, ts.cast(dim.schema[stamp_col].dataType))
    if surrogate_key:
        old_keys = dim.select(*key, surrogate_key)
        matched = src.join(old_keys, list(key), "inner")
        fresh = src.join(old_keys.select(*key), list(key), "left_anti")
        start = dim.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long")).scalar()
        fresh = assign_keys(fresh, surrogate_key, key, start)
        fresh = fresh.withColumn(surrogate_key, F.col(surrogate_key).cast(dim.schema[surrogate_key].dataType))
        return keep.unionByName(matched.select(*dim.columns)).unionByName(fresh.select(*dim.columns))
    return keep.unionByName(src.select(*dim.columns))


def as_of(dim: DataFrame, ts, closed: str = "left", start: str = "effective_start_dt",
          end: str = "effective_end_dt") -> DataFrame:
    """Versions valid at ``ts`` (J-13). ``closed='left'``: ``start <= t < end``;
    ``closed='both'``: ``start <= t <= end`` (the BETWEEN form)."""
    t = _ts(ts)
    upper = (F.col(end) > t) if closed == "left" else (F.col(end) >= t)
    return dim.filter((F.col(start) <= t) & (F.col(end).isNull() | upper))


def as_of_join(df: DataFrame, dim: DataFrame, on: dict[str, str], ts: str, columns: Sequence[str],
               how: str = "left", start: str = "effective_start_dt", end: str = "effective_end_dt",
               broadcast: bool | None = None) -> DataFrame:
    """Join each row to the dimension version valid at the row's time (J-14).

    Equi-join on the natural key plus the half-open range condition; Spark
    hashes (or broadcasts) on the key and evaluates the range as a join filter,
    so only the versions of one key are compared. At most one version matches
    when the dimension passes :func:`check_scd2`.
    """
    d = dim.select(*[F.col(v).alias(f"_aj_{k}") for k, v in on.items()],
                   F.col(start).alias("_aj_s"), F.col(end).alias("_aj_e"), *columns)
    d = bounded_broadcast(d, broadcast=broadcast)
    cond = None
    for k in on:
        c = df[k] == d[f"_aj_{k}"]
        cond = c if cond is None else cond & c
    t = F.col(ts).cast("timestamp")
    cond = cond & (d["_aj_s"] <= t) & (d["_aj_e"].isNull() | (d["_aj_e"] > t))
    return df.join(d, cond, how).drop(*[f"_aj_{k}" for k in on], "_aj_s", "_aj_e")


def as_of_carry(df: DataFrame, dim: DataFrame, on: dict[str, str], ts: str, columns: Sequence[str],
                start: str = "effective_start_dt", end: str = "effective_end_dt") -> DataFrame:
    """:func:`as_of_join` for dimensions of any size (J-14), by carry-forward.

    Versions and rows are put in one order of (key, time), versions first, and
    the last version of the key is carried along to its rows, across partition
    borders too; it counts unless it has ended. No version is compared with a
    row, a key with most of the rows spans many tasks, and the dimension is
    computed once. Rows with a null key or time match nothing.
    """
    keys = [f"_ac_k{i}" for i in range(len(on))]
    versions = materialize(dim.where(F.col(start).isNotNull()).select(*[F.col(v).alias(k) for k, v in zip(keys, on.values(), strict=True)], F.col(start).alias("_ac_t"),
                                      F.struct(F.col(end).alias("end"), *columns).alias("_ac_v")), "as-of-versions")
    rows = df.select(*[F.col(c).alias(k) for k, c in zip(keys, on, strict=True)], F.col(ts).cast("timestamp").alias("_ac_t"), F.struct("*").alias("_ac_row"))
    known = F.expr(" AND ".join(f"{k} IS NOT NULL" for k in [*keys, "_ac_t"]))
    both = (versions.dropna(subset=keys).withColumn("_ac_kind", F.lit(0))
            .unionByName(rows.where(known).withColumn("_ac_kind", F.lit(1)), allowMissingColumns=True))
    last = carry_last(both, keys, ["_ac_t", "_ac_kind"], "_ac_v", "_ac_last", "as-of").where("_ac_kind = 1")
    live = F.col("_ac_last.end").isNull() | (F.col("_ac_last.end") > F.col("_ac_t"))
    found = last.select("_ac_row.*", *[F.when(live, F.col(f"_ac_last.{c}")).alias(c) for c in columns])
    return found.unionByName(rows.where(~known).select("_ac_row.*"), allowMissingColumns=True)


def history_as_of(hist: DataFrame, dim: DataFrame, fk: str, pk: str, ts, columns: Sequence[str]) -> DataFrame:
    """Two-level point in time (J-15): fact history rows valid at ``ts``, each with
    the dimension version valid at ``ts``."""
    h = as_of(hist, ts)
    d = as_of(dim, ts).select(F.col(pk).alias("_hp"), *columns)
    return h.join(bounded_broadcast(d), F.col(fk) == F.col("_hp"), "left").drop("_hp")


def timeline(dim: DataFrame, natural_key: Sequence[str], start: str = "effective_start_dt",
             end: str = "effective_end_dt") -> DataFrame:
    """Versions with the next version's start (W-09): the basis of gap/overlap checks."""
    w = Window.partitionBy(*natural_key).orderBy(F.col(start), F.col(end).asc_nulls_last())
    return (dim.withColumn("version_no", F.row_number().over(w))
            .withColumn("next_start", F.lead(start).over(w)))


def check_scd2(dim: DataFrame, natural_key: Sequence[str], start: str = "effective_start_dt",
               end: str = "effective_end_dt") -> DataFrame:
    """SCD2 integrity per key (D-06): exactly one active row, no overlaps, no gaps.

    Returns one row per natural key that breaks a rule, with counts of active
    rows, overlaps and gaps. One shuffle by key; each key's versions are
    scanned in order by a window, never gathered into a list.
    """
    t = timeline(dim, natural_key, start, end)
    nxt = F.col("next_start")
    t = t.withColumns({
        "_overlap": nxt.isNotNull() & (F.col(end).isNull() | (nxt < F.col(end))),
        "_gap": nxt.isNotNull() & F.col(end).isNotNull() & (nxt > F.col(end)),
        "_open_not_last": nxt.isNotNull() & F.col(end).isNull(),
    })
    per_key = t.groupBy(*natural_key).agg(
        F.count_if(F.col("is_active")).alias("active_rows"),
        F.count_if("_overlap").alias("overlaps"),
        F.count_if("_gap").alias("gaps"),
        F.count(F.lit(1)).alias("versions"))
    return per_key.filter((F.col("active_rows") != 1) | (F.col("overlaps") > 0) | (F.col("gaps") > 0))
