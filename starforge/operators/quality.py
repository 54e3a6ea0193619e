"""Data quality checks, row flags, results, profile (Q-01..Q-09)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# Fixed values of the daily check job: thresholds (percent) and check names.
THRESHOLD_COMPLETENESS = 100.0
THRESHOLD_VALIDITY = 99.0
THRESHOLD_UNIQUENESS = 100.0
VALID_DATE_MIN = "1900-01-01"


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def _result(table: str, name: str, ctype: str, checked: Column, failed: Column,
            threshold: float, at_least: bool, ts) -> list[Column]:
    """Columns of one ``dq_results`` row from a checked and a failed count.

    Pass rate is percent of rows passing; an empty table gives 0 and fails.
    """
    checked = checked.cast("long")
    failed = failed.cast("long")
    rate = F.when(checked > 0, (checked - failed) * 100.0 / checked).otherwise(F.lit(0.0))
    ok = (rate >= threshold) if at_least else (rate == threshold)
    return [F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
            F.lit(ctype).alias("check_type"), _ts(ts).alias("check_timestamp"),
            checked.alias("records_checked"), (checked - failed).alias("records_passed"),
            failed.alias("records_failed"), F.round(rate, 2).cast("decimal(5,2)").alias("pass_rate"),
            F.lit(threshold).cast("decimal(5,2)").alias("threshold"),
            F.when(ok, "PASS").otherwise("FAIL").alias("status"),
            F.lit(None).cast("string").alias("details")]


def _emit(counts: DataFrame, results: list[list[Column]]) -> DataFrame:
    """One output row per check from a one-row aggregate: an array of structs
    exploded in a single branch (the aggregate is planned and run once)."""
    return counts.select(F.explode(F.array(*[F.struct(*r) for r in results])).alias("_r")).select("_r.*")


def check_not_null(df: DataFrame, cols: Sequence[str], table: str, ts) -> DataFrame:
    """Completeness (Q-01): one aggregate pass for every column."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)]
    counts = df.agg(*aggs)
    return _emit(counts, [_result(table, f"{c}_not_null", "COMPLETENESS", F.col("_n"), F.col(f"_null_{i}"),
                                  THRESHOLD_COMPLETENESS, False, ts) for i, c in enumerate(cols)])


def _checks_row(df: DataFrame, subject_cfg: Mapping, as_of) -> DataFrame:
    """All counts of one subject's checks in a single aggregate.

    Duplicate keys need a grouping by id first; the other counts are summed on
    top of that grouping (count of rows per id), so the table is scanned once.
    """
    idc, datec = subject_cfg["id"], subject_cfg["date"]
    req = subject_cfg["required"]
    lo = F.lit(VALID_DATE_MIN).cast("date")
    bad_date = F.coalesce((F.col(datec) < lo) | (F.col(datec) > _ts(as_of)), F.lit(False))
    per_id = df.groupBy(idc).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(req)],
        F.count_if(bad_date).alias("_bad_date"),
    )
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(req))],
        F.coalesce(F.sum("_bad_date"), F.lit(0)).alias("_bad_date"),
        # NULL ids form one group in groupBy; count it like any other id
        F.count_if(F.col("_n") > 1).alias("_dup_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("_dup_rows"),
    )


def run_checks(df: DataFrame, subject: str, check_ts, as_of=None) -> DataFrame:
    """The daily checks of a subject as ``dq_results`` rows (Q-01..Q-03, Q-07).

    Completeness of the required fields (threshold 100), date validity in
    ``[1900-01-01, as_of]`` (99, ``>=``; NULL dates pass), and uniqueness of
    the id (100; failed = number of duplicated ids, the reference's count).
    One scan and one shuffle (by id) for all checks; the result is a handful
    of rows built from a one-row aggregate, never collected to the driver.
    """
    cfg = schemas.subject(subject)
    table = f"staging.{cfg['table']}"
    as_of = check_ts if as_of is None else as_of
    row = _checks_row(df, cfg, as_of)
    results = [_result(table, f"{c}_not_null", "COMPLETENESS", F.col("_n"), F.col(f"_null_{i}"),
                       THRESHOLD_COMPLETENESS, False, check_ts) for i, c in enumerate(cfg["required"])]
    results.append(_result(table, f"{cfg['date']}_valid_range", "VALIDITY", F.col("_n"),
                           F.col("_bad_date"), THRESHOLD_VALIDITY, True, check_ts))
    uniq = _result(table, f"{cfg['id']}_unique", "CONSISTENCY", F.col("_n"), F.col("_dup_keys"),
                   THRESHOLD_UNIQUENESS, False, check_ts)
    uniq[-1] = F.concat(F.lit("duplicate_rows="), F.col("_dup_rows").cast("string")).alias("details")
    results.append(uniq)
    return _emit(row, results)


def check_range(df: DataFrame, c: str, lo, hi, table: str, ts, threshold: float = THRESHOLD_VALIDITY) -> DataFrame:
    """Validity of one column in ``[lo, hi]`` (Q-02); NULL passes."""
    bad = F.coalesce((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(False))
    counts = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_bad"))
    return counts.select(*_result(table, f"{c}_valid_range", "VALIDITY", F.col("_n"), F.col("_bad"),
                                  threshold, True, ts))


def check_unique(df: DataFrame, idc: str, table: str, ts) -> DataFrame:
    """Uniqueness of ``idc`` (Q-03): failed = duplicated ids; details = duplicated rows."""
    per_id = df.groupBy(idc).agg(F.count(F.lit(1)).alias("_c"))
    counts = per_id.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"),
                        F.count_if(F.col("_c") > 1).alias("_dup"),
                        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("_rows"))
    cols = _result(table, f"{idc}_unique", "CONSISTENCY", F.col("_n"), F.col("_dup"),
                   THRESHOLD_UNIQUENESS, False, ts)
    cols[-1] = F.concat(F.lit("duplicate_rows="), F.col("_rows").cast("string")).alias("details")
    return counts.select(*cols)


def check_refs(df: DataFrame, dim: DataFrame, fk: str, pk: str, table: str, ts) -> DataFrame:
    """Referential integrity (Q-04): rows whose non-NULL ``fk`` has no ``pk``; threshold 100."""
    keys = dim.select(F.col(pk).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    joined = df.select(fk).join(keys, F.col(fk) == F.col("_pk"), "left")
    counts = joined.agg(F.count(F.lit(1)).alias("_n"),
                        F.count_if(F.col(fk).isNotNull() & F.col("_hit").isNull()).alias("_bad"))
    return counts.select(*_result(table, f"{fk}_references_{pk}", "INTEGRITY", F.col("_n"),
                                  F.col("_bad"), 100.0, False, ts))


def _type_ok(c: str, dtype: T.DataType, max_len: int | None) -> Column:
    col = F.col(c)
    ok = F.lit(True)
    if not isinstance(dtype, T.StringType):
        ok = col.isNull() | col.cast("string").try_cast(dtype).isNotNull()
    if max_len is not None:
        ok = ok & (col.isNull() | (F.length(col.cast("string")) <= max_len))
    return ok


def check_types(df: DataFrame, schema: T.StructType, table: str, ts) -> DataFrame:
    """Type / length conformity (Q-05): values castable and within VARCHAR lengths."""
    fields = [fl for fl in schema.fields if fl.name in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(~_type_ok(fl.name, fl.dataType, fl.metadata.get("max_length"))).alias(f"_bad_{i}")
        for i, fl in enumerate(fields)]
    counts = df.agg(*aggs)
    return _emit(counts, [_result(table, f"{fl.name}_type", "CONFORMITY", F.col("_n"), F.col(f"_bad_{i}"),
                                  100.0, False, ts) for i, fl in enumerate(fields)])


def _repeats(df: DataFrame, idc: str) -> DataFrame:
    """The rows with ``_dup_id``, their id if it is repeated."""
    repeated = (df.filter(F.col(idc).isNotNull()).groupBy(F.col(idc).alias("_dup_id"))
                .agg(F.count(F.lit(1)).alias("_dup_n")).filter("_dup_n > 1").select("_dup_id"))
    return df.join(repeated, F.col(idc) == F.col("_dup_id"), "left")


def flag_rows(df: DataFrame, subject: str, as_of, ids: str = "any") -> DataFrame:
    """Row flags ``dq_is_valid`` and ``dq_validation_errors`` (Q-06).

    Errors per row: each missing required field, a date out of range, a
    duplicated id (ids are counted map-side and only the repeated ones are
    joined back, so neither a hot id nor the rows without an id form one group). Errors are
    joined with ``;`` in check order; NULL when the row is clean. ``ids``
    are ``grouped`` for rows that a grouping by id has left in place (none
    NULL): they are counted where they lie, without another shuffle; or
    ``missing`` if all are NULL, so none is repeated.
    """
    cfg = schemas.subject(subject)
    lo = F.lit(VALID_DATE_MIN).cast("date")
    if ids == "missing":
        counted = df.withColumn("_dup_id", F.col(cfg["id"]))
    elif ids == "grouped":
        counted = (df.withColumn("_dup_n", F.count(F.lit(1)).over(Window.partitionBy(cfg["id"])))
                   .withColumn("_dup_id", F.when(F.col("_dup_n") > 1, F.col(cfg["id"]))).drop("_dup_n"))
    else:
        counted = _repeats(df, cfg["id"])
    errs = [F.when(F.col(c).isNull(), F.lit(f"{c}_not_null")) for c in cfg["required"]]
    errs.append(F.when(F.coalesce((F.col(cfg["date"]) < lo) | (F.col(cfg["date"]) > _ts(as_of)),
                                  F.lit(False)), F.lit(f"{cfg['date']}_valid_range")))
    errs.append(F.when(F.col("_dup_id").isNotNull(), F.lit(f"{cfg['id']}_unique")))
    arr = F.array_compact(F.array(*errs))
    return (counted.withColumn("_errs", arr)
            .withColumn("dq_is_valid", F.size("_errs") == 0)
            .withColumn("dq_validation_errors",
                        F.when(F.size("_errs") > 0, F.array_join("_errs", ";")))
            .drop("_errs", "_dup_id"))


def failures(results: DataFrame, raise_on_fail: bool = False) -> DataFrame:
    """Failed checks (Q-08). With ``raise_on_fail`` one small action checks for any."""
    failed = results.filter(F.col("status") == "FAIL")
    if raise_on_fail and failed.limit(1).count() > 0:
        names = sorted(r["check_name"] for r in failed.select("check_name").distinct().collect())
        raise RuntimeError(f"data quality checks failed: {names}")
    return failed


def profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Data profile (Q-09): rows, NULLs, distinct values, min and max per column.

    One aggregate pass for every column; the wide row is then unpivoted with
    ``stack`` (one output row per column). ``approx`` uses HyperLogLog sketches
    for the distinct counts (bounded memory for very wide or huge tables).
    """
    cols = list(cols or df.columns)
    dc = F.approx_count_distinct if approx else F.count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), dc(F.col(c)).alias(f"d{i}"),
                 F.min(F.col(c)).cast("string").alias(f"lo{i}"),
                 F.max(F.col(c)).cast("string").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    args = ", ".join(f"'{c}', n{i}, d{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {args}) as (column_name, null_count, distinct_count, min_value, max_value)",
        "_rows as row_count",
    ).select("column_name", F.col("row_count").cast("long").alias("row_count"),
             F.col("null_count").cast("long").alias("null_count"),
             F.col("distinct_count").cast("long").alias("distinct_count"), "min_value", "max_value")
