"""Archive by age (X-07, X-08, A-20)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .tables import VersionedTable, append, register_external


def cutoff(as_of, days: int | None = None, years: int | None = None) -> Column:
    """Archive cutoff date: ``as_of - days`` (the reference's 3650 days) or
    ``as_of - years`` calendar years."""
    base = as_of if isinstance(as_of, Column) else F.lit(str(as_of)[:10]).cast("date")
    if years is not None:
        return F.add_months(base, -12 * years)
    return F.date_sub(base, 3650 if days is None else days)


def archive_split(fact: DataFrame, d_date: DataFrame, date_key: str, cut: Column,
                  part: str = "archive_year"):
    """(old, kept) by the fact's date key against a cutoff date.

    One broadcast join to the calendar (bounded) tags each row; ``old`` are
    rows with a calendar date before the cutoff, plus ``archive_year``;
    ``kept`` is the rest (including rows whose key has no calendar row). Only
    fact columns are kept, the calendar columns are not archived. No shuffle
    of the fact.
    """
    cal = F.broadcast(d_date.select(F.col("date_key").alias("_ad_key"), F.col("date_value").alias("_ad_date")))
    tagged = fact.join(cal, fact[date_key] == cal["_ad_key"], "left")
    is_old = F.coalesce(F.col("_ad_date") < cut, F.lit(False))
    old = tagged.filter(is_old).withColumn(part, F.year("_ad_date").cast("int")).drop("_ad_key", "_ad_date")
    kept = tagged.filter(~is_old).drop("_ad_key", "_ad_date")
    return old, kept


def archive_counts(archived: DataFrame, part: str = "archive_year") -> DataFrame:
    """Archived rows per year (A-20)."""
    return archived.groupBy(part).agg(F.count(F.lit(1)).alias("archived_rows"))


def archive_year_counts(spark: SparkSession, path: str, years=None, part: str = "archive_year") -> DataFrame:
    """Rows per year of a written archive, from metadata alone (A-20, S-06).

    The count is pushed into the Parquet reader, which takes row counts from the
    file footers and the year from the folder names; no column is read. ``years``
    prunes folders. The reader needs two settings, so the frame belongs to a
    session of its own and the caller's settings stay as they are; an empty
    archive folder holds no year and is an error, as for any reader.
    """
    own = spark.newSession()
    for key, value in {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true", "spark.sql.session.timeZone": "UTC"}.items():
        own.conf.set(key, value)
    df = own.read.parquet(path)
    if years is not None:
        df = df.filter(F.col(part).isin(list(years)))
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("archived_rows"))


def run_archive(fact_table: VersionedTable, d_date: DataFrame, date_key: str, cut: Column,
                archive_path: str, catalog_name: str | None = None, part: str = "archive_year") -> dict:
    """Archive run (X-08): write old rows by year, verify, then switch the fact
    to the kept rows.

    The old set is materialized once (Parquet in the shared checkpoint
    folder), so the written archive and the verified count are the same rows;
    the archive is appended before the fact loses them, and the fact's new
    version is written next to the old one, so a failure at any step leaves
    no row lost.
    """
    fact = fact_table.read()
    old, kept = archive_split(fact, d_date, date_key, cut, part)
    old = materialize(old, "archive")
    n_old = old.count()
    if n_old:
        try:
            existing = fact.sparkSession.read.parquet(archive_path).count()
        except Exception:  # noqa: BLE001 - first run: no archive yet
            existing = 0
        append(old, archive_path, [part])
        written = fact.sparkSession.read.parquet(archive_path).count() - existing
        if written != n_old:
            raise RuntimeError(f"archive wrote {written} rows, expected {n_old}; fact left unchanged")
        fact_table.write(kept)
        if catalog_name:
            register_external(fact.sparkSession, catalog_name, archive_path, [part])
    return {"archived": n_old, "run_at": dt.datetime.now(dt.timezone.utc).isoformat()}
