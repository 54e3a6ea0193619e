"""Readers: raw landing trees, CSV, warehouse tables, inline rows, archive (S-01..S-07)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(spark: SparkSession, root: str, table: str,
             schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan ``root/<table>/`` including dated sub-folders (``YYYY/MM/DD``).

    ``recursiveFileLookup`` finds files at any depth; an explicit schema avoids
    footer inference and fails loudly on drift.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{root.rstrip('/')}/{table}")


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType,
                   date_format: str = "yyyy-MM-dd", mode: str = "overwrite") -> DataFrame:
    """Convert a landed CSV (header row, typed by ``schema``) to Snappy Parquet (S-02)."""
    df = (spark.read.option("header", "true").option("dateFormat", date_format)
          .option("mode", "FAILFAST").schema(schema).csv(src))
    df.write.mode(mode).option("compression", "snappy").parquet(dst)
    return spark.read.schema(schema).parquet(dst)


def read_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet path (S-03)."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(name_or_path)
    return spark.table(name_or_path)


def seed_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Inline rows (VALUES / UNION ALL of literals, S-04, U-02). For small reference data only."""
    return spark.createDataFrame(list(rows), schema)


def read_archive(spark: SparkSession, path: str, years: Iterable[int] | None = None,
                 part: str = "archive_year") -> DataFrame:
    """Read an archive partitioned by year; a year list prunes folders (S-06)."""
    df = spark.read.option("basePath", path).parquet(path)
    if years is not None:
        df = df.filter(F.col(part).isin(list(years)))
    return df


def incremental_extract(df: DataFrame, last_run, created: str, updated: str | None = None) -> DataFrame:
    """Rows created or updated at or after the high-water mark (S-07).

    The comparison is a plain filter, so it reaches the Parquet scan as a
    pushed predicate (row-group min/max skipping).
    """
    mark = last_run if isinstance(last_run, Column) else F.lit(last_run).cast("timestamp")
    cond = F.col(created) >= mark
    if updated is not None:
        cond = cond | (F.col(updated) >= mark)
    return df.filter(cond)


def high_water_mark(runlog: DataFrame, job_name: str) -> DataFrame:
    """One-row frame with the last processed date of the latest successful run."""
    return (runlog.filter((F.col("job_name") == job_name) & (F.col("status") == "SUCCESS"))
            .agg(F.max("last_processed_date").alias("last_processed_date")))


def file_information(df: DataFrame, source_system: str | None = None) -> DataFrame:
    """One row per landed file read by ``df`` (D-09): path, name, size and
    record count, from the file source's hidden ``_metadata`` column. A
    grouped count (partial aggregation per task), so the size of the input
    does not matter; ``df`` must come straight from a file read."""
    m = df.select(F.col("_metadata.file_path").alias("file_path"),
                  F.col("_metadata.file_name").alias("file_name"),
                  F.col("_metadata.file_size").alias("file_size_bytes"))
    out = m.groupBy("file_path", "file_name", "file_size_bytes").agg(F.count(F.lit(1)).alias("record_count"))
    if source_system is not None:
        out = out.withColumn("source_system", F.lit(source_system))
    return out
