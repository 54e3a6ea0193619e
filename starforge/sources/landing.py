"""What has been taken from a source: high-water marks (S-07) and landed files (S-08, D-09).

Both are small tables of one row per run and subject, or per file. A run's
rows are written to folders of its own and its marks last, so a run repeated
after a stop replaces what it wrote and a finished run is not repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import change_hash
from ..operators.staging import latest_rows

MARKS = "run string, subject string, column_name string, value timestamp, taken_rows long"
FILES = "run string, path string, size_bytes long, modified timestamp"


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table that its first run creates: empty before."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path) if isinstance(schema, str) else spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# ---- high-water marks

def marks_of(spark: SparkSession, path: str, subject: str) -> dict:
    """The greatest committed value per column of a subject (a few values)."""
    rows = _read(spark, f"{path}/marks", MARKS).where(F.col("subject") == subject).groupBy("column_name").agg(F.max("value").alias("v")).collect()
    return {r["column_name"]: r["v"] for r in rows}


def since_marks(df: DataFrame, marks: dict, columns: Sequence[str], overlap: str) -> DataFrame:
    """Rows with any of ``columns`` at or after its mark less the overlap; all rows
    while a column has no mark. Literals, so the filter reaches the scan."""
    if not all(marks.get(c) for c in columns):
        return df
    low = [F.col(c) >= F.lit(marks[c]) - F.expr(f"INTERVAL {overlap}") for c in columns]
    return df.where(reduce(Column.__or__, low))


def take_batch(df: DataFrame, path: str, subject: str, key: Sequence[str], columns: Sequence[str], run: str, overlap: str = "7 DAYS") -> DataFrame:
    """The rows of a source that are new or changed since the marks (S-07).

    Rows created or updated from the marks on, less ``overlap`` for late
    arrivals, are extracted; of copies of a key the newest counts; rows that an
    earlier run took in the same state are left out. The batch is written to
    ``taken/<subject>/run=<run>``, then the marks of its extract are committed.
    """
    spark, base = df.sparkSession, f"{path}/taken/{subject}"
    own = f"{base}/run={run}"
    if not _read(spark, f"{path}/marks", MARKS).where((F.col("run") == run) & (F.col("subject") == subject)).isEmpty():
        return spark.read.parquet(own)
    extract = since_marks(df, marks_of(spark, path, subject), columns, overlap)
    newest = latest_rows(extract.withColumn("_key", change_hash(list(key), "safe")), "_key", columns)
    rows = newest.withColumn("row_hash", change_hash([c for c in df.columns], "safe"))
    before = (_read(spark, base, T.StructType([*rows.schema.fields, T.StructField("run", T.StringType())])).where(F.col("run") != run)
              .select("_key", "row_hash").distinct())
    rows.join(before, ["_key", "row_hash"], "left_anti").select(*rows.columns).write.mode("overwrite").parquet(own)
    top = extract.agg(*[F.max(c).cast("timestamp").alias(c) for c in columns])
    taken = spark.read.parquet(own).count()
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("m")
    (top.select(cells).select(F.lit(run).alias("run"), F.lit(subject).alias("subject"), "m.column_name", "m.value", F.lit(taken).cast("long").alias("taken_rows"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{subject}/{run}"))
    return spark.read.parquet(own)


# ---- landed files

def _unit(path: Column, folders: bool) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1) if folders else path


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", folders: bool = False) -> DataFrame:
    """(path, size_bytes, modified) of every file under ``folder``; contents are
    not read. With ``folders`` the unit is a sub-folder that lands as a whole
    (Spark writers name their files anew): its size, and the time of its newest file."""
    names = (("file_path", "path"), ("file_size", "size_bytes"), ("file_modification_time", "modified"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
             .select(*[F.col(f"_metadata.{c}").alias(n) for c, n in names]))
    if not folders:
        return files
    return files.groupBy(_unit(F.col("path"), True).alias("path")).agg(F.sum("size_bytes").alias("size_bytes"), F.max("modified").alias("modified"))


def known_files(spark: SparkSession, registry: str) -> DataFrame:
    """The newest registered state of each file."""
    w = Window.partitionBy("path").orderBy(F.col("modified").desc(), F.col("run").desc())
    return _read(spark, registry, FILES).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def files_to_read(spark: SparkSession, folder: str, registry: str, pattern: str = "*.parquet", folders: bool = False) -> DataFrame:
    """Landed files (or ``folders``) that no run has read in their present state, with ``status``
    NEW or CHANGED: an anti-join with the registry, before any file is opened."""
    known = known_files(spark, registry).select("path", F.col("size_bytes").alias("_size"), F.col("modified").alias("_modified"))
    same = (F.col("size_bytes") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
    return (list_files(spark, folder, pattern, folders).join(known, "path", "left").where(~F.coalesce(same, F.lit(False)))
            .select("path", "size_bytes", "modified", F.when(F.col("_size").isNull(), "NEW").otherwise("CHANGED").alias("status")))


def register_files(files: DataFrame, registry: str, run: str) -> None:
    """Commit the files that a run has read; a repeated run replaces its own rows."""
    files.select(F.lit(run).alias("run"), "path", "size_bytes", "modified").coalesce(1).write.mode("overwrite").parquet(f"{registry}/{run}")


def read_listed(spark: SparkSession, files: DataFrame, schema: T.StructType, folder: str, folders: bool = False) -> DataFrame:
    """The rows of the listed files (or ``folders``) with ``file_path`` and
    ``status``, by a join on the path that each row was read from."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder).select("*", F.col("_metadata.file_path").alias("file_path"))
    listed = files.select(F.col("path").alias("_unit"), "status")
    return rows.withColumn("_unit", _unit(F.col("file_path"), folders)).join(listed, "_unit").drop("_unit")
