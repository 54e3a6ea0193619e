"""Table writes and keyed mutations on plain Parquet (K-01..K-09).

Plain Parquet has no MERGE and cannot overwrite a path that the same plan
reads. So mutations are DataFrame → DataFrame functions (the next state), and
a :class:`VersionedTable` writes each state to ``<path>/v=<n>/`` and then
switches a one-row pointer, so readers see either the old or the new version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def update_by_keys(df: DataFrame, keys_df: DataFrame, key: Sequence[str],
                   assignments: Mapping[str, Column]) -> DataFrame:
    """Rows whose key is in ``keys_df`` get ``assignments`` (K-03, UPDATE … WHERE key IN …).

    A left join with a match flag in place of a key list collected to the driver.
    """
    k = keys_df.select(*key).distinct().withColumn("_upd_hit", F.lit(True))
    j = df.join(k, list(key), "left")
    hit = F.coalesce(F.col("_upd_hit"), F.lit(False))
    cols = [F.when(hit, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in assignments else F.col(c) for c in df.columns]
    return j.select(*cols)


def delete_by_keys(df: DataFrame, keys_df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys_df`` (K-04, DELETE … WHERE key IN …)."""
    return df.join(keys_df.select(*key), list(key), "left_anti")


def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changed and new rows replace / join the target (K-05, MERGE)."""
    return target.join(changes.select(*key), list(key), "left_anti") \
        .unionByName(changes.select(*target.columns))


class VersionedTable:
    """A Parquet table stored as numbered versions with a pointer.

    ``write`` puts the new state in the next version folder, then adds a
    pointer to it; a failure before the pointer switch leaves the old version live.
    Reading and writing the same table in one plan is safe: the new state goes
    to a different folder than the one being read.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    def _pointer(self) -> str:
        return f"{self.path}/_current"

    def version(self) -> int:
        """The current version; 0 only if neither pointer nor version exists.
        A version without a pointer is an error, never an empty table."""
        try:
            row = self.spark.read.json(self._pointer()).agg(F.max("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            try:
                self.spark.read.format("binaryFile").load(f"{self.path}/v=*")
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                return 0
            raise RuntimeError(f"table {self.path} has versions but no pointer; restore {self._pointer()}") from e
        return int(row[0]) if row and row[0] is not None else 0

    def exists(self) -> bool:
        return self.version() > 0

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        v = self.version()
        if v == 0:
            if schema is None:
                raise FileNotFoundError(f"table {self.path} has no version")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.path}/v={v}")

    def write(self, df: DataFrame, sort_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version (K-01 overwrite semantics) and switch to it."""
        v = self.version() + 1
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
        w = out.write.mode("overwrite").option("compression", "snappy")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.path}/v={v}")
        # one more pointer file, the greatest version counts: there is no moment without a pointer
        self.spark.createDataFrame([(v,)], "version int").coalesce(1).write.mode("append") \
            .json(self._pointer())
        return v

    def append(self, df: DataFrame) -> int:
        """K-02: the next version holds the current rows plus ``df``."""
        if not self.exists():
            return self.write(df)
        cur = self.read()
        return self.write(cur.unionByName(df.select(*cur.columns)))


def write_full(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate-and-load (K-01)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append files (K-02, K-06 with ``partition_by``)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_external(spark: SparkSession, name: str, path: str, parts: Sequence[str] = ()) -> DataFrame:
    """Catalog table over a partitioned Parquet folder, partitions discovered (K-07)."""
    part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    schema = spark.read.parquet(path).schema
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{path}'")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """CREATE TABLE … AS SELECT (K-08)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def insert_into(df: DataFrame, name: str) -> None:
    """INSERT INTO … SELECT by column name (K-08)."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.insertInto(name)


def create_all(spark: SparkSession, root: str) -> list[str]:
    """Create the ``staging`` and ``dw`` databases and every table, empty (K-09)."""
    made = []
    for db, tables in schemas.TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        for tname, schema in tables.items():
            full = f"{db}.{tname}"
            if not spark.catalog.tableExists(full):
                spark.createDataFrame([], schema).write.format("parquet") \
                    .option("path", f"{root.rstrip('/')}/{db}/{tname}").saveAsTable(full)
            made.append(full)
    return made


def list_tables(spark: SparkSession, db: str, rules: Mapping[str, str] | None = None) -> DataFrame:
    """Catalog listing with a kind per name pattern (P-17), e.g.
    ``{'dimension': 'd_%', 'history': 'f_%_hist', 'fact': 'f_%'}`` (first match wins)."""
    rules = rules or {"dimension": "d\\_%", "history": "f\\_%\\_hist", "fact": "f\\_%"}
    names = [(t.name,) for t in spark.catalog.listTables(db)]
    df = spark.createDataFrame(names, "table_name string")
    kind = None
    for k, pat in rules.items():
        cond = F.col("table_name").like(pat)
        kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
    return df.withColumn("table_kind", kind.otherwise(F.lit("other")))
