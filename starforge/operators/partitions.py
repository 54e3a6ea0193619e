"""Date-partitioned fact tables whose loads rewrite only the partitions they change (K-05, K-06, X-06).

A table is a plain Parquet folder partitioned by a function of its date key.
A load compares the batch with the narrow columns of the target, reads only
the partitions that hold a changed row or get a new one, and overwrites those
(dynamic partition overwrite); all other files stay as they are.

Loads commit in two steps. The next state of the touched partitions is written
under ``_loads/<run>/rows``, then one plan row per touched partition under
``_loads/<run>/plan``; only then are the partitions switched, and ``done`` is
written last. A load that stopped before its plan has changed nothing; one
that stopped later is switched again, from the same rows, by the next load or
:func:`finish_loads`. A run that is done is not repeated. One load runs at a time.
Archive runs commit the same way.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import packed, unpacked
from ..session import materialize
from .facts import CHANGED, NEW, UNCHANGED
from .keys import assign_keys

PLAN = "part_value int, rows_before long, rows_after long, new_rows long, changed_rows long, run string"


def month_part(date_key: str) -> Column:
    """yyyymm of a date key; rows without a date are partition 0."""
    return F.coalesce(F.floor(F.col(date_key) / 100), F.lit(0)).cast("int")


def day_part(date_key: str) -> Column:
    """The date key itself; rows without a date are partition 0."""
    return F.coalesce(F.col(date_key), F.lit(0)).cast("int")


def dealt(df: DataFrame, part: Column | str, *spread: str) -> DataFrame:
    """Rows of one partition in few tasks, so in few files."""
    return df.repartition(part, F.pmod(F.xxhash64(*spread), F.lit(8)))


def write_partitions(df: DataFrame, path: str, part: str, value: Column, lie: bool = False) -> None:
    """The initial load: all partitions, rows of one partition in few files
    (``lie``: the rows are :func:`dealt` already)."""
    out = df.withColumn(part, value)
    _write(out if lie else dealt(out, part, *df.columns[:2]), path, part)


def _write(df: DataFrame, path: str, *parts: str, dynamic: bool = False) -> None:
    out = df.write.mode("overwrite").option("compression", "zstd")
    (out.option("partitionOverwriteMode", "dynamic") if dynamic else out).partitionBy(*parts).parquet(path)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def _runs(spark: SparkSession, path: str, step: str) -> list[str]:
    """Runs that reached ``step``: a handful of names, one per unfinished load and its predecessors."""
    try:
        rows = spark.read.schema("run string").json(f"{path}/_loads/*/{step}").distinct().collect()
    except AnalysisException as e:
        if not _missing(e):
            raise
        return []
    return sorted(r["run"] for r in rows if r["run"])


def _one(spark: SparkSession, path: str, run: str) -> None:
    spark.range(1).select(F.lit(run).alias("run")).coalesce(1).write.mode("overwrite").json(path)


def _switch(spark: SparkSession, path: str, part: str, run: str) -> None:
    """Overwrite the touched partitions of a planned load or archive run; may be
    repeated. Archived rows go first, to folders of their own run."""
    base, schema = f"{path}/_loads/{run}", spark.read.parquet(path).schema
    to = _archive_of(spark, base)
    if to:
        old = spark.read.parquet(f"{base}/archived")
        _write(old, to, "archive_year", "run", dynamic=True)
    rows = spark.read.schema(schema).parquet(f"{base}/rows")
    _write(rows, path, part, dynamic=True)
    # an overwrite by rows can't empty a partition: all of its rows moved elsewhere
    empty = spark.read.schema(PLAN).json(f"{base}/plan").where("rows_after = 0 AND rows_before > 0").select("part_value").collect()
    for r in empty:
        rows.drop(part).limit(0).write.mode("overwrite").parquet(f"{path}/{part}={r['part_value']}")
    _one(spark, f"{base}/done", run)


def _archive_of(spark: SparkSession, base: str) -> str | None:
    """The archive of an archive run; None for a load."""
    try:
        return spark.read.schema("run string").json(f"{base}/archive").first()["run"]
    except AnalysisException as e:
        if not _missing(e):
            raise
        return None


def finish_loads(spark: SparkSession, path: str, part: str) -> list[str]:
    """Switch planned loads that were stopped; their names."""
    done = set(_runs(spark, path, "done"))
    todo = [r for r in _runs(spark, path, "plan") if r not in done]
    for run in todo:
        _switch(spark, path, part, run)
    return todo


def load_plan(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The touched partitions of a load, with their row counts."""
    return spark.read.schema(PLAN).json(f"{path}/_loads/{run}/plan")


def tag_changes(batch: DataFrame, target: DataFrame, key: str, sk: str, part: str, hash_col: str = "record_hash") -> DataFrame:
    """The batch's rows with ``action`` and, where the key is known, the
    target's surrogate key, creation time and partition: one join with narrow
    columns. A key that the target holds twice is an error."""
    twice = F.raise_error(F.concat(F.lit(f"repeated {key} in the target: "), F.col(key).cast("string")))
    was = F.struct(F.col(sk).alias("sk"), F.col("created_dt").alias("created"), F.col(part).alias("part"), packed(hash_col).alias("hash"))
    # a grouping would sort all rows before the shuffle, to combine keys that may not repeat
    known = (target.where(F.col(key).isNotNull()).select(key, was.alias("_was")).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
             .select(key, F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(F.lit(True)).alias("_hit"), "_was"))
    action = (F.when(F.col("_hit").isNull(), NEW).when(~packed(hash_col).eqNullSafe(F.col("_was.hash")), CHANGED).otherwise(UNCHANGED))
    return batch.join(known, key, "left").withColumn("action", action).drop("_hit")


def _replace(old: DataFrame, new: DataFrame, gone: DataFrame, key: str, part: str, hash_col: str = "record_hash") -> DataFrame:
    """The old rows without those that ``gone`` names by partition and key, and
    the new rows, dealt for the write. The names travel with the rows, so the
    one shuffle that the write needs also finds the rows to leave out."""
    rows = old.withColumn("_kind", F.lit(1)).unionByName(new.withColumn("_kind", F.lit(2)))
    rows = rows.withColumn(hash_col, packed(hash_col)).unionByName(gone.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    lie = rows.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(8))).repartition(part, "_spread")
    first = F.min("_kind").over(Window.partitionBy(part, "_spread", key).orderBy("_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = lie.withColumn("_first", first).where((F.col("_kind") == 2) | ((F.col("_kind") == 1) & (F.col("_first") == 1)))
    return left.withColumn(hash_col, unpacked(hash_col)).select(*old.columns)


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, key: str, sk: str, part: str, value: Callable[[], Column],
                      batch_ts, run: str, before_switch: Callable[[], None] | None = None) -> DataFrame:
    """Load a batch of fact rows (no surrogate keys yet) into the table at ``path``; returns :func:`load_plan`.

    CHANGED rows replace their row, whatever partition it is in, and keep its
    key; NEW rows get keys after the greatest; partitions without either are
    neither read in full nor written. The list of touched partitions, bounded
    by the calendar, is the only thing the driver sees. ``before_switch`` runs
    between the two steps.
    """
    finish_loads(spark, path, part)
    if run in _runs(spark, path, "done"):
        return load_plan(spark, path, run)
    ts = F.lit(batch_ts).cast("timestamp")
    target = read_partitions(spark, path)
    cols = [c for c in target.columns if c != part]
    tagged = materialize(tag_changes(batch.withColumn(part, value()), target.select(key, sk, "created_dt", "record_hash", part), key, sk, part)
                         .where(F.col("action") != UNCHANGED), f"load-{run}")
    changed, new = tagged.where(F.col("action") == CHANGED), tagged.where(F.col("action") == NEW)
    moved = tagged.select(F.explode(F.array_distinct(F.array_compact(F.array(part, "_was.part")))).alias(part)).distinct()
    touched = sorted(r[0] for r in moved.collect())
    old = target.where(F.col(part).isin(touched))
    start = target.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()
    fresh = assign_keys(new.drop(sk), sk, [key], start).withColumns({"created_dt": ts, "updated_dt": ts})
    replaced = changed.withColumns({sk: F.col("_was.sk"), "created_dt": F.col("_was.created"), "updated_dt": ts})
    rows = _replace(old.select(*cols, part), replaced.select(*cols, part).unionByName(fresh.select(*cols, part)),
                    changed.select(F.col(key), F.col("_was.part").alias(part)), key, part)
    base = f"{path}/_loads/{run}"
    _write(rows, f"{base}/rows", part)
    counts = [old.groupBy(F.col(part).alias("part_value")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("rows_before")),
              spark.read.schema(rows.schema).parquet(f"{base}/rows").groupBy(F.col(part).alias("part_value")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("what", F.lit("rows_after")),
              tagged.groupBy(F.col(part).alias("part_value"), F.when(F.col("action") == NEW, "new_rows").otherwise("changed_rows").alias("what"))
              .agg(F.count(F.lit(1)).alias("n")).select("part_value", "n", "what"),
              moved.select(F.col(part).alias("part_value"), F.lit(0).cast("long").alias("n"), F.lit("rows_after").alias("what"))]
    plan = counts[0]
    for c in counts[1:]:
        plan = plan.unionByName(c)
    names = ["rows_before", "rows_after", "new_rows", "changed_rows"]
    plan = plan.groupBy("part_value").agg(*[F.coalesce(F.sum(F.when(F.col("what") == w, F.col("n"))), F.lit(0)).alias(w) for w in names])
    plan.withColumn("run", F.lit(run)).coalesce(1).write.mode("overwrite").json(f"{base}/plan")
    if before_switch:
        before_switch()
    if touched:
        _switch(spark, path, part, run)
    else:
        _one(spark, f"{base}/done", run)
    return load_plan(spark, path, run)


# ---- archive

class ArchiveMismatch(RuntimeError):
    """Written archive rows differ from the fact's; nothing was removed."""


def _fingerprint(df: DataFrame, columns: list[str]) -> tuple[int, int]:
    """Rows and the sum of their 64-bit hashes, which is taken in three parts:
    they add up as longs for 2**41 rows, where a decimal costs more than the hash."""
    h, low = F.xxhash64(*columns), F.lit((1 << 22) - 1)
    row = (df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(low)).alias("h0"),
                                       F.sum(F.shiftright("h", 22).bitwiseAND(low)).alias("h1"), F.sum(F.shiftright("h", 44)).alias("h2")).first())
    return row["n"], sum(int(row[f"h{k}"] or 0) << 22 * k for k in range(3))


def archive_partitions(spark: SparkSession, path: str, part: str, date_key: str, upto: int, cut: dt.date, archive_path: str, run: str,
                       before_switch: Callable[[], None] | None = None) -> DataFrame:
    """Move the rows dated before ``cut`` to the archive (X-08, K-04, K-06); returns :func:`load_plan`.

    Only partitions up to ``upto`` (the cutoff's own) are read. The old rows are
    written beside the fact with their year, read back and compared with the
    fact's (rows and sum of row hashes); the plan then names the touched
    partitions, and the switch writes the archive first and removes the rows
    from the fact last, both by overwriting folders of the run's own, so
    a stopped run is completed and a finished one is not repeated. Rows
    without a calendar date stay.
    """
    finish_loads(spark, path, part)
    if run in _runs(spark, path, "done"):
        return load_plan(spark, path, run)
    target = read_partitions(spark, path)
    # by arithmetic, not by writing and parsing a text per row; a key that is no date fails as in to_date
    key = F.col(date_key)
    date = F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100 % 100).cast("int"), (key % 100).cast("int"))
    within = target.where((F.col(part) > 0) & (F.col(part) <= upto))
    is_old = F.coalesce(date < F.lit(cut), F.lit(False))
    old, base = within.where(is_old), f"{path}/_loads/{run}"
    counts = materialize(within.groupBy(F.col(part).alias("part_value"))
                         .agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(~is_old).alias("rows_after")).where("rows_after < rows_before"), f"archive-{run}")
    touched = sorted(r[0] for r in counts.select("part_value").collect())
    if touched:
        (old.withColumn("archive_year", F.year(date).cast("int")).withColumn("run", F.lit(run))
         .repartition("archive_year", F.pmod(F.xxhash64(*target.columns[:2]), F.lit(8))).write.mode("overwrite").partitionBy("archive_year", "run").parquet(f"{base}/archived"))
        written = spark.read.schema(target.schema).parquet(f"{base}/archived")
        if _fingerprint(old, target.columns) != _fingerprint(written, target.columns):
            raise ArchiveMismatch(f"archive of run {run} differs from the rows of {path}; fact left unchanged")
        _one(spark, f"{base}/archive", archive_path)
    kept = within.where(F.col(part).isin(touched) & ~is_old)
    kept.repartition(part, F.pmod(F.xxhash64(*target.columns[:2]), F.lit(8))).write.mode("overwrite").partitionBy(part).parquet(f"{base}/rows")
    (counts.withColumns({"new_rows": F.lit(0), "changed_rows": F.lit(0), "run": F.lit(run)}).coalesce(1).write.mode("overwrite").json(f"{base}/plan"))
    if before_switch:
        before_switch()
    if touched:
        _switch(spark, path, part, run)
    else:
        _one(spark, f"{base}/done", run)
    return load_plan(spark, path, run)
