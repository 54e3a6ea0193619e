"""Structured Streaming forms of the batch steps (R-01..R-03)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.monitor import AGG, _seconds


def table_source(root: str, name: str) -> str:
    """Path of a Parquet table for a file stream, be the table one file or a
    folder of part files. As a pattern (of one name) both can be listed; a
    plain path to a single file is refused by the stream source."""
    return f"{root.rstrip('/')}/{{{name}.parquet}}"


def ingest_new_files(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType,
                     fmt: str = "parquet", transform: Callable[[DataFrame], DataFrame] | None = None,
                     partition_by: Sequence[str] = (), wait: bool = True, glob: str | None = None,
                     recursive: bool = False):
    """Process each landed file exactly once (R-01, the "bookmark").

    A file source remembers which files it has read in the checkpoint; with
    ``availableNow`` each run takes all new files (in bounded micro-batches)
    and stops. The Parquet sink commits through its own log, so a retried
    batch does not duplicate rows. ``src`` is a folder; ``glob`` picks files in it.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", 1000)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:  # dated sub-folders of a landing tree
        reader = reader.option("recursiveFileLookup", "true")
    sdf = reader.load(src)
    if transform is not None:
        sdf = transform(sdf)
    w = (sdf.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(dst)
    if wait:
        q.awaitTermination()
    return q


def window_counts_stream(sdf: DataFrame, ts: str, value: str, agg: str = "Sum", width: str = "5 minutes",
                         watermark: str = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Tumbling-window statistic with a late-data bound (R-02): rows later than
    the watermark are dropped and their window's state is released. Event
    time must be a TIMESTAMP (a TIMESTAMP_NTZ column is read as UTC)."""
    if dict(sdf.dtypes).get(ts) == "timestamp_ntz":
        sdf = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    return (sdf.withWatermark(ts, watermark)
            .groupBy(*by, F.window(F.col(ts), width).alias("period"))
            .agg(AGG[agg](F.col(value)).alias("stat"))
            .select(*by, F.col("period.start").alias("period_start"),
                    F.col("period.end").alias("period_end"), "stat"))


def _epoch_sink(sink: str) -> Callable[[DataFrame, int], None]:
    """Write a micro-batch to its own epoch folder; a repeated epoch replaces it."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
    return write


def stream_alarm(spark: SparkSession, sdf: DataFrame, ts: str, value: str, agg: str, threshold: float,
                 periods: int, sink: str, checkpoint: str, width: str = "5 minutes",
                 watermark: str = "10 minutes", by: Sequence[str] = (), wait: bool = True):
    """Period statistics for alarms (R-02): windows that the watermark has passed
    are written to ``sink``/periods, once each, those still open stay in the
    query's state. :func:`alarms_from_periods` judges what is written, with
    the same ``threshold`` and ``periods``; :func:`keyed_alarm` judges in the stream.
    """
    counts = window_counts_stream(sdf, ts, value, agg, width, watermark, by)
    q = (counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(_epoch_sink(f"{sink}/periods")).trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def alarms_from_periods(spark: SparkSession, sink: str, threshold: float, periods: int,
                        width: str = "5 minutes", by: Sequence[str] = ()) -> DataFrame:
    """ALARM periods over the stored period statistics of :func:`stream_alarm`."""
    stats = spark.read.parquet(f"{sink}/periods").dropDuplicates([*by, "period_start"])
    step = _seconds(width)
    br = stats.filter(F.col("stat") > threshold) \
        .withColumn("_idx", (F.unix_timestamp("period_start") / step).cast("long"))
    w = Window.partitionBy(*by).orderBy("_idx")
    br = br.withColumn("_grp", F.col("_idx") - F.row_number().over(w))
    wr = Window.partitionBy(*by, "_grp").orderBy("_idx")
    return (br.withColumn("consecutive", F.row_number().over(wr).cast("int"))
            .filter(F.col("consecutive") >= periods)
            .select(*by, "period_start", "period_end", F.col("stat").alias("stat_value"), "consecutive"))


def advance_runs(closed: DataFrame, runs: DataFrame | None, by: Sequence[str], threshold: float, step: int) -> tuple[DataFrame, DataFrame]:
    """(breaching periods with ``consecutive``, next runs) for a micro-batch of
    closed periods. ``runs`` holds per series the last closed period's index and
    the length of the breaching run that ends there; a run of the batch goes on
    with it if it begins at the next index. Windows run over aggregated periods."""
    closed = closed.withColumn("_idx", F.floor(F.unix_timestamp("period_start") / step).cast("long"))
    island = Window.partitionBy(*by, "_grp")
    breach = (closed.where(F.col("stat") > threshold)
              .withColumn("_grp", F.col("_idx") - F.row_number().over(Window.partitionBy(*by).orderBy("_idx")))
              .withColumn("_n", F.row_number().over(island.orderBy("_idx"))).withColumn("_first", F.min("_idx").over(island)))
    if runs is None:
        runs = closed.limit(0).select(*by, F.col("_idx").alias("last"), F.lit(0).cast("long").alias("run"))
    old = runs.select(*[F.col(c).alias(f"_o_{c}") for c in by], "last", "run")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in by])
    carry = F.when(F.col("_first") == F.col("last") + 1, F.col("run")).otherwise(F.lit(0))
    judged = (breach.join(old, same, "left").withColumn("consecutive", (F.col("_n") + carry).cast("int"))
              .select(*by, "period_start", "period_end", F.col("stat").alias("stat_value"), "consecutive", "_idx"))
    ends = closed.select(*by, "_idx", F.lit(0).alias("consecutive")).unionByName(judged.select(*by, "_idx", "consecutive"))
    newest = F.max(F.struct("_idx", "consecutive"))
    now = ends.groupBy(*by).agg(newest.alias("_e")).select(*by, F.col("_e._idx").alias("last"), F.col("_e.consecutive").cast("long").alias("run"))
    next_runs = now.unionByName(runs).groupBy(*by).agg(F.max(F.struct("last", "run")).alias("_r")).select(*by, "_r.last", "_r.run")
    return judged.drop("_idx"), next_runs


def marker_folder(spark: SparkSession, path: str, ts: str) -> None:
    """An empty folder of end markers for :func:`keyed_alarm`."""
    spark.createDataFrame([], f"{ts} timestamp").write.mode("overwrite").parquet(path)


def end_stream(spark: SparkSession, path: str, ts: str, last: dt.datetime, margin: dt.timedelta = dt.timedelta(days=1)) -> None:
    """Land the end marker of a finished stream: an event ``margin`` after the
    last one, which moves the watermark past all open windows but is no event
    itself. The next run of the query closes and judges them."""
    spark.createDataFrame([(last + margin,)], f"{ts} timestamp").coalesce(1).write.mode("append").parquet(path)


def keyed_alarm(spark: SparkSession, sdf: DataFrame, ts: str, value: str, agg: str, threshold: float,
                 periods: int, sink: str, checkpoint: str, markers: str, width: str = "5 minutes",
                 watermark: str = "10 minutes", by: Sequence[str] = (), wait: bool = True):
    """Streaming alarm (R-02): periods whose statistic is above ``threshold`` for
    ``periods`` consecutive periods, as :func:`~starforge.operators.monitor.window_alarm`
    finds them in a batch.

    Windows close when the watermark passes them, those of a series in time order
    over the micro-batches. Each micro-batch reads the series' runs that the one
    before it wrote and writes its alarms and the next runs to folders of its own
    epoch, so a restarted query goes on and a repeated epoch replaces its own
    rows. ``markers`` is a folder
    made by :func:`marker_folder`; :func:`end_stream` flushes what is still open.
    Events later than the watermark are dropped, as are those without a time.
    """
    if dict(sdf.dtypes).get(ts) == "timestamp_ntz":
        sdf = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    events = sdf.select(*by, ts, F.col(value).alias("_value"), F.lit(False).alias("_end"))
    ends = spark.readStream.schema(f"{ts} timestamp").parquet(markers).withColumn("_end", F.lit(True))
    # the condition names the event time, so it stays above the watermark
    marked = (events.unionByName(ends, allowMissingColumns=True).withWatermark(ts, watermark)
              .where(F.when(F.col("_end"), F.lit(None)).otherwise(F.col(ts)).isNotNull()))
    series = list(by) or ["_all"]
    marked = marked if by else marked.withColumn("_all", F.lit(0))
    closed = (marked.groupBy(*series, F.window(F.col(ts), width).alias("period")).agg(AGG[agg](F.col("_value")).cast("double").alias("stat"))
              .select(*series, F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"), "stat"))

    def judge(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        before = [e for e in _epochs(spark, f"{sink}/runs") if e < epoch]
        runs = spark.read.parquet(f"{sink}/runs/epoch={before[-1]}") if before else None
        found, next_runs = advance_runs(batch, runs, series, threshold, _seconds(width))
        write = _epoch_sink(f"{sink}/runs")
        write(next_runs, epoch)
        _epoch_sink(f"{sink}/alarms")(found.where(F.col("consecutive") >= periods).select(*by, "period_start", "period_end", "stat_value", "consecutive"), epoch)
        batch.unpersist()

    q = (closed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(judge).trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """The epochs written under ``path``, in order (one number per micro-batch)."""
    try:
        rows = spark.read.parquet(path).select("_metadata.file_path").distinct()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    found = rows.select(F.regexp_extract("file_path", r"/epoch=(\d+)/", 1).cast("long").alias("e")).distinct().collect()
    return sorted(r["e"] for r in found)


def read_alarms(spark: SparkSession, sink: str) -> DataFrame:
    """The alarms written so far."""
    return spark.read.parquet(f"{sink}/alarms").drop("epoch").withColumn("state", F.lit("ALARM"))


def stream_upsert(sdf: DataFrame, apply_fn: Callable[[DataFrame, int], None], checkpoint: str,
                  wait: bool = True):
    """Micro-batch upsert (R-03): ``apply_fn(batch, epoch)`` runs the batch
    SCD2 / fact upsert on each micro-batch (e.g. writing a new version of a
    :class:`~starforge.operators.tables.VersionedTable`). ``epoch`` lets the
    function skip a batch it has already committed after a restart."""
    q = (sdf.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply_fn)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q
