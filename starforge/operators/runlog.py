"""Job run log (``etl_control``, K-10) and slowest runs (T-06)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas


class RunLog:
    """One run of a job: counts are observed on the written frame while it is
    written (``DataFrame.observe``), so no extra pass counts them.

    ``row()`` gives the ``etl_control`` row as a one-row frame to append.
    """

    def __init__(self, spark: SparkSession, job_name: str, job_type: str):
        self.spark = spark
        self.job_name = job_name
        self.job_type = job_type
        self.start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.end = None
        self.status = "RUNNING"
        self.error = None
        self.read = self.written = self.rejected = None
        self.last_date = None
        self._obs: Observation | None = None

    def observe(self, df: DataFrame, rejected=None) -> DataFrame:
        """Wrap the frame being written; its row count (and rejected rows, a
        boolean column expression) are collected as the write runs."""
        self._obs = Observation(f"runlog_{self.job_name}")
        aggs = [F.count(F.lit(1)).alias("written")]
        if rejected is not None:
            aggs.append(F.count_if(rejected).alias("rejected"))
        return df.observe(self._obs, *aggs)

    def finish(self, status: str = "SUCCESS", read: int | None = None, error: str | None = None,
               last_date=None) -> "RunLog":
        self.end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.status = status
        self.error = error
        self.read = read
        self.last_date = last_date
        if self._obs is not None:
            vals = self._obs.get
            self.written = vals.get("written")
            self.rejected = vals.get("rejected", self.rejected)
        return self

    def fail(self, error: BaseException) -> "RunLog":
        """End the run as FAILED with the counts known so far; what was being
        written has no count."""
        self.end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.status, self.written = "FAILED", None
        self.error = f"{type(error).__name__}: {error}"[:2000]
        return self

    def row(self) -> DataFrame:
        return self.spark.createDataFrame([(
            self.job_name, self.job_type, self.start, self.end, self.status, self.read, self.written,
            self.rejected, self.error, self.last_date)], schemas.ETL_CONTROL)


def slowest(runlog: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` longest finished runs with their duration in seconds (T-06)."""
    dur = F.timestamp_diff("SECOND", F.col("start_timestamp"), F.col("end_timestamp"))
    return (runlog.filter(F.col("end_timestamp").isNotNull())
            .withColumn("duration_seconds", dur)
            .orderBy(F.col("duration_seconds").desc(), F.col("start_timestamp").desc(), F.col("job_name"))
            .limit(n))
