"""Fixed-period alarms over a metric series and the error-log filter (W-10, P-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AGG = {"Sum": F.sum, "Average": F.avg, "Maximum": F.max, "Minimum": F.min, "SampleCount": F.count}


def period_stats(df: DataFrame, ts: str, value: str, agg: str = "Sum", width: str = "5 minutes",
                 by: Sequence[str] = ()) -> DataFrame:
    """One statistic per fixed period (tumbling window) and series."""
    w = F.window(F.col(ts), width)
    return (df.groupBy(*by, w.alias("period"))
            .agg(AGG[agg](F.col(value)).alias("stat"))
            .select(*by, F.col("period.start").alias("period_start"),
                    F.col("period.end").alias("period_end"), "stat"))


def window_alarm(df: DataFrame, ts: str, value: str, agg: str, threshold: float, periods: int = 1,
                 width: str = "5 minutes", by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Periods in ALARM (W-10): the statistic is above ``threshold`` for
    ``periods`` consecutive periods. A period without data does not breach
    (it breaks a run).

    Gaps and islands: breaching periods are numbered in time order; period
    index minus that number is constant along a run of consecutive periods.
    The window runs per series (``by``) over aggregated periods, whose count
    is bounded by the time span / ``width``.
    """
    if where is not None:
        df = df.filter(where)
    stats = period_stats(df, ts, value, agg, width, by)
    step = _seconds(width)
    idx = (F.unix_timestamp("period_start") / step).cast("long")
    br = stats.filter(F.col("stat") > threshold).withColumn("_idx", idx)
    w = Window.partitionBy(*by).orderBy("_idx")
    br = br.withColumn("_grp", F.col("_idx") - F.row_number().over(w))
    wr = Window.partitionBy(*by, "_grp").orderBy("_idx")
    return (br.withColumn("consecutive", F.row_number().over(wr).cast("int"))
            .filter(F.col("consecutive") >= periods)
            .select(*by, "period_start", "period_end", F.col("stat").alias("stat_value"), "consecutive")
            .withColumn("state", F.lit("ALARM")))


def _seconds(width: str) -> int:
    n, unit = width.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(n) * mult[unit.rstrip("s")]


def error_log(df: DataFrame, ts: str, message: str, pattern: str = "ERROR", n: int = 20) -> DataFrame:
    """Newest ``n`` log lines containing ``pattern`` (P-16): a top-k, not a sort."""
    return (df.filter(F.col(message).contains(pattern))
            .orderBy(F.col(ts).desc(), *[F.col(c) for c in df.columns if c not in (ts,)])
            .limit(n))
