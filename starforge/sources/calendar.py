"""Date series and the date dimension (S-05, D-07)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as fd


def _as_date(v) -> Column:
    if isinstance(v, Column):
        return F.to_date(v)
    if isinstance(v, (dt.date, dt.datetime)):
        v = v.isoformat()[:10]
    return F.lit(v).cast("date")


def date_series(spark: SparkSession, start, end, bounds: DataFrame | None = None,
                name: str = "date_value") -> DataFrame:
    """One row per day in ``[start, end]``.

    ``start``/``end`` are literals, or column names of the one-row ``bounds``
    frame (e.g. min/max dates aggregated from a fact), so the calendar follows
    the data without a driver round trip. The sequence is exploded from one
    row; its length is bounded by the day span (36,525 rows per century).
    """
    if bounds is None:
        base = spark.range(1).select(_as_date(start).alias("_s"), _as_date(end).alias("_e"))
    else:
        base = bounds.select(_as_date(F.col(start)).alias("_s"), _as_date(F.col(end)).alias("_e"))
    return base.select(F.explode(F.sequence("_s", "_e", F.expr("INTERVAL 1 DAY"))).alias(name))


def build_d_date(spark: SparkSession, start, end, fiscal_start: int = 10,
                 bounds: DataFrame | None = None, holidays: DataFrame | None = None) -> DataFrame:
    """Date dimension (D-07): keys, calendar parts, names, weekend and fiscal fields.

    ``holidays`` (one ``date_value`` column) sets ``is_holiday`` through a
    left join; without it the flag is false, as in the reference seed (F-10).
    """
    d = F.col("date_value")
    days = date_series(spark, start, end, bounds)
    out = days.select(
        fd.date_key(d).alias("date_key"),
        d.alias("date_value"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        fd.month_name(d).alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        fd.day_of_week0(d).alias("day_of_week"),
        fd.day_name(d).alias("day_name"),
        fd.is_weekend(d).alias("is_weekend"),
        fd.fiscal_year(d, fiscal_start).alias("fiscal_year"),
        fd.fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
    )
    if holidays is None:
        out = out.withColumn("is_holiday", F.lit(False))
    else:
        h = holidays.select(F.to_date("date_value").alias("date_value")).distinct() \
            .withColumn("is_holiday", F.lit(True))
        out = out.join(F.broadcast(h), "date_value", "left") \
            .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    return out.select("date_key", "date_value", "year", "quarter", "month", "month_name",
                      "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend",
                      "is_holiday", "fiscal_year", "fiscal_quarter")


def month_spine(spark: SparkSession, start, end, bounds: DataFrame | None = None) -> DataFrame:
    """Dense list of month starts between two dates (for growth / lag measures)."""
    if bounds is None:
        base = spark.range(1).select(_as_date(start).alias("_s"), _as_date(end).alias("_e"))
    else:
        base = bounds.select(_as_date(F.col(start)).alias("_s"), _as_date(F.col(end)).alias("_e"))
    return base.select(F.explode(F.sequence(F.trunc("_s", "month"), F.trunc("_e", "month"),
                                            F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
