"""Time intelligence: YTD, growth, same period last year, moving average (W-02..W-06, J-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import divide


def monthly(df: DataFrame, date_col: str, value: str | None = None, dense: bool = True) -> DataFrame:
    """Monthly totals (row count, or sum of ``value``) on a dense month spine.

    The spine runs from the first to the last month with data; months without
    rows get 0, so lag-based measures compare calendar neighbours. Its length
    is the number of months spanned (bounded by the calendar, not the data).
    """
    m = F.trunc(F.to_date(date_col), "month")
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    totals = df.groupBy(m.alias("month_start")).agg(agg.alias("total"))
    if not dense:
        return totals
    b = totals.agg(F.min("month_start").alias("s"), F.max("month_start").alias("e"))
    spine = b.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return (spine.join(totals, "month_start", "left")
            .withColumn("total", F.coalesce("total", F.lit(0)).cast("long")))


def _series_window():
    # one global order over months: the series length is bounded by the calendar span
    return Window.orderBy("month_start")


def ytd(monthly_df: DataFrame) -> DataFrame:
    """Year-to-date running total per calendar year (W-02)."""
    w = Window.partitionBy(F.year("month_start")).orderBy("month_start") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly_df.withColumn("ytd_total", F.sum("total").over(w).cast("long"))


def growth(monthly_df: DataFrame, periods: int = 1, name: str = "growth") -> DataFrame:
    """(current − previous) / previous over ``periods`` months, 0 when the
    previous is 0 or missing (W-03). Needs the dense spine."""
    prev = F.lag("total", periods).over(_series_window())
    return (monthly_df.withColumn("previous_total", prev.cast("long"))
            .withColumn(name, F.round(divide(F.col("total") - F.col("previous_total"),
                                             F.col("previous_total")), 4).cast("decimal(12,4)")))


def same_period_last_year(monthly_df: DataFrame) -> DataFrame:
    """Total of the same month one year earlier (W-04).

    On the dense spine of :func:`monthly` the month twelve rows back is the
    same calendar month a year earlier, so ``lag(12)`` finds it in one pass
    (no self join, which would plan the whole input twice). The lagged month
    is checked, so a frame without the dense spine still gets NULL, not a
    wrong month.
    """
    w = _series_window()
    lag_m = F.lag("month_start", 12).over(w)
    lag_t = F.lag("total", 12).over(w)
    same = lag_m == F.add_months("month_start", -12)
    return monthly_df.withColumn("last_year_total", F.when(same, lag_t).cast("long"))


def yoy(monthly_df: DataFrame) -> DataFrame:
    """Year-over-year growth (W-05) from :func:`same_period_last_year`."""
    s = same_period_last_year(monthly_df)
    return s.withColumn("yoy_growth", F.round(divide(F.col("total") - F.col("last_year_total"),
                                                     F.col("last_year_total")), 4).cast("decimal(12,4)"))


def moving_average(df: DataFrame, date_col: str, months: int = 3) -> DataFrame:
    """Moving average over days, evaluated at each month end (W-06, J-20).

    For the month ending on ``last``: the days in ``(add_months(last, -months), last]``;
    the total of rows on those days divided by the number of days that have
    at least one row (days without rows are skipped, as an average over days
    with a blank measure is).

    The range join is written as a bounded explode: a day can only fall in
    the windows of its own month end and the next ``months`` month ends, so
    each daily total is copied to those candidates and filtered by the exact
    bound. No inequality join, no single task.
    """
    d = F.to_date(date_col)
    daily = df.groupBy(d.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    # over the days, whose number the calendar bounds; the rows are read once
    daily = daily.withColumn("last", F.last_day(F.max("day").over(Window.partitionBy())))
    cand = daily.select("day", "n", "last", F.explode(F.sequence(F.lit(0), F.lit(months))).alias("k")) \
        .withColumn("anchor", F.last_day(F.add_months("day", F.col("k"))))
    inwin = cand.filter((F.col("day") > F.add_months("anchor", -months)) & (F.col("anchor") <= F.col("last")))
    return (inwin.groupBy("anchor")
            .agg(F.sum("n").alias("window_total"), F.count(F.lit(1)).alias("days_with_rows"))
            .select(F.trunc("anchor", "month").alias("month_start"), F.col("anchor").alias("month_end"),
                    F.col("window_total").cast("long"), F.col("days_with_rows").cast("long"),
                    F.round(F.col("window_total") / F.col("days_with_rows"), 4)
                    .cast("decimal(18,4)").alias("moving_avg")))


def trailing_window(days: DataFrame, anchors: DataFrame, months: int = 3) -> DataFrame:
    """Pairs (anchor, day) with ``add_months(anchor, -months) < day <= anchor``
    (J-20), for small calendars: anchors are broadcast and the range is a join
    condition on a month-bounded candidate set."""
    a = anchors.select(F.col("anchor"))
    cand = days.withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(months)))) \
        .withColumn("anchor", F.last_day(F.add_months("day", F.col("_m")))).drop("_m")
    return cand.join(F.broadcast(a), "anchor").filter(F.col("day") > F.add_months("anchor", -months))
