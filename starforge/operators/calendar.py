"""Filters on calendar attributes as ranges of date keys (P-09).

The days that pass a filter on the calendar are turned into runs of consecutive
days. A fact is then filtered by its own date key (a pushed range) and, if it is
partitioned by the date, by its partition column too, so files outside the slice
are never listed for reading. Filters with many short runs (weekends over a
century) become a semi-join with the passing days, which prunes partitions
dynamically.

Defined results: rows without a date or with one outside the calendar never
pass; a filter that no day passes gives an empty fact; a NULL attribute is a
day that doesn't pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Runs of days written as ranges into the filter; with more, a semi-join takes their place.
MAX_RANGES = 64


def day_runs(d_date: DataFrame, where: Column | str) -> DataFrame:
    """(first_key, last_key): maximal runs of consecutive days that pass ``where``.

    The window runs over days of the calendar, a table the date span bounds.
    """
    days = d_date.where(where).select("date_key", "date_value").distinct()
    island = F.date_sub("date_value", F.row_number().over(Window.orderBy("date_value")))
    return days.withColumn("_run", island).groupBy("_run").agg(F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key")).drop("_run")


def in_calendar(fact: DataFrame, d_date: DataFrame, where: Column | str, key: str,
                part: str | None = None, part_of: Callable[[str], Column] | None = None, max_ranges: int = MAX_RANGES) -> DataFrame:
    """Fact rows whose date ``key`` is a day of the calendar that passes ``where``.

    ``part`` names the fact's partition column and ``part_of`` the increasing
    function of the key that made it (``partitions.month_part``).
    """
    runs = day_runs(d_date, where)
    rows = runs.orderBy("first_key").limit(max_ranges + 1).collect()  # no more than max_ranges + 1 pairs of keys
    if len(rows) <= max_ranges:
        keep = F.lit(False)
        for r in rows:
            keep = keep | F.col(key).between(r.first_key, r.last_key)
        if part is not None and rows:
            ends = _part_ends(runs, part_of)
            inside = F.lit(False)
            for lo, hi in ends:
                inside = inside | F.col(part).between(lo, hi)
            keep = keep & inside
        return fact.where(keep)
    days = d_date.where(where).select(F.col("date_key").alias("_ic_key")).distinct()
    out = fact
    if part is not None:
        parts = days.select(part_of("_ic_key").alias("_ic_part")).distinct()
        out = out.join(F.broadcast(parts), F.col(part) == F.col("_ic_part"), "left_semi")
    return out.join(F.broadcast(days), F.col(key) == F.col("_ic_key"), "left_semi")  # days of one calendar


def _part_ends(runs: DataFrame, part_of: Callable[[str], Column]) -> list[tuple[int, int]]:
    rows = runs.select(part_of("first_key").alias("lo"), part_of("last_key").alias("hi")).distinct().orderBy("lo", "hi").collect()
    return [(r.lo, r.hi) for r in rows]


def last_months(as_of: Column, months: int = 12) -> Column:
    """Calendar days of the ``months`` whole months that end with the one of ``as_of``."""
    start = F.add_months(F.trunc(as_of, "month"), 1 - months)
    return (F.col("date_value") >= start) & (F.col("date_value") <= F.last_day(as_of))
