"""Enrichment by levels of geography: zipcode, else county, else state (J-18).

Reference rows come in vintages (a census year). The row that counts is the
latest one per key under a total order, so ties on the year don't pick any row.
Tracts add up to zipcodes and counties to states: populations are summed, medians
averaged by population in whole hundredths, so the result doesn't depend on the
order of rows.

Defined results: a zipcode without rows takes its county's, else its state's, else
NULLs with level NULL; a key column that is NULL matches nothing; areas without
population or without a value keep out of the average; repeated reference rows count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import bounded_broadcast


def latest_vintage(ref: DataFrame, on: Sequence[str], year: str) -> DataFrame:
    """One row per key: the latest ``year``, ties by the remaining columns from
    the left, largest first and NULL last. Combined map-side."""
    rest = [c for c in ref.columns if c not in on and c != year]
    row = F.struct(year, *rest)
    return ref.groupBy(*on).agg(F.max(row).alias("_v")).select(*on, "_v.*")


def weighted(value: str, weight: str) -> Column:
    """Average of a DECIMAL(n,2) column by weight, cut to whole hundredths."""
    ok = F.col(value).isNotNull() & (F.col(weight) > 0)
    cents = F.when(ok, (F.col(value) * 100).cast("decimal(14,0)") * F.col(weight).cast("decimal(12,0)"))
    whole = F.floor(F.sum(cents) / F.sum(F.when(ok, F.col(weight).cast("decimal(20,0)"))))
    return (whole.cast("decimal(16,0)") / 100).cast("decimal(12,2)")


def roll_up(ref: DataFrame, on: Sequence[str], year: str, population: str, medians: Sequence[str]) -> DataFrame:
    """Areas added up to the area that ``on`` names, with the latest year among them."""
    ref = ref.dropna(subset=list(on))
    return ref.groupBy(*on).agg(F.max(year).alias(year), F.sum(F.col(population).cast("long")).alias(population), *[weighted(m, population).alias(m) for m in medians])


def enrich_levels(df: DataFrame, levels: Sequence[tuple[str, DataFrame, Sequence[str]]], cols: Sequence[str], level: str = "level",
                  broadcast: bool | None = None) -> DataFrame:
    """``cols`` of the first level that has a row for the row's keys, whole rows
    only (no mixing of levels), and that level's name. ``levels`` are (name,
    reference with one row per key, key columns), nearest first."""
    out, found = df, []
    for i, (name, ref, on) in enumerate(levels):
        small = ref.select(*[F.col(c).alias(f"_k{i}_{c}") for c in on], F.struct(F.lit(name).alias(level), *cols).alias(f"_level{i}"))
        same = [F.col(c) == F.col(f"_k{i}_{c}") for c in on]
        out = out.join(bounded_broadcast(small, broadcast=broadcast), same, "left").drop(*[f"_k{i}_{c}" for c in on])
        found.append(f"_level{i}")
    return out.withColumn("_level", F.coalesce(*found)).select(*df.columns, *[F.col(f"_level.{c}").alias(c) for c in (*cols, level)])
