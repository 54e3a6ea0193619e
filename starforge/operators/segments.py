"""Ordered work inside groups that no group can skew: running sums and last known values.

Rows are range-partitioned by group and order, so a group with a third of all
rows spans a third of the partitions ("slices"). What a slice needs from the
slices before it is one row per slice and group; a window over that small
frame gives each slice its carry. Row-level windows run per slice and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .keys import _LOCAL_BITS

SLICE, AT = "_sg_slice", "_sg_at"


def sliced(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` written once in the order of (group, order), with the slice of each
    row and a number that ascends in it. Group columns must not be null."""
    by = [*group, *order]
    rows = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id()), name)
    return rows.withColumn(SLICE, F.shiftright(AT, _LOCAL_BITS))


def _carried(rows: DataFrame, group: Sequence[str], own: Column, carry, out: str) -> DataFrame:
    """Per slice and group ``carry(window)`` over the earlier slices' ``own``, for
    the groups that go on from one slice into the next: a group in several slices
    begins all of them but its first, so there are fewer of them than slices."""
    first = rows.groupBy(SLICE).agg(F.min_by(F.struct(*group), F.col(AT)).alias("_sg_first"))
    cut = F.broadcast(first.select("_sg_first.*").distinct())
    per = rows.join(cut, list(group), "left_semi").groupBy(SLICE, *group).agg(own.alias("_sg_own"))
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn(out, carry(F.col("_sg_own")).over(earlier)).drop("_sg_own")


def prefix_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, name: str = "prefix") -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the group before this one."""
    rows = sliced(df, group, order, name)
    local = F.sum(value).over(Window.partitionBy(SLICE, *group).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1))
    offsets = _carried(rows, group, F.sum(value), F.sum, "_sg_carry")
    return (rows.withColumn("_sg_local", local).join(F.broadcast(offsets), [SLICE, *group], "left")
            .withColumn(out, F.coalesce("_sg_local", F.lit(0)) + F.coalesce("_sg_carry", F.lit(0))).drop(SLICE, AT, "_sg_local", "_sg_carry"))


def carry_last(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, name: str = "carry") -> DataFrame:
    """``out``: the last non-null ``value`` of the group up to this row."""
    rows = sliced(df, group, order, name)
    local = F.last(value, ignorenulls=True).over(Window.partitionBy(SLICE, *group).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0))
    newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(AT)))
    lasts = _carried(rows, group, newest, lambda c: F.last(c, ignorenulls=True), "_sg_carry")
    return (rows.withColumn("_sg_local", local).join(F.broadcast(lasts), [SLICE, *group], "left")
            .withColumn(out, F.coalesce("_sg_local", "_sg_carry")).drop(SLICE, AT, "_sg_local", "_sg_carry"))
