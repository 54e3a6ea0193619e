"""Surrogate key assignment (W-08) without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def assign_keys(df: DataFrame, key: str, order: Sequence, start=0,
                checkpoint: bool = True) -> DataFrame:
    """Dense keys ``start+1, start+2, ...`` following ``order`` (like IDENTITY).

    The rows are range-partitioned and sorted inside each partition, so every
    partition holds a contiguous slice of the order. Each row gets its local
    position from ``monotonically_increasing_id`` (partition id in the high
    bits, position in the low bits); a per-partition count (one row per
    partition, a bounded frame) gives each partition its offset. No step puts
    all rows in one task. ``order`` must be a total order (unique) for keys to
    be reproducible. ``start`` may be a literal or a Column (e.g. from a
    one-row ``max(key)`` frame joined in by the caller).

    The numbered frame is written once (Parquet in the shared checkpoint
    folder) so the per-partition counts and the keyed rows read the same ids,
    even if a task is retried on another executor.
    """
    cols = _order_cols(order)
    numbered = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                .withColumn("_sf_mid", F.monotonically_increasing_id()))
    if checkpoint:
        numbered = materialize(numbered, f"keys-{key}")
    numbered = (numbered.withColumn("_sf_pid", F.shiftright("_sf_mid", _LOCAL_BITS))
                .withColumn("_sf_pos", F.col("_sf_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    per_part = numbered.groupBy("_sf_pid").agg(F.count(F.lit(1)).alias("_sf_n"))
    # one row per partition: a global window here is bounded by the partition count
    offsets = per_part.select(
        "_sf_pid",
        F.coalesce(F.sum("_sf_n").over(Window.orderBy("_sf_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_sf_off"))
    start_c = start if isinstance(start, Column) else F.lit(start)
    return (numbered.join(F.broadcast(offsets), "_sf_pid")
            .withColumn(key, (start_c + F.col("_sf_off") + F.col("_sf_pos") + 1).cast("long"))
            .drop("_sf_mid", "_sf_pid", "_sf_pos", "_sf_off"))


def small_keys(df: DataFrame, key: str, order: Sequence, start=0) -> DataFrame:
    """Row-number keys for a dimension whose size is bounded by construction
    (a code list, a calendar, a seed). One window over the whole frame."""
    start_c = start if isinstance(start, Column) else F.lit(start)
    return df.withColumn(key, (start_c + F.row_number().over(Window.orderBy(*_order_cols(order))))
                         .cast("long"))
