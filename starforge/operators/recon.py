"""Reconciliation across layers (A-21) and orphan summaries (J-12)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .measures import table_counts


def reconcile(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts per layer in load order with the difference to the previous
    layer (source → staging → valid → warehouse). One count job per layer
    runs as part of a single union plan."""
    counts = table_counts(layers, name="layer")
    order = {name: i for i, name in enumerate(layers)}
    pos = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    counts = counts.withColumn("layer_no", pos[F.col("layer")].cast("int"))
    prev = counts.select((F.col("layer_no") + 1).alias("layer_no"), F.col("row_count").alias("previous_count"))
    return (counts.join(prev, "layer_no", "left")
            .withColumn("difference", (F.col("row_count") - F.col("previous_count")).cast("long"))
            .select("layer_no", "layer", F.col("row_count").cast("long"),
                    F.col("previous_count").cast("long"), "difference"))


def orphan_count(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows, rows with a non-NULL key and orphans, as one row."""
    keys = dim.select(F.col(pk).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    j = fact.select(fk).join(keys, F.col(fk) == F.col("_pk"), "left")
    return j.agg(F.count(F.lit(1)).alias("row_count"),
                 F.count(F.col(fk)).alias("with_key"),
                 F.count_if(F.col(fk).isNotNull() & F.col("_hit").isNull()).alias("orphans"))
