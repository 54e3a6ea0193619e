"""Connected components over edges, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge (a, b); component is the
    smallest id reachable. Every round takes the least label of the neighbours
    and then the label's own label, so paths shorten as labels spread; a hub's
    edges are combined before they are shuffled."""
    both = materialize(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = (both.join(label.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m")))
        hooked = label.join(near, label["id"] == near["a"]).select("id", F.least("component", "m").alias("to"), F.col("component").alias("was"))
        root = label.select(F.col("id").alias("to"), F.col("component").alias("up"))
        step = materialize(hooked.join(root, "to", "left").select("id", F.least("to", F.coalesce("up", "to")).alias("component"), "was"), "labels")
        label = step.select("id", "component")
        if not step.where("component != was").limit(1).count():
            return label


def merged(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) after more edges: components of the known components'
    own ids, so that only what is new is worked on."""
    name = known.select(F.col("id").alias("_id"), F.col("component").alias("_c"))
    ends = edges
    for side in "ab":
        ends = ends.join(name, F.col(side) == F.col("_id"), "left").withColumn(side, F.coalesce("_c", side)).drop("_id", "_c")
    top = components(ends.where("a != b").distinct()).select(F.col("id").alias("_id"), F.col("component").alias("_c"))
    old = known.join(top, F.col("component") == F.col("_id"), "left").select("id", F.coalesce("_c", "component").alias("component"))
    new = top.join(known, F.col("_id") == known["id"], "left_anti").select(F.col("_id").alias("id"), F.col("_c").alias("component"))
    return old.unionAll(new)
