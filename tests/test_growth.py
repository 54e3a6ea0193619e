"""Steps whose driver, broadcast and shuffle volume must not grow with the rows."""

from pyspark.sql import functions as F

from starforge.operators import scd, segments


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scd2_joins_are_not_broadcast(spark):
    dim = spark.sql("SELECT 1L AS part_key, 1L AS k, 'a' AS v, TIMESTAMP '1990-01-01' AS effective_start_dt, CAST(NULL AS TIMESTAMP) AS effective_end_dt, TRUE AS is_active")
    out = scd.scd2_apply(spark.sql("SELECT * FROM VALUES (1L, 'b'), (2L, 'c') AS t(k, v)"), dim, ["k"], ["v"], "part_key", "2000-01-01 00:00:00")
    got = sorted((r["part_key"], r["k"], r["v"], r["is_active"]) for r in out.collect())
    assert got == [(1, 1, "a", False), (2, 1, "b", True), (3, 2, "c", True)]
    diff = scd.scd2_diff_frame(spark.sql("SELECT * FROM VALUES (1L, 'b') AS t(k, v)"), dim, ["k"], ["v"], "part_key", "2000-01-01 00:00:00")
    assert "BroadcastHashJoin" not in _plan(diff)


def test_only_groups_cut_by_a_slice_are_carried(spark):
    df = spark.range(2000).select((F.col("id") / 2).cast("long").alias("g"), "id", F.lit(1).alias("v"))
    rows = segments.sliced(df, ["g"], ["id"], "growth")
    slices = rows.select(segments.SLICE).distinct().count()
    per = segments._carried(rows, ["g"], F.sum("v"), F.sum, "c")
    assert per.select("g").distinct().count() <= slices
    sums = segments.prefix_sum(df, ["g"], ["id"], "v", "s")
    assert sums.count() == 2000 and sums.where(F.col("s") != F.col("id") % 2).count() == 0
