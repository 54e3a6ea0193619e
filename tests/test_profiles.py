"""Stored profiles: merging them answers as one pass over all rows would."""
from pyspark.sql import functions as F

from starforge.operators import profiles as p


def merged(spark, df, part, **kw):
    return {r.column_name: r for r in p.merge_profiles(p.profile_partitions(df, part, **kw)).collect()}


def frame(spark):
    # one partition holds most rows, one value a third of them; NULLs and NaN in every kind of column
    return spark.range(6000).select(
        F.when(F.col("id") % 50 != 0, F.lit("hot")).when(F.col("id") % 100 == 0, F.lit("b")).alias("part"),
        F.when(F.col("id") % 3 != 0, F.col("id")).otherwise(F.lit(7)).alias("n"),
        F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("x"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("s"),
        F.lit(None).cast("string").alias("none"))


def test_merged_partitions_equal_one_pass(spark):
    df, cols = frame(spark), ["n", "x", "s", "none"]
    many, one = merged(spark, df, "part", cols=cols), merged(spark, df, F.lit("all"), cols=cols)
    exact = {r.column_name: r.distinct_count for r in p.exact_distinct(df, cols).collect()}
    for c in cols:
        a, b = many[c], one[c]
        for name in ("row_count", "null_count", "min_text", "max_text", "min_number"):
            assert a[name] == b[name]
        want = exact.get(c, 0)
        for r in (a, b):
            assert abs(r.distinct_estimate - want) <= r.distinct_error * want + 1
    assert many["none"].distinct_estimate == 0 and many["none"].quantiles is None and many["s"].quantiles is None
    assert many["s"].min_text == "v0" and many["n"].max_number == 5999 and many["n"].null_count == 0 and many["s"].null_count == 1500


def test_quantiles_lie_within_the_stated_rank_error(spark):
    df = frame(spark).select("n", "x")
    rows = p.merge_profiles(p.profile_partitions(df, F.pmod("n", F.lit(9))))
    ranks = {r.column_name: r.ranks for r in p.quantile_ranks(df, rows).collect()}
    assert set(ranks) == {"n", "x"}
    for got in ranks.values():
        for (below, upto), q in zip(got, (0.25, 0.5, 0.75), strict=True):
            assert below - p.KLL_RANK_ERROR <= q <= upto + p.KLL_RANK_ERROR


def test_empty_table_and_null_partition(spark):
    df = frame(spark)
    assert p.profile_partitions(df.limit(0), "part").count() == 0
    assert p.merge_profiles(p.profile_partitions(df.limit(0), "part")).count() == 0
    parts = {r.part_value: r.row_count for r in p.profile_partitions(df, "part", ["s"]).collect()}
    assert parts == {"hot": 5880, "b": 60, None: 60}
