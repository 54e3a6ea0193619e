"""Prefix sums and carried values over hot groups equal the plain windows; the as-of join equals a plain comparison."""
import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import facts, scd, segments
from tests.conftest import rows


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small frames would be coalesced into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def hot(spark, n=2000):
    g = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("g"), F.col("id") % 40))
    return spark.range(n).select(g.alias("g"), ((F.col("id") * 37) % 2003).alias("o"), (F.col("id") % 5).alias("v"))


def test_prefix_sum_and_carry_over_slices(spark):
    df = hot(spark)
    w = Window.partitionBy("g").orderBy("o")
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert rows(segments.prefix_sum(df, ["g"], ["o"], "v", "s"), "g", "o", "s") == rows(want, "g", "o", "s")
    gaps = df.withColumn("x", F.when(F.col("v") == 4, F.col("o")))
    want = gaps.withColumn("l", F.last("x", ignorenulls=True).over(w)).na.fill(-1)
    assert rows(segments.carry_last(gaps, ["g"], ["o"], "x", "l").na.fill(-1), "g", "o", "l") == rows(want, "g", "o", "l")
    slices = segments.sliced(df, ["g"], ["o"], "t").where("g = 'HOT'").groupBy(segments.SLICE).count()
    assert slices.count() > 1 and slices.agg(F.max("count")).first()[0] < 2000 / 3
    assert segments.prefix_sum(df.limit(0), ["g"], ["o"], "v", "s").count() == 0


def test_first_time_ties_and_null_persons(spark):
    d = dt.date(2024, 1, 1)
    data = [("1", d, None), ("2", d, None), ("2", d, None), ("3", d + dt.timedelta(1), None), ("4", None, "x"), ("5", d, "x")]
    df = spark.createDataFrame(data, "id string, day date, who string")
    got = facts.first_time(df, ["who"], "day", "id")
    assert sorted((r.id, r.previous_registration_count, r.is_first_time_registration) for r in got.collect()) == [
        ("1", 0, True), ("2", 1, False), ("2", 1, False), ("3", 3, False), ("4", 0, True), ("5", 1, False)]


def test_as_of_carry_equals_comparison(spark):
    rng, t0 = random.Random(2), dt.datetime(2024, 1, 1)
    dim, facts_ = [], []
    for k in range(30):
        at = t0 + dt.timedelta(days=rng.randrange(20))
        for v in range(rng.randrange(1, 5)):
            end = at + dt.timedelta(days=rng.randrange(1, 20))
            dim.append((k, "n", v, at, None if rng.random() < 0.2 else end))
            if dim[-1][4] is None:
                break
            at = end + dt.timedelta(days=rng.choice([0, 0, 5]))
    for i in range(1500):
        k = rng.choice([7, 7, rng.randrange(33), None])
        facts_.append((i, k, "n" if rng.random() < 0.9 else None, None if rng.random() < 0.05 else t0 + dt.timedelta(days=rng.randrange(70)), "end"))
    d = spark.createDataFrame(dim, "k int, s string, v int, effective_start_dt timestamp, effective_end_dt timestamp")
    f = spark.createDataFrame(facts_, "i int, key int, sub string, at timestamp, `end` string")
    want = {}
    for i, k, s, t, _ in facts_:
        hits = [v for dk, ds, v, a, b in dim if dk == k and ds == s and t is not None and a <= t and (b is None or b > t)]
        assert len(hits) <= 1
        want[i] = hits[0] if hits else None
    got = scd.as_of_carry(f, d, {"key": "k", "sub": "s"}, "at", ["v"])
    assert got.columns == ["i", "key", "sub", "at", "end", "v"]
    assert {r.i: r.v for r in got.collect()} == want
    plain = scd.as_of_join(f, d, {"key": "k", "sub": "s"}, "at", ["v"])
    assert {r.i: r.v for r in plain.collect()} == want
