import datetime as dt
import os

from pyspark.sql import functions as F

from starforge import schemas
from starforge.operators import lookup, quality, timeintel
from starforge.sources import high_water_mark, read_table, seed_rows
from starforge.streaming import alarms_from_periods, stream_alarm

from conftest import rows

TS = "2026-01-20 20:00:00"


def test_single_checks(spark):
    df = spark.createDataFrame([("a", dt.date(1800, 1, 1)), ("a", dt.date(2020, 1, 1)), ("b", None)],
                               "id string, d date")
    r = quality.check_range(df, "d", "1900-01-01", "2030-01-01", "t", TS).first()
    assert (r["records_failed"], r["status"]) == (1, "FAIL")
    u = quality.check_unique(df, "id", "t", TS).first()
    assert (u["records_failed"], u["details"]) == (1, "duplicate_rows=2")
    n = {x["check_name"]: x["records_failed"] for x in quality.check_not_null(df, ["id", "d"], "t", TS).collect()}
    assert n == {"id_not_null": 0, "d_not_null": 1}


def test_trailing_window_and_key_of(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 1, 31),), (dt.date(2024, 3, 1),),
                                  (dt.date(2024, 4, 30),)], "day date")
    anchors = spark.createDataFrame([(dt.date(2024, 4, 30),)], "anchor date")
    got = rows(timeintel.trailing_window(days, anchors, 3), "day")
    # (add_months(2024-04-30, -3), 2024-04-30] = (2024-01-30, 2024-04-30]: start excluded
    assert got == [(dt.date(2024, 1, 31),), (dt.date(2024, 3, 1),), (dt.date(2024, 4, 30),)]
    dim = spark.createDataFrame([(1, "USA", True), (2, "CAN", False)], "k int, id string, is_active boolean")
    assert lookup.key_of(dim, (F.col("id") == "USA") & F.col("is_active"), "k").first()["k"] == 1


def test_high_water_mark_and_readers(spark, tmp_path):
    runs = spark.createDataFrame([
        ("load", "X", dt.datetime(2025, 1, 1), None, "SUCCESS", None, None, None, None, dt.date(2025, 1, 1)),
        ("load", "X", dt.datetime(2025, 1, 2), None, "FAILED", None, None, None, None, dt.date(2025, 1, 9)),
        ("load", "X", dt.datetime(2025, 1, 3), None, "SUCCESS", None, None, None, None, dt.date(2025, 1, 3))],
        schemas.ETL_CONTROL)
    assert high_water_mark(runs, "load").first()[0] == dt.date(2025, 1, 3)
    seed_rows(spark, [(1, "a")], "id int, v string").write.parquet(str(tmp_path / "t"))
    assert rows(read_table(spark, str(tmp_path / "t"))) == [(1, "a")]


def test_stream_alarm_matches_batch_rule(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    pts = [(t + dt.timedelta(minutes=m), v) for m, v in [(1, 60.0), (6, 70.0), (11, 80.0), (21, 90.0), (59, 1.0)]]
    src = tmp_path / "in"
    os.makedirs(src)
    spark.createDataFrame(pts, "ts timestamp, value double").write.parquet(str(src / "f"))
    sdf = spark.readStream.schema("ts timestamp, value double").option("recursiveFileLookup", "true") \
        .parquet(str(src))
    sink = str(tmp_path / "sink")
    stream_alarm(spark, sdf, "ts", "value", "Maximum", 50.0, 3, sink, str(tmp_path / "ck"))
    got = rows(alarms_from_periods(spark, sink, 50.0, 3), "period_start")
    assert got == [(t + dt.timedelta(minutes=10),)]


def test_bounded_broadcast_falls_back_to_a_shuffle_join(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint may broadcast
    try:
        small = lookup.lookup(fact, dim, {"k": "k"}, "v", max_rows=100)
        big = lookup.lookup(fact, dim, {"k": "k"}, "v", max_rows=10)
        plan = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert "BroadcastHashJoin" in plan(small)
        assert "BroadcastHashJoin" not in plan(big)
        assert rows(small) == rows(big)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
