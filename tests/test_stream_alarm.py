"""The alarm over micro-batches equals the batch rule, wherever the batches are cut, and a repeated epoch changes nothing."""
import datetime as dt
import random

from pyspark.sql import functions as F

from starforge.operators.monitor import window_alarm
from starforge.streaming import end_stream, keyed_alarm, marker_folder, read_alarms
from starforge.streaming.stream import advance_runs
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def test_runs_carry_over_any_cut(spark):
    rng = random.Random(4)
    data = [(s, T0 + dt.timedelta(minutes=5 * i), rng.choice([1.0, 9.0, 9.0])) for s in ("a", "b", None) for i in range(40) if rng.random() < 0.85]
    df = spark.createDataFrame(data, "s string, period_start timestamp, stat double").withColumn("period_end", F.col("period_start") + F.expr("INTERVAL 5 MINUTES"))
    want = rows(window_alarm(df, "period_start", "stat", "Sum", 5.0, 3, "5 minutes", by=["s"]).na.fill("-", ["s"]), "s", "period_start", "consecutive")
    runs, got = None, []
    for lo, hi in [(0, 7), (7, 8), (8, 8), (8, 25), (25, 40)]:
        part = df.where((F.col("period_start") >= F.lit(T0 + dt.timedelta(minutes=5 * lo))) & (F.col("period_start") < F.lit(T0 + dt.timedelta(minutes=5 * hi))))
        found, runs = advance_runs(part, runs, ["s"], 5.0, 300)
        got += rows(found.where("consecutive >= 3").na.fill("-", ["s"]), "s", "period_start", "consecutive")
        runs = spark.createDataFrame(runs.collect(), "s string, last long, run long")
    assert sorted(got) == want and want


def test_stream_without_series_restarts_and_flushes(spark, tmp_path):
    land, marks, sink, ck = (str(tmp_path / x) for x in ("in", "marks", "sink", "ck"))
    ev = [(T0 + dt.timedelta(minutes=m), 60.0) for m in (1, 6, 11, 16, 40, 46, 51)]
    schema = "at timestamp, v double"
    marker_folder(spark, marks, "at")

    def start():
        keyed_alarm(spark, spark.readStream.schema(schema).parquet(land), "at", "v", "Maximum", 50.0, 2, sink, ck, marks)

    for part in (ev[:3], ev[3:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(land)
        start()
    end_stream(spark, marks, "at", ev[-1][0])
    start()
    want = window_alarm(spark.createDataFrame(ev, schema), "at", "v", "Maximum", 50.0, 2)
    got = read_alarms(spark, sink)
    assert rows(got, "period_start", "consecutive", "state") == rows(want, "period_start", "consecutive", "state") and got.count() == 5
