"""Registered queries: metric alarms, error log, recency, enrichment, streaming ingest and windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.predicates import since
from ..operators import lookup, monitor
from ..session import scratch_path
from ..streaming import stream
from . import domain
from .catalog import REGISTRY, query

ALARM_THRESHOLD, ALARM_PERIODS = 100.0, 2


@query("window_alarm", "W-10 A-08", f"""
WITH w AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, sum(value) AS stat
           FROM events GROUP BY 1, 2),
b AS (SELECT *, CAST(epoch(period_start) / 300 AS BIGINT) AS idx FROM w WHERE stat > {ALARM_THRESHOLD}),
g AS (SELECT *, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS grp FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, grp ORDER BY idx) AS consecutive FROM g)
SELECT event_type, period_start, period_start + INTERVAL 5 MINUTE AS period_end, round(stat, 4) AS stat_value,
       CAST(consecutive AS INTEGER) AS consecutive, 'ALARM' AS state
FROM r WHERE consecutive >= {ALARM_PERIODS}""")
def window_alarm(spark, sf):
    """Per event type: 5-minute sums above the threshold for two periods in a row."""
    e = domain.table(spark, sf, "events")
    out = monitor.window_alarm(e, "ts", "value", "Sum", ALARM_THRESHOLD, ALARM_PERIODS, "5 minutes",
                               by=["event_type"])
    return out.withColumn("stat_value", F.round("stat_value", 4))


@query("error_log", "P-16 T-01", """
SELECT event_id, ts, event_type, value FROM events WHERE contains(event_type, 'error')
ORDER BY ts DESC, event_id LIMIT 20""")
def error_log(spark, sf):
    """The 20 newest error entries."""
    e = domain.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return monitor.error_log(e, "ts", "event_type", "error", 20)


@query("recent_events", "P-10 A-03", """
SELECT event_type, CAST(count(*) AS BIGINT) AS event_count FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1""")
def recent_events(spark, sf):
    """Events of the last day before the newest event, per type."""
    e = domain.table(spark, sf, "events")
    as_of = e.agg(F.max("ts")).scalar()
    return e.filter(since("ts", as_of, "1 day")).groupBy("event_type") \
        .agg(F.count(F.lit(1)).alias("event_count"))


@query("enrich_zipcodes", "J-18 T-04", """
WITH ref AS (SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS state_code,
                    CAST(year(l.l_shipdate) AS INTEGER) AS stats_year,
                    CAST(count(DISTINCT l.l_suppkey) AS BIGINT) AS active_suppliers
             FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2),
latest AS (SELECT * FROM ref QUALIFY row_number() OVER (PARTITION BY state_code ORDER BY stats_year DESC) = 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS zipcode, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS state_code,
       l.stats_year, l.active_suppliers
FROM customer c LEFT JOIN latest l ON l.state_code = lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')""")
def enrich_zipcodes(spark, sf):
    """Zipcodes enriched with the latest year of supplier activity in their state."""
    li = domain.table(spark, sf, "lineitem")
    s = domain.table(spark, sf, "supplier")
    ref = (li.join(s, li.l_suppkey == s.s_suppkey)
           .groupBy(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("state_code"),
                    F.year("l_shipdate").alias("stats_year"))
           .agg(F.count_distinct("l_suppkey").alias("active_suppliers")))
    c = domain.table(spark, sf, "customer")
    base = c.select(F.col("c_custkey").cast("string").alias("zipcode"),
                    F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code"))
    return lookup.enrich(base, ref, ["state_code"], year="stats_year") \
        .select("zipcode", "state_code", "stats_year", "active_suppliers")


# ------------------------------------------------------------------ streaming

@query("stream_ingest", "R-01 S-08 S-01", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS row_count FROM orders GROUP BY 1""")
def stream_ingest(spark, sf):
    """Landed order files ingested once through a file stream (checkpointed),
    then counted from the sink."""
    run = uuid.uuid4().hex
    src = stream.table_source(sf, "orders")
    dst = scratch_path(spark, f"stream_ingest/{run}/out")
    ck = scratch_path(spark, f"stream_ingest/{run}/checkpoint")
    schema = domain.table(spark, sf, "orders").schema
    stream.ingest_new_files(spark, src, dst, ck, schema,
                            transform=lambda d: d.select("o_orderkey", "o_orderstatus"))
    return spark.read.parquet(dst).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("stream_window", "R-02 W-10", """
WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events),
w AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, sum(value) AS stat
      FROM events GROUP BY 1, 2)
SELECT event_type, period_start, period_start + INTERVAL 5 MINUTE AS period_end, round(stat, 4) AS stat
FROM w WHERE period_start + INTERVAL 5 MINUTE <= (SELECT wm FROM m)""")
def stream_window(spark, sf):
    """5-minute sums per event type from a stream with a 10-minute late-data bound;
    windows are emitted once the watermark passes them."""
    run = uuid.uuid4().hex
    src = stream.table_source(sf, "events")
    sink = scratch_path(spark, f"stream_window/{run}/sink")
    ck = scratch_path(spark, f"stream_window/{run}/checkpoint")
    e = domain.table(spark, sf, "events")
    sdf = spark.readStream.schema(e.schema).parquet(src)
    stream.stream_alarm(spark, sdf, "ts", "value", "Sum", ALARM_THRESHOLD, ALARM_PERIODS, sink, ck,
                        by=["event_type"])
    # a batch without a finished window writes an empty file, so the folder exists
    periods = spark.read.parquet(f"{sink}/periods")
    return periods.select("event_type", "period_start", "period_end", F.round("stat", 4).alias("stat"))


LANDINGS = 3


@query("stream_alarm", "R-02 W-10", REGISTRY["window_alarm"][1])
def stream_alarm(spark, sf):
    """The alarm of ``window_alarm`` from a stream: events land in three spans of
    time, the query is started anew for each, continues from its state, and an
    end marker flushes the windows still open."""
    run = uuid.uuid4().hex
    land, marks, sink, ck = (scratch_path(spark, f"stream_alarm/{run}/{x}") for x in ("landing", "markers", "alarms", "checkpoint"))
    e = domain.table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    stream.marker_folder(spark, marks, "ts")
    span = F.least(F.floor((F.col("ts").cast("double") - F.lit(lo).cast("double"))
                           / (F.lit(hi).cast("double") - F.lit(lo).cast("double") + 1) * LANDINGS), F.lit(LANDINGS - 1))

    def start():
        sdf = spark.readStream.schema(e.schema).parquet(land)
        stream.keyed_alarm(spark, sdf, "ts", "value", "Sum", ALARM_THRESHOLD, ALARM_PERIODS, sink, ck, marks, by=["event_type"])

    for k in range(LANDINGS):
        e.where(span == k).write.mode("append").parquet(land)
        start()
    stream.end_stream(spark, marks, "ts", hi)
    start()
    return stream.read_alarms(spark, sink).withColumn("stat_value", F.round("stat_value", 4))
