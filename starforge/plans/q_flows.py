"""Registered queries: landed CSV to facts, holidays, keyed updates, catalog tables, run times and streamed upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import lookup, runlog, tables
from ..operators.staging import fill_missing
from ..session import materialize, scratch_path
from ..sources.calendar import build_d_date, date_series
from ..sources.files import csv_to_parquet, read_raw
from ..streaming import stream
from . import domain
from .catalog import query
from .oracle import with_ctes

HOLIDAYS = ["01-01", "07-04", "12-25"]  # month and day
CSV = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
                    T.StructField("o_orderdate", T.DateType()), T.StructField("o_comment", T.StringType())])


def _orders(spark, sf):
    return domain.table(spark, sf, "orders")


def _folder(spark, name):
    return scratch_path(spark, f"flows/{name}-{uuid.uuid4().hex}")


@query("csv_landing", "S-01 S-02 F-17 P-14 A-03", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, trim(o_orderpriority) AS priority, 'none' AS note, o_orderstatus AS status, count(*) AS orders, max(o_orderkey) AS last_order
FROM orders GROUP BY 1, 2, 4""")
def csv_landing(spark, sf):
    """Orders landed as CSV by year, converted to dated Parquet folders, read as
    one tree; padded text is trimmed and the empty note filled."""
    landed, raw = _folder(spark, "csv"), _folder(spark, "raw")
    rows = _orders(spark, sf).select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"),
                                     F.concat(F.lit("  "), "o_orderpriority", F.lit("  ")).alias("o_comment"), F.year("o_orderdate").alias("y"))
    rows.write.partitionBy("y").option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(landed)
    for r in rows.select("y").distinct().orderBy("y").collect():  # a few years
        csv_to_parquet(spark, f"{landed}/y={r.y}", f"{raw}/orders/{r.y}/01/01", CSV)
    read = fill_missing(read_raw(spark, raw, "orders", CSV).withColumn("o_comment", F.trim("o_comment")).withColumn("note", F.lit(None).cast("string")), {"note": "none"})
    return (read.groupBy(F.year("o_orderdate").alias("year"), F.col("o_comment").alias("priority"), "note", F.col("o_orderstatus").alias("status"))
            .agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last_order")))


@query("holiday_orders", "F-10 D-07 J-11", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%m-%d') IN ({', '.join(f"'{h}'" for h in HOLIDAYS)}) AS is_holiday, count(*) AS orders FROM orders GROUP BY 1, 2""")
def holiday_orders(spark, sf):
    """Orders on and off holidays per year, over a calendar built with its holiday list."""
    days = date_series(spark, domain.CALENDAR_START, domain.CALENDAR_END)
    holidays = days.where(F.date_format("date_value", "MM-dd").isin(HOLIDAYS))
    cal = build_d_date(spark, domain.CALENDAR_START, domain.CALENDAR_END, holidays=holidays).select("date_value", "is_holiday")
    o = _orders(spark, sf).select(F.to_date("o_orderdate").alias("date_value"))
    return (o.join(F.broadcast(cal), "date_value").groupBy(F.year("date_value").alias("year"), "is_holiday").agg(F.count(F.lit(1)).alias("orders")))


@query("hold_orders", "K-03 J-09", """
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'H' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def hold_orders(spark, sf):
    """Orders of customers in debt are put on hold: an update by a set of keys."""
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus")
    keys = domain.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return tables.update_by_keys(o, keys, ["o_custkey"], {"o_orderstatus": F.lit("H")}).select("o_orderkey", "o_orderstatus")


@query("key_of_status", "J-19", with_ctes("d_code") + """
SELECT code_key, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS orders FROM d_code WHERE code_id = 'REG_STATUS_F'""")
def key_of_status(spark, sf):
    """The code key of one status by scalar lookup, with the number of its orders."""
    key = lookup.key_of(domain.d_code(spark, sf), F.col("code_id") == "REG_STATUS_F", "code_key")
    n = _orders(spark, sf).where("o_orderstatus = 'F'").agg(F.count(F.lit(1)).alias("orders"))
    return key.select(F.col("code_key").cast("long").alias("code_key"), n.scalar().alias("orders"))


@query("catalog_tables", "K-07 K-08 P-17", """
SELECT 'f_orders' AS table_name, 'fact' AS table_kind, CAST(year(o_orderdate) AS INTEGER) AS part, count(*) AS row_count FROM orders GROUP BY 3
UNION ALL SELECT 'd_customers', 'dimension', CAST(NULL AS INTEGER), (SELECT count(*) FROM customer)""")
def catalog_tables(spark, sf):
    """A partitioned folder registered as an external table, a table made by a
    select and filled by an insert; counted through the catalog, then dropped from it."""
    run = uuid.uuid4().hex[:8]
    fact, dim = f"f_orders_{run}", f"d_customers_{run}"
    folder, kept = _folder(spark, "external"), _folder(spark, "made")
    _orders(spark, sf).select("o_orderkey", F.year("o_orderdate").alias("part")).write.partitionBy("part").parquet(folder)
    people = domain.table(spark, sf, "customer").select("c_custkey", "c_name")
    try:
        ext = tables.register_external(spark, fact, folder, ["part"])
        tables.create_table_as(people.where("c_custkey % 2 = 0"), dim, kept)
        tables.insert_into(people.where("c_custkey % 2 <> 0"), dim)
        kinds = tables.list_tables(spark, spark.catalog.currentDatabase()).where(F.col("table_name").isin(fact, dim))
        counts = (ext.groupBy("part").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(fact))
                  .unionByName(spark.table(dim).agg(F.count(F.lit(1)).alias("row_count")).withColumn("part", F.lit(None).cast("int")).withColumn("table_name", F.lit(dim))))
        out = materialize(counts.join(F.broadcast(kinds), "table_name"), "catalog-tables")  # a row per partition
    finally:
        for name in (fact, dim):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out.select(F.expr(f"left(table_name, length(table_name) - {len(run) + 1})").alias("table_name"), "table_kind", F.col("part").cast("int").alias("part"), "row_count")


@query("slowest_runs", "T-06 T-02", """
SELECT 'load_' || strftime(ts, '%Y%m%d') AS job_name, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS duration_seconds, count(*) AS records_read
FROM events GROUP BY 1 ORDER BY 2 DESC, min(ts) DESC, 1 LIMIT 10""")
def slowest_runs(spark, sf):
    """The ten longest runs of a run log that holds one run per day of events, from its first to its last event."""
    day = F.concat(F.lit("load_"), F.date_format("ts", "yyyyMMdd"))
    log = (domain.table(spark, sf, "events").groupBy(day.alias("job_name"))
           .agg(F.min("ts").cast("timestamp").alias("start_timestamp"), F.max("ts").cast("timestamp").alias("end_timestamp"), F.count(F.lit(1)).alias("records_read")))
    return runlog.slowest(log, 10).select("job_name", "duration_seconds", "records_read")


@query("stream_upsert", "R-03 K-05 K-01", """
SELECT o_orderkey, o_orderstatus FROM orders""")
def stream_upsert(spark, sf):
    """An order table loaded while every order was open, then brought up to date
    by a stream of the order files; each micro-batch writes the next version, and a
    repeated one the same rows again."""
    target = tables.VersionedTable(spark, _folder(spark, "streamed"))
    o = _orders(spark, sf)
    target.write(o.where("o_orderdate < TIMESTAMP '1997-01-01'").select("o_orderkey", F.lit("O").alias("o_orderstatus")))

    def apply(batch, epoch):
        target.write(tables.upsert(target.read(), batch.select("o_orderkey", "o_orderstatus"), ["o_orderkey"]))

    sdf = spark.readStream.schema(o.schema).parquet(stream.table_source(sf, "orders"))
    stream.stream_upsert(sdf, apply, _folder(spark, "upsert-checkpoint"))
    return target.read()

