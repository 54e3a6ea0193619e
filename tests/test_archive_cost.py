"""An archive run's passes: hashes added as longs, dates told by arithmetic, rows dealt before their hash."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from starforge.operators import partitions
from starforge.plans import domain, q_partitions
from starforge.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_fingerprint_is_the_exact_sum_of_hashes_without_decimals(spark, monkeypatch):
    df = spark.range(2000).select("id", F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("v"))
    want = (2000, sum(r[0] for r in df.select(F.xxhash64("id", "v")).collect()))
    plans, first = [], type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: plans.append(_plan(self)) or first(self))
    assert partitions._fingerprint(df, ["id", "v"]) == want
    assert partitions._fingerprint(df.limit(0), ["id", "v"]) == (0, 0)
    assert plans and "decimal" not in plans[0].lower()


def test_archive_tells_dates_without_parsing_texts(spark, monkeypatch):
    path = scratch_path(spark, f"archive-cost-{uuid.uuid4().hex}")
    days = [20231231, 20240131, 20240209, 20240210, 20240229, None]
    df = spark.createDataFrame([(i, str(i), d) for i, d in enumerate(days)], "k long, id string, day int")
    partitions.write_partitions(df, path, "part", partitions.month_part("day"))
    seen, write = [], partitions._write
    monkeypatch.setattr(partitions, "_write", lambda d, *a, **kw: seen.append(_plan(d)) or write(d, *a, **kw))
    partitions.archive_partitions(spark, path, "part", "day", 202402, dt.date(2024, 2, 10), f"{path}-to", "a")
    assert sorted((r["day"], r["archive_year"]) for r in spark.read.parquet(f"{path}-to").collect()) == [(20231231, 2023), (20240131, 2024), (20240209, 2024)]
    assert sorted(str(r["day"]) for r in partitions.read_partitions(spark, path).collect()) == ["20240210", "20240229", "None"]
    assert seen and not any("gettimestamp" in p.lower() or "yyyyMMdd" in p for p in seen)


def test_the_written_fact_is_dealt_before_its_hash(spark, monkeypatch):
    cols = ("compliance_id string, registration_id string, compliance_date date, due_date date, completion_date date, compliance_status string, "
            "compliance_result string, is_doj_referral boolean, source_list_type string, source_year int, state string, error_message string, "
            "source_system string, source_file_name string, dq_is_valid boolean")
    day = dt.date(1996, 5, 1)
    df = spark.createDataFrame([(str(i), "1", day, day, day, "O", "R", True, "S", 1996, "01", None, "LINEITEM", "f", True) for i in range(5)], cols)
    calendar = {"d_date": domain.d_date(spark)}
    monkeypatch.setattr(domain, "staging", lambda *a: df)
    monkeypatch.setattr(domain, "dims", lambda *a, **kw: calendar)
    seen, write = [], partitions.write_partitions
    monkeypatch.setattr(partitions, "write_partitions", lambda d, *a, **kw: seen.append(d._jdf.queryExecution().optimizedPlan().toString()) or write(d, *a, **kw))
    path = scratch_path(spark, f"dealt-{uuid.uuid4().hex}")
    monkeypatch.setattr(q_partitions, "scratch_path", lambda _spark, name: f"{path}/{name.rsplit('/', 1)[1]}")
    q_partitions.archived(spark, "", "compliance")
    below = seen[0][seen[0].index("RepartitionByExpression"):]
    assert "md5" not in below and spark.read.parquet(f"{path}/archive").where("record_hash IS NOT NULL").count() == 5
