"""A load's shuffles: each is taken once, on narrow rows, and none sorts the rows before it."""

import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from starforge.functions.hashing import packed, unpacked
from starforge.operators import partitions
from starforge.operators.facts import build_fact
from starforge.plans import domain, q_partitions
from starforge.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _staging(spark, n=40):
    day = dt.date(1999, 12, 1)
    rows = [(f"{i % 30}-1" if i % 10 else None, f"{i % 30}", day + dt.timedelta(i), "O", "R", "01", "LINEITEM", "lineitem_19991201.parquet", True) for i in range(n)]
    cols = ("compliance_id string, registration_id string, compliance_date date, compliance_status string, compliance_result string, state string, "
            "source_system string, source_file_name string, dq_is_valid boolean")
    df = spark.createDataFrame(rows, cols)
    return df.withColumns({c: F.lit(None).cast(t) for c, t in (("due_date", "date"), ("completion_date", "date"), ("is_doj_referral", "boolean"),
                                                               ("source_list_type", "string"), ("source_year", "int"), ("error_message", "string"))})


def test_latest_rows_are_flagged_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(domain, "staging", lambda *a: _staging(spark))
    for rows in q_partitions.first_and_batch(spark, "", "compliance"):
        assert len(re.findall("Exchange hashpartitioning", _plan(rows))) == 1
        got = rows.groupBy(F.col("compliance_id").isNull().alias("unnamed"), "dq_is_valid", "dq_validation_errors").count().collect()
        assert {r["dq_is_valid"] for r in got if not r["unnamed"]} == {True}
        assert {r["dq_validation_errors"] for r in got if r["unnamed"]} == {"compliance_id_not_null"}


def test_the_hash_is_not_carried_through_the_key_shuffle(spark):
    dims = {"d_date": domain.d_date(spark)}
    seen = []
    out = build_fact(_staging(spark), dims, "compliance", "2000-01-01 00:00:00", skip=("codes", "state", "source", "file"),
                     layout=lambda df: seen.extend(df.columns) or partitions.dealt(df, "compliance_date_key", "compliance_id"))
    assert seen and not {"record_hash", "created_dt", "updated_dt", "source_system_id", "retry_count"} & set(seen)
    assert out.where("record_hash IS NULL OR created_dt IS NULL OR retry_count <> 0").count() == 0
    assert sorted(r[0] for r in out.select("compliance_key").collect()) == list(range(1, 41))


def test_a_load_neither_sorts_the_target_nor_joins_the_old_rows(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def rows(ids, v, part):
            return spark.createDataFrame([(i, v, part) for i in ids], "id string, v string, part int").select(
                F.lit(None).cast("long").alias("k"), "id", F.col("part").alias("day"), F.md5("v").alias("record_hash"),
                *[F.lit("2024-01-01 00:00:00").cast("timestamp").alias(c) for c in ("created_dt", "updated_dt")], "part")

        target = rows(["a", "b", None, None], "x", 1).withColumn("k", F.monotonically_increasing_id())
        tagged = partitions.tag_changes(rows(["a", "b", "c"], "y", 2), target, "id", "k", "part")
        assert "SortAggregate" not in _plan(tagged) and {r["id"]: r["action"] for r in tagged.collect()} == {"a": "CHANGED", "b": "CHANGED", "c": "NEW"}
        path = scratch_path(spark, f"volume-{uuid.uuid4().hex}")
        partitions.write_partitions(target.drop("part"), path, "part", F.lit(1))
        seen, write = [], partitions._write
        monkeypatch.setattr(partitions, "_write", lambda df, *a, **kw: seen.append(_plan(df)) or write(df, *a, **kw))
        partitions.upsert_partitions(spark, path, rows(["a", "c"], "y", 2).drop("part"), "id", "k", "part", lambda: F.lit(2), "2024-07-01 00:00:00", "r")
        assert seen and "LeftAnti" not in seen[0]
        got = sorted((str(r["id"]), r["part"], r["record_hash"] is not None) for r in partitions.read_partitions(spark, path).collect())
        assert got == [("None", 1, True), ("None", 1, True), ("a", 2, True), ("b", 1, True), ("c", 2, True)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_packed_hashes_are_given_back_as_they_were(spark):
    texts = ["d41d8cd98f00b204e9800998ecf8427e", "D41D", "abc", "x", "", None, "0a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r) for r in df.withColumn("p", packed("t")).select("t", unpacked("p")).collect()] == [(t, t) for t in texts]
