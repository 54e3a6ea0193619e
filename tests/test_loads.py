"""Loads with repeated ids, runs repeated after a failure, streams over table folders."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.operators import facts, quality
from starforge.operators.staging import latest_rows
from starforge.operators.tables import VersionedTable
from starforge.plans import pipeline, q_ops
from starforge.sources.seeds import seed_dimensions

from conftest import rows
from test_pipeline import BATCH1, BATCH2, raw

TS1, TS2 = "2025-01-18 02:00:00", "2025-01-22 02:00:00"


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), (None, 1, "p"), (None, 1, "p")],
                               "id string, d int, v string")
    got = latest_rows(df, "id", ["d"])
    assert got.columns == ["id", "d", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for r in df.collect() if r["d"] != 1 or r["id"] is None][1:]))
    assert latest_rows(df.limit(0), "id", ["d"]).count() == 0


def test_flag_rows_null_and_repeated_ids(spark):
    base = raw(spark, BATCH1 + BATCH1[:1])
    nulls = raw(spark, BATCH1[:2]).withColumn("registration_id", F.lit(None).cast("string"))
    got = quality.flag_rows(base.unionByName(nulls), "registration", TS1)
    assert sorted(map(tuple, got.select("registration_id", "dq_validation_errors").collect()), key=str) == sorted([
        ("REG001", "registration_id_unique"), ("REG001", "registration_id_unique"), ("REG002", None), ("REG003", None),
        (None, "registration_id_not_null"), (None, "registration_id_not_null")], key=str)


def test_split_refuses_a_repeated_target_key(spark):
    new = spark.createDataFrame([("a", "h"), ("b", "h"), (None, "h")], "id string, record_hash string")
    assert rows(facts.split_changes(new, new.where("id = 'a'"), "id").where("id IS NOT NULL"), "id", "action") == [("a", "UNCHANGED"), ("b", "NEW")]
    with pytest.raises(Exception, match="repeated id in the target"):
        facts.split_changes(new, new.unionAll(new), "id").collect()


def test_repeated_ids_load_the_latest(spark, tmp_path):
    root = str(tmp_path / "wh")
    dims = seed_dimensions(spark, "2025-01-01 00:00:00")
    c = pipeline.run_pipeline(spark, "registration", "INITIAL", raw(spark, BATCH1 + BATCH2), root, TS2, dims)
    assert (c["landed"], c["staging"], c["warehouse"]) == (5, 4, 4)
    fact = VersionedTable(spark, f"{root}/f_registration").read()
    assert [r[0] for r in rows(fact, "registration_id")] == ["REG001", "REG002", "REG003", "REG004"]
    staged = VersionedTable(spark, f"{root}/stg_registration").read()
    assert rows(staged.where("registration_id = 'REG002'"), "registration_status") == [("INACTIVE",)]
    failed = VersionedTable(spark, f"{root}/dq_results").read().where("status = 'FAIL'")
    assert rows(failed, "check_name") == [("registration_id_unique",)]      # the copies are still reported


def test_run_repeated_after_a_failed_fact_write(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    dims = seed_dimensions(spark, "2025-01-01 00:00:00")
    pipeline.run_pipeline(spark, "registration", "INITIAL", raw(spark, BATCH1), root, TS1, dims)
    write = VersionedTable.write

    def broken(self, df, sort_by=()):
        if self.path.endswith("/f_registration"):
            raise OSError("disk")
        return write(self, df, sort_by)

    monkeypatch.setattr(VersionedTable, "write", broken)
    with pytest.raises(OSError):
        pipeline.run_pipeline(spark, "registration", "INCREMENTAL", raw(spark, BATCH2), root, TS2, dims)
    monkeypatch.undo()
    want = [("REG002", "INSERT", False, 20250118), ("REG002", "UPDATE", True, 20250122)]
    for _ in range(2):                                            # a further run of the batch changes nothing
        c = pipeline.run_pipeline(spark, "registration", "INCREMENTAL", raw(spark, BATCH2), root, TS2, dims)
        assert c["warehouse"] == 4
        hist = VersionedTable(spark, f"{root}/f_registration_hist").read()
        assert rows(hist, "registration_id", "change_type", "is_current", "snapshot_date_key") == want


def test_history_of_a_repeated_run_reopens_what_it_closed(spark):
    t0, t1 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    existing = spark.createDataFrame([("a", 1, "S1", t0)], "id string, sk long, s string, created_dt timestamp")
    split = spark.createDataFrame([("a", None, "S2", t0, "CHANGED")], "id string, sk long, s string, created_dt timestamp, action string")
    old = spark.createDataFrame([(1, "a", 20250101, "S1", "UPDATE", t0, None, True, t0)],
                                "sk long, id string, snapshot_date_key int, s string, change_type string, effective_start_dt timestamp, "
                                "effective_end_dt timestamp, is_current boolean, created_dt timestamp")
    once = facts.history_rows(split, existing, old, "id", "sk", ["s"], str(t1))
    twice = facts.history_rows(split, existing, once, "id", "sk", ["s"], str(t1))
    want = [("S1", t0, False), ("S2", t1, True)]
    assert rows(once, "s", "effective_start_dt", "is_current") == rows(twice, "s", "effective_start_dt", "is_current") == want


def test_streams_read_folders_of_part_files(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    for name in ("orders", "events"):
        spark.read.parquet(f"{src}/{name}.parquet").repartition(5).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert rows(q_ops.stream_ingest(spark, str(tmp_path))) == rows(q_ops.stream_ingest(spark, src))
    assert q_ops.stream_window(spark, str(tmp_path)).count() > 0


def test_first_time_counts_earlier_loads(spark, tmp_path):
    root = str(tmp_path / "wh")
    dims = seed_dimensions(spark, "2025-01-01 00:00:00")
    pipeline.run_pipeline(spark, "registration", "INITIAL", raw(spark, BATCH1), root, TS1, dims)
    again = ("REG005", *BATCH1[0][1:3], dt.date(2025, 1, 20), *BATCH1[0][4:])       # the person of REG001
    second = ("REG006", *again[1:3], dt.date(2025, 1, 21), *again[4:])
    batch = raw(spark, [again, second, *BATCH2])
    for _ in range(2):                                                              # and a repeated run
        pipeline.run_pipeline(spark, "registration", "INCREMENTAL", batch, root, TS2, dims)
        fact = VersionedTable(spark, f"{root}/f_registration").read()
        assert rows(fact, "registration_id", "previous_registration_count", "is_first_time_registration") == [
            ("REG001", 0, True), ("REG002", 0, True), ("REG003", 0, True), ("REG004", 0, True),
            ("REG005", 1, False), ("REG006", 2, False)]
    persons = VersionedTable(spark, f"{root}/registration_person").read()
    assert persons.columns == ["registration_id", "registration_date", "person_key"] and persons.count() == 6
