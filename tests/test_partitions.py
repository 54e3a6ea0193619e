"""Partitioned fact loads: only touched partitions are rewritten, loads survive a stop at any step."""
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from starforge.operators import partitions as p
from starforge.session import scratch_path

COLS = "k long, id string, day int, v string, record_hash string, created_dt timestamp, updated_dt timestamp"


def frame(spark, rows, ts="2024-01-01 00:00:00"):
    df = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[3]) for r in rows], "k long, id string, day int, v string, record_hash string")
    return df.withColumns({"created_dt": F.lit(ts).cast("timestamp"), "updated_dt": F.lit(ts).cast("timestamp")})


def month():
    return p.month_part("day")


@pytest.fixture()
def path(spark):
    path = scratch_path(spark, f"partition-test-{uuid.uuid4().hex}")
    rows = [(1, "a", 20240105, "x"), (2, "b", 20240206, "x"), (3, "c", 20240307, "x"), (4, "d", 20240408, "x"), (5, "e", None, "x"), (6, "f", 20240501, "x")]
    p.write_partitions(frame(spark, rows), path, "part", month())
    return path


BATCH = [(None, "a", 20240105, "x"), (None, "b", 20240206, "y"), (None, "d", 20240309, "y"), (None, "n", 20240601, "z"), (None, "m", None, "z")]
WANT = {("a", 1, 202401, "x"), ("b", 2, 202402, "y"), ("c", 3, 202403, "x"), ("d", 4, 202403, "y"), ("e", 5, 0, "x"), ("f", 6, 202405, "x"),
        ("m", 7, 0, "z"), ("n", 8, 202406, "z")}


def state(spark, path):
    return {(r.id, r.k, r.part, r.v) for r in p.read_partitions(spark, path).collect()}


def files(spark, path):
    rows = spark.read.parquet(path).select("part", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {(r.part, r.file_path, r.file_modification_time) for r in rows}


def load(spark, path, run="r1", **kw):
    return p.upsert_partitions(spark, path, frame(spark, BATCH), "id", "k", "part", month, "2024-07-01 00:00:00", run, **kw)


def test_only_touched_partitions_change(spark, path):
    before = files(spark, path)
    plan = {r.part_value: (r.rows_before, r.rows_after, r.new_rows, r.changed_rows) for r in load(spark, path).collect()}
    assert plan == {202402: (1, 1, 0, 1), 202403: (1, 2, 0, 1), 202404: (1, 0, 0, 0), 202406: (0, 1, 1, 0), 0: (1, 2, 1, 0)}
    assert state(spark, path) == WANT
    after = files(spark, path)
    assert {f for f in before if f[0] in (202401, 202405)} <= after and not {f for f in before if f[0] in plan} & after
    again = load(spark, path).count()  # a run that is done is not repeated
    assert again == 5 and files(spark, path) == after
    same = load(spark, path, run="r2")
    assert same.count() == 0 and state(spark, path) == WANT


def test_stopped_load_is_finished_by_the_next(spark, path):
    def stop():
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        load(spark, path, before_switch=stop)
    assert len(state(spark, path)) == 6
    assert p.finish_loads(spark, path, "part") == ["r1"] and state(spark, path) == WANT
    assert p.finish_loads(spark, path, "part") == []


def test_half_switched_load_is_repeated(spark, path, monkeypatch):
    monkeypatch.setattr(p, "_one", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        load(spark, path)  # switched, but not marked as done
    monkeypatch.undo()
    assert load(spark, path, run="r2").count() == 0 and state(spark, path) == WANT


def test_repeated_key_in_target_is_an_error(spark, path):
    frame(spark, [(9, "b", 20240501, "x")]).withColumn("part", month()).write.mode("append").partitionBy("part").parquet(path)
    with pytest.raises(Exception, match="repeated id in the target: b"):
        load(spark, path)


OLD = {"a": 2024, "b": 2024}


def archive(spark, path, run="a1", **kw):
    return p.archive_partitions(spark, path, "part", "day", 202402, dt.date(2024, 2, 10), f"{path}-archive", run, **kw)


def archived(spark, path):
    return {r.id: r.archive_year for r in spark.read.parquet(f"{path}-archive").collect()}


def test_archive_moves_old_rows_once(spark, path):
    frame(spark, [(8, "h", 20240215, "x")]).withColumn("part", month()).write.mode("append").partitionBy("part").parquet(path)
    before = files(spark, path)
    plan = {r.part_value: (r.rows_before, r.rows_after) for r in archive(spark, path).collect()}
    assert plan == {202401: (1, 0), 202402: (2, 1)} and archived(spark, path) == OLD
    assert {i for i, *_ in state(spark, path)} == {"c", "d", "e", "f", "h"}
    assert {f for f in before if f[0] not in plan} <= files(spark, path)
    assert archive(spark, path).count() == 2 and archive(spark, path, run="a2").count() == 0
    assert spark.read.parquet(f"{path}-archive").count() == 2


def test_stopped_archive_is_completed(spark, path, monkeypatch):
    def stop(*a):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        archive(spark, path, before_switch=stop)
    assert len(state(spark, path)) == 6
    one = p._one
    monkeypatch.setattr(p, "_one", lambda s, to, run: stop() if to.endswith("done") else one(s, to, run))
    with pytest.raises(RuntimeError, match="stopped"):
        p.finish_loads(spark, path, "part")  # archived and removed, but not marked as done
    monkeypatch.undo()
    assert p.finish_loads(spark, path, "part") == ["a1"]
    assert archived(spark, path) == OLD and len(state(spark, path)) == 4 and spark.read.parquet(f"{path}-archive").count() == 2


def test_archive_that_differs_removes_nothing(spark, path, monkeypatch):
    monkeypatch.setattr(p, "_fingerprint", lambda df, cols, seen=[]: seen.append(1) or len(seen))
    with pytest.raises(p.ArchiveMismatch):
        archive(spark, path)
    assert len(state(spark, path)) == 6
