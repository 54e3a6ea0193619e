import datetime as dt


from starforge.operators import scd

from conftest import rows

DIM = ("code_key int, code_id string, code_value string, effective_start_dt timestamp, "
       "effective_end_dt timestamp, is_active boolean")
T0 = dt.datetime(2025, 1, 1)
BATCH = "2026-01-20 20:00:00"
TB = dt.datetime(2026, 1, 20, 20, 0)


def g2(spark):
    dim = spark.createDataFrame([(101, "RS001", "PENDING", T0, None, True),
                                 (102, "RS002", "ACTIVE", T0, None, True)], DIM)
    src = spark.createDataFrame([("RS001", "ACTIVE"), ("RS002", "ACTIVE"), ("RS003", "INACTIVE")],
                                "code_id string, code_value string")
    return dim, src


def test_g2_scd2_apply(spark):
    dim, src = g2(spark)
    out = scd.scd2_apply(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    assert rows(out) == [
        (101, "RS001", "PENDING", T0, TB, False),
        (102, "RS002", "ACTIVE", T0, None, True),
        (103, "RS001", "ACTIVE", TB, None, True),
        (104, "RS003", "INACTIVE", TB, None, True),
    ]
    assert scd.check_scd2(out, ["code_id"]).count() == 0


def test_scd2_apply_is_idempotent(spark):
    dim, src = g2(spark)
    once = scd.scd2_apply(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    twice = scd.scd2_apply(src, once, ["code_id"], ["code_value"], "code_key", "2026-02-01 00:00:00")
    assert rows(once) == rows(twice)


def test_g3_classify(spark):
    cur = spark.createDataFrame([("RS001", "PENDING", True), ("RS002", "ACTIVE", True)],
                                "code_id string, code_value string, is_active boolean")
    src = spark.createDataFrame([("RS001", "ACTIVE"), ("RS002", "ACTIVE"), ("RS004", "NEW")],
                                "code_id string, code_value string")
    out = scd.classify(src, cur, ["code_id"], ["code_value"])
    assert rows(out, "code_id", "action") == [("RS001", "CHANGED"), ("RS002", "UNCHANGED"), ("RS004", "NEW")]
    full = scd.classify(src.filter("code_id != 'RS002'"), cur, ["code_id"], ["code_value"], include_missing=True)
    assert ("RS002", "MISSING") in rows(full, "code_id", "action")


def test_g4_point_in_time(spark):
    dim, src = g2(spark)
    out = scd.scd2_apply(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    rs1 = out.filter("code_id = 'RS001'")
    assert rows(scd.as_of(rs1, "2025-06-01 00:00:00"), "code_value") == [("PENDING",)]
    assert rows(scd.as_of(rs1, "2027-01-01 00:00:00"), "code_value") == [("ACTIVE",)]
    assert rows(scd.as_of(rs1, BATCH), "code_key") == [(103,)]
    assert rows(scd.as_of(rs1, BATCH, closed="both"), "code_key") == [(101,), (103,)]


def test_as_of_join_picks_the_valid_version(spark):
    dim, src = g2(spark)
    out = scd.scd2_apply(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    facts = spark.createDataFrame([(1, "RS001", dt.datetime(2025, 6, 1)), (2, "RS001", dt.datetime(2026, 6, 1)),
                                   (3, "RS003", dt.datetime(2025, 6, 1))], "id int, code_id string, ts timestamp")
    j = scd.as_of_join(facts, out, {"code_id": "code_id"}, "ts", ["code_value"])
    assert rows(j, "id", "code_value") == [(1, "PENDING"), (2, "ACTIVE"), (3, None)]


def test_untracked_column_does_not_version(spark):
    dim = spark.createDataFrame([(1, "A", "x", 1, T0, None, True)],
                                "k int, id string, v string, display_order int, effective_start_dt timestamp, "
                                "effective_end_dt timestamp, is_active boolean")
    src = spark.createDataFrame([("A", "x", 9)], "id string, v string, display_order int")
    same = scd.scd2_apply(src, dim, ["id"], ["v"], "k", BATCH)
    assert rows(same, "k", "display_order", "is_active") == [(1, 1, True)]
    t1 = scd.scd2_apply(src, dim, ["id"], ["v"], "k", BATCH, type1_columns=["display_order"])
    assert rows(t1, "k", "display_order", "is_active") == [(1, 9, True)]


def test_expire_missing_and_duplicates(spark):
    dim, _ = g2(spark)
    src = spark.createDataFrame([("RS001", "PENDING"), ("RS003", "X"), ("RS003", "Y")],
                                "code_id string, code_value string")
    out = scd.scd2_apply(src, dim, ["code_id"], ["code_value"], "code_key", BATCH, expire_missing=True)
    got = rows(out, "code_id", "is_active")
    assert ("RS002", False) in got                       # missing key closed
    assert sum(1 for r in got if r[0] == "RS003") == 1   # duplicate source rows: one version


def test_check_scd2_finds_overlaps(spark):
    bad = spark.createDataFrame([
        (1, "A", T0, dt.datetime(2025, 6, 1), False), (2, "A", dt.datetime(2025, 5, 1), None, True),
        (3, "B", T0, None, True), (4, "B", dt.datetime(2025, 2, 1), None, True)],
        "k int, id string, effective_start_dt timestamp, effective_end_dt timestamp, is_active boolean")
    out = scd.check_scd2(bad, ["id"])
    assert rows(out, "id", "active_rows", "overlaps") == [("A", 1, 1), ("B", 2, 1)]


def test_scd1_apply_keeps_keys(spark):
    dim = spark.createDataFrame([(1, "01", 5, T0), (2, "02", 7, T0)],
                                "k long, code string, n int, last_updated_dt timestamp")
    src = spark.createDataFrame([("02", 8), ("03", 1)], "code string, n int")
    out = scd.scd1_apply(dim, src, ["code"], "k", BATCH)
    assert rows(out, "k", "code", "n") == [(1, "01", 5), (2, "02", 8), (3, "03", 1)]


def test_scd2_diff(spark):
    dim, src = g2(spark)
    ins, exp = scd.scd2_diff(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    assert rows(ins, "code_id") == [("RS001",), ("RS003",)]
    assert rows(exp) == [(101,)]
    assert "record_hash" not in ins.columns and "_h_src" not in ins.columns
    frame = scd.scd2_diff_frame(src, dim, ["code_id"], ["code_value"], "code_key", BATCH)
    assert sorted(r["action"] for r in frame.collect()) == ["EXPIRE", "INSERT", "INSERT"]


def test_null_key_parts_match_and_closed_rows_stay(spark):
    dim = spark.createDataFrame([(1, "a", None, "x", T0, None, True), (2, "b", "1", "y", T0, None, True),
                                 (3, "c", "1", "old", dt.datetime(2024, 1, 1), T0, False),
                                 (4, "c", "1", "new", T0, None, True)],
                                "k int, id string, part string, v string, effective_start_dt timestamp, "
                                "effective_end_dt timestamp, is_active boolean")
    src = spark.createDataFrame([("a", None, "x"), ("b", "1", "z"), ("c", "1", "new"), ("d", None, "w")],
                                "id string, part string, v string")
    key = ["id", "part"]
    out = scd.scd2_apply(src, dim, key, ["v"], "k", BATCH)
    assert rows(out, "k", "id", "part", "v", "is_active") == [
        (1, "a", None, "x", True), (2, "b", "1", "y", False), (3, "c", "1", "old", False),
        (4, "c", "1", "new", True), (5, "b", "1", "z", True), (6, "d", None, "w", True)]
    assert rows(scd.classify(src, dim, key, ["v"]), "id", "action") == [
        ("a", "UNCHANGED"), ("b", "CHANGED"), ("c", "UNCHANGED"), ("d", "NEW")]
    ins, exp = scd.scd2_diff(src, dim, key, ["v"], "k", BATCH)
    assert rows(ins, "id") == [("b",), ("d",)] and rows(exp) == [(2,)]


def test_scd1_repeated_source_rows_give_one(spark):
    dim = spark.createDataFrame([(1, "01", 5, T0)], "k long, code string, n int, last_updated_dt timestamp")
    src = spark.createDataFrame([("01", 8), ("01", 9), ("02", 1), ("02", 1)], "code string, n int")
    assert rows(scd.scd1_apply(dim, src, ["code"], "k", BATCH), "k", "code", "n") == [(1, "01", 8), (2, "02", 1)]
