import datetime as dt

import pytest

from starforge import schemas
from starforge.operators import measures, quality

from conftest import rows

TS = "2026-01-20 20:00:00"
SCHEMA = "registration_id string, registration_date date, registration_status string"


def checks(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return {r["check_name"]: r for r in quality.run_checks(df, "registration", TS).collect()}


def test_null_date_passes_validity_and_duplicates_count_keys(spark):
    r = checks(spark, [("A", None, "ACTIVE"), ("B", dt.date(1850, 1, 1), "ACTIVE"),
                       ("C", dt.date(2025, 1, 1), None), ("C", dt.date(2025, 1, 1), "X"),
                       ("C", dt.date(2025, 1, 2), "X")])
    assert r["registration_date_valid_range"]["records_failed"] == 1       # only the 1850 date
    assert r["registration_date_not_null"]["records_failed"] == 1
    assert r["registration_status_not_null"]["status"] == "FAIL"
    u = r["registration_id_unique"]
    assert (u["records_failed"], u["details"]) == (1, "duplicate_rows=3")  # id seen 3 times: one key


def test_empty_table_fails_with_zero_rate(spark):
    r = checks(spark, [])
    assert all(v["status"] == "FAIL" and float(v["pass_rate"]) == 0.0 for v in r.values())


def test_validity_threshold_is_at_least_99(spark):
    data = [(str(i), dt.date(2020, 1, 1), "A") for i in range(99)] + [("x", dt.date(1800, 1, 1), "A")]
    assert checks(spark, data)["registration_date_valid_range"]["status"] == "PASS"


def test_unknown_subject_raises():
    with pytest.raises(ValueError):
        schemas.subject("voters")


def test_flag_rows_and_error_frequency(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 1, 1), "X"), ("A", None, "X"), ("B", dt.date(2025, 1, 1), None)],
                               SCHEMA)
    f = quality.flag_rows(df, "registration", TS)
    got = rows(f, "registration_id", "dq_is_valid", "dq_validation_errors")
    assert got == [("A", False, "registration_date_not_null;registration_id_unique"),
                   ("A", False, "registration_id_unique"), ("B", False, "registration_status_not_null")]
    freq = rows(measures.error_frequency(f), "error", "occurrences")
    assert ("registration_id_unique", 2) in freq


def test_types_profile_refs_failures(spark):
    df = spark.createDataFrame([("R" * 101, dt.date(2025, 1, 1), "A"), ("R1", dt.date(2025, 1, 2), "B")], SCHEMA)
    t = {r["check_name"]: r for r in quality.check_types(df, schemas.STG_REGISTRATION, "t", TS).collect()}
    assert t["registration_id_type"]["records_failed"] == 1                # VARCHAR(100) exceeded
    p = {r["column_name"]: r for r in quality.profile(df).collect()}
    assert p["registration_status"]["distinct_count"] == 2 and p["registration_date"]["min_value"] == "2025-01-01"
    dim = spark.createDataFrame([("R1",)], "registration_id string")
    refs = quality.check_refs(df, dim, "registration_id", "registration_id", "t", TS).first()
    assert refs["records_failed"] == 1
    res = quality.run_checks(df, "registration", TS)
    assert quality.failures(res).count() == 0
    bad = quality.run_checks(df.limit(0), "registration", TS)
    with pytest.raises(RuntimeError):
        quality.failures(bad, raise_on_fail=True)
