"""Golden case G1 end to end and the seed counts of G5."""
import datetime as dt

from pyspark.sql import functions as F

from starforge.operators.tables import VersionedTable
from starforge.plans.pipeline import run_pipeline
from starforge.sources.calendar import build_d_date
from starforge.sources.seeds import seed_dimensions

from conftest import rows

RAW = ("registration_id string, first_name string, last_name string, email string, phone string, "
       "street_address string, city string, state string, zipcode string, country string, "
       "registration_date date, birth_date date, registration_status string, registration_type string, "
       "classification string, registration_method string, source_system string, source_file_name string")


def raw(spark, data):
    full = [(i, "F", "L", "e@x", "1", "street", "Springfield", st, z, "USA", rd, bd, status, typ, "Standard", meth,
             src, f) for (i, st, z, rd, bd, status, typ, meth, src, f) in data]
    return spark.createDataFrame(full, RAW)


BATCH1 = [
    ("REG001", "IL", "62701", dt.date(2025, 1, 15), dt.date(1990, 5, 20), "ACTIVE", "NEW", "Internet",
     "Web Portal", "batch_20250115.csv"),
    ("REG002", "IL", "60601", dt.date(2025, 1, 16), dt.date(1985, 8, 15), "ACTIVE", "NEW", "Internet",
     "Web Portal", "batch_20250116.csv"),
    ("REG003", "IL", "61602", dt.date(2025, 1, 17), dt.date(1992, 3, 10), "PENDING", "RENEWAL", "DMV",
     "DMV System", "batch_20250117.csv"),
]
BATCH2 = [
    ("REG004", "IL", "61101", dt.date(2025, 1, 21), dt.date(1988, 11, 25), "ACTIVE", "NEW", "Mobile",
     "Mobile App", "batch_20250121.csv"),
    ("REG002", "IL", "60601", dt.date(2025, 1, 21), dt.date(1985, 8, 15), "INACTIVE", "UPDATE", "Internet",
     "Web Portal", "batch_20250121.csv"),
]


def test_g5_seed_counts(spark):
    seeds = seed_dimensions(spark, "2025-01-01 00:00:00")
    counts = {k: v.count() for k, v in seeds.items()}
    assert counts == {"d_code_category": 8, "d_code": 9, "d_data_source": 5, "d_country": 1, "d_state": 4}
    cal = build_d_date(spark, "2015-01-01", "2034-12-31")
    r = cal.agg(F.count("*").alias("n"), F.min("date_value").alias("a"), F.max("date_value").alias("b")).first()
    assert (r["n"], r["a"], r["b"]) == (7305, dt.date(2015, 1, 1), dt.date(2034, 12, 31))
    names = cal.filter("date_value = '2025-01-04'").first()
    assert (names["day_name"], names["month_name"], names["is_weekend"]) == ("Saturday", "January", True)


def test_g1_initial_then_incremental(spark, tmp_path):
    root = str(tmp_path / "wh")
    dims = seed_dimensions(spark, "2025-01-01 00:00:00")
    c1 = run_pipeline(spark, "registration", "INITIAL", raw(spark, BATCH1), root, "2025-01-18 02:00:00", dims)
    assert (c1["staging"], c1["valid"], c1["warehouse"]) == (3, 3, 3)
    fact = VersionedTable(spark, f"{root}/f_registration").read()
    ages = dict(rows(fact, "registration_id", "age_at_registration"))
    assert ages == {"REG001": 34, "REG002": 39, "REG003": 32}
    assert fact.filter("state_key IS NULL").count() == 3                   # IL is not a seeded state
    assert fact.filter("data_source_key IS NULL").count() == 0
    assert not set(fact.columns) & {"first_name", "last_name", "email", "phone", "street_address", "birth_date"}

    c2 = run_pipeline(spark, "registration", "INCREMENTAL", raw(spark, BATCH2), root, "2025-01-22 02:00:00", dims)
    assert c2["warehouse"] == 4
    fact = VersionedTable(spark, f"{root}/f_registration").read()
    assert dict(rows(fact, "registration_id", "registration_key"))["REG004"] == 4
    hist = VersionedTable(spark, f"{root}/f_registration_hist").read()
    got = rows(hist, "registration_id", "change_type", "is_current", "snapshot_date_key")
    assert got == [("REG002", "INSERT", False, 20250118), ("REG002", "UPDATE", True, 20250122)]
    runs = VersionedTable(spark, f"{root}/etl_control").read()
    assert rows(runs, "job_type", "status", "records_written") == [("INCREMENTAL", "SUCCESS", 4),
                                                                  ("INITIAL", "SUCCESS", 3)]
    dq = VersionedTable(spark, f"{root}/dq_results").read()
    assert dq.count() == 10 and dq.filter("status = 'FAIL'").count() == 0
