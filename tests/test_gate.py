"""The daily flow stops at the gate, keeps rejected rows apart and logs failed runs."""
import datetime as dt

import pytest

from starforge.operators.tables import VersionedTable
from starforge.plans.pipeline import DimensionLoad, GateFailed, run_pipeline
from starforge.sources.seeds import seed_dimensions

from conftest import rows
from test_pipeline import BATCH1, raw

TS = "2025-01-18 02:00:00"


def test_gate_quarantine_and_failed_rows(spark, tmp_path):
    root, dims = str(tmp_path / "wh"), seed_dimensions(spark, "2025-01-01 00:00:00")
    late = ("REG009", *BATCH1[0][1:2], "9", dt.date(2025, 3, 1), *BATCH1[0][4:])
    batch = raw(spark, [*BATCH1, late, ("REG010", *late[1:])])
    table = {n: VersionedTable(spark, f"{root}/{n}") for n in ("etl_control", "rejected_registration", "f_registration", "d_zipcode")}
    with pytest.raises(GateFailed, match="2 of 5 rows"):
        run_pipeline(spark, "registration", "INITIAL", batch, root, TS, dims, max_rejected=0.3)
    assert not table["f_registration"].exists()
    zips = spark.createDataFrame([("62701", 1), ("60601", 2)], "zipcode string, state_key long")
    load = {"d_zipcode": DimensionLoad(zips, ["zipcode"], ["state_key"], "zipcode_key")}
    for _ in range(2):  # and again: neither rejected rows nor versions double
        counts = run_pipeline(spark, "registration", "INITIAL", batch, root, TS, dims, dimension_loads=load, max_rejected=0.4)
        assert counts["rejected"] == 2 and counts["warehouse"] == 3
    assert rows(table["rejected_registration"].read(), "registration_id", "dq_validation_errors") == [
        ("REG009", "registration_date_valid_range"), ("REG010", "registration_date_valid_range")]
    assert table["d_zipcode"].read().count() == 2
    assert rows(table["f_registration"].read().na.fill(0), "registration_id", "zipcode_key") == [("REG001", 2), ("REG002", 1), ("REG003", 0)]
    with pytest.raises(KeyError):
        run_pipeline(spark, "registration", "INITIAL", batch, root, TS, {k: v for k, v in dims.items() if k != "d_data_source"})
    log = table["etl_control"].read().na.fill(-1).na.fill("-")
    got = sorted((r.status, r.records_read, r.records_written, r.records_rejected, r.error_message.split(":")[0]) for r in log.collect())
    assert got == [("FAILED", 5, -1, 2, "GateFailed"), ("FAILED", 5, -1, 2, "KeyError"), ("SUCCESS", 5, 3, 2, "-"), ("SUCCESS", 5, 3, 2, "-")]
