"""Facts and code dimension keyed over the codes and files of all subjects."""

import datetime as dt

from starforge.plans import catalog, domain, q_quality


def _tables(spark, d):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")

    day = dt.datetime(1999, 3, 1)
    put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(1, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, "Customer#1", 1, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("supplier", [(1, 1)], "s_suppkey long, s_nationkey int")
    put("orders", [(1, 1, "F", 10.0, day, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    put("lineitem", [(1, 1, 1, 1, 5.0, 0.1, "R", "F", day)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    put("events", [(1, day, 1, "click", 60.0, "{}")], "event_id long, ts timestamp, user_id long, event_type string, value double, props string")


def test_facts_key_codes_and_files_over_all_subjects(spark, tmp_path):
    _tables(spark, tmp_path)
    sf = str(tmp_path)
    codes = {r["code_id"]: r["code_key"] for r in q_quality.code_dimension(spark, sf).collect()}
    files = {r["file_name"]: r["file_key"] for r in domain.d_file(spark, sf, dense=True).collect()}
    assert sorted(codes.values()) == list(range(1, 9)) and sorted(files.values()) == [1, 2, 3]
    reg, comp, ver = (getattr(catalog, f"fact_{s}")(spark, sf).first() for s in ("registration", "compliance", "verification"))
    assert reg["registration_status_code_key"] == codes["REG_STATUS_F"] and reg["file_key"] == files["orders_19990301.parquet"] == 3
    assert comp["compliance_result_code_key"] == codes["COMP_RESULT_R"] and comp["file_key"] == files["lineitem_19990301.parquet"] == 2
    assert ver["verification_method_code_key"] == codes["VERIF_METHOD_click"] and ver["file_key"] == files["events_19990301.parquet"] == 1
