"""Keys that don't depend on what else is built, measures that read their rows once."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.operators import measures
from starforge.plans import domain, warehouse

SF = "/root/testdata/sf0.001"


def test_code_and_file_keys_are_the_same_in_every_build(spark):
    def keys(df, key, name):
        return {r[name]: r[key] for r in df.select(key, name).collect()}

    whole = keys(domain.d_code(spark, SF), "code_key", "code_id")
    part = keys(domain.d_code(spark, SF, ["VERIF_RESULT"]), "code_key", "code_id")
    assert part and part.items() <= whole.items() and len(set(whole.values())) == len(whole)
    files = keys(domain.d_file(spark, SF), "file_key", "file_name")
    events = keys(domain.d_file(spark, SF, feeds=["EVENTS"]), "file_key", "file_name")
    assert events and events.items() <= files.items() and len(set(files.values())) == len(files)


def test_a_subject_reads_its_own_feed_only(spark):
    f = warehouse.fact(spark, SF, "verification")
    files = {x.rsplit("/", 1)[-1] for x in f.inputFiles()}
    assert "events.parquet" in files and not files & {"orders.parquet", "lineitem.parquet"}


def test_star_plans_only_the_named_roles(spark):
    st = warehouse.registration_star(spark, SF, ("reg",))
    assert "reg_date_value" in st.columns and "status_code_value" not in st.columns and "state_state_name" not in st.columns
    assert st.filter(F.col("state_key").isNotNull()).count() == 0  # not looked up


def test_matrix_shares_are_of_all_rows(spark):
    df = spark.createDataFrame([("x", "A"), ("x", "A"), ("x", "Z"), ("y", None)], "s string, r string")
    got = {r["s"]: (r["A"], float(r["A_share"]), r["B"]) for r in measures.matrix(df, ["s"], "r", ["A", "B"]).collect()}
    assert got == {"x": (2, 0.5, 0), "y": (0, 0.0, 0)}


def test_to_date_kpis_with_nulls_and_without_rows(spark):
    rows = [(dt.date(2000, 5, 1), "O"), (dt.date(2001, 1, 1), "O"), (dt.date(2001, 3, 1), "F"), (None, "O")]
    df = spark.createDataFrame(rows, "d date, s string")
    cond = {"n": F.lit(True), "open": F.col("s") == "O"}
    assert tuple(measures.to_date_kpis(df, "d", cond, "ytd").first()) == (4, 3, 2)
    assert tuple(measures.to_date_kpis(df.limit(0), "d", cond, "ytd").first()) == (0, 0, 0)


def test_share_of_total_reads_its_source_once(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v long")
    got = {r["k"]: float(r["share"]) for r in measures.with_share(df, "v").collect()}
    assert got == {"a": 0.25, "b": 0.75}
