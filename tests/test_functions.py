import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import (change_hash, completed_years, date_key, day_of_week0, divide,
                                 fiscal_quarter, fiscal_year, out_of_range)


def one(spark, col, schema, values):
    return spark.createDataFrame(values, schema).select(col.alias("x")).collect()


def test_compat_hash_collides_safe_hash_does_not(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", "c", None), ("a", "b|c", None)],
                               "x string, y string, z string")
    r = df.select(change_hash(["x", "y", "z"], "compat").alias("c"),
                  change_hash(["x", "y", "z"], "safe").alias("s")).collect()
    assert r[0]["c"] == r[1]["c"]          # NULL skipped: (a, null, b) ~ (a, b, null)
    assert r[2]["c"] == r[3]["c"]          # separator not escaped
    assert len({x["s"] for x in r}) == 4   # safe mode tells all four apart


def test_compat_hash_is_md5_of_joined_text(spark):
    import hashlib
    r = spark.createDataFrame([("REG001", "ACTIVE")], "a string, b string") \
        .select(change_hash(["a", "b"], "compat").alias("h")).first()
    assert r["h"] == hashlib.md5(b"REG001|ACTIVE").hexdigest()


def test_completed_years(spark):
    df = spark.createDataFrame([
        (dt.date(2004, 2, 29), dt.date(2025, 2, 28), 20),
        (dt.date(2004, 2, 29), dt.date(2025, 3, 1), 21),
        (dt.date(1990, 5, 20), dt.date(2025, 1, 15), 34),   # REG001
        (dt.date(1985, 8, 15), dt.date(2025, 1, 16), 39),   # REG002
        (dt.date(1992, 3, 10), dt.date(2025, 1, 17), 32),   # REG003
        (dt.date(1988, 11, 25), dt.date(2025, 1, 21), 36),  # REG004
    ], "b date, r date, want int")
    for r in df.select(completed_years("b", "r").alias("age"), "want").collect():
        assert r["age"] == r["want"]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2025, 10, 5),), (dt.date(2025, 3, 1),)], "d date")
    r = df.select(date_key("d").alias("k"), day_of_week0("d").alias("w"), fiscal_year("d").alias("fy"),
                  fiscal_quarter("d").alias("fq")).collect()
    assert (r[0]["k"], r[0]["w"], r[0]["fy"], r[0]["fq"]) == (20251005, 0, 2026, 1)  # a Sunday in October
    assert (r[1]["k"], r[1]["fy"], r[1]["fq"]) == (20250301, 2025, 2)


def test_divide_and_range(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 4, dt.date(1800, 1, 1)), (None, 2, dt.date(2000, 1, 1))],
                               "a int, b int, d date")
    r = df.select(divide("a", "b").alias("q"),
                  out_of_range("d", F.lit("1900-01-01").cast("date"), F.lit("2030-01-01").cast("date")).alias("o")
                  ).collect()
    assert [x["q"] for x in r] == [0.0, 0.25, 0.0]
    assert [x["o"] for x in r] == [False, True, False]  # NULL date is not out of range
