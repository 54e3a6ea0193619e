"""Census enrichment by levels: ties on the vintage, missing keys, empty references, weighted medians."""
import random
from decimal import Decimal

from starforge.operators import enrich as e

COLS = ["vintage", "population", "income"]
CENSUS = "zip string, tract string, yr int, population int, income decimal(12,2)"


def test_latest_vintage_has_a_total_order(spark):
    rows = [("z", "t1", 2010, 900, "9.00"), ("z", "t1", 2020, 100, "5.00"), ("z", "t1", 2020, 200, "1.00"), ("z", "t1", 2020, None, "8.00"),
            ("z", "t2", None, 7, "1.00"), ("z", "t2", 2000, None, None), ("z", "t1", 2020, 200, "1.00")]
    rows = [(*r[:4], Decimal(r[4]) if r[4] else None) for r in rows]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        got = {r.tract: (r.yr, r.population, r.income) for r in e.latest_vintage(spark.createDataFrame(rows, CENSUS).repartition(3), ["zip", "tract"], "yr").collect()}
        assert got == {"t1": (2020, 200, Decimal("1.00")), "t2": (2000, None, None)}


def test_tracts_add_up_with_weighted_medians(spark):
    rows = [("a", "1", 2020, 100, Decimal("10.00")), ("a", "2", 2019, 300, Decimal("20.01")), ("a", "3", 2020, 50, None), ("a", "4", 2020, 0, Decimal("99.00")),
            ("b", "1", 2020, None, Decimal("5.00")), (None, "1", 2020, 5, Decimal("5.00"))]
    got = {r.zip: (r.yr, r.population, r.income) for r in e.roll_up(spark.createDataFrame(rows, CENSUS), ["zip"], "yr", "population", ["income"]).collect()}
    assert got == {"a": (2020, 450, Decimal("17.50")), "b": (2020, None, None)}  # (10.00 * 100 + 20.01 * 300) / 400 = 17.5075


def test_levels_fall_back_with_whole_rows(spark):
    base = spark.createDataFrame([("z1", "s1", "c1", "x"), ("z2", "s1", "c1", "y"), ("z3", "s1", None, "y"), ("z4", "s9", "c1", "y"), (None, "s1", "c9", None), ("z1", "s1", "c1", "x")],
                                 "zip string, state string, county string, level_0 string")
    zips = spark.createDataFrame([("z1", 2020, 5, None)], "zip string, vintage int, population int, income int")
    county = spark.createDataFrame([("s1", "c1", 2015, 50, 500), (None, "c1", 2015, 1, 1)], "state string, county string, vintage int, population int, income int")
    state = spark.createDataFrame([("s1", 2010, 99, 900)], "state string, vintage int, population int, income int")
    levels = [("ZIP", zips, ["zip"]), ("COUNTY", county, ["state", "county"]), ("STATE", state, ["state"])]
    for broadcast in (True, False):
        rows = e.enrich_levels(base, levels, COLS, broadcast=broadcast).collect()
        got = sorted(((r.zip, r.vintage, r.population, r.income, r.level) for r in rows), key=str)
        assert got == sorted([("z1", 2020, 5, None, "ZIP")] * 2 + [("z2", 2015, 50, 500, "COUNTY"), ("z3", 2010, 99, 900, "STATE"), ("z4", None, None, None, None),
                                                                  (None, 2010, 99, 900, "STATE")], key=str)
    empty = [(n, ref.limit(0), on) for n, ref, on in levels]
    assert {r.level for r in e.enrich_levels(base, empty, COLS).collect()} == {None}
    assert e.enrich_levels(base.limit(0), levels, COLS).count() == 0
