"""Calendar filters become key ranges or a semi-join, archive counts come from footers."""
import uuid

import pytest
from pyspark.sql import functions as F

from starforge.operators import archive, calendar, partitions
from starforge.session import scratch_path
from starforge.sources.calendar import build_d_date


@pytest.fixture(scope="module")
def d_date(spark):
    return build_d_date(spark, "2020-01-01", "2024-12-31")


@pytest.fixture(scope="module")
def fact(spark):
    """Days 2022-01-01 .. 2024-12-31, one of them with a third of all rows, rows without a date, and dates outside the calendar."""
    path = scratch_path(spark, f"calendar-test-{uuid.uuid4().hex}")
    day = F.expr("date_add(DATE'2022-01-01', CAST(id % 1096 AS INT))")
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 20240131).when(F.col("id") % 100 == 1, None).when(F.col("id") % 100 == 2, 20300105)
                                    .otherwise(F.date_format(day, "yyyyMMdd").cast("int")).alias("date_key"))
    partitions.write_partitions(rows, path, "part", partitions.month_part("date_key"))
    return partitions.read_partitions(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("where", ["is_weekend", "year = 2023 AND quarter IN (1, 3)", "fiscal_year = 2024", "month_name = 'January'", "year = 1999"])
def test_ranges_and_semi_join_agree_with_a_plain_join(fact, d_date, where):
    want = sorted(r.id for r in fact.join(d_date.where(where).select("date_key"), "date_key").collect())
    for limit in (0, 3, 1000):
        got = calendar.in_calendar(fact, d_date, where, "date_key", "part", partitions.month_part, max_ranges=limit)
        assert got.columns == fact.columns and sorted(r.id for r in got.collect()) == want
    assert sorted(r.id for r in calendar.in_calendar(fact, d_date, where, "date_key").collect()) == want


def test_slice_prunes_partitions_and_reaches_the_reader(fact, d_date):
    year = calendar.in_calendar(fact, d_date, calendar.last_months(F.lit("2024-06-11").cast("date")), "date_key", "part", partitions.month_part)
    text = plan(year)
    assert "part#" in text.split("PartitionFilters: [")[1].split("]")[0] and "202307" in text and "202406" in text
    assert "GreaterThanOrEqual(date_key,20230701)" in text
    months = {r.m for r in year.select(F.floor(F.col("date_key") / 100).alias("m")).distinct().collect()}
    assert months == {202307 + i for i in range(6)} | {202401 + i for i in range(6)}
    short = calendar.in_calendar(fact, d_date, "is_weekend AND year = 2023", "date_key", "part", partitions.month_part, max_ranges=5)
    assert "dynamicpruning" in plan(short)


def test_archive_counts_read_no_column(spark):
    path = scratch_path(spark, f"archive-counts-{uuid.uuid4().hex}")
    rows = spark.range(500).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("x")).alias("v"), (2000 + F.col("id") % 3).cast("int").alias("archive_year"))
    rows.write.partitionBy("archive_year").parquet(path)
    settings = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    counts = archive.archive_year_counts(spark, path)
    assert {r.archive_year: r.archived_rows for r in counts.collect()} == {2000: 167, 2001: 167, 2002: 166}
    text = plan(counts)
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [archive_year]" in text
    assert "id#" not in text and "v#" not in text
    assert [tuple(r) for r in archive.archive_year_counts(spark, path, [2001]).collect()] == [(2001, 167)]
    assert settings == {k: spark.conf.get(k) for k in settings}
