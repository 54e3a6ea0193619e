"""High-water marks and the file registry: late, repeated and unchanged rows, changed files, repeated runs."""
import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from starforge.sources import landing
from tests.conftest import rows

T = dt.datetime(2024, 1, 10)
SCHEMA = "id string, created timestamp, updated timestamp, v string, run string"


def d(n):
    return T + dt.timedelta(days=n)


def take(spark, path, data, run):
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA).withColumnRenamed("run", "tag")
    out = landing.take_batch(df, path, "s", ["id"], ["created", "updated"], run, "2 DAYS")
    return rows(out.withColumn("at", F.date_format("updated", "dd")).na.fill("-"), "id", "v", "at")


def test_marks_overlap_and_repeats(spark, tmp_path):
    path = str(tmp_path)
    first = [("a", d(0), d(1), "1"), ("b", d(0), None, "1"), ("a", d(0), d(0), "0"), (None, d(0), d(0), "n")]
    assert take(spark, path, first, "r1") == [("-", "n", "10"), ("a", "1", "11"), ("b", "1", "-")]
    assert landing.marks_of(spark, path, "s") == {"created": d(0), "updated": d(1)} and landing.marks_of(spark, path, "other") == {}
    second = [*first, ("c", d(-1), None, "late"), ("old", d(-9), d(-8), "missed"), ("b", d(0), d(5), "2"), ("e", d(6), None, "1")]
    want = [("b", "2", "15"), ("c", "late", "-"), ("e", "1", "-")]
    assert take(spark, path, second, "r2") == want
    assert take(spark, path, [("z", d(9), None, "ignored")], "r2") == want  # a finished run is not repeated
    assert take(spark, path, second, "r3") == []
    assert landing.marks_of(spark, path, "s") == {"created": d(6), "updated": d(5)}


def test_registry_tells_new_from_changed_files(spark, tmp_path):
    src, reg = str(tmp_path / "in"), str(tmp_path / "reg")

    def land(name, n):
        (tmp_path / "in").mkdir(exist_ok=True)
        pq.write_table(pa.table({"id": list(range(n))}), f"{src}/{name} x.parquet")

    def run(name):
        files = landing.files_to_read(spark, src, reg)
        files = spark.createDataFrame(files.collect(), files.schema)
        got = landing.read_listed(spark, files, spark.range(1).schema, src).groupBy("status").count()
        landing.register_files(files, reg, name)
        return rows(got)

    land("a", 3)
    land("b", 4)
    assert run("r1") == [("NEW", 7)] and run("r2") == []
    land("b", 6)
    land("c", 1)
    assert run("r3") == [("CHANGED", 6), ("NEW", 1)] and run("r4") == []
