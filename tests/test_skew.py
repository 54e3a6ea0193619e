"""Hot keys: one key holds a third of all rows. Results must equal the plain forms."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import facts, keys, measures
from starforge.operators.staging import latest_per_key, latest_per_key_agg

N = 3000


def skewed(spark):
    ids = spark.range(N)
    person = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("p"), (F.col("id") % 97).cast("string")))
    return ids.select(F.col("id").cast("string").alias("registration_id"), person.alias("first_name"),
                      F.lit(None).cast("string").alias("last_name"), F.lit(None).cast("date").alias("birth_date"),
                      F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 37 % 2500).cast("int"))
                      .alias("registration_date"))


def test_first_time_two_level_equals_single_window(spark):
    df = skewed(spark)
    got = facts.first_time(df, ["first_name", "last_name", "birth_date"], "registration_date", "registration_id")
    w = Window.partitionBy("first_name", "last_name", "birth_date").orderBy("registration_date", "registration_id")
    ref = df.withColumn("want", (F.row_number().over(w) - 1).cast("int"))
    j = got.join(ref, "registration_id")
    assert j.filter(F.col("previous_registration_count") != F.col("want")).count() == 0
    assert got.filter("first_name = 'HOT'").agg(F.max("previous_registration_count")).first()[0] == N // 3 - 1


def test_hot_key_latest_and_duplicates(spark):
    df = skewed(spark)
    a = latest_per_key(df, ["first_name"], [F.col("registration_date").desc(), F.col("registration_id").desc()])
    b = latest_per_key_agg(df, ["first_name"], "registration_date", ["registration_id"])
    assert sorted(map(tuple, a.select("first_name", "registration_id").collect())) == \
        sorted(map(tuple, b.select("first_name", "registration_id").collect()))
    d = {r["first_name"]: r["row_count"] for r in measures.duplicates(df, ["first_name"]).collect()}
    assert d["HOT"] == N // 3


def test_keys_with_a_hot_prefix(spark):
    df = skewed(spark)
    k = keys.assign_keys(df, "k", ["first_name", "registration_id"])
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("first_name", "registration_id")))
    assert k.join(ref, "registration_id").filter("k != r").count() == 0
