"""The warehouse roles on the driver's tables.

Registration staging comes from ``orders`` (with ``customer``, ``nation``,
``region`` as the source system's person and geography data), compliance from
``lineitem`` (with ``supplier``), verification from ``events``. Dimensions are
derived from the same data: codes from the distinct status/type/result values,
states from nations, countries from regions, zipcodes from customers, data
sources and files from the staging metadata.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..operators.keys import assign_keys, small_keys
from ..operators.lookup import BROADCAST_MAX_ROWS, bounded_broadcast
from ..operators.staging import conform
from ..sources.calendar import build_d_date
from ..sources.seeds import CODE_CATEGORIES

# Fixed values used across the plans. The batch instant is after every date
# in the data, so "now" checks do not depend on the wall clock.
BATCH_TS = "2002-01-01 00:00:00"
DIM_START_TS = "1990-01-01 00:00:00"       # when the seeded dimension versions begin
SNAPSHOT_DATE = "2000-01-01"                # date of the earlier load used by incremental plans
CALENDAR_START, CALENDAR_END = "1900-01-01", "2099-12-31"

# Which raw column (or rule over it) feeds which code category: the same
# rules the staging frames apply, read straight from the narrow source column.
CODE_SOURCES = [
    ("REG_TYPE", "orders", lambda: F.col("o_orderpriority")),
    ("REG_STATUS", "orders", lambda: F.col("o_orderstatus")),
    ("CLASSIFICATION", "orders", lambda: classification(F.col("o_totalprice"))),
    ("COMP_STATUS", "lineitem", lambda: F.col("l_linestatus")),
    ("COMP_RESULT", "lineitem", lambda: F.col("l_returnflag")),
    ("VERIF_METHOD", "events", lambda: F.col("event_type")),
    ("VERIF_STATUS", "events", lambda: verification_status(F.col("value"))),
    ("VERIF_RESULT", "events", lambda: verification_result(F.col("value"))),
]

# Code categories and source system of each subject's rows.
SUBJECT_CODES = {"registration": ["REG_TYPE", "REG_STATUS", "CLASSIFICATION"],
                 "compliance": ["COMP_STATUS", "COMP_RESULT"],
                 "verification": ["VERIF_METHOD", "VERIF_STATUS", "VERIF_RESULT"]}
SUBJECT_FEED = {"registration": "ORDERS", "compliance": "LINEITEM", "verification": "EVENTS"}

# Low bits of code and file keys; the category or data source is above them.
GROUP_SHIFT = 32

# Source system and daily landing file of each subject's rows.
SOURCE_FILES = [("ORDERS", "orders", "o_orderdate"), ("LINEITEM", "lineitem", "l_shipdate"),
                ("EVENTS", "events", "ts")]


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy frame. The handle (file listing, footer schema)
    is made once per session and path; every action still reads the files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _day_file(prefix: str, ts_col: str):
    return F.concat(F.lit(prefix + "_"), date_key(F.col(ts_col)).cast("string"), F.lit(".parquet"))


def _feed_of(file_col):
    """Feed (source system) named by a landing file: ``orders_19981003.parquet`` → ``ORDERS``."""
    return F.upper(F.substring_index(file_col, "_", 1))


def _state_code(c):
    return F.lpad(F.col(c).cast("string"), 2, "0")


def stg_registration(spark: SparkSession, sf_dir: str, batch_ts: str = BATCH_TS) -> DataFrame:
    """``orders`` ⟕ person/geography data → ``stg_registration`` rows."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nations and regions are fixed reference lists (25 and 5 rows at every scale)
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    people = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
    # customers grow with the data: broadcast only under the checked bound,
    # otherwise a shuffle join on the customer key
    df = o.join(bounded_broadcast(people), o.o_custkey == people.c_custkey, "left")
    out = df.select(
        F.col("o_orderkey").cast("string").alias("registration_id"),
        F.col("c_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("street_address"),
        F.lit(None).cast("string").alias("city"),
        _state_code("c_nationkey").alias("state"),
        F.col("c_custkey").cast("string").alias("zipcode"),
        F.col("r_name").alias("country"),
        F.to_date("o_orderdate").alias("registration_date"),
        F.date_sub(F.lit("1990-06-30").cast("date"),
                   (F.col("c_custkey") * 7919 % 25000).cast("int")).alias("birth_date"),
        F.col("o_orderstatus").alias("registration_status"),
        F.col("o_orderpriority").alias("registration_type"),
        classification(F.col("o_totalprice")).alias("classification"),
        F.col("c_mktsegment").alias("registration_method"),
        _feed_of(_day_file("orders", "o_orderdate")).alias("source_system"),
        _day_file("orders", "o_orderdate").alias("source_file_name"),
    )
    return _stamp(out, schemas.STG_REGISTRATION, batch_ts)


def stg_compliance(spark: SparkSession, sf_dir: str, batch_ts: str = BATCH_TS) -> DataFrame:
    """``lineitem`` (state from the supplier's nation) → ``stg_compliance`` rows."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    df = li.join(bounded_broadcast(s), li.l_suppkey == s.s_suppkey, "left")
    d = F.to_date("l_shipdate")
    out = df.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("compliance_id"),
        F.col("l_orderkey").cast("string").alias("registration_id"),
        d.alias("compliance_date"),
        F.date_add(d, 30).alias("due_date"),
        F.date_add(d, F.col("l_quantity").cast("int")).alias("completion_date"),
        F.col("l_linestatus").alias("compliance_status"),
        F.col("l_returnflag").alias("compliance_result"),
        (F.col("l_returnflag") == "R").alias("is_doj_referral"),
        F.lit("SHIPMENT").alias("source_list_type"),
        F.year("l_shipdate").alias("source_year"),
        _state_code("s_nationkey").alias("state"),
        _feed_of(_day_file("lineitem", "l_shipdate")).alias("source_system"),
        _day_file("lineitem", "l_shipdate").alias("source_file_name"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("compliance_score"),
    )
    return _stamp(out, schemas.STG_COMPLIANCE, batch_ts, extra=["compliance_score"])


def classification(price):
    return F.when(price >= 250000, "PREMIUM").otherwise("STANDARD")


def verification_result(v):
    return F.when(v >= 50, "MATCH").otherwise("NO_MATCH")


def verification_status(v):
    return (F.when(v < 25, "REQUESTED").when(v < 50, "IN_PROGRESS")
            .when(v < 100, "COMPLETED").otherwise("VERIFIED"))


def stg_verification(spark: SparkSession, sf_dir: str, batch_ts: str = BATCH_TS) -> DataFrame:
    """``events`` → ``stg_verification`` rows (score from ``value``)."""
    e = table(spark, sf_dir, "events")
    d = F.to_date("ts")
    v = F.col("value")
    out = e.select(
        F.col("event_id").cast("string").alias("verification_id"),
        F.col("user_id").cast("string").alias("registration_id"),
        d.alias("verification_date"),
        d.alias("request_date"),
        F.date_add(d, F.floor(v / 100).cast("int")).alias("response_date"),
        F.col("event_type").alias("verification_method"),
        verification_status(v).alias("verification_status"),
        verification_result(v).alias("verification_result"),
        F.lit(None).cast("string").alias("interim_status"),
        (v >= 50).alias("is_match"),
        F.least(v, F.lit(999.99)).cast("decimal(5,2)").alias("match_score"),
        F.col("props").alias("verification_flags"),
        F.lit(None).cast("string").alias("state"),
        _feed_of(_day_file("events", "ts")).alias("source_system"),
        _day_file("events", "ts").alias("source_file_name"),
    )
    return _stamp(out, schemas.STG_VERIFICATION, batch_ts)


def _stamp(df: DataFrame, schema, batch_ts: str, extra=()) -> DataFrame:
    out = df.withColumns({"load_timestamp": F.lit(batch_ts).cast("timestamp"),
                          "processing_status": F.lit("PENDING"),
                          "dq_is_valid": F.lit(True)})
    if not extra:
        return conform(out, schema)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in out.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return out.select(*cols, *[F.col(c) for c in extra])


STAGING = {"registration": stg_registration, "compliance": stg_compliance,
           "verification": stg_verification}


def staging(spark: SparkSession, sf_dir: str, subject: str, batch_ts: str = BATCH_TS) -> DataFrame:
    return STAGING[subject](spark, sf_dir, batch_ts)


# ---------------------------------------------------------------- dimensions

def d_date(spark: SparkSession) -> DataFrame:
    """Calendar for the lookups: fixed span, so bounded (73,049 rows) and broadcast."""
    return build_d_date(spark, CALENDAR_START, CALENDAR_END)


def d_code_category(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, cid, name, ctype, desc) for i, (cid, name, ctype, desc) in enumerate(CODE_CATEGORIES)]
    df = spark.createDataFrame(rows, "code_category_key long, code_category_id string, category_name string, "
                                     "category_type string, description string")
    return df.withColumns({"effective_start_dt": F.lit(DIM_START_TS).cast("timestamp"),
                           "effective_end_dt": F.lit(None).cast("timestamp"),
                           "is_active": F.lit(True)})


def high_key(group: str, rank: str):
    """Key of the ``rank``-th member of a group: stable when other groups grow or are left out."""
    return (F.shiftleft(F.col(group).cast("long"), GROUP_SHIFT) + F.col(rank)).cast("long")


def d_code(spark: SparkSession, sf_dir: str, categories=None, dense: bool = False) -> DataFrame:
    """Code dimension from the distinct values of each categorized column.

    Size is bounded by the number of distinct codes. A key holds its category's
    key in the high bits and the code's rank within the category in the low
    ones, so a code has the same key whichever ``categories`` are built. With
    ``dense`` the keys are 1, 2, ... over all categories, all of which are built.
    Each source table is scanned once for all its categorized columns
    ((category, value) pairs exploded per row, aggregated map-side).
    """
    if dense and categories is not None:
        raise ValueError("dense keys number the codes of all categories")
    by_table: dict[str, list] = {}
    for cat, tbl, expr in CODE_SOURCES:
        if categories is not None and cat not in categories:
            continue
        by_table.setdefault(tbl, []).append(F.struct(F.lit(cat).alias("code_category_id"),
                                                     expr().alias("code_value")))
    parts = [table(spark, sf_dir, tbl).select(F.explode(F.array(*items)).alias("c"))
             .select("c.*").filter(F.col("code_value").isNotNull()).distinct()
             for tbl, items in by_table.items()]
    vals = parts[0]
    for p in parts[1:]:
        vals = vals.unionByName(p)
    cats = d_code_category(spark).select("code_category_id", "code_category_key")
    vals = vals.join(F.broadcast(cats), "code_category_id")
    vals = vals.withColumn("display_order", F.row_number().over(
        Window.partitionBy("code_category_id").orderBy("code_value")).cast("int"))
    if dense:
        vals = small_keys(vals, "code_key", ["code_category_key", "code_value"])
    else:
        vals = vals.withColumn("code_key", high_key("code_category_key", "display_order"))
    return vals.select(
        "code_key", F.concat_ws("_", "code_category_id", "code_value").alias("code_id"),
        "code_category_key", "code_value", F.col("code_value").alias("code_description"),
        "display_order", F.lit(DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_active"))


def d_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    keyed = small_keys(r, "country_key", ["r_name"])
    return keyed.select(
        "country_key", F.col("r_name").alias("country_id"), F.col("r_name").alias("country_name"),
        F.substring("r_name", 1, 2).alias("country_code_iso2"),
        F.substring("r_name", 1, 3).alias("country_code_iso3"),
        F.lit(DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_active"),
        "r_regionkey")


def d_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    ctry = d_country(spark, sf_dir).select("r_regionkey", "country_key", "country_name")
    s = n.join(F.broadcast(ctry), n.n_regionkey == ctry.r_regionkey, "left") \
        .withColumn("state_code", _state_code("n_nationkey"))
    keyed = small_keys(s, "state_key", ["state_code"])
    return keyed.select(
        "state_key", F.col("state_code").alias("state_id"), F.col("n_name").alias("state_name"),
        "state_code", "country_key", "country_name",
        F.lit(DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_active"))


def d_zipcode(spark: SparkSession, sf_dir: str, state: DataFrame | None = None) -> DataFrame:
    """One zipcode per customer. Grows with the data, so keys use the
    distributed :func:`assign_keys` and lookups check its size before broadcast."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    st = (state if state is not None else d_state(spark, sf_dir)).select("state_code", "state_key")
    z = c.withColumn("state_code", _state_code("c_nationkey")) \
        .join(F.broadcast(st), "state_code", "left") \
        .withColumn("zipcode", F.col("c_custkey").cast("string"))
    keyed = assign_keys(z, "zipcode_key", ["zipcode"])
    return keyed.select(
        "zipcode_key", F.col("zipcode").alias("zipcode_id"), "zipcode",
        F.lit(None).cast("string").alias("city"), "state_key",
        F.lit(None).cast("decimal(10,6)").alias("latitude"),
        F.lit(None).cast("decimal(10,6)").alias("longitude"),
        F.lit(DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_active"))


def d_data_source(spark: SparkSession) -> DataFrame:
    """One data source per subject feed; keys follow the source system name."""
    src = spark.createDataFrame([(name,) for name, _t, _c in SOURCE_FILES], "source_system string")
    keyed = small_keys(src, "data_source_key", ["source_system"])
    return keyed.select(
        "data_source_key", F.concat(F.lit("SRC_"), "source_system").alias("data_source_id"),
        F.col("source_system").alias("source_name"), F.lit("File").alias("source_type"),
        "source_system", F.lit(None).cast("string").alias("connection_string"),
        F.lit("Daily").alias("schedule_frequency"), F.lit(True).alias("is_enabled"),
        F.lit(DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_active"))


def d_file(spark: SparkSession, sf_dir: str, batch_ts: str = BATCH_TS, feeds=None, dense: bool = False) -> DataFrame:
    """File dimension: one row per landed daily file with its record count.

    Bounded by days × feeds. A key holds its data source's key in the high bits
    and the file's rank by name within that source in the low ones, so it is the
    same whichever ``feeds`` (source systems, all by default) are built. With
    ``dense`` the keys are 1, 2, ... by file name over all feeds. Each feed
    reads its date column only and is aggregated map-side before the shuffle.
    """
    if dense and feeds is not None:
        raise ValueError("dense keys number the files of all feeds")
    parts = []
    for name, tbl, col in SOURCE_FILES:
        if feeds is not None and name not in feeds:
            continue
        parts.append(table(spark, sf_dir, tbl).select(_day_file(tbl, col).alias("file_name"))
                     .groupBy("file_name").agg(F.count(F.lit(1)).alias("record_count"))
                     .withColumn("source_system", F.lit(name)))
    meta = reduce(DataFrame.unionByName, parts)
    src = d_data_source(spark).select("source_system", "data_source_key")
    f = meta.join(F.broadcast(src), "source_system", "left")
    if dense:
        f = small_keys(f, "file_key", ["file_name"])
    else:
        f = f.withColumn("_rank", F.row_number().over(Window.partitionBy("source_system").orderBy("file_name")))
        f = f.withColumn("file_key", high_key("data_source_key", "_rank"))
    return f.select(
        "file_key", F.col("file_name").alias("file_id"), "data_source_key", "file_name",
        F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("long").alias("file_size_bytes"),
        F.col("record_count").cast("long"), F.lit(batch_ts).cast("timestamp").alias("load_timestamp"),
        F.lit("COMPLETED").alias("processing_status"), F.lit(None).cast("string").alias("error_message"))


class Dims(dict):
    """Dimension frames by name; ``small`` names those checked to fit a broadcast."""

    def __init__(self, *a, **kw):
        super().__init__(*a, **kw)
        self.small = set()
        self.calendar_span = None


def dims(spark: SparkSession, sf_dir: str, stg=None, with_zipcode: bool = True, need=None,
         code_categories=None, subject: str | None = None, whole: bool = False) -> Dims:
    """The dimensions a fact build needs.

    Small by construction (no count needed): the calendar (generated over a
    fixed span, and its keys computed inside it), the code categories and
    data sources (seed lists), states and countries (the 25 nations and 5
    regions at every scale). Derived from the data: codes and files; those
    are built once, cached, and counted once against the broadcast bound, so
    lookups broadcast them without counting again and read the cached rows
    instead of re-deriving them from full scans. (In a deployed warehouse
    they are tables.) The zipcode dimension grows with the customers: it is
    neither cached nor assumed small. ``need`` limits the build to the named
    dimensions; ``subject`` to the codes and files of one subject, so only
    its feed is scanned for them; ``code_categories`` to fewer of its codes.
    ``whole`` builds codes and files of all subjects, with dense keys.
    """
    if whole:
        subject = code_categories = None
    if subject is not None and code_categories is None:
        code_categories = SUBJECT_CODES[subject]
    feeds = None if subject is None else [SUBJECT_FEED[subject]]
    makers = {
        "d_date": lambda: d_date(spark),
        "d_code_category": lambda: d_code_category(spark),
        "d_code": lambda: d_code(spark, sf_dir, code_categories, dense=whole),
        "d_state": lambda: d_state(spark, sf_dir),
        "d_country": lambda: d_country(spark, sf_dir),
        "d_data_source": lambda: d_data_source(spark),
        "d_file": lambda: d_file(spark, sf_dir, feeds=feeds, dense=whole),
    }
    bounded = {"d_date", "d_code_category", "d_state", "d_country", "d_data_source"}
    out = Dims()
    for name, make in makers.items():
        if need is not None and name not in need:
            continue
        if name in bounded:
            out[name] = make()
            out.small.add(name)
            continue
        df = make().cache()
        if df.count() <= BROADCAST_MAX_ROWS:
            out.small.add(name)
        out[name] = df
    out.calendar_span = (CALENDAR_START, CALENDAR_END) if "d_date" in out else None
    if with_zipcode and (need is None or "d_zipcode" in need):
        out["d_zipcode"] = d_zipcode(spark, sf_dir, out.get("d_state"))
    return out
