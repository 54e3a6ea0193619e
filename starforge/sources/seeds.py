"""Seed rows of the reference dimensions (D-08, S-04).

Keys are given in insertion order, as an IDENTITY column would number them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code categories (id, name, type, description), in seed order.
CODE_CATEGORIES = [
    ("REG_TYPE", "Registration Type", "registration", "Types of voter registration"),
    ("REG_STATUS", "Registration Status", "registration", "Status of registration"),
    ("COMP_STATUS", "Compliance Status", "compliance", "Compliance check status"),
    ("COMP_RESULT", "Compliance Result", "compliance", "Result of compliance check"),
    ("VERIF_METHOD", "Verification Method", "verification", "Method used for verification"),
    ("VERIF_STATUS", "Verification Status", "verification", "Status of verification"),
    ("VERIF_RESULT", "Verification Result", "verification", "Result of verification"),
    ("CLASSIFICATION", "Classification", "registration", "Registration classification"),
]

# Codes per category (value, description, display order), in seed order.
CODES = {
    "REG_TYPE": [("NEW", "New Registration", 1), ("RENEWAL", "Renewal", 2),
                 ("UPDATE", "Update Existing", 3), ("TRANSFER", "Transfer", 4)],
    "REG_STATUS": [("ACTIVE", "Active", 1), ("INACTIVE", "Inactive", 2), ("PENDING", "Pending", 3),
                   ("CANCELLED", "Cancelled", 4), ("SUSPENDED", "Suspended", 5)],
}

# Data sources (id, name, type, source system, schedule). System names are
# the seeded ones without the platform-name prefix they carry in the seed script.
DATA_SOURCES = [
    ("SRC_INTERNET", "Internet", "Online", "Web Portal", "Real-time"),
    ("SRC_IVR", "IVR", "Phone", "IVR System", "Real-time"),
    ("SRC_DMV", "DMV", "Integration", "DMV System", "Daily"),
    ("SRC_BATCH", "Batch File", "File", "Batch Processing", "Daily"),
    ("SRC_MOBILE", "Mobile App", "Mobile", "Mobile App", "Real-time"),
]

# Country (id, name, iso2, iso3) and states (code, name).
COUNTRIES = [("USA", "United States", "US", "USA")]
STATES = [("CA", "California"), ("NY", "New York"), ("TX", "Texas"), ("FL", "Florida")]


def _scd(df: DataFrame, ts) -> DataFrame:
    return df.withColumns({"effective_start_dt": F.lit(ts).cast("timestamp"),
                           "effective_end_dt": F.lit(None).cast("timestamp"),
                           "is_active": F.lit(True)})


def seed_dimensions(spark: SparkSession, batch_ts: str, extra_states=()) -> dict[str, DataFrame]:
    """The seeded dimensions: code categories, codes, data sources, country, states.

    Codes get their category key the way the seed's scalar subquery does
    (J-19): a join on the category id. ``extra_states`` adds (code, name)
    rows after the four seeded states.
    """
    cats = spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(CODE_CATEGORIES)],
        "code_category_key long, code_category_id string, category_name string, category_type string, "
        "description string")
    code_rows, k = [], 0
    for cat, rows in CODES.items():
        for seq, (value, desc, order) in enumerate(rows, start=1):
            k += 1
            code_rows.append((k, f"{cat}_{seq}", cat, value, desc, order))
    codes = spark.createDataFrame(code_rows, "code_key long, code_id string, cat string, code_value string, "
                                             "code_description string, display_order int")
    codes = codes.join(F.broadcast(cats.select("code_category_key", F.col("code_category_id").alias("cat"))),
                       "cat").drop("cat")
    sources = spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(DATA_SOURCES)],
        "data_source_key long, data_source_id string, source_name string, source_type string, "
        "source_system string, schedule_frequency string").withColumn("is_enabled", F.lit(True))
    country = spark.createDataFrame([(i + 1, *row) for i, row in enumerate(COUNTRIES)],
                                    "country_key long, country_id string, country_name string, "
                                    "country_code_iso2 string, country_code_iso3 string")
    states = spark.createDataFrame(
        [(i + 1, code, name, code, 1) for i, (code, name) in enumerate([*STATES, *extra_states])],
        "state_key long, state_id string, state_name string, state_code string, country_key long") \
        .join(F.broadcast(country.select("country_key", "country_name")), "country_key", "left")
    return {"d_code_category": _scd(cats, batch_ts), "d_code": _scd(codes, batch_ts),
            "d_data_source": _scd(sources, batch_ts), "d_country": _scd(country, batch_ts),
            "d_state": _scd(states, batch_ts)}
