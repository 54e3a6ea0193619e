"""Registered queries: profiles kept per partition and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiles
from ..session import materialize
from . import domain
from .catalog import query
from .oracle import with_ctes

COLUMNS = {
    "registration": ["registration_id", "registration_date", "state", "registration_status", "zipcode", "phone"],
    "compliance": ["compliance_id", "compliance_date", "compliance_score", "source_year", "state"],
    "verification": ["verification_id", "verification_date", "verification_method", "match_score"],
}
NUMERIC = {"compliance_score", "source_year", "match_score"}
DATE = {"registration": "registration_date", "compliance": "compliance_date", "verification": "verification_date"}
POINTS = (0.25, 0.5, 0.75)


def _sql() -> str:
    parts = []
    for subject, cols in COLUMNS.items():
        for c in cols:
            lo, hi = ((f"CAST(min({c}) AS DOUBLE)", f"CAST(max({c}) AS DOUBLE)") if c in NUMERIC else ("NULL", "NULL"))
            tlo, thi = (("NULL", "NULL") if c in NUMERIC else (f"min(CAST({c} AS VARCHAR))", f"max(CAST({c} AS VARCHAR))"))
            parts.append(f"""SELECT '{subject}' AS subject, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
       CAST({lo} AS DOUBLE) AS min_number, CAST({hi} AS DOUBLE) AS max_number, CAST({tlo} AS VARCHAR) AS min_text, CAST({thi} AS VARCHAR) AS max_text,
       count(DISTINCT {c}) AS distinct_count, TRUE AS distinct_within_bound, TRUE AS quantiles_within_bound FROM stg_{subject}""")
    return with_ctes(*[f"stg_{s}" for s in COLUMNS]) + "\nUNION ALL ".join(parts)


@query("profile_merged", "Q-09 A-05 A-02", _sql())
def profile_merged(spark, sf):
    """Each subject's monthly profiles, stored, then merged over all months; the
    distinct and quantile estimates are compared with exact counts over the
    rows, and the result says whether they lie within their stated bounds."""
    out = None
    for subject, cols in COLUMNS.items():
        rows = domain.staging(spark, sf, subject).select(*cols)
        stored = materialize(profiles.profile_partitions(rows, F.date_format(DATE[subject], "yyyyMM"), cols), f"profile-{subject}")
        merged = materialize(profiles.merge_profiles(stored, quantiles=POINTS), f"profile-merged-{subject}")
        one = merged.join(F.broadcast(profiles.exact_distinct(rows, cols)), "column_name", "left")
        one = one.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0).cast("long")))
        if NUMERIC & set(cols):
            one = one.join(F.broadcast(profiles.quantile_ranks(rows, merged)), "column_name", "left")
        else:
            one = one.withColumn("ranks", F.lit(None).cast("array<struct<below:double,upto:double>>"))
        ok = [(F.col("ranks")[i]["below"] - F.col("rank_error") <= q) & (F.col("ranks")[i]["upto"] + F.col("rank_error") >= q) for i, q in enumerate(POINTS)]
        one = one.select(
            F.lit(subject).alias("subject"), "column_name", "row_count", "null_count", "min_number", "max_number", "min_text", "max_text", "distinct_count",
            (F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.ceil(F.col("distinct_error") * F.col("distinct_count"))).alias("distinct_within_bound"),
            F.when(F.col("quantiles").isNull(), F.lit(True)).otherwise(ok[0] & ok[1] & ok[2]).alias("quantiles_within_bound"))
        out = one if out is None else out.unionByName(one)
    return out
