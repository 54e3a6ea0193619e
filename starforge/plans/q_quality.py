"""Registered queries: row flags, failures, profile, conformity, integrity, duplicates, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import lookup, measures, quality, staging
from . import domain
from .catalog import REGISTRY, query
from .oracle import TS, with_ctes


@query("dq_flags_compliance", "Q-06 P-05", with_ctes("stg_compliance") + f""",
d AS (SELECT compliance_id, count(*) AS n FROM stg_compliance GROUP BY 1)
SELECT s.compliance_id, s.compliance_date, errs IS NULL AS dq_is_valid, errs AS dq_validation_errors
FROM (
  SELECT s.*, NULLIF(concat_ws(';',
           CASE WHEN s.compliance_id IS NULL THEN 'compliance_id_not_null' END,
           CASE WHEN s.compliance_date IS NULL THEN 'compliance_date_not_null' END,
           CASE WHEN s.compliance_status IS NULL THEN 'compliance_status_not_null' END,
           CASE WHEN s.compliance_date < DATE '1900-01-01' OR s.compliance_date > {TS}
                THEN 'compliance_date_valid_range' END,
           CASE WHEN d.n > 1 AND s.compliance_id IS NOT NULL THEN 'compliance_id_unique' END), '') AS errs
  FROM stg_compliance s LEFT JOIN d ON d.compliance_id IS NOT DISTINCT FROM s.compliance_id) s""")
def dq_flags_compliance(spark, sf):
    """Row-level flags: valid or not, and which checks each row fails."""
    flagged = quality.flag_rows(domain.staging(spark, sf, "compliance"), "compliance", domain.BATCH_TS)
    return flagged.select("compliance_id", "compliance_date", "dq_is_valid", "dq_validation_errors")


@query("dq_error_frequency", "A-15", with_ctes("stg_compliance") + """,
d AS (SELECT compliance_id, count(*) AS n FROM stg_compliance GROUP BY 1)
SELECT 'compliance_id_unique' AS error, CAST(sum(n) AS BIGINT) AS occurrences FROM d WHERE n > 1""")
def dq_error_frequency(spark, sf):
    """How often each validation error occurs across the flagged rows."""
    flagged = quality.flag_rows(domain.staging(spark, sf, "compliance"), "compliance", domain.BATCH_TS)
    return measures.error_frequency(flagged)


def _failures_sql():
    parts = [f"SELECT * FROM ({REGISTRY[f'dq_{s}'][1]}) WHERE status = 'FAIL'"
             for s in ("registration", "compliance", "verification")]
    return "\nUNION ALL\n".join(parts)


@query("dq_failures", "Q-08 Q-07", _failures_sql())
def dq_failures(spark, sf):
    """Failed checks of the three subjects (the alert list)."""
    res = None
    for s in ("registration", "compliance", "verification"):
        r = quality.run_checks(domain.staging(spark, sf, s), s, domain.BATCH_TS)
        res = r if res is None else res.unionByName(r)
    return quality.failures(res)


_PROFILE_COLS = ["registration_id", "registration_date", "registration_status", "registration_type",
                 "state", "zipcode", "birth_date"]


@query("dq_profile_registration", "Q-09 A-02 A-05", with_ctes("stg_registration") + "\n".join(
    ("" if i == 0 else "UNION ALL ") +
    f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS row_count, "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value FROM stg_registration"
    for i, c in enumerate(_PROFILE_COLS)))
def dq_profile_registration(spark, sf):
    """Profile of the registration staging table: one aggregate pass for all columns."""
    return quality.profile(domain.staging(spark, sf, "registration"), _PROFILE_COLS)


def _types_sql():
    rows = []
    for fl in schemas.STG_REGISTRATION.fields:
        n = fl.metadata.get("max_length")
        bad = f"count(*) FILTER (WHERE length({fl.name}) > {n})" if n else "0"
        rows.append(f"""SELECT 'staging.stg_registration' AS table_name, '{fl.name}_type' AS check_name,
  'CONFORMITY' AS check_type, {TS} AS check_timestamp, CAST(count(*) AS BIGINT) AS records_checked,
  CAST(count(*) - {bad} AS BIGINT) AS records_passed, CAST({bad} AS BIGINT) AS records_failed,
  CAST(round(CASE WHEN count(*) > 0 THEN (count(*) - {bad}) * 100.0 / count(*) ELSE 0 END, 2) AS DECIMAL(5,2)) AS pass_rate,
  CAST(100.0 AS DECIMAL(5,2)) AS threshold,
  CASE WHEN count(*) > 0 AND {bad} = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(NULL AS VARCHAR) AS details FROM stg_registration""")
    return with_ctes("stg_registration") + "\nUNION ALL\n".join(rows)


@query("dq_types_registration", "Q-05", _types_sql())
def dq_types_registration(spark, sf):
    """Type and length conformity of every staging column against its declared type."""
    return quality.check_types(domain.staging(spark, sf, "registration"), schemas.STG_REGISTRATION,
                               "staging.stg_registration", domain.BATCH_TS)


@query("dq_refs_compliance", "Q-04 J-12", with_ctes("stg_registration", "stg_compliance") + f"""
, c AS (SELECT CAST(count(*) AS BIGINT) AS n,
               CAST(count(*) FILTER (WHERE s.registration_id IS NOT NULL AND NOT EXISTS (
                   SELECT 1 FROM stg_registration r WHERE r.registration_id = s.registration_id)) AS BIGINT) AS bad
        FROM stg_compliance s)
SELECT 'staging.stg_compliance' AS table_name, 'registration_id_references_registration_id' AS check_name,
       'INTEGRITY' AS check_type, {TS} AS check_timestamp, n AS records_checked, n - bad AS records_passed,
       bad AS records_failed,
       CAST(round(CASE WHEN n > 0 THEN (n - bad) * 100.0 / n ELSE 0 END, 2) AS DECIMAL(5,2)) AS pass_rate,
       CAST(100.0 AS DECIMAL(5,2)) AS threshold,
       CASE WHEN n > 0 AND bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(NULL AS VARCHAR) AS details
FROM c""")
def dq_refs_compliance(spark, sf):
    """Referential integrity: every compliance check points at a staged registration."""
    return quality.check_refs(domain.staging(spark, sf, "compliance"), domain.staging(spark, sf, "registration"),
                              "registration_id", "registration_id", "staging.stg_compliance", domain.BATCH_TS)


@query("orphans", "J-12", with_ctes("stg_registration", "stg_compliance") + """
SELECT r.registration_id, r.registration_date FROM stg_registration r
WHERE NOT EXISTS (SELECT 1 FROM stg_compliance c WHERE c.registration_id = r.registration_id)""")
def orphans(spark, sf):
    """Registrations without any compliance check (anti join on the business key)."""
    reg = domain.staging(spark, sf, "registration").select("registration_id", "registration_date")
    comp = domain.staging(spark, sf, "compliance").select("registration_id")
    return lookup.orphans(reg, comp, "registration_id", "registration_id")


@query("duplicates", "A-06 Q-03", with_ctes("stg_compliance") + """
SELECT compliance_id, CAST(count(*) AS BIGINT) AS row_count FROM stg_compliance GROUP BY 1 HAVING count(*) > 1""")
def duplicates(spark, sf):
    return measures.duplicates(domain.staging(spark, sf, "compliance"), ["compliance_id"])


_LATEST_COLS = ["compliance_date", "completion_date", "compliance_score", "compliance_result",
                "compliance_status", "state", "registration_id"]


@query("latest_per_key", "A-13 T-04 D6", with_ctes("stg_compliance") + f"""
SELECT compliance_id, {', '.join(_LATEST_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY compliance_id ORDER BY
         {', '.join(c + ' DESC NULLS LAST' for c in _LATEST_COLS)}) AS rn FROM stg_compliance) WHERE rn = 1""")
def latest_per_key(spark, sf):
    """One compliance row per id, the newest (deterministic full tie-break);
    ``max_by`` aggregates map-side so a heavily repeated id stays cheap."""
    s = domain.staging(spark, sf, "compliance").select("compliance_id", *_LATEST_COLS)
    return staging.latest_per_key_agg(s, ["compliance_id"], _LATEST_COLS[0], _LATEST_COLS[1:])


@query("date_stats", "A-04 A-05", with_ctes("stg_registration", "stg_compliance", "stg_verification") + """
SELECT 'registration' AS subject, min(registration_date) AS min_date, max(registration_date) AS max_date,
       CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT registration_id) AS BIGINT) AS distinct_keys
FROM stg_registration
UNION ALL SELECT 'compliance', min(compliance_date), max(compliance_date), count(*), count(DISTINCT compliance_id)
FROM stg_compliance
UNION ALL SELECT 'verification', min(verification_date), max(verification_date), count(*),
       count(DISTINCT verification_id) FROM stg_verification""")
def date_stats(spark, sf):
    """Date range, rows and distinct ids of each staged subject."""
    out = None
    for s in ("registration", "compliance", "verification"):
        cfg = schemas.subject(s)
        r = measures.date_stats(domain.staging(spark, sf, s), cfg["date"], cfg["id"]) \
            .select(F.lit(s).alias("subject"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@query("code_dimension", "D-08 S-04 J-19 U-02 A-14", with_ctes("d_code", whole=True) + """
SELECT code_key, code_id, code_category_key, code_value,
       CAST(row_number() OVER (PARTITION BY code_category_key ORDER BY code_value) AS INTEGER) AS display_order
FROM d_code""")
def code_dimension(spark, sf):
    """Code dimension built from the categorized values, keyed per category order."""
    return domain.d_code(spark, sf, dense=True).select("code_key", "code_id", "code_category_key", "code_value",
                                           "display_order")


@query("file_information", "D-09", with_ctes("d_file", "d_data_source") + """
SELECT f.file_key, f.file_name, CAST(f.record_count AS BIGINT) AS record_count, s.data_source_key
FROM d_file f JOIN d_data_source s ON s.source_system = CASE
  WHEN f.file_name LIKE 'orders\\_%' ESCAPE '\\' THEN 'ORDERS'
  WHEN f.file_name LIKE 'lineitem\\_%' ESCAPE '\\' THEN 'LINEITEM' ELSE 'EVENTS' END""")
def file_information(spark, sf):
    """One row per landed daily file with its record count and source."""
    return domain.d_file(spark, sf).select("file_key", "file_name", "record_count", "data_source_key")


@query("geo_hierarchy", "J-16 J-04 F-17", with_ctes("d_state") + """
SELECT CAST(c.c_custkey AS VARCHAR) AS zipcode, s.state_name, s.country_name,
       left(s.country_name, 2) AS country_code_iso2
FROM customer c LEFT JOIN d_state s ON lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') = s.state_code""")
def geo_hierarchy(spark, sf):
    """Zipcode → state → country, walking the snowflake one level at a time."""
    c = domain.table(spark, sf, "customer")
    base = c.select(F.col("c_custkey").cast("string").alias("zipcode"),
                    F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code"))
    out = lookup.hierarchy(base, [(domain.d_state(spark, sf), "state_code", ["state_name", "country_key"]),
                                  (domain.d_country(spark, sf), "country_key",
                                   ["country_name", "country_code_iso2"])])
    return out.select("zipcode", "state_name", "country_name", "country_code_iso2")


@query("landed_files", "D-09 S-01", "\nUNION ALL ".join(
    f"SELECT '{name}' AS source_system, '{tbl}.parquet' AS file_name, count(*) AS record_count FROM {tbl}" for name, tbl, _c in domain.SOURCE_FILES))
def landed_files(spark, sf):
    """One row per landed source file with its record count, from the file
    metadata of the reads (its size, which SQL can't see, is left out; the SQL
    is for tables of one file each)."""
    from ..sources.files import file_information
    out = None
    for name, tbl, _c in domain.SOURCE_FILES:
        f = file_information(domain.table(spark, sf, tbl), name)
        out = f if out is None else out.unionByName(f)
    return out.select("source_system", "file_name", F.col("record_count").cast("long"))
