"""Registered queries: one per operator group of the inventory, each with its
reference SQL. Every query reads the driver's tables (or frames Spark derives
from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.calendar import build_d_date
from ..operators import quality
from . import domain, warehouse
from .oracle import TS, dk, safe_hash, with_ctes

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None, str]] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn):
        REGISTRY[name] = (fn, sql, ids)
        return fn
    return deco


# ------------------------------------------------------------------ flagship

@query("agg_registration_monthly", "A-19 A-03 J-11 X-01 J-02 J-03", with_ctes("stg_registration", "d_state") + """
SELECT CAST(year(r.registration_date) AS INTEGER) AS year, CAST(month(r.registration_date) AS INTEGER) AS month,
       s.state_name, r.registration_status AS status, COUNT(*) AS registration_count
FROM stg_registration r LEFT JOIN d_state s ON r.state = s.state_code
GROUP BY 1, 2, 3, 4""")
def agg_registration_monthly(spark, sf):
    """Monthly count by state and status over the star (the BI aggregate table)."""
    st = warehouse.registration_star(spark, sf, ("reg", "state", "status"))
    return (st.groupBy(F.col("reg_year").alias("year"), F.col("reg_month").alias("month"),
                       "state_name", F.col("status_code_value").alias("status"))
            .agg(F.count(F.lit(1)).alias("registration_count")))


@query("agg_registration_daily", "A-19 A-03", with_ctes("stg_registration") + f"""
SELECT {dk('registration_date')} AS date_key, registration_status AS status, registration_type AS type,
       COUNT(*) AS registration_count
FROM stg_registration GROUP BY 1, 2, 3""")
def agg_registration_daily(spark, sf):
    st = warehouse.registration_star(spark, sf, ("status", "type"))
    return (st.groupBy(F.col("registration_date_key").alias("date_key"),
                       F.col("status_code_value").alias("status"), F.col("type_code_value").alias("type"))
            .agg(F.count(F.lit(1)).alias("registration_count")))


# ------------------------------------------------------------------ calendar

@query("d_date", "D-07 S-05 F-05 F-06 F-07 F-08 F-09 F-10 F-14 W-01", """
WITH b AS (SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS s,
                  make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS e FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_value,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
       CAST(year(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, CAST(quarter(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter
FROM days""")
def d_date(spark, sf):
    """Date dimension spanning the whole years of the order dates."""
    o = domain.table(spark, sf, "orders")
    bounds = o.agg(F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("s"),
                   F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("e"))
    return build_d_date(spark, "s", "e", bounds=bounds)


# ------------------------------------------------------------------ facts

def _registration_sql(whole: bool) -> str:
    return with_ctes("stg_registration", "d_code", "d_state", "d_zipcode", "d_data_source", "d_file",
                          extra="""ft AS (
  SELECT s.*, row_number() OVER (PARTITION BY first_name, last_name, birth_date
                                 ORDER BY registration_date, registration_id) - 1 AS prev
  FROM stg_registration s WHERE dq_is_valid)""", whole=whole) + f"""
SELECT row_number() OVER (ORDER BY ft.registration_id) AS registration_key, ft.registration_id,
       {dk('ft.registration_date')} AS registration_date_key, {dk('ft.birth_date')} AS birth_date_key,
       {dk('ft.registration_date')} AS effective_date_key,
       cs.code_key AS registration_status_code_key, ct.code_key AS registration_type_code_key,
       cc.code_key AS classification_code_key, z.zipcode_key, st.state_key, st.country_key,
       ds.data_source_key, f.file_key,
       CAST(year(ft.registration_date) - year(ft.birth_date)
            - CASE WHEN month(ft.registration_date) * 100 + day(ft.registration_date)
                        < month(ft.birth_date) * 100 + day(ft.birth_date) THEN 1 ELSE 0 END AS INTEGER)
         AS age_at_registration,
       ft.registration_method, ft.prev = 0 AS is_first_time_registration,
       CAST(ft.prev AS INTEGER) AS previous_registration_count,
       ft.source_system AS source_system_id, 1 AS source_record_version,
       {safe_hash(['ft.registration_id', 'ft.registration_status'])} AS record_hash,
       {TS} AS created_dt, {TS} AS updated_dt
FROM ft
LEFT JOIN d_code cs ON cs.code_category_id = 'REG_STATUS' AND cs.code_value = ft.registration_status
LEFT JOIN d_code ct ON ct.code_category_id = 'REG_TYPE' AND ct.code_value = ft.registration_type
LEFT JOIN d_code cc ON cc.code_category_id = 'CLASSIFICATION' AND cc.code_value = ft.classification
LEFT JOIN d_zipcode z ON z.zipcode = ft.zipcode
LEFT JOIN d_state st ON st.state_code = ft.state
LEFT JOIN d_data_source ds ON ds.source_system = ft.source_system
LEFT JOIN d_file f ON f.file_name = ft.source_file_name"""


@query("fact_registration", "X-01 J-02 J-03 J-04 J-05 J-06 J-16 F-13 W-07 W-08 D-01 P-03 P-05 F-01 F-02 F-04 F-15 P-01 P-02 S-03", _registration_sql(True))
def fact_registration(spark, sf):
    return warehouse.fact(spark, sf, "registration", keys=True, zipcode=True, person_counts=True, whole=True)


def _compliance_sql(whole: bool) -> str:
    return with_ctes("stg_compliance", "d_code", "d_state", "d_data_source", "d_file", whole=whole) + f"""
SELECT row_number() OVER (ORDER BY s.compliance_id,
         {safe_hash(['s.compliance_id', 's.compliance_status', 's.compliance_result'])},
         {dk('s.compliance_date')} NULLS FIRST, {dk('s.completion_date')} NULLS FIRST,
         s.compliance_score NULLS FIRST, st.state_key NULLS FIRST, s.registration_id NULLS FIRST)
       AS compliance_key, s.compliance_id, s.registration_id,
       {dk('s.compliance_date')} AS compliance_date_key, {dk('s.due_date')} AS due_date_key,
       {dk('s.completion_date')} AS completion_date_key,
       cs.code_key AS compliance_status_code_key, cr.code_key AS compliance_result_code_key,
       st.state_key, ds.data_source_key, f.file_key, s.is_doj_referral, s.compliance_score,
       CAST(s.completion_date - s.compliance_date AS INTEGER) AS days_to_completion,
       s.source_list_type, s.source_year, s.error_message, 0 AS retry_count,
       s.source_system AS source_system_id,
       {safe_hash(['s.compliance_id', 's.compliance_status', 's.compliance_result'])} AS record_hash,
       {TS} AS created_dt, {TS} AS updated_dt
FROM stg_compliance s
LEFT JOIN d_code cs ON cs.code_category_id = 'COMP_STATUS' AND cs.code_value = s.compliance_status
LEFT JOIN d_code cr ON cr.code_category_id = 'COMP_RESULT' AND cr.code_value = s.compliance_result
LEFT JOIN d_state st ON st.state_code = s.state
LEFT JOIN d_data_source ds ON ds.source_system = s.source_system
LEFT JOIN d_file f ON f.file_name = s.source_file_name"""


@query("fact_compliance", "X-02 J-07 F-12", _compliance_sql(True))
def fact_compliance(spark, sf):
    return warehouse.fact(spark, sf, "compliance", keys=True, whole=True)


def _verification_sql(whole: bool) -> str:
    return with_ctes("stg_verification", "d_code", "d_state", "d_data_source", "d_file", whole=whole) + f"""
SELECT row_number() OVER (ORDER BY s.verification_id) AS verification_key, s.verification_id, s.registration_id,
       {dk('s.verification_date')} AS verification_date_key, {dk('s.request_date')} AS request_date_key,
       {dk('s.response_date')} AS response_date_key,
       cm.code_key AS verification_method_code_key, cs.code_key AS verification_status_code_key,
       cr.code_key AS verification_result_code_key, st.state_key, ds.data_source_key, f.file_key,
       s.is_match, s.match_score, s.interim_status, s.verification_flags,
       CAST(date_diff('second', CAST(s.request_date AS TIMESTAMP), CAST(s.response_date AS TIMESTAMP)) AS INTEGER)
         AS response_time_seconds,
       s.error_message, 0 AS retry_count, s.source_system AS source_system_id,
       {safe_hash(['s.verification_id', 's.verification_status', 's.verification_result'])} AS record_hash,
       {TS} AS created_dt, {TS} AS updated_dt
FROM stg_verification s
LEFT JOIN d_code cm ON cm.code_category_id = 'VERIF_METHOD' AND cm.code_value = s.verification_method
LEFT JOIN d_code cs ON cs.code_category_id = 'VERIF_STATUS' AND cs.code_value = s.verification_status
LEFT JOIN d_code cr ON cr.code_category_id = 'VERIF_RESULT' AND cr.code_value = s.verification_result
LEFT JOIN d_state st ON st.state_code = s.state
LEFT JOIN d_data_source ds ON ds.source_system = s.source_system
LEFT JOIN d_file f ON f.file_name = s.source_file_name"""


@query("fact_verification", "X-03 J-08 F-12", _verification_sql(True))
def fact_verification(spark, sf):
    return warehouse.fact(spark, sf, "verification", keys=True, whole=True)


#: SQL of each fact; off ``whole``, with code and file keys per category and feed.
FACT_SQL = {"registration": _registration_sql, "compliance": _compliance_sql, "verification": _verification_sql}


# ------------------------------------------------------------------ data quality

def _dq_sql(subject: str, idc: str, datec: str, required: list[str], dup_rows: bool = True) -> str:
    stg = f"stg_{subject}"
    rate = ("CAST(round(CASE WHEN n > 0 THEN (n - {f}) * 100.0 / n ELSE 0 END, 2) AS DECIMAL(5,2))")
    rows = []
    for c in required:
        f = f"nn_{c}"
        r = rate.format(f=f)
        rows.append(f"""SELECT 'staging.{stg}' AS table_name, '{c}_not_null' AS check_name, 'COMPLETENESS' AS check_type,
       {TS} AS check_timestamp, n AS records_checked, n - {f} AS records_passed, {f} AS records_failed,
       {r} AS pass_rate, CAST(100.0 AS DECIMAL(5,2)) AS threshold,
       CASE WHEN {r} = 100 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(NULL AS VARCHAR) AS details FROM c""")
    r = rate.format(f="bad_date")
    rows.append(f"""SELECT 'staging.{stg}', '{datec}_valid_range', 'VALIDITY', {TS}, n, n - bad_date, bad_date,
       {r}, CAST(99.0 AS DECIMAL(5,2)), CASE WHEN {r} >= 99 THEN 'PASS' ELSE 'FAIL' END, NULL FROM c""")
    r = rate.format(f="dup_keys")
    rows.append(f"""SELECT 'staging.{stg}', '{idc}_unique', 'CONSISTENCY', {TS}, n, n - dup_keys, dup_keys,
       {r}, CAST(100.0 AS DECIMAL(5,2)), CASE WHEN {r} = 100 THEN 'PASS' ELSE 'FAIL' END,
       'duplicate_rows=' || CAST(dup_rows AS VARCHAR) FROM c""")
    nn = ", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nn_{c}" for c in required)
    return with_ctes(stg) + f""", c AS (
  SELECT CAST(count(*) AS BIGINT) AS n, {nn},
         CAST(count(*) FILTER (WHERE {datec} < DATE '1900-01-01' OR {datec} > {TS}) AS BIGINT) AS bad_date,
         (SELECT CAST(count(*) AS BIGINT) FROM (SELECT {idc} FROM {stg} GROUP BY {idc} HAVING count(*) > 1)) AS dup_keys,
         (SELECT CAST(coalesce(sum(k), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM {stg} GROUP BY {idc} HAVING count(*) > 1)) AS dup_rows
  FROM {stg})
""" + "\nUNION ALL\n".join(rows)


for _subj, _id, _date, _req in [
        ("registration", "registration_id", "registration_date", ["registration_id", "registration_date", "registration_status"]),
        ("compliance", "compliance_id", "compliance_date", ["compliance_id", "compliance_date", "compliance_status"]),
        ("verification", "verification_id", "verification_date", ["verification_id", "verification_date", "verification_status"])]:
    def _make(subj):
        def fn(spark, sf):
            return quality.run_checks(domain.staging(spark, sf, subj), subj, domain.BATCH_TS)
        fn.__name__ = f"dq_{subj}"
        return fn
    query(f"dq_{_subj}", "Q-01 Q-02 Q-03 Q-07 S-09 F-03 F-18 F-19 P-06 P-07 P-01 P-02", _dq_sql(_subj, _id, _date, _req))(_make(_subj))


# more registered queries live in sibling modules; importing them registers them
from . import q_census, q_flows, q_loads, q_ops, q_partitions, q_profiles, q_quality, q_reports, q_scd  # noqa: E402,F401
