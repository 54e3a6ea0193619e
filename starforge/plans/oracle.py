"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans, as plain SQL over the driver's
tables, so the comparison checks semantics rather than shared code. The CTEs
below restate the staging and dimension rules of ``domain.py``.
"""

from __future__ import annotations

from .domain import BATCH_TS, CODE_CATEGORIES, DIM_START_TS

TS = f"TIMESTAMP '{BATCH_TS}'"
DIM_TS = f"TIMESTAMP '{DIM_START_TS}'"


def dk(expr: str) -> str:
    """yyyyMMdd integer of a date expression."""
    return f"CAST(strftime(CAST({expr} AS DATE), '%Y%m%d') AS INTEGER)"


def safe_hash(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '\\N')"
                      for c in cols)
    return f"md5(concat_ws('|', {parts}))"


CTE = {}

CTE["stg_registration"] = f"""stg_registration AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS registration_id,
         c.c_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
         lower(replace(c.c_name, '#', '.')) || '@example.com' AS email,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS street_address,
         CAST(NULL AS VARCHAR) AS city,
         lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS state,
         CAST(c.c_custkey AS VARCHAR) AS zipcode,
         r.r_name AS country,
         CAST(o.o_orderdate AS DATE) AS registration_date,
         CAST(DATE '1990-06-30' - CAST((c.c_custkey * 7919) % 25000 AS INTEGER) AS DATE) AS birth_date,
         o.o_orderstatus AS registration_status,
         o.o_orderpriority AS registration_type,
         CASE WHEN o.o_totalprice >= 250000 THEN 'PREMIUM' ELSE 'STANDARD' END AS classification,
         c.c_mktsegment AS registration_method,
         'ORDERS' AS source_system,
         'orders_' || strftime(o.o_orderdate, '%Y%m%d') || '.parquet' AS source_file_name,
         {TS} AS load_timestamp, 'PENDING' AS processing_status,
         CAST(NULL AS VARCHAR) AS error_message, TRUE AS dq_is_valid,
         CAST(NULL AS VARCHAR) AS dq_validation_errors
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

CTE["stg_compliance"] = f"""stg_compliance AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS compliance_id,
         CAST(l.l_orderkey AS VARCHAR) AS registration_id,
         CAST(l.l_shipdate AS DATE) AS compliance_date,
         CAST(CAST(l.l_shipdate AS DATE) + 30 AS DATE) AS due_date,
         CAST(CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) AS DATE) AS completion_date,
         l.l_linestatus AS compliance_status, l.l_returnflag AS compliance_result,
         l.l_returnflag = 'R' AS is_doj_referral, 'SHIPMENT' AS source_list_type,
         CAST(year(l.l_shipdate) AS INTEGER) AS source_year,
         lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS state,
         'LINEITEM' AS source_system,
         'lineitem_' || strftime(l.l_shipdate, '%Y%m%d') || '.parquet' AS source_file_name,
         {TS} AS load_timestamp, 'PENDING' AS processing_status,
         CAST(NULL AS VARCHAR) AS error_message, TRUE AS dq_is_valid,
         CAST(NULL AS VARCHAR) AS dq_validation_errors,
         CAST(l.l_discount * 100 AS DECIMAL(5,2)) AS compliance_score
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

CTE["stg_verification"] = f"""stg_verification AS (
  SELECT CAST(event_id AS VARCHAR) AS verification_id, CAST(user_id AS VARCHAR) AS registration_id,
         CAST(ts AS DATE) AS verification_date, CAST(ts AS DATE) AS request_date,
         CAST(CAST(ts AS DATE) + CAST(floor(value / 100) AS INTEGER) AS DATE) AS response_date,
         event_type AS verification_method,
         CASE WHEN value < 25 THEN 'REQUESTED' WHEN value < 50 THEN 'IN_PROGRESS'
              WHEN value < 100 THEN 'COMPLETED' ELSE 'VERIFIED' END AS verification_status,
         CASE WHEN value >= 50 THEN 'MATCH' ELSE 'NO_MATCH' END AS verification_result,
         CAST(NULL AS VARCHAR) AS interim_status, value >= 50 AS is_match,
         CAST(least(value, 999.99) AS DECIMAL(5,2)) AS match_score,
         props AS verification_flags, CAST(NULL AS VARCHAR) AS state,
         'EVENTS' AS source_system,
         'events_' || strftime(ts, '%Y%m%d') || '.parquet' AS source_file_name,
         {TS} AS load_timestamp, 'PENDING' AS processing_status,
         CAST(NULL AS VARCHAR) AS error_message, TRUE AS dq_is_valid,
         CAST(NULL AS VARCHAR) AS dq_validation_errors
  FROM events
)"""

_cats = ", ".join(f"({i + 1}, '{cid}')" for i, (cid, *_r) in enumerate(CODE_CATEGORIES))
CTE["d_code_category"] = f"""d_code_category AS (
  SELECT * FROM (VALUES {_cats}) t(code_category_key, code_category_id)
)"""

CTE["d_code"] = """code_vals AS (
  SELECT DISTINCT 'REG_TYPE' AS cid, o_orderpriority AS v FROM orders
  UNION ALL SELECT DISTINCT 'REG_STATUS', o_orderstatus FROM orders
  UNION ALL SELECT DISTINCT 'CLASSIFICATION', CASE WHEN o_totalprice >= 250000 THEN 'PREMIUM' ELSE 'STANDARD' END FROM orders
  UNION ALL SELECT DISTINCT 'COMP_STATUS', l_linestatus FROM lineitem
  UNION ALL SELECT DISTINCT 'COMP_RESULT', l_returnflag FROM lineitem
  UNION ALL SELECT DISTINCT 'VERIF_METHOD', event_type FROM events
  UNION ALL SELECT DISTINCT 'VERIF_STATUS', CASE WHEN value < 25 THEN 'REQUESTED' WHEN value < 50 THEN 'IN_PROGRESS'
                                                 WHEN value < 100 THEN 'COMPLETED' ELSE 'VERIFIED' END FROM events
  UNION ALL SELECT DISTINCT 'VERIF_RESULT', CASE WHEN value >= 50 THEN 'MATCH' ELSE 'NO_MATCH' END FROM events
),
d_code AS (
  SELECT k.code_category_key * 4294967296 + row_number() OVER (PARTITION BY k.code_category_key ORDER BY v.v) AS code_key,
         v.cid || '_' || v.v AS code_id, k.code_category_key, k.code_category_id,
         v.v AS code_value, TRUE AS is_active
  FROM code_vals v JOIN d_code_category k ON v.cid = k.code_category_id
  WHERE v.v IS NOT NULL
)"""

CTE["d_country"] = """d_country AS (
  SELECT row_number() OVER (ORDER BY r_name) AS country_key, r_name AS country_id,
         r_name AS country_name, r_regionkey
  FROM region
)"""

CTE["d_state"] = """d_state AS (
  SELECT row_number() OVER (ORDER BY lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')) AS state_key,
         lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS state_code, n.n_name AS state_name,
         c.country_key, c.country_name
  FROM nation n LEFT JOIN d_country c ON n.n_regionkey = c.r_regionkey
)"""

CTE["d_zipcode"] = """d_zipcode AS (
  SELECT row_number() OVER (ORDER BY CAST(c.c_custkey AS VARCHAR)) AS zipcode_key,
         CAST(c.c_custkey AS VARCHAR) AS zipcode, s.state_key
  FROM customer c LEFT JOIN d_state s ON lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') = s.state_code
)"""

CTE["d_data_source"] = """d_data_source AS (
  SELECT row_number() OVER (ORDER BY source_system) AS data_source_key, source_system
  FROM (VALUES ('ORDERS'), ('LINEITEM'), ('EVENTS')) t(source_system)
)"""

CTE["d_file"] = """d_file AS (
  SELECT d.data_source_key * 4294967296 + row_number() OVER (PARTITION BY d.data_source_key ORDER BY t.file_name) AS file_key,
         t.file_name, t.record_count
  FROM (SELECT 'ORDERS' AS source_system, 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS file_name, count(*) AS record_count
        FROM orders GROUP BY 2
        UNION ALL SELECT 'LINEITEM', 'lineitem_' || strftime(l_shipdate, '%Y%m%d') || '.parquet', count(*) FROM lineitem GROUP BY 2
        UNION ALL SELECT 'EVENTS', 'events_' || strftime(ts, '%Y%m%d') || '.parquet', count(*) FROM events GROUP BY 2) t
  JOIN d_data_source d ON d.source_system = t.source_system
)"""

# The same dimensions keyed densely over all categories and all feeds.
CTE_WHOLE = {"d_code": """code_vals AS (
  SELECT DISTINCT 'REG_TYPE' AS cid, o_orderpriority AS v FROM orders
  UNION ALL SELECT DISTINCT 'REG_STATUS', o_orderstatus FROM orders
  UNION ALL SELECT DISTINCT 'CLASSIFICATION', CASE WHEN o_totalprice >= 250000 THEN 'PREMIUM' ELSE 'STANDARD' END FROM orders
  UNION ALL SELECT DISTINCT 'COMP_STATUS', l_linestatus FROM lineitem
  UNION ALL SELECT DISTINCT 'COMP_RESULT', l_returnflag FROM lineitem
  UNION ALL SELECT DISTINCT 'VERIF_METHOD', event_type FROM events
  UNION ALL SELECT DISTINCT 'VERIF_STATUS', CASE WHEN value < 25 THEN 'REQUESTED' WHEN value < 50 THEN 'IN_PROGRESS'
                                                 WHEN value < 100 THEN 'COMPLETED' ELSE 'VERIFIED' END FROM events
  UNION ALL SELECT DISTINCT 'VERIF_RESULT', CASE WHEN value >= 50 THEN 'MATCH' ELSE 'NO_MATCH' END FROM events
),
d_code AS (
  SELECT row_number() OVER (ORDER BY k.code_category_key, v.v) AS code_key,
         v.cid || '_' || v.v AS code_id, k.code_category_key, k.code_category_id,
         v.v AS code_value, TRUE AS is_active
  FROM code_vals v JOIN d_code_category k ON v.cid = k.code_category_id
  WHERE v.v IS NOT NULL
)""",
             "d_file": """d_file AS (
  SELECT row_number() OVER (ORDER BY file_name) AS file_key, file_name, record_count
  FROM (SELECT 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS file_name, count(*) AS record_count
        FROM orders GROUP BY 1
        UNION ALL SELECT 'lineitem_' || strftime(l_shipdate, '%Y%m%d') || '.parquet', count(*) FROM lineitem GROUP BY 1
        UNION ALL SELECT 'events_' || strftime(ts, '%Y%m%d') || '.parquet', count(*) FROM events GROUP BY 1) t
)"""}

DEPS = {
    "stg_registration": [], "stg_compliance": [], "stg_verification": [], "d_code_category": [],
    "d_code": ["d_code_category"],
    "d_country": [], "d_state": ["d_country"], "d_zipcode": ["d_state"],
    "d_data_source": [], "d_file": ["d_data_source"],
}


def with_ctes(*names: str, extra: str = "", whole: bool = False) -> str:
    """``WITH`` clause holding the named CTEs and their dependencies, in order;
    ``whole`` takes those of ``CTE_WHOLE``."""
    order: list[str] = []
    ctes, deps = (CTE | CTE_WHOLE, DEPS | {"d_file": []}) if whole else (CTE, DEPS)

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [ctes[n] for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def code_key(category: str, value_expr: str) -> str:
    """Scalar lookup of a code key in one category."""
    return (f"(SELECT dc.code_key FROM d_code dc WHERE dc.code_category_id = '{category}' "
            f"AND dc.code_value = {value_expr})")
