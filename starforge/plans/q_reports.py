"""Registered queries: report datasets (one per visual), KPIs, time intelligence,
drill-down, row security, top-n. All read the star built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.predicates import divide
from ..operators import lookup, measures, security, timeintel
from . import domain, warehouse
from .catalog import query
from .oracle import with_ctes

REG = with_ctes("stg_registration", "d_state")
REGS = REG + ", rs AS (SELECT r.*, s.state_name, s.country_name FROM stg_registration r " \
             "LEFT JOIN d_state s ON r.state = s.state_code)\n"
COMP = with_ctes("stg_compliance", "d_state") + ", cs AS (SELECT c.*, s.state_name FROM stg_compliance c " \
                                                "LEFT JOIN d_state s ON c.state = s.state_code)\n"
VER = with_ctes("stg_verification")
MONTH = "CAST(date_trunc('month', {c}) AS DATE)"


def _rate_sql(num: str, den: str) -> str:
    return f"CAST(round(CASE WHEN {den} = 0 OR {den} IS NULL THEN 0 ELSE CAST({num} AS DOUBLE) / {den} END, 4) AS DECIMAL(10,4))"


def reg_star(spark, sf, *roles):
    """The registration star with the given roles only."""
    return warehouse.registration_star(spark, sf, roles)


def month_of(c):
    return F.trunc(F.col(c), "month").alias("month_start")


# ------------------------------------------------------------------ registration visuals

@query("report_registration_trend", "M-01 A-03 J-11 P-09", REG + f"""
SELECT {MONTH.format(c='registration_date')} AS month_start, registration_status AS status,
       CAST(count(*) AS BIGINT) AS registration_count FROM stg_registration GROUP BY 1, 2""")
def report_registration_trend(spark, sf):
    st = reg_star(spark, sf, "reg", "status")
    return st.groupBy(month_of("reg_date_value"), F.col("status_code_value").alias("status")) \
        .agg(F.count(F.lit(1)).alias("registration_count"))


@query("report_state_share", "M-02 A-10", REGS + f"""
, c AS (SELECT state_name, count(*) AS n FROM rs GROUP BY 1)
SELECT state_name, CAST(n AS BIGINT) AS registration_count,
       {_rate_sql('n', '(SELECT sum(n) FROM c)')} AS share FROM c""")
def report_state_share(spark, sf):
    st = reg_star(spark, sf, "state")
    c = st.groupBy("state_name").agg(F.count(F.lit(1)).alias("registration_count"))
    return measures.with_share(c, "registration_count")


@query("report_top_states", "M-03 T-02 T-01", REGS + """
SELECT state_name, CAST(count(*) AS BIGINT) AS registration_count FROM rs GROUP BY 1
ORDER BY registration_count DESC, state_name LIMIT 10""")
def report_top_states(spark, sf):
    st = reg_star(spark, sf, "state")
    c = st.groupBy("state_name").agg(F.count(F.lit(1)).alias("registration_count"))
    return measures.top_n(c, "registration_count", 10, ["state_name"])


@query("report_by_type", "M-04 J-17", REG + """
SELECT registration_type AS type, CAST(count(*) AS BIGINT) AS registration_count FROM stg_registration GROUP BY 1""")
def report_by_type(spark, sf):
    """Counts through the type relationship (the inactive role switched on)."""
    dm = domain.dims(spark, sf, with_zipcode=False, need={"d_date", "d_code", "d_code_category"}, subject="registration",
                     code_categories=["REG_STATUS", "REG_TYPE"])
    f = warehouse.fact(spark, sf, "registration", dims=dm, skip=("file", "source", "state"), codes=["REG_STATUS", "REG_TYPE"])
    roles = {"status": "registration_status_code_key", "type": "registration_type_code_key"}
    f = lookup.with_role(f, roles, "type", "code_key_in_use")
    codes = lookup.bounded_broadcast(dm["d_code"].select(F.col("code_key").alias("code_key_in_use"), "code_value"),
                                     broadcast=True if "d_code" in dm.small else None)
    return f.join(codes, "code_key_in_use", "left").groupBy(F.col("code_value").alias("type")) \
        .agg(F.count(F.lit(1)).alias("registration_count"))


@query("report_registration_detail", "M-05 J-11 J-04 J-05", REGS + """
SELECT registration_id, registration_date, state_name, zipcode, registration_type AS type,
       registration_status AS status,
       CAST(year(registration_date) - year(birth_date)
            - CASE WHEN month(registration_date) * 100 + day(registration_date)
                        < month(birth_date) * 100 + day(birth_date) THEN 1 ELSE 0 END AS INTEGER) AS age_at_registration,
       source_system AS data_source FROM rs""")
def report_registration_detail(spark, sf):
    """The detail table: every registration with its dimension names (no personal data)."""
    cats = ["REG_STATUS", "REG_TYPE"]
    dm = domain.dims(spark, sf, with_zipcode=True, need=warehouse.REPORT_DIMS | {"d_zipcode"}, subject="registration", code_categories=cats)
    f = warehouse.fact(spark, sf, "registration", zipcode=True, dims=dm, skip=("file",), codes=cats)
    st = lookup.star(f, {
        "reg": (dm["d_date"], "registration_date_key", "date_key", ["date_value"]),
        "state": (dm["d_state"], "state_key", "state_key", ["state_name"]),
        "zip": (dm["d_zipcode"], "zipcode_key", "zipcode_key", ["zipcode"]),
        "type": (dm["d_code"], "registration_type_code_key", "code_key", ["code_value"]),
        "status": (dm["d_code"], "registration_status_code_key", "code_key", ["code_value"]),
        "src": (dm["d_data_source"], "data_source_key", "data_source_key", ["source_name"]),
    }, how="left")
    return st.select("registration_id", F.col("reg_date_value").alias("registration_date"), "state_name",
                     "zipcode", F.col("type_code_value").alias("type"),
                     F.col("status_code_value").alias("status"), "age_at_registration",
                     F.col("src_source_name").alias("data_source"))


AGE_EDGES = [18, 26, 36, 46, 56, 66]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65"]


@query("report_age_distribution", "M-06 A-12 F-13", REG + """
, a AS (SELECT CAST(year(registration_date) - year(birth_date)
            - CASE WHEN month(registration_date) * 100 + day(registration_date)
                        < month(birth_date) * 100 + day(birth_date) THEN 1 ELSE 0 END AS INTEGER) AS age
        FROM stg_registration)
SELECT CASE WHEN age IS NULL THEN 'unknown' WHEN age < 18 THEN 'under 18' WHEN age >= 18 AND age < 26 THEN '18-25' WHEN age >= 26 AND age < 36 THEN '26-35'
            WHEN age >= 36 AND age < 46 THEN '36-45' WHEN age >= 46 AND age < 56 THEN '46-55'
            WHEN age >= 56 AND age < 66 THEN '56-65' ELSE '66+' END AS bucket,
       CAST(count(*) AS BIGINT) AS row_count
FROM a GROUP BY 1""")
def report_age_distribution(spark, sf):
    st = reg_star(spark, sf)
    return measures.histogram(st, "age_at_registration", AGE_EDGES, AGE_LABELS, below="under 18", above="66+")


@query("report_by_method", "M-07 A-03", REG + """
SELECT registration_method, CAST(count(*) AS BIGINT) AS registration_count FROM stg_registration GROUP BY 1""")
def report_by_method(spark, sf):
    st = reg_star(spark, sf)
    return st.groupBy("registration_method").agg(F.count(F.lit(1)).alias("registration_count"))


@query("report_monthly_status_share", "M-08 A-10", REG + f"""
, c AS (SELECT {MONTH.format(c='registration_date')} AS month_start, registration_status AS status, count(*) AS n
        FROM stg_registration GROUP BY 1, 2)
SELECT month_start, status, CAST(n AS BIGINT) AS registration_count,
       {_rate_sql('n', 'sum(n) OVER (PARTITION BY month_start)')} AS share FROM c""")
def report_monthly_status_share(spark, sf):
    st = reg_star(spark, sf, "reg", "status")
    c = st.groupBy(month_of("reg_date_value"), F.col("status_code_value").alias("status")) \
        .agg(F.count(F.lit(1)).alias("registration_count"))
    return measures.with_share(c, "registration_count", within=["month_start"])


# ------------------------------------------------------------------ compliance visuals

def comp_star(spark, sf, *codes, day=False, state=False):
    return warehouse.subject_star(spark, sf, "compliance", {c: f"compliance_{c}_code_key" for c in codes}, day, state)


@query("report_compliance_status_trend", "M-09 A-03", COMP + f"""
SELECT {MONTH.format(c='compliance_date')} AS month_start, compliance_status AS status,
       CAST(count(*) AS BIGINT) AS check_count FROM stg_compliance GROUP BY 1, 2""")
def report_compliance_status_trend(spark, sf):
    st = comp_star(spark, sf, "status", day=True)
    return st.groupBy(month_of("day_date_value"), F.col("status_code_value").alias("status")) \
        .agg(F.count(F.lit(1)).alias("check_count"))


@query("report_compliance_by_state", "M-10 A-17", COMP + f"""
SELECT state_name, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE compliance_result = 'A') AS BIGINT) AS hits,
       {_rate_sql("count(*) FILTER (WHERE compliance_result = 'A')", 'count(*)')} AS pass_rate
FROM cs GROUP BY 1""")
def report_compliance_by_state(spark, sf):
    st = comp_star(spark, sf, "result", state=True)
    return measures.rate(st, ["state_name"], F.col("result_code_value") == "A", "pass_rate")


@query("report_referrals_monthly", "M-11 A-07", COMP + f"""
SELECT {MONTH.format(c='compliance_date')} AS month_start, CAST(count(*) AS BIGINT) AS checks,
       CAST(count(*) FILTER (WHERE is_doj_referral) AS BIGINT) AS referrals FROM stg_compliance GROUP BY 1""")
def report_referrals_monthly(spark, sf):
    st = comp_star(spark, sf, day=True)
    return measures.measure(st, [month_of("day_date_value")],
                            {"checks": ("count", None), "referrals": ("count_if", F.col("is_doj_referral"))})


RESULTS = ["A", "N", "R"]


@query("report_compliance_matrix", "M-12 A-11", COMP + """
, c AS (SELECT state_name,
               count(*) FILTER (WHERE compliance_result = 'A') AS a, count(*) FILTER (WHERE compliance_result = 'N') AS n,
               count(*) FILTER (WHERE compliance_result = 'R') AS r FROM cs GROUP BY 1),
t AS (SELECT count(*) AS total FROM cs)
SELECT state_name, CAST(a AS BIGINT) AS "A", CAST(n AS BIGINT) AS "N", CAST(r AS BIGINT) AS "R",
""" + ",\n".join(f"{_rate_sql(x.lower(), '(SELECT total FROM t)')} AS \"{x}_share\"" for x in RESULTS) + " FROM c")
def report_compliance_matrix(spark, sf):
    st = comp_star(spark, sf, "result", state=True)
    return measures.matrix(st, ["state_name"], "result_code_value", RESULTS)


# ------------------------------------------------------------------ verification visuals

def ver_star(spark, sf, *codes, day=False):
    return warehouse.subject_star(spark, sf, "verification", {c: f"verification_{c}_code_key" for c in codes}, day, False)


@query("report_verification_method_success", "M-13 A-17", VER + f"""
SELECT verification_method AS method, CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE is_match) AS BIGINT) AS hits,
       {_rate_sql('count(*) FILTER (WHERE is_match)', 'count(*)')} AS success_rate
FROM stg_verification GROUP BY 1""")
def report_verification_method_success(spark, sf):
    st = ver_star(spark, sf, "method").withColumn("method", F.col("method_code_value"))
    return measures.rate(st, ["method"], F.col("is_match"), "success_rate")


SCORE_EDGES = [0, 25, 50, 75, 100.01]
SCORE_LABELS = ["0-25", "25-50", "50-75", "75-100"]


@query("report_match_score_histogram", "M-14 A-12", VER + """
SELECT CASE WHEN match_score IS NULL THEN 'unknown' WHEN match_score < 0 THEN 'below 0' WHEN match_score < 25 THEN '0-25' WHEN match_score >= 25 AND match_score < 50 THEN '25-50'
            WHEN match_score >= 50 AND match_score < 75 THEN '50-75'
            WHEN match_score < 100.01 THEN '75-100' ELSE 'above 100' END AS bucket,
       CAST(count(*) AS BIGINT) AS row_count
FROM stg_verification GROUP BY 1""")
def report_match_score_histogram(spark, sf):
    st = ver_star(spark, sf)
    return measures.histogram(st, "match_score", SCORE_EDGES, SCORE_LABELS, below="below 0", above="above 100")


FUNNEL = ["REQUESTED", "IN_PROGRESS", "COMPLETED", "VERIFIED"]


@query("report_verification_funnel", "M-15 A-16", VER + """
, r AS (SELECT CASE verification_status WHEN 'REQUESTED' THEN 1 WHEN 'IN_PROGRESS' THEN 2
                    WHEN 'COMPLETED' THEN 3 WHEN 'VERIFIED' THEN 4 ELSE 0 END AS k FROM stg_verification),
s AS (SELECT * FROM (VALUES (1, 'REQUESTED'), (2, 'IN_PROGRESS'), (3, 'COMPLETED'), (4, 'VERIFIED')) t(stage_no, stage)),
c AS (SELECT s.stage_no, s.stage, (SELECT count(*) FROM r WHERE r.k >= s.stage_no) AS reached FROM s)
SELECT CAST(c.stage_no AS INTEGER) AS stage_no, c.stage, CAST(c.reached AS BIGINT) AS reached,
       """ + _rate_sql("c.reached", "coalesce(p.reached, c.reached)") + """ AS conversion
FROM c LEFT JOIN c p ON p.stage_no = c.stage_no - 1""")
def report_verification_funnel(spark, sf):
    st = ver_star(spark, sf, "status")
    return measures.funnel(st, "status_code_value", FUNNEL)


SLA_SECONDS = 172800  # fixed value: two days


@query("report_response_time", "M-16 A-08 F-12", VER + f"""
SELECT {MONTH.format(c='verification_date')} AS month_start,
       CAST(round(avg(CAST(date_diff('second', CAST(request_date AS TIMESTAMP), CAST(response_date AS TIMESTAMP)) AS DOUBLE)), 4)
            AS DECIMAL(18,4)) AS avg_response_seconds,
       {SLA_SECONDS} AS sla_seconds,
       avg(CAST(date_diff('second', CAST(request_date AS TIMESTAMP), CAST(response_date AS TIMESTAMP)) AS DOUBLE)) > {SLA_SECONDS}
         AS above_sla
FROM stg_verification GROUP BY 1""")
def report_response_time(spark, sf):
    st = ver_star(spark, sf, day=True)
    avg = F.avg(F.col("response_time_seconds").cast("double"))
    return (st.groupBy(month_of("day_date_value"))
            .agg(F.round(avg, 4).cast("decimal(18,4)").alias("avg_response_seconds"), (avg > SLA_SECONDS).alias("above_sla"))
            .withColumn("sla_seconds", F.lit(SLA_SECONDS)))


# ------------------------------------------------------------------ KPIs

@query("kpi_registration", "A-18 A-01 A-07 W-02", REG + """
, m AS (SELECT max(registration_date) AS d FROM stg_registration)
SELECT CAST(count(*) AS BIGINT) AS total_registrations,
       CAST(count(*) FILTER (WHERE registration_status = 'O') AS BIGINT) AS active_registrations,
       CAST(count(*) FILTER (WHERE year(registration_date) = (SELECT year(d) FROM m)
                               AND registration_date <= (SELECT d FROM m)) AS BIGINT) AS ytd_registrations
FROM stg_registration""")
def kpi_registration(spark, sf):
    """Total, active (open status) and year-to-date as of the last registration day."""
    st = reg_star(spark, sf, "reg", "status")
    return measures.to_date_kpis(st, "reg_date_value", {"total_registrations": F.lit(True), "active_registrations": F.col("status_code_value") == "O"},
                                 "ytd_registrations")


@query("kpi_compliance", "A-18 A-08 A-09", COMP + f"""
SELECT CAST(count(*) AS BIGINT) AS total_checks,
       {_rate_sql("count(*) FILTER (WHERE compliance_result = 'A')", 'count(*)')} AS pass_rate,
       CAST(count(*) FILTER (WHERE is_doj_referral) AS BIGINT) AS referrals,
       CAST(round(avg(CAST(completion_date - compliance_date AS DOUBLE)), 4) AS DECIMAL(18,4)) AS avg_days_to_completion
FROM stg_compliance""")
def kpi_compliance(spark, sf):
    st = comp_star(spark, sf, "result")
    return st.agg(F.count(F.lit(1)).alias("total_checks"),
                  F.round(divide(F.count_if(F.col("result_code_value") == "A"), F.count(F.lit(1))), 4)
                  .cast("decimal(10,4)").alias("pass_rate"),
                  F.count_if("is_doj_referral").alias("referrals"),
                  F.round(F.avg(F.col("days_to_completion").cast("double")), 4).cast("decimal(18,4)")
                  .alias("avg_days_to_completion"))


@query("kpi_verification", "A-18 A-08", VER + f"""
SELECT CAST(count(*) AS BIGINT) AS total_verifications,
       {_rate_sql('count(*) FILTER (WHERE is_match)', 'count(*)')} AS match_rate,
       CAST(round(avg(CAST(match_score AS DOUBLE)), 4) AS DECIMAL(18,4)) AS avg_match_score,
       CAST(round(avg(CAST(date_diff('second', CAST(request_date AS TIMESTAMP), CAST(response_date AS TIMESTAMP)) AS DOUBLE)), 4)
            AS DECIMAL(18,4)) AS avg_response_seconds
FROM stg_verification""")
def kpi_verification(spark, sf):
    st = ver_star(spark, sf)
    return st.agg(F.count(F.lit(1)).alias("total_verifications"),
                  F.round(divide(F.count_if("is_match"), F.count(F.lit(1))), 4).cast("decimal(10,4)")
                  .alias("match_rate"),
                  F.round(F.avg(F.col("match_score").cast("double")), 4).cast("decimal(18,4)").alias("avg_match_score"),
                  F.round(F.avg(F.col("response_time_seconds").cast("double")), 4).cast("decimal(18,4)")
                  .alias("avg_response_seconds"))


# ------------------------------------------------------------------ time intelligence

_MONTHLY = REG + f"""
, c AS (SELECT {MONTH.format(c='registration_date')} AS month_start, count(*) AS n FROM stg_registration GROUP BY 1),
b AS (SELECT min(month_start) AS s, max(month_start) AS e FROM c),
sp AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b),
m AS (SELECT sp.month_start, CAST(coalesce(c.n, 0) AS BIGINT) AS total FROM sp LEFT JOIN c USING (month_start))
"""


def reg_monthly(spark, sf):
    st = reg_star(spark, sf, "reg")
    return timeintel.monthly(st, "reg_date_value")


@query("ytd_registrations", "W-02", _MONTHLY + """
SELECT month_start, total, CAST(sum(total) OVER (PARTITION BY year(month_start) ORDER BY month_start
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ytd_total FROM m""")
def ytd_registrations(spark, sf):
    return timeintel.ytd(reg_monthly(spark, sf))


@query("mom_growth", "W-03 A-09", _MONTHLY + """
, g AS (SELECT month_start, total, lag(total) OVER (ORDER BY month_start) AS previous_total FROM m)
SELECT month_start, total, CAST(previous_total AS BIGINT) AS previous_total,
       CAST(round(CASE WHEN previous_total IS NULL OR previous_total = 0 THEN 0
                       ELSE CAST(total - previous_total AS DOUBLE) / previous_total END, 4) AS DECIMAL(12,4)) AS growth
FROM g""")
def mom_growth(spark, sf):
    return timeintel.growth(reg_monthly(spark, sf))


@query("yoy_growth", "W-04 W-05 A-09", _MONTHLY + """
SELECT a.month_start, a.total, b.total AS last_year_total,
       CAST(round(CASE WHEN b.total IS NULL OR b.total = 0 THEN 0
                       ELSE CAST(a.total - b.total AS DOUBLE) / b.total END, 4) AS DECIMAL(12,4)) AS yoy_growth
FROM m a LEFT JOIN m b ON b.month_start = CAST(a.month_start - INTERVAL 12 MONTH AS DATE)""")
def yoy_growth(spark, sf):
    return timeintel.yoy(reg_monthly(spark, sf))


@query("moving_average_3m", "W-06 J-20", REG + """
, d AS (SELECT registration_date AS day, count(*) AS n FROM stg_registration GROUP BY 1),
a AS (SELECT DISTINCT last_day(day) AS anchor FROM d
      UNION SELECT last_day(CAST(day + INTERVAL 1 MONTH AS DATE)) FROM d
      UNION SELECT last_day(CAST(day + INTERVAL 2 MONTH AS DATE)) FROM d
      UNION SELECT last_day(CAST(day + INTERVAL 3 MONTH AS DATE)) FROM d),
w AS (SELECT a.anchor, sum(d.n) AS window_total, count(*) AS days_with_rows
      FROM a JOIN d ON d.day > CAST(a.anchor - INTERVAL 3 MONTH AS DATE) AND d.day <= a.anchor
      WHERE a.anchor <= (SELECT last_day(max(day)) FROM d) GROUP BY 1)
SELECT CAST(date_trunc('month', anchor) AS DATE) AS month_start, anchor AS month_end,
       CAST(window_total AS BIGINT) AS window_total, CAST(days_with_rows AS BIGINT) AS days_with_rows,
       CAST(round(CAST(window_total AS DOUBLE) / days_with_rows, 4) AS DECIMAL(18,4)) AS moving_avg
FROM w""")
def moving_average_3m(spark, sf):
    st = reg_star(spark, sf, "reg")
    return timeintel.moving_average(st, "reg_date_value", 3)


# ------------------------------------------------------------------ drill-down, security, listings

@query("drill_down", "A-22", REGS + """
SELECT country_name, state_name, CAST(GROUPING(country_name, state_name) AS INTEGER) AS grouping_level,
       CAST(count(*) AS BIGINT) AS registration_count
FROM rs GROUP BY ROLLUP (country_name, state_name)""")
def drill_down(spark, sf):
    st = reg_star(spark, sf, "country", "state")
    out = measures.drill_down(st, ["country_name", "state_name"], {"registration_count": ("count", None)})
    return out.withColumn("grouping_level", F.col("grouping_level").cast("int"))


# The grants of the security example (user, role, member).
GRANTS = [("analyst_1", "STATE", "07"), ("analyst_1", "REGION", "ASIA"), ("director", "ALL", None)]


@query("rls_registrations", "P-13 P-11", REGS + """
SELECT registration_id, state_name FROM rs WHERE state = '07' OR country_name = 'ASIA'""")
def rls_registrations(spark, sf):
    """Registrations visible to ``analyst_1`` (one state and one region)."""
    dm = domain.dims(spark, sf, with_zipcode=False, need={"d_date", "d_state"})
    f = warehouse.fact(spark, sf, "registration", dims=dm, skip=("file", "source", "codes"))
    grants = spark.createDataFrame(GRANTS, "user_name string, role string, member string")
    seen = security.apply_rls(f, dm["d_state"], grants, "analyst_1")
    names = F.broadcast(dm["d_state"].select("state_key", "state_name"))
    return seen.join(names, "state_key", "left").select("registration_id", "state_name")


@query("report_sliced", "P-09 P-12 P-11 F-16", REG + """
SELECT registration_id, registration_date, registration_status AS status FROM stg_registration
WHERE year(registration_date) = 1998 AND quarter(registration_date) IN (1, 2)
  AND registration_status IN ('F', 'O') AND registration_type IN ('1-URGENT', '2-HIGH')""")
def report_sliced(spark, sf):
    """Detail rows under slicers: calendar (year, quarters) and member lists."""
    from ..functions.predicates import members
    st = reg_star(spark, sf, "reg", "status", "type")
    cond = (members("reg_year", [1998]) & members("reg_quarter", [1, 2])
            & members("status_code_value", ["F", "O"]) & members("type_code_value", ["1-URGENT", "2-HIGH"]))
    return st.filter(cond).select("registration_id", F.col("reg_date_value").alias("registration_date"),
                                  F.col("status_code_value").alias("status"))


@query("report_sample", "T-03", REG + """
SELECT registration_id, registration_date, registration_status AS status FROM stg_registration
ORDER BY registration_date DESC, registration_id LIMIT 10""")
def report_sample(spark, sf):
    """Ten newest registrations (a top-k: per-task top 10, merged)."""
    st = reg_star(spark, sf, "reg", "status")
    s = st.select("registration_id", F.col("reg_date_value").alias("registration_date"),
                  F.col("status_code_value").alias("status"))
    return measures.sample_rows(s, [F.col("registration_date").desc(), F.col("registration_id")], 10)


@query("latest_checks", "T-01", with_ctes("stg_compliance") + """
SELECT compliance_id, compliance_date, compliance_status, compliance_result, completion_date, compliance_score,
       state, registration_id FROM stg_compliance
ORDER BY compliance_date DESC, compliance_id DESC, completion_date DESC, compliance_score DESC,
         compliance_result DESC, compliance_status DESC, state DESC, registration_id DESC LIMIT 20""")
def latest_checks(spark, sf):
    s = domain.staging(spark, sf, "compliance").select(
        "compliance_id", "compliance_date", "compliance_status", "compliance_result", "completion_date",
        "compliance_score", "state", "registration_id")
    order = [F.col(c).desc() for c in ["compliance_date", "compliance_id", "completion_date", "compliance_score",
                                       "compliance_result", "compliance_status", "state", "registration_id"]]
    return measures.latest(s, order, 20)


@query("state_window_rank", "T-05 A-10", REGS + """
SELECT state_name, month_start, n AS registration_count,
       CAST(rank() OVER (PARTITION BY month_start ORDER BY n DESC) AS INTEGER) AS rank_in_month
FROM (SELECT state_name, CAST(date_trunc('month', registration_date) AS DATE) AS month_start,
             CAST(count(*) AS BIGINT) AS n FROM rs GROUP BY 1, 2)""")
def state_window_rank(spark, sf):
    """States ranked within each month (an ordered listing per partition)."""
    st = reg_star(spark, sf, "reg", "state")
    c = st.groupBy("state_name", month_of("reg_date_value")).agg(F.count(F.lit(1)).alias("registration_count"))
    w = Window.partitionBy("month_start").orderBy(F.col("registration_count").desc())
    return c.withColumn("rank_in_month", F.rank().over(w).cast("int"))
