"""Registered queries: two loads of each subject into a date-partitioned fact.

The first load holds the rows dated before ``first_until``; those dated from
``open_from`` on were still open then (``was``), and compliance checks of line 7
were recorded 40 days too early, so their later load moves them to another
partition. The second load brings every row from ``since`` on, as of
``batch_ts``: rows dated after it fail the date check (FALSE flags) and stay
out, later ones than the first load's are NEW, closed ones CHANGED, the rest UNCHANGED.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..operators import archive, calendar, facts, partitions, quality
from ..operators.staging import latest_known
from ..session import scratch_path
from . import domain, warehouse
from .catalog import FACT_SQL, query
from .oracle import CTE, dk, with_ctes

PART = "date_part"
LOADS = {
    "registration": {"first_until": "2000-01-01", "open_from": "1999-11-02", "since": "1999-07-01", "batch_ts": "2000-07-01 00:00:00",
                     "part": partitions.month_part, "was": {"registration_status": "'O'"}},
    "compliance": {"first_until": "2000-01-01", "open_from": "1999-11-02", "since": "1999-07-01", "batch_ts": "2000-07-01 00:00:00",
                   "part": partitions.month_part,
                   "was": {"compliance_status": "'O'", "compliance_result": "'N'", "is_doj_referral": "FALSE",
                           "compliance_date": "CASE WHEN compliance_id LIKE '%-7' THEN date_add(compliance_date, -40) ELSE compliance_date END"}},
    "verification": {"first_until": "2024-01-15", "open_from": "2024-01-13", "since": "2024-01-10", "batch_ts": "2024-01-20 00:00:00",
                     "part": partitions.day_part, "was": {"verification_status": "'REQUESTED'", "verification_result": "'NO_MATCH'", "is_match": "FALSE"}},
}


def first_and_batch(spark, sf, subject):
    """Checked staging rows of both loads: one row per id, FALSE flags where a check fails."""
    cfg, spec = LOADS[subject], schemas.subject(subject)
    stg, date = domain.staging(spark, sf, subject), spec["date"]
    is_open = F.col(date) >= F.lit(cfg["open_from"]).cast("date")
    first = stg.where(F.col(date) < F.lit(cfg["first_until"]).cast("date"))
    first = first.select(*[F.when(is_open, F.expr(cfg["was"][c])).otherwise(F.col(c)).cast(stg.schema[c].dataType).alias(c) if c in cfg["was"] else F.col(c)
                           for c in stg.columns])
    batch = stg.where(F.col(date) >= F.lit(cfg["since"]).cast("date"))
    return [quality.flag_rows(latest_known(rows, spec["id"], [date]), subject, ts, ids="grouped")
            .unionByName(quality.flag_rows(rows.where(F.col(spec["id"]).isNull()), subject, ts, ids="missing"))
            for rows, ts in ((first, cfg["first_until"] + " 00:00:00"), (batch, cfg["batch_ts"]))]


def two_loads(spark, sf, subject):
    """Both loads; the fact's rows, their partition and whether the second load rewrote it."""
    cfg, spec = LOADS[subject], facts.FACT_SPECS[subject]
    first, batch = first_and_batch(spark, sf, subject)
    need = warehouse.REPORT_DIMS | {"d_file"} | ({"d_zipcode"} if subject == "registration" else set())
    dims = domain.dims(spark, sf, with_zipcode=subject == "registration", need=need, subject=subject)
    path = scratch_path(spark, f"facts/{subject}-{uuid.uuid4().hex}")

    def value():
        return cfg["part"](f"{subject}_date_key")

    fact = facts.build_fact(first, dims, subject, cfg["first_until"] + " 00:00:00",
                            layout=lambda df: partitions.dealt(df, value(), spec["key"], spec["id"]))
    partitions.write_partitions(fact, path, PART, value(), lie=True)
    kw = {"earlier": facts.person_rows(first)} if subject == "registration" else {}
    rows = facts.build_fact(batch, dims, subject, cfg["batch_ts"], assign=False, **kw)
    plan = partitions.upsert_partitions(spark, path, rows, spec["id"], spec["key"], PART, value, cfg["batch_ts"], "second")
    out = partitions.read_partitions(spark, path)
    touched = plan.select(F.col("part_value").alias(PART), F.lit(True).alias("rewritten"))
    return out.join(F.broadcast(touched), PART, "left").withColumn("rewritten", F.coalesce("rewritten", F.lit(False)))


def _sql(subject: str) -> str:
    cfg, sub, spec = LOADS[subject], schemas.subject(subject), facts.FACT_SPECS[subject]
    i, date, key, stg = sub["id"], sub["date"], spec["key"], f"stg_{subject}"
    cols = [f.name for f in sub["schema"].fields] + (["compliance_score"] if subject == "compliance" else [])
    latest = f"QUALIFY row_number() OVER (PARTITION BY {i} ORDER BY {date} DESC NULLS LAST, {', '.join(f'{c} DESC NULLS LAST' for c in cols if c != i)}) = 1"
    was = ", ".join(f"CASE WHEN {date} >= DATE '{cfg['open_from']}' THEN {v.replace('date_add(compliance_date, -40)', 'CAST(compliance_date - 40 AS DATE)')} "
                    f"ELSE {c} END AS {c}" for c, v in cfg["was"].items())
    differ = " OR ".join(f"e.{c} IS DISTINCT FROM b.{c}" for c in spec["tracked"] if c != i)
    ts1, ts2 = f"TIMESTAMP '{cfg['first_until']} 00:00:00'", f"TIMESTAMP '{cfg['batch_ts']}'"
    part = f"{dk(date)} // 100" if cfg["part"] is partitions.month_part else dk(date)
    fact = FACT_SQL[subject](whole=False).replace(f"FROM {stg} s WHERE dq_is_valid", "FROM final s").replace(f"FROM {stg} s", "FROM final s")
    names = ", ".join(cols)
    return f"""WITH {CTE[stg]},
w1 AS (SELECT * REPLACE ({was}) FROM {stg} WHERE {date} < DATE '{cfg['first_until']}'),
s1 AS (SELECT {names} FROM w1 {latest}),
s2 AS (SELECT * FROM (SELECT {names} FROM {stg} WHERE {date} >= DATE '{cfg['since']}' {latest}) WHERE {date} <= {ts2}),
ex AS (SELECT *, row_number() OVER (ORDER BY {i}) AS k FROM s1),
act AS (SELECT b.*, e.k, e.{date} AS was_date, CASE WHEN e.{i} IS NULL THEN 'NEW' WHEN {differ} THEN 'CHANGED' ELSE 'UNCHANGED' END AS action
        FROM s2 b LEFT JOIN ex e ON e.{i} = b.{i}),
final AS MATERIALIZED (
  SELECT {names}, k, {ts1} AS c0, {ts1} AS u0 FROM ex WHERE {i} NOT IN (SELECT {i} FROM act WHERE action = 'CHANGED')
  UNION ALL SELECT {names}, k, {ts1}, {ts2} FROM act WHERE action = 'CHANGED'
  UNION ALL SELECT {names}, (SELECT max(k) FROM ex) + row_number() OVER (ORDER BY {i}), {ts2}, {ts2} FROM act WHERE action = 'NEW'),
touched AS (SELECT {part} AS p FROM act WHERE action <> 'UNCHANGED' UNION SELECT {part.replace(date, 'was_date')} FROM act WHERE action = 'CHANGED')
SELECT f.* REPLACE (x.k AS {key}, x.c0 AS created_dt, x.u0 AS updated_dt), CAST({part} AS INTEGER) AS {PART}, {part} IN (SELECT p FROM touched) AS rewritten
FROM ({fact}) f JOIN (SELECT {i}, {date}, k, c0, u0 FROM final) x USING ({i})"""


@query("load_registration_partitions", "X-06 X-04 X-01 K-05 K-06 P-05 W-07 Q-06", _sql("registration"))
def load_registration_partitions(spark, sf):
    return two_loads(spark, sf, "registration")


@query("load_compliance_partitions", "X-06 X-04 X-02 K-05 K-06 P-05 Q-06 A-13", _sql("compliance"))
def load_compliance_partitions(spark, sf):
    return two_loads(spark, sf, "compliance")


@query("load_verification_partitions", "X-06 X-04 X-03 K-05 K-06 P-05 Q-06", _sql("verification"))
def load_verification_partitions(spark, sf):
    return two_loads(spark, sf, "verification")


# ------------------------------------------------------------------ archive of all subjects

ARCHIVE_CUT = {"registration": "1997-01-15", "compliance": "1997-01-15", "verification": "2024-01-10"}


def write_fact(spark, sf, subject, path):
    """The subject's fact by date partition, without the lookups a count doesn't read."""
    spec = facts.FACT_SPECS[subject]

    def value():
        return LOADS[subject]["part"](f"{subject}_date_key")

    fact = warehouse.fact(spark, sf, subject, skip=("codes", "zipcode", "state", "source", "file"),
                          layout=lambda df: partitions.dealt(df, value(), spec["key"], spec["id"]))
    partitions.write_partitions(fact, path, PART, value(), lie=True)


def archived(spark, sf, subject):
    """An archive run over the subject's partitioned fact; (fact path, archive path)."""
    path, to = (scratch_path(spark, f"archive-run/{subject}-{uuid.uuid4().hex}/{x}") for x in ("fact", "archive"))
    key, cfg, day = f"{subject}_date_key", LOADS[subject], dt.date.fromisoformat(ARCHIVE_CUT[subject])
    upto = day.year * 100 + day.month if cfg["part"] is partitions.month_part else day.year * 10000 + day.month * 100 + day.day
    write_fact(spark, sf, subject, path)
    partitions.archive_partitions(spark, path, PART, key, upto, day, to, f"before-{day}")
    return path, to


def _archive_sql(subject: str) -> str:
    date, cut = schemas.subject(subject)["date"], f"DATE '{ARCHIVE_CUT[subject]}'"
    return f"""SELECT '{subject}' AS subject, CASE WHEN {date} < {cut} THEN CAST(year({date}) AS INTEGER) ELSE -1 END AS archive_year, count(*) AS row_count
FROM stg_{subject} GROUP BY 2"""


@query("archive_run", "X-08 K-04 K-06 A-20", with_ctes(*[f"stg_{s}" for s in ARCHIVE_CUT]) + "\nUNION ALL ".join(map(_archive_sql, ARCHIVE_CUT)))
def archive_run(spark, sf):
    """Rows per archive year after an archive run over each fact, kept rows as year -1."""
    out = None
    for subject in ARCHIVE_CUT:
        path, to = archived(spark, sf, subject)
        kept = partitions.read_partitions(spark, path).agg(F.lit(-1).alias("archive_year"), F.count(F.lit(1)).alias("row_count"))
        per = spark.read.parquet(to).groupBy("archive_year").agg(F.count(F.lit(1)).alias("row_count")).unionByName(kept).withColumn("subject", F.lit(subject))
        out = per if out is None else out.unionByName(per)
    return out.select("subject", "archive_year", "row_count")


@query("archive_year_counts", "A-20 S-06 X-08", with_ctes(*[f"stg_{s}" for s in ARCHIVE_CUT]) + "\nUNION ALL ".join(
    f"""SELECT '{s}' AS subject, CAST(year({schemas.subject(s)['date']}) AS INTEGER) AS archive_year, count(*) AS archived_rows
FROM stg_{s} WHERE {schemas.subject(s)['date']} < DATE '{cut}' GROUP BY 2""" for s, cut in ARCHIVE_CUT.items()))
def archive_year_counts(spark, sf):
    """Rows per year of each subject's archive, counted from footers and folder names."""
    out = None
    for subject in ARCHIVE_CUT:
        per = archive.archive_year_counts(spark, archived(spark, sf, subject)[1]).select(F.lit(subject).alias("subject"), "archive_year", "archived_rows")
        counts = scratch_path(spark, f"archive-years/{subject}-{uuid.uuid4().hex}")
        per.write.parquet(counts)  # one row a year; the counting session ends here
        rows = spark.read.parquet(counts)
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------ calendar slices of partitioned facts

def partitioned_fact(spark, sf, subject):
    """The subject's fact written by date partition, without the lookups a count doesn't read."""
    path = scratch_path(spark, f"calendar/{subject}-{uuid.uuid4().hex}")
    write_fact(spark, sf, subject, path)
    return partitions.read_partitions(spark, path)


@query("last_12_months", "P-09 J-11 A-03", with_ctes("stg_registration") + """
SELECT CAST(strftime(registration_date, '%Y%m') AS INTEGER) AS month, count(*) AS registrations FROM stg_registration
WHERE registration_date >= (SELECT date_trunc('month', max(registration_date)) - INTERVAL 11 MONTH FROM stg_registration) GROUP BY 1""")
def last_12_months(spark, sf):
    """Registrations per month of the last twelve months; the slice of the
    calendar prunes the fact's partitions and is pushed to its reader."""
    fact = partitioned_fact(spark, sf, "registration")
    newest = domain.table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate")).alias("d")).first()["d"]  # one date
    where = calendar.last_months(F.lit(newest).cast("date"))
    rows = calendar.in_calendar(fact, domain.d_date(spark), where, "registration_date_key", PART, partitions.month_part)
    return rows.groupBy(F.floor(F.col("registration_date_key") / 100).cast("int").alias("month")).agg(F.count(F.lit(1)).alias("registrations"))


@query("weekend_checks", "P-09 J-11 A-03", with_ctes("stg_compliance") + """
SELECT CAST(year(compliance_date) AS INTEGER) AS year, count(*) AS checks FROM stg_compliance
WHERE dayofweek(compliance_date) IN (0, 6) GROUP BY 1""")
def weekend_checks(spark, sf):
    """Compliance checks on weekend days per year: a slice of thousands of short
    runs of days, answered by a semi-join with the calendar's days."""
    fact = partitioned_fact(spark, sf, "compliance")
    rows = calendar.in_calendar(fact, domain.d_date(spark), "is_weekend", "compliance_date_key", PART, partitions.month_part)
    return rows.groupBy(F.floor(F.col("compliance_date_key") / 10000).cast("int").alias("year")).agg(F.count(F.lit(1)).alias("checks"))
