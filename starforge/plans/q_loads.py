"""Registered queries: incremental fact loads, fact history, archive, reconciliation.

The existing registration fact is the load of ``SNAPSHOT_DATE``: orders
placed before it, with the status they had then (an order now finished whose
last line shipped on or after that day was still open). The incremental batch
is today's staging: later orders are NEW, orders finished since are CHANGED.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import archive, facts, recon, scd
from ..operators.staging import valid
from ..operators.tables import VersionedTable
from ..session import materialize, scratch_path
from ..sources import landing
from ..sources.files import incremental_extract
from . import domain, pipeline, warehouse
from .catalog import FACT_SQL, query
from .oracle import TS, dk, safe_hash, with_ctes

SNAP_TS = f"{domain.SNAPSHOT_DATE} 00:00:00"
ARCHIVE_AS_OF, ARCHIVE_YEARS = "2002-01-01", 5


def snapshot_staging(spark, sf):
    stg = domain.staging(spark, sf, "registration")
    last = domain.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = stg.join(last, F.col("registration_id") == F.col("l_orderkey").cast("string"), "left")
    was_open = (F.col("registration_status") == "F") & (F.col("last_ship") >= F.lit(SNAP_TS).cast("timestamp"))
    return (j.filter(F.col("registration_date") < F.lit(domain.SNAPSHOT_DATE).cast("date"))
            .withColumn("registration_status", F.when(was_open, "O").otherwise(F.col("registration_status")))
            .select(*stg.columns))


def _dims(spark, sf, file=True, all_feeds=False):
    need = {"d_date", "d_code", "d_code_category", "d_state", "d_country", "d_data_source", "d_zipcode"}
    return domain.dims(spark, sf, with_zipcode=True, need=need | {"d_file"} if file else need, subject="registration", whole=all_feeds)


def existing_and_batch(spark, sf, whole=True, all_feeds=False):
    """The existing fact and the batch's fact rows. A history has no person counts,
    files or sources: with ``whole`` off they are not looked up. ``all_feeds``
    keys codes and files over all subjects."""
    dm = _dims(spark, sf, whole, all_feeds)
    kw = {} if whole else {"person_counts": False, "skip": ("file", "source")}
    existing = facts.build_fact(snapshot_staging(spark, sf), dm, "registration", SNAP_TS, assign=True, **kw)
    batch = facts.build_fact(domain.staging(spark, sf, "registration"), dm, "registration", domain.BATCH_TS,
                             assign=False, **kw)
    return existing, batch, dm


def split_of(spark, sf, whole=True, all_feeds=False):
    """The existing fact and the tagged batch, written once: several branches read it."""
    existing, batch, dm = existing_and_batch(spark, sf, whole, all_feeds)
    return existing, materialize(facts.split_changes(batch, existing, "registration_id"), "split-registration"), dm


_CMP = f""",
ls AS (SELECT CAST(l_orderkey AS VARCHAR) AS rid, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
snap AS (
  SELECT r.registration_id, r.registration_date, r.registration_type, r.state, r.zipcode,
         CASE WHEN r.registration_status = 'F' AND ls.last_ship >= TIMESTAMP '{SNAP_TS}' THEN 'O'
              ELSE r.registration_status END AS registration_status
  FROM stg_registration r LEFT JOIN ls ON ls.rid = r.registration_id
  WHERE r.registration_date < DATE '{domain.SNAPSHOT_DATE}'),
ex AS (SELECT row_number() OVER (ORDER BY registration_id) AS registration_key, * FROM snap),
cmp AS (
  SELECT r.*, e.registration_key AS ex_key, e.registration_status AS ex_status,
         CASE WHEN e.registration_id IS NULL THEN 'NEW'
              WHEN e.registration_status IS DISTINCT FROM r.registration_status THEN 'CHANGED'
              ELSE 'UNCHANGED' END AS action
  FROM stg_registration r LEFT JOIN ex e USING (registration_id)),
maxk AS (SELECT coalesce(max(registration_key), 0) AS m FROM ex)
"""
_SNAP = with_ctes("stg_registration", "d_code", "d_state", "d_zipcode") + _CMP


def _code(alias, cat, val):
    return f"LEFT JOIN d_code {alias} ON {alias}.code_category_id = '{cat}' AND {alias}.code_value = {val}"


@query("split_changes", "X-04 J-09 J-10", _SNAP + "SELECT registration_id, action FROM cmp")
def split_changes(spark, sf):
    existing, batch, _ = existing_and_batch(spark, sf)
    return facts.split_changes(batch, existing, "registration_id").select("registration_id", "action")


@query("fact_upsert", "X-06 K-05 W-08", with_ctes("stg_registration", "d_code", "d_state", "d_zipcode", whole=True) + _CMP + f""",
full_fact AS ({FACT_SQL['registration'](whole=True)})
SELECT f.* REPLACE (c.registration_key AS registration_key, cs.code_key AS registration_status_code_key,
       {safe_hash(['c.registration_id', 'c.status'])} AS record_hash, c.created_dt AS created_dt, c.updated_dt AS updated_dt)
FROM (
  SELECT ex_key AS registration_key, registration_id, ex_status AS status,
         TIMESTAMP '{SNAP_TS}' AS created_dt, TIMESTAMP '{SNAP_TS}' AS updated_dt FROM cmp WHERE action = 'UNCHANGED'
  UNION ALL
  SELECT ex_key, registration_id, registration_status, TIMESTAMP '{SNAP_TS}', {TS} FROM cmp WHERE action = 'CHANGED'
  UNION ALL
  SELECT (SELECT m FROM maxk) + row_number() OVER (ORDER BY registration_id), registration_id, registration_status,
         {TS}, {TS} FROM cmp WHERE action = 'NEW') c
JOIN full_fact f ON f.registration_id = c.registration_id
{_code('cs', 'REG_STATUS', 'c.status')}""")
def fact_upsert(spark, sf):
    """Next fact state after the incremental batch (INCREMENTAL mode)."""
    existing, split, _ = split_of(spark, sf, all_feeds=True)
    return facts.upsert_fact(existing, split, "registration_id", "registration_key", domain.BATCH_TS)


_HIST = _SNAP + f""",
hist AS (
  SELECT c.ex_key AS registration_key, c.registration_id, {dk(f"DATE '{domain.SNAPSHOT_DATE}'")} AS snapshot_date_key,
         {dk('c.registration_date')} AS registration_date_key, cs.code_key AS registration_status_code_key,
         ct.code_key AS registration_type_code_key, z.zipcode_key, st.state_key,
         'INSERT' AS change_type, TIMESTAMP '{SNAP_TS}' AS effective_start_dt, {TS} AS effective_end_dt,
         FALSE AS is_current, TIMESTAMP '{SNAP_TS}' AS created_dt
  FROM cmp c {_code('cs', 'REG_STATUS', 'c.ex_status')} {_code('ct', 'REG_TYPE', 'c.registration_type')}
  LEFT JOIN d_state st ON st.state_code = c.state LEFT JOIN d_zipcode z ON z.zipcode = c.zipcode
  WHERE c.action = 'CHANGED'
  UNION ALL
  SELECT c.ex_key, c.registration_id, {dk(TS)}, {dk('c.registration_date')}, cs.code_key, ct.code_key,
         z.zipcode_key, st.state_key, 'UPDATE', {TS}, CAST(NULL AS TIMESTAMP), TRUE, {TS}
  FROM cmp c {_code('cs', 'REG_STATUS', 'c.registration_status')} {_code('ct', 'REG_TYPE', 'c.registration_type')}
  LEFT JOIN d_state st ON st.state_code = c.state LEFT JOIN d_zipcode z ON z.zipcode = c.zipcode
  WHERE c.action = 'CHANGED')
"""


def history(spark, sf):
    existing, split, dm = split_of(spark, sf, whole=False)
    cols = ["registration_date_key", "registration_status_code_key", "registration_type_code_key",
            "zipcode_key", "state_key"]
    return facts.history_rows(split, existing, None, "registration_id", "registration_key", cols,
                              domain.BATCH_TS), dm


@query("fact_history", "X-05 P-15 K-02", _HIST + "SELECT * FROM hist")
def fact_history(spark, sf):
    """History of the changed registrations: the closed prior row and the open new row."""
    return history(spark, sf)[0]


@query("history_as_of", "J-15 J-13", _HIST + """
SELECT h.registration_id, h.change_type, c.code_value AS status
FROM hist h LEFT JOIN d_code c ON c.code_key = h.registration_status_code_key
WHERE h.effective_start_dt <= TIMESTAMP '2001-01-01 00:00:00'
  AND (h.effective_end_dt IS NULL OR h.effective_end_dt > TIMESTAMP '2001-01-01 00:00:00')""")
def history_as_of(spark, sf):
    """Each changed registration as it stood on 2001-01-01, with the status valid then."""
    hist, dm = history(spark, sf)
    out = scd.history_as_of(hist, dm["d_code"], "registration_status_code_key", "code_key",
                            "2001-01-01 00:00:00", [F.col("code_value").alias("status")])
    return out.select("registration_id", "change_type", "status")


# ------------------------------------------------------------------ archive

def archive_sets(spark, sf, all_feeds=False):
    dm = _dims(spark, sf, all_feeds=all_feeds)
    f = warehouse.fact(spark, sf, "registration", keys=True, zipcode=True, person_counts=True, dims=dm)
    cut = archive.cutoff(ARCHIVE_AS_OF, years=ARCHIVE_YEARS)
    return archive.archive_split(f, dm["d_date"], "registration_date_key", cut)


_ARCH = with_ctes("stg_registration") + f""",
keyed AS (SELECT row_number() OVER (ORDER BY registration_id) AS registration_key, registration_id,
                 registration_date, {dk('registration_date')} AS registration_date_key FROM stg_registration),
old AS (SELECT registration_key, registration_id, registration_date_key,
               CAST(year(registration_date) AS INTEGER) AS archive_year
        FROM keyed WHERE registration_date < DATE '{ARCHIVE_AS_OF}' - INTERVAL {ARCHIVE_YEARS} YEAR)
"""


@query("archive_split", "X-07 J-11 F-11", _ARCH + f"""
, full_fact AS ({FACT_SQL['registration'](whole=True)})
SELECT f.*, old.archive_year FROM old JOIN full_fact f USING (registration_id)""")
def archive_split(spark, sf):
    """Registrations older than five years before the run date, tagged with their archive year."""
    old, _kept = archive_sets(spark, sf, all_feeds=True)
    return old


@query("archive_counts", "A-20 X-08", _ARCH + """
SELECT archive_year, CAST(count(*) AS BIGINT) AS archived_rows FROM old GROUP BY 1
UNION ALL SELECT -1, (SELECT CAST(count(*) AS BIGINT) FROM keyed) - (SELECT count(*) FROM old)""")
def archive_counts(spark, sf):
    """Rows archived per year, plus the kept rows as year -1 (old + kept = fact)."""
    old, kept = archive_sets(spark, sf)
    kept_n = kept.agg(F.lit(-1).alias("archive_year"), F.count(F.lit(1)).alias("archived_rows"))
    return archive.archive_counts(old).unionByName(kept_n)


# ------------------------------------------------------------------ reconciliation / extract

@query("reconcile", "A-21 U-03 A-01", with_ctes("stg_registration") + """
, c AS (
  SELECT 1 AS layer_no, 'source' AS layer, (SELECT count(*) FROM orders) AS row_count
  UNION ALL SELECT 2, 'staging', (SELECT count(*) FROM stg_registration)
  UNION ALL SELECT 3, 'valid', (SELECT count(*) FROM stg_registration WHERE dq_is_valid)
  UNION ALL SELECT 4, 'warehouse', (SELECT count(*) FROM stg_registration WHERE dq_is_valid))
SELECT CAST(c.layer_no - 1 AS INTEGER) AS layer_no, c.layer, CAST(c.row_count AS BIGINT) AS row_count,
       CAST(p.row_count AS BIGINT) AS previous_count, CAST(c.row_count - p.row_count AS BIGINT) AS difference
FROM c LEFT JOIN c p ON p.layer_no = c.layer_no - 1""")
def reconcile(spark, sf):
    """Counts from source to warehouse for registrations, with the loss at each step."""
    stg = domain.staging(spark, sf, "registration")
    f = warehouse.fact(spark, sf, "registration", skip=("codes", "zipcode", "file"))
    return recon.reconcile({"source": domain.table(spark, sf, "orders"), "staging": stg,
                            "valid": valid(stg), "warehouse": f})


@query("incremental_extract", "S-07", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'""")
def incremental_extract_q(spark, sf):
    """Rows at or after the high-water mark (a pushed-down scan filter)."""
    o = domain.table(spark, sf, "orders")
    return incremental_extract(o, "2001-01-01 00:00:00", "o_orderdate").select("o_orderkey", "o_orderdate")


# ------------------------------------------------------------------ prior counts under skew

@query("prior_registrations", "W-07", """
WITH p AS (SELECT CAST(o.o_orderkey AS VARCHAR) AS registration_id, CAST(o.o_orderdate AS DATE) AS registration_date,
                  CASE o.o_orderkey % 3 WHEN 0 THEN 'HOT' WHEN 1 THEN NULL ELSE c.c_name END AS first_name
           FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey),
n AS (SELECT *, row_number() OVER (PARTITION BY first_name ORDER BY registration_date, registration_id) - 1 AS prev FROM p)
SELECT registration_id, first_name, CAST(prev AS INTEGER) AS previous_registration_count, prev = 0 AS is_first_time_registration FROM n""")
def prior_registrations(spark, sf):
    """Earlier registrations of each person where one person holds a third of the
    rows and another third has no person at all."""
    name = F.when(F.col("o_orderkey") % 3 == 0, F.lit("HOT")).when(F.col("o_orderkey") % 3 == 1, F.lit(None)).otherwise(F.col("c_name"))
    c = domain.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    people = domain.table(spark, sf, "orders").join(c, "o_custkey", "left").select(
        F.col("o_orderkey").cast("string").alias("registration_id"), F.to_date("o_orderdate").alias("registration_date"), name.alias("first_name"))
    out = facts.first_time(people, ["first_name"], "registration_date", "registration_id")
    return out.select("registration_id", "first_name", "previous_registration_count", "is_first_time_registration")


# ------------------------------------------------------------------ marks and landed files

FIRST_SEEN = "1999-06-30 00:00:00"
_CHANGES = """l AS (SELECT l_orderkey AS k, l_shipdate AS s FROM lineitem),
a1 AS (SELECT o_orderkey AS order_id, o_orderdate AS created, max(s) AS updated FROM orders LEFT JOIN l ON k = o_orderkey AND s <= TIMESTAMP '{t}'
       WHERE o_orderdate <= TIMESTAMP '{t}' GROUP BY 1, 2),
a2 AS (SELECT o_orderkey AS order_id, o_orderdate AS created, max(s) AS updated FROM orders LEFT JOIN l ON k = o_orderkey GROUP BY 1, 2)""".format(t=FIRST_SEEN)


def order_changes(spark, sf, until=None):
    """Orders as a source system shows them at ``until``: when each was created and last shipped from."""
    o, li = domain.table(spark, sf, "orders"), domain.table(spark, sf, "lineitem")
    if until:
        t = F.lit(until).cast("timestamp")
        o, li = o.where(F.col("o_orderdate") <= t), li.where(F.col("l_shipdate") <= t)
    last = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.max("l_shipdate").cast("timestamp").alias("updated"))
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("created")).join(last, "order_id", "left")


@query("incremental_twice", "S-07 A-13", f"""
WITH {_CHANGES},
m AS (SELECT max(created) - INTERVAL 7 DAY AS c, max(updated) - INTERVAL 7 DAY AS u FROM a1)
SELECT 'first' AS run, * FROM a1
UNION ALL SELECT 'second', a2.* FROM a2, m WHERE (created >= m.c OR updated >= m.u)
  AND NOT EXISTS (SELECT 1 FROM a1 WHERE a1.order_id = a2.order_id AND a1.created = a2.created AND a1.updated IS NOT DISTINCT FROM a2.updated)""")
def incremental_twice(spark, sf):
    """Two extracts of the orders by high-water marks: what each run took."""
    path, out = scratch_path(spark, f"marks/{uuid.uuid4().hex}"), None
    for run, until in (("first", FIRST_SEEN), ("second", None)):
        rows = landing.take_batch(order_changes(spark, sf, until), path, "orders", ["order_id"], ["created", "updated"], run)
        rows = rows.select(F.lit(run).alias("run"), "order_id", "created", "updated")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("files_changed", "S-08 D-09 R-01", """
WITH d AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderdate < TIMESTAMP '2000-07-01' AS early FROM orders)
SELECT 'first' AS run, y AS order_year, 'NEW' AS status, count(*) AS row_count FROM d WHERE early GROUP BY 2
UNION ALL SELECT 'second', y, CASE WHEN y = 2000 THEN 'CHANGED' ELSE 'NEW' END, count(*) FROM d WHERE y >= 2000 GROUP BY 2, 3""")
def files_changed(spark, sf):
    """Yearly order folders ingested twice: the second time only the rows of the one
    that was replaced and of the new one are taken."""
    base = scratch_path(spark, f"landing/{uuid.uuid4().hex}")
    o = domain.table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    out = None
    for run, landed in (("first", o.where("o_orderdate < TIMESTAMP '2000-07-01'")), ("second", o.where("order_year >= 2000"))):
        (landed.withColumn("part", F.col("order_year")).repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("part").parquet(f"{base}/orders"))
        files = materialize(landing.files_to_read(spark, f"{base}/orders", f"{base}/registry", folders=True), "landed-files")
        rows = landing.read_listed(spark, files, o.schema, f"{base}/orders", folders=True)
        per = materialize(rows.groupBy("order_year", "status").agg(F.count(F.lit(1)).alias("row_count")).withColumn("run", F.lit(run)), "landed-counts")
        landing.register_files(files, f"{base}/registry", run)
        out = per if out is None else out.unionByName(per)
    return out


# ------------------------------------------------------------------ daily flow with gate and quarantine

#: (mode, rows dated from, before, batch instant) of each run; the last one comes with an instant before most of its rows.
RUNS = [("INITIAL", "1995-01-01", "1999-07-01", "1999-07-01 00:00:00"), ("INCREMENTAL", "1999-01-01", "2001-01-01", "2000-07-01 00:00:00"),
        ("INCREMENTAL", "1995-01-01", "2002-01-01", "1996-01-01 00:00:00")]
MAX_REJECTED = 0.5


def _runs_sql() -> str:
    out = []
    for n, (mode, lo, hi, ts) in enumerate(RUNS, 1):
        out.append(f"""SELECT {n} AS run_no, '{mode}' AS job_type, r.read AS records_read, r.bad AS records_rejected, r.bad > {MAX_REJECTED} * r.read AS failed,
       (SELECT count(DISTINCT o_orderkey) FROM orders WHERE {' OR '.join(f"(o_orderdate >= DATE '{a}' AND o_orderdate < DATE '{b}' AND CAST(o_orderdate AS DATE) <= TIMESTAMP '{t}')"
                                                                         for _, a, b, t in RUNS[:n])}) AS loaded
FROM (SELECT count(*) AS read, count(*) FILTER (CAST(o_orderdate AS DATE) > TIMESTAMP '{ts}') AS bad FROM orders WHERE o_orderdate >= DATE '{lo}' AND o_orderdate < DATE '{hi}') r""")
    return ("WITH r AS (" + "\nUNION ALL ".join(out) + """)
SELECT CAST(run_no AS INTEGER) AS run_no, job_type, CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status, records_read,
       CASE WHEN NOT failed THEN loaded END AS records_written, records_rejected FROM r
UNION ALL SELECT 0, 'quarantine', 'SUCCESS', CAST(NULL AS BIGINT), CAST(sum(records_rejected) AS BIGINT), NULL FROM r
UNION ALL SELECT 0, 'd_zipcode', 'SUCCESS', NULL, (SELECT count(*) FROM customer), NULL""")


@query("pipeline_counts", "X-09 Q-08 K-10 P-05 D-03", _runs_sql())
def pipeline_counts(spark, sf):
    """The run log of three daily flows over the registrations: an initial load, an
    incremental one with rows dated after the batch, and one that the gate stops;
    with the rows in quarantine and in the dimension loaded on the way."""
    root, ids = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}"), schemas.subject("registration")
    dims = domain.dims(spark, sf, with_zipcode=False, need={"d_code", "d_code_category", "d_state", "d_data_source"}, subject="registration")
    stg, zips = domain.staging(spark, sf, "registration"), domain.d_zipcode(spark, sf).select("zipcode", "state_key")
    loads = {"d_zipcode": pipeline.DimensionLoad(zips, ["zipcode"], ["state_key"], "zipcode_key")}
    for mode, lo, hi, ts in RUNS:
        raw = stg.where((F.col(ids["date"]) >= F.lit(lo).cast("date")) & (F.col(ids["date"]) < F.lit(hi).cast("date")))
        try:
            pipeline.run_pipeline(spark, "registration", mode, raw, root, ts, dims, dimension_loads=loads, max_rejected=MAX_REJECTED)
        except pipeline.GateFailed:
            continue  # the flow has logged it
    log = VersionedTable(spark, f"{root}/etl_control").read()
    runs = log.select(F.row_number().over(Window.orderBy("start_timestamp")).alias("run_no"), "job_type", "status", "records_read", "records_written", "records_rejected")
    for name, folder in (("quarantine", "rejected_registration"), ("d_zipcode", "d_zipcode")):
        n = VersionedTable(spark, f"{root}/{folder}").read().agg(F.count(F.lit(1)).alias("records_written"))
        runs = runs.unionByName(n.withColumns({"run_no": F.lit(0), "job_type": F.lit(name), "status": F.lit("SUCCESS")}), allowMissingColumns=True)
    return runs
