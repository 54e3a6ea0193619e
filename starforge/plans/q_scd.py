"""Registered queries: slowly changing dimensions on ``part`` and an SCD1 enrichment table.

The existing part dimension is the one loaded when the parts were first sold
before ``SCD_BATCH_TS``: one active version per such part, with the size it
had then (parts now above size 40 were one smaller). The source is today's
``part`` table. Applying SCD2 closes the grown parts, opens their new
versions, and adds the parts first sold later.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scd
from ..operators.keys import assign_keys, small_keys
from ..operators.staging import current
from ..session import materialize
from . import domain
from .catalog import query

SCD_BATCH_TS = "1998-01-01 00:00:00"
TRACKED = ["p_brand", "p_type", "p_size"]
NK = ["p_partkey"]


def part_source(spark, sf):
    return domain.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


def part_dimension(spark, sf):
    """The dimension as it stood before the batch (see module doc)."""
    li = domain.table(spark, sf, "lineitem")
    first = li.groupBy("l_partkey").agg(F.min("l_shipdate").alias("first_sale")) \
        .filter(F.col("first_sale") < F.lit(SCD_BATCH_TS).cast("timestamp"))
    p = part_source(spark, sf).join(first.hint("merge"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    p = p.withColumn("p_size", F.when(F.col("p_size") > 40, F.col("p_size") - 1).otherwise(F.col("p_size")))
    # the starting state is numbered in natural-key order (distributed numbering)
    keyed = assign_keys(p, "part_key", NK)
    return keyed.select("part_key", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
                        F.lit(domain.DIM_START_TS).cast("timestamp").alias("effective_start_dt"),
                        F.lit(None).cast("timestamp").alias("effective_end_dt"),
                        F.lit(True).alias("is_active"))


def applied(spark, sf):
    return scd.scd2_apply(part_source(spark, sf), part_dimension(spark, sf), NK, TRACKED, "part_key",
                          SCD_BATCH_TS)


_CUR = f"""WITH first_sale AS (SELECT l_partkey, min(l_shipdate) AS d FROM lineitem GROUP BY 1),
cur AS (
  SELECT row_number() OVER (ORDER BY p.p_partkey) AS part_key, p.p_partkey, p.p_name, p.p_brand, p.p_type,
         CASE WHEN p.p_size > 40 THEN p.p_size - 1 ELSE p.p_size END AS p_size
  FROM part p JOIN first_sale f ON f.l_partkey = p.p_partkey
  WHERE f.d < TIMESTAMP '{SCD_BATCH_TS}'),
cmp AS (
  SELECT s.*, c.part_key AS cur_key,
         CASE WHEN c.p_partkey IS NULL THEN 'NEW'
              WHEN s.p_brand IS DISTINCT FROM c.p_brand OR s.p_type IS DISTINCT FROM c.p_type
                   OR s.p_size IS DISTINCT FROM c.p_size THEN 'CHANGED' ELSE 'UNCHANGED' END AS action
  FROM part s LEFT JOIN cur c ON s.p_partkey = c.p_partkey),
maxk AS (SELECT coalesce(max(part_key), 0) AS m FROM cur),
applied AS (
  SELECT c.part_key, c.p_partkey, c.p_name, c.p_brand, c.p_type, c.p_size,
         TIMESTAMP '{domain.DIM_START_TS}' AS effective_start_dt,
         CASE WHEN x.action = 'CHANGED' THEN TIMESTAMP '{SCD_BATCH_TS}' END AS effective_end_dt,
         x.action <> 'CHANGED' AS is_active
  FROM cur c JOIN cmp x ON x.p_partkey = c.p_partkey
  UNION ALL
  SELECT (SELECT m FROM maxk) + row_number() OVER (ORDER BY p_partkey), p_partkey, p_name, p_brand, p_type, p_size,
         TIMESTAMP '{SCD_BATCH_TS}', CAST(NULL AS TIMESTAMP), TRUE
  FROM cmp WHERE action IN ('NEW', 'CHANGED'))
"""


@query("scd2_classify", "D-05 J-01 D-01 F-01 F-02", _CUR + "SELECT p_partkey, action FROM cmp")
def scd2_classify(spark, sf):
    out = scd.classify(part_source(spark, sf), part_dimension(spark, sf), NK, TRACKED)
    return out.select("p_partkey", "action")


@query("scd2_diff", "D-02 J-09 J-10 P-08 U-01", _CUR + f"""
SELECT 'INSERT' AS action, p_partkey, CAST(NULL AS BIGINT) AS part_key, p_brand, p_type, p_size,
       TIMESTAMP '{SCD_BATCH_TS}' AS effective_start_dt
FROM cmp WHERE action IN ('NEW', 'CHANGED')
UNION ALL
SELECT 'EXPIRE', p_partkey, cur_key, NULL, NULL, NULL, NULL FROM cmp WHERE action = 'CHANGED'""")
def scd2_diff(spark, sf):
    return scd.scd2_diff_frame(part_source(spark, sf), part_dimension(spark, sf), NK, TRACKED, "part_key",
                               SCD_BATCH_TS)


@query("scd2_apply", "D-03 W-08 K-03 P-15", _CUR + "SELECT * FROM applied")
def scd2_apply(spark, sf):
    return applied(spark, sf)


# ------------------------------------------------------------------ a second batch

SECOND_TS = "2000-01-01 00:00:00"   # fixed value: the instant of the second batch


def second_source(spark, sf):
    """The source at the second batch: the parts still sold since the first one;
    those returned at least once since then come one size up."""
    li = domain.table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= F.lit(SCD_BATCH_TS).cast("timestamp"))
    sold = li.groupBy("l_partkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"))
    p = part_source(spark, sf).join(sold.hint("merge"), F.col("p_partkey") == F.col("l_partkey"))
    return p.select("p_partkey", "p_name", "p_brand", "p_type",
                    F.when(F.col("returned"), F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"))


def applied_twice(spark, sf):
    """The dimension after both batches; the state between them is a written table."""
    first = materialize(applied(spark, sf), "part-dimension")
    return scd.scd2_apply(second_source(spark, sf), first, NK, TRACKED, "part_key", SECOND_TS, expire_missing=True)


_TWICE = _CUR + f""",
sold AS (SELECT l_partkey, bool_or(l_returnflag = 'R') AS returned FROM lineitem
         WHERE l_shipdate >= TIMESTAMP '{SCD_BATCH_TS}' GROUP BY 1),
src2 AS (SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, CASE WHEN s.returned THEN p.p_size + 1 ELSE p.p_size END AS p_size
         FROM part p JOIN sold s ON s.l_partkey = p.p_partkey),
open1 AS (SELECT * FROM applied WHERE is_active),
reopened AS (SELECT s.* FROM src2 s LEFT JOIN open1 a USING (p_partkey)
             WHERE a.p_partkey IS NULL OR (s.p_brand, s.p_type, s.p_size) IS DISTINCT FROM (a.p_brand, a.p_type, a.p_size)),
shut AS (SELECT a.part_key FROM open1 a LEFT JOIN src2 s USING (p_partkey)
         WHERE s.p_partkey IS NULL OR (s.p_brand, s.p_type, s.p_size) IS DISTINCT FROM (a.p_brand, a.p_type, a.p_size)),
twice AS (
  SELECT a.* REPLACE (CASE WHEN h.part_key IS NOT NULL THEN TIMESTAMP '{SECOND_TS}' ELSE a.effective_end_dt END AS effective_end_dt,
                      a.is_active AND h.part_key IS NULL AS is_active)
  FROM applied a LEFT JOIN shut h USING (part_key)
  UNION ALL
  SELECT (SELECT max(part_key) FROM applied) + row_number() OVER (ORDER BY p_partkey), p_partkey, p_name, p_brand, p_type, p_size,
         TIMESTAMP '{SECOND_TS}', CAST(NULL AS TIMESTAMP), TRUE
  FROM reopened)
"""


@query("scd2_apply_twice", "D-03 D-02 W-08 P-15", _TWICE + "SELECT * FROM twice")
def scd2_apply_twice(spark, sf):
    """A second batch on a dimension that holds closed versions: those stay as
    they are, changed and missing parts are closed, changed and new ones opened."""
    return applied_twice(spark, sf)


@query("scd2_current", "P-04 D-03", _TWICE + "SELECT part_key, p_partkey, p_size, effective_start_dt FROM twice WHERE is_active")
def scd2_current(spark, sf):
    """Active versions of a dimension most of whose parts have closed ones."""
    return current(applied_twice(spark, sf)).select("part_key", "p_partkey", "p_size", "effective_start_dt")


@query("scd2_check", "D-06 W-09", _CUR + """
, per_key AS (
  SELECT p_partkey, count(*) AS versions, count(*) FILTER (WHERE is_active) AS active_rows
  FROM applied GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS keys_checked,
       CAST(count(*) FILTER (WHERE versions > 1) AS BIGINT) AS keys_with_history,
       CAST(sum(versions) AS BIGINT) AS versions,
       CAST(count(*) FILTER (WHERE active_rows <> 1) AS BIGINT) AS violations
FROM per_key""")
def scd2_check(spark, sf):
    """Integrity of the applied dimension: per-key rules, summarized in one row."""
    dim = applied(spark, sf)
    bad = scd.check_scd2(dim, NK)
    per_key = dim.groupBy(*NK).agg(F.count(F.lit(1)).alias("versions"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys_checked"),
        F.count_if(F.col("versions") > 1).alias("keys_with_history"),
        F.sum("versions").cast("long").alias("versions"),
    ).withColumn("violations", bad.agg(F.count(F.lit(1))).scalar())


@query("scd2_as_of", "J-13 P-04", _CUR + """
SELECT part_key, p_partkey, p_size, is_active FROM applied
WHERE effective_start_dt <= TIMESTAMP '1997-06-01 00:00:00'
  AND (effective_end_dt IS NULL OR effective_end_dt > TIMESTAMP '1997-06-01 00:00:00')""")
def scd2_as_of(spark, sf):
    """Versions valid on 1997-06-01 (before the batch): the old sizes."""
    return scd.as_of(applied(spark, sf), "1997-06-01 00:00:00").select("part_key", "p_partkey", "p_size",
                                                                          "is_active")


@query("scd2_as_of_join", "J-14", _CUR + """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, a.part_key, a.p_size
FROM lineitem l LEFT JOIN applied a ON a.p_partkey = l.l_partkey
  AND a.effective_start_dt <= l.l_shipdate AND (a.effective_end_dt IS NULL OR a.effective_end_dt > l.l_shipdate)""")
def scd2_as_of_join(spark, sf):
    """Every shipped line joined to the part version valid on its ship date."""
    li = domain.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    out = scd.as_of_carry(li, applied(spark, sf), {"l_partkey": "p_partkey"}, "l_shipdate",
                          ["part_key", "p_size"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "part_key", "p_size")


@query("scd2_timeline", "W-09 T-05", _CUR + """
SELECT part_key, p_partkey, effective_start_dt, effective_end_dt, is_active,
       row_number() OVER (PARTITION BY p_partkey ORDER BY effective_start_dt, effective_end_dt NULLS LAST) AS version_no,
       lead(effective_start_dt) OVER (PARTITION BY p_partkey ORDER BY effective_start_dt, effective_end_dt NULLS LAST) AS next_start
FROM applied""")
def scd2_timeline(spark, sf):
    t = scd.timeline(applied(spark, sf), NK)
    return t.select("part_key", "p_partkey", "effective_start_dt", "effective_end_dt", "is_active",
                    F.col("version_no").cast("long"), "next_start")


# ------------------------------------------------------------------ SCD1 enrichment

def nation_stats(spark, sf, before: str | None):
    """Supplier activity per state (nation): active suppliers and shipped quantity."""
    li = domain.table(spark, sf, "lineitem")
    if before is not None:
        li = li.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp"))
    s = domain.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = li.select("l_suppkey", "l_quantity").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return (j.groupBy(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("state_code"))
            .agg(F.count_distinct("l_suppkey").alias("active_suppliers"),
                 F.sum("l_quantity").cast("decimal(18,2)").alias("shipped_qty")))


@query("scd1_apply", "D-04 K-05 J-18", f"""
WITH act AS (SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS state_code, l.l_suppkey, l.l_quantity, l.l_shipdate
             FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
old AS (SELECT row_number() OVER (ORDER BY state_code) AS stats_key, state_code FROM act
        WHERE l_shipdate < TIMESTAMP '{SCD_BATCH_TS}' GROUP BY state_code),
src AS (SELECT state_code, count(DISTINCT l_suppkey) AS active_suppliers,
               CAST(sum(l_quantity) AS DECIMAL(18,2)) AS shipped_qty FROM act GROUP BY 1)
SELECT coalesce(o.stats_key, (SELECT coalesce(max(stats_key), 0) FROM old)
                + row_number() OVER (PARTITION BY o.stats_key IS NULL ORDER BY s.state_code)) AS stats_key,
       s.state_code, s.active_suppliers, s.shipped_qty, TIMESTAMP '{domain.BATCH_TS}' AS last_updated_dt
FROM src s LEFT JOIN old o ON o.state_code = s.state_code""")
def scd1_apply(spark, sf):
    """Refresh a type-1 enrichment table: values overwritten in place, keys kept."""
    old = small_keys(nation_stats(spark, sf, SCD_BATCH_TS), "stats_key", ["state_code"]) \
        .withColumn("last_updated_dt", F.lit(domain.DIM_START_TS).cast("timestamp"))
    src = nation_stats(spark, sf, None)
    return scd.scd1_apply(old, src, ["state_code"], "stats_key", domain.BATCH_TS) \
        .select("stats_key", "state_code", F.col("active_suppliers").cast("long"), "shipped_qty",
                "last_updated_dt")
