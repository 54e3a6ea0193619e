"""One subject's daily flow as plain functions (X-09): stage → check → gate → dimensions → fact → history → reconcile.

Each step reads what the previous one wrote (versioned Parquet tables under a
warehouse root) and a failing step raises, so the caller (a scheduler) stops;
the run log then gets a FAILED row with the counts known by then. Rows that
fail a check go to a quarantine table and not into the fact; a batch with too
many of them stops at the gate, before any dimension or fact changes. Read
and rejected rows are counted while staging is written, written rows while the
fact is. Driver code only handles counts and paths; rows stay in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.dates import date_key
from ..operators import facts, quality, recon, scd
from ..operators.keys import assign_keys
from ..operators.runlog import RunLog
from ..operators.staging import conform, invalid, latest_rows, stamp
from ..operators.tables import VersionedTable
from ..session import materialize
from ..sources.calendar import build_d_date

# Dimensions bounded by construction: seed lists and the generated calendar.
BOUNDED_DIMS = {"d_date", "d_code", "d_code_category", "d_state", "d_country", "d_data_source"}


def file_dimension(staged: DataFrame, d_data_source: DataFrame, batch_ts: str,
                   existing: DataFrame | None = None) -> DataFrame:
    """Operational file dimension: the staged files with their record counts,
    appended to the known files (new files get the next keys)."""
    # one row per file: a file holding rows of several source systems is
    # attributed to the first of them, so the file lookup stays one-to-one
    files = staged.groupBy(F.col("source_file_name").alias("file_name")) \
        .agg(F.count(F.lit(1)).alias("record_count"), F.min("source_system").alias("source_system"))
    files = files.join(F.broadcast(d_data_source.select("source_system", "data_source_key")),
                       "source_system", "left")
    if existing is not None:
        files = files.join(existing.select("file_name"), "file_name", "left_anti")
        start = existing.agg(F.coalesce(F.max("file_key"), F.lit(0)).cast("long")).scalar()
    else:
        start = F.lit(0)
    new = assign_keys(files, "file_key", ["file_name"], start) \
        .select("file_key", F.col("file_name").alias("file_id"), "data_source_key", "file_name",
                F.col("record_count").cast("long"), F.lit(batch_ts).cast("timestamp").alias("load_timestamp"),
                F.lit("COMPLETED").alias("processing_status"))
    return new if existing is None else existing.unionByName(new, allowMissingColumns=True)


class DimensionLoad(NamedTuple):
    """A type 2 dimension loaded before the fact: its source and how versions are told apart."""
    source: DataFrame
    natural_key: list[str]
    tracked: list[str]
    surrogate_key: str


class GateFailed(RuntimeError):
    """A batch has more rejected rows than allowed."""


def load_dimension(spark: SparkSession, table: VersionedTable, load: DimensionLoad, batch_ts: str, seed: DataFrame | None) -> DataFrame:
    """Apply a source to its dimension table (first to ``seed``, or an empty one) and read it back."""
    columns = load.source.schema.fields
    empty = T.StructType([T.StructField(load.surrogate_key, T.LongType()), *columns, T.StructField("effective_start_dt", T.TimestampType()),
                          T.StructField("effective_end_dt", T.TimestampType()), T.StructField("is_active", T.BooleanType())])
    now = table.read() if table.exists() else seed if seed is not None else spark.createDataFrame([], empty)
    table.write(scd.scd2_apply(load.source, now, load.natural_key, load.tracked, load.surrogate_key, batch_ts))
    return table.read()


def run_pipeline(spark: SparkSession, subject: str, mode: str, raw: DataFrame, root: str, batch_ts: str,
                 dims: Mapping[str, DataFrame], calendar=("1900-01-01", "2099-12-31"),
                 dimension_loads: Mapping[str, DimensionLoad] | None = None, max_rejected: float = 1.0) -> dict:
    """Load one batch of ``raw`` rows of ``subject`` into the warehouse at ``root``.

    ``dims``: seeded dimensions (``d_code``, ``d_code_category``, ``d_state``,
    ``d_data_source``; ``d_zipcode`` optional). ``dimension_loads`` are applied
    as type 2 loads before the fact and replace the dimension of that name.
    ``max_rejected`` is the share of rejected rows from which on the gate
    stops the batch (:class:`GateFailed`). Returns the counts of the run
    (a handful of numbers) and writes: staging, dq_results, the quarantine
    (``rejected_<subject>``), the loaded dimensions, d_file, the fact and, in
    INCREMENTAL mode, the fact history, each as a new table version, plus one
    ``etl_control`` row, also if the run fails.
    """
    log = RunLog(spark, f"load_{subject}", mode.upper())
    try:
        return _run(spark, subject, mode, raw, root, batch_ts, dims, calendar, dimension_loads or {}, max_rejected, log)
    except Exception as e:
        log.fail(e)
        VersionedTable(spark, f"{root}/etl_control").append(log.row())
        raise


def _run(spark, subject, mode, raw, root, batch_ts, dims, calendar, dimension_loads, max_rejected, log) -> dict:
    cfg = schemas.subject(subject)
    t = {name: VersionedTable(spark, f"{root}/{name}") for name in
         (cfg["table"], "dq_results", f"rejected_{subject}", "d_file", f"f_{subject}", f"f_{subject}_hist",
          "registration_person", "etl_control", *dimension_loads)}

    # the checks see every landed row; of an id's copies the latest is staged
    landed = materialize(conform(stamp(raw, batch_ts), cfg["schema"]), f"landed-{subject}")
    t["dq_results"].append(quality.run_checks(landed, subject, batch_ts))
    staged = quality.flag_rows(latest_rows(landed, cfg["id"], [cfg["date"]]), subject, batch_ts)
    seen = Observation(f"staged_{subject}")
    t[cfg["table"]].write(staged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(~F.col("dq_is_valid")).alias("rejected")))
    log.read, log.rejected = seen.get["read"], seen.get["rejected"]
    staged = t[cfg["table"]].read()
    if log.rejected:
        # a repeated run of the batch replaces its own rejected rows
        held, own = t[f"rejected_{subject}"], F.col("load_timestamp") == F.lit(batch_ts).cast("timestamp")
        rows = invalid(staged)
        held.write(held.read().where(~own).unionByName(rows) if held.exists() else rows)
    if log.read and log.rejected / log.read > max_rejected:
        raise GateFailed(f"{log.rejected} of {log.read} rows of {cfg['table']} rejected, at most {max_rejected:.2%} are allowed")

    d_file = file_dimension(staged, dims["d_data_source"], batch_ts,
                            t["d_file"].read() if t["d_file"].exists() else None)
    t["d_file"].write(d_file)

    all_dims = dict(dims)
    for name, load in dimension_loads.items():
        all_dims[name] = load_dimension(spark, t[name], load, batch_ts, dims.get(name))
    all_dims["d_file"] = t["d_file"].read()
    all_dims["d_date"] = build_d_date(spark, *calendar)
    from ..plans.domain import Dims
    dm = Dims(all_dims)
    dm.small = (BOUNDED_DIMS & set(all_dims)) - set(dimension_loads)  # files and zipcodes grow: their lookups check the size
    dm.calendar_span = tuple(calendar)

    fact_t, hist_t = t[f"f_{subject}"], t[f"f_{subject}_hist"]
    spec_key = facts.FACT_SPECS[subject]["key"]  # files sorted by the surrogate key (min/max skipping)
    initial, kw = mode.upper() == "INITIAL" or not fact_t.exists(), {}
    if subject == "registration":
        # hashed persons of all loads; replaced by id, so a repeated run gives the same
        earlier = None if initial else t["registration_person"].read()
        t["registration_person"].write(facts.next_persons(earlier, facts.person_rows(staged)))
        kw = {} if initial else {"earlier": earlier}
    if initial:
        fact = facts.build_fact(staged, dm, subject, batch_ts)
        fact_t.write(log.observe(fact), sort_by=[spec_key])
    else:
        existing = fact_t.read()
        hist = hist_t.read() if hist_t.exists() else None
        fact, new_hist = facts.load_fact(staged, dm, subject, "INCREMENTAL", existing, hist, batch_ts, **kw)
        # history first: if the fact write fails, the next run of the batch
        # finds the same changes and redoes its history rows
        hist_t.write(new_hist)
        fact_t.write(log.observe(fact), sort_by=[spec_key])
    rec = recon.reconcile({"landed": landed, "staging": staged, "valid": staged.filter("dq_is_valid"),
                           "warehouse": fact_t.read()})
    counts = {r["layer"]: r["row_count"] for r in rec.collect()}
    log.finish("SUCCESS", read=log.read,
               last_date=staged.agg(F.max(cfg["date"])).first()[0])
    t["etl_control"].append(log.row())
    counts["rejected"] = log.rejected
    counts["history"] = hist_t.read().count() if hist_t.exists() else 0
    counts["snapshot_date_key"] = spark.range(1).select(date_key(F.lit(batch_ts))).first()[0]
    return counts
