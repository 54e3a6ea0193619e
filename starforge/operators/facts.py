"""Fact builders, incremental split, fact history, load modes (X-01..X-06, W-07, P-03)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import completed_years, date_key
from ..functions.hashing import change_hash
from ..session import materialize
from .keys import assign_keys
from .lookup import lookup, lookup_code, lookup_date
from .segments import prefix_sum
from .staging import latest_rows, strip_pii, valid

NEW, CHANGED, UNCHANGED = "NEW", "CHANGED", "UNCHANGED"

# Per subject: date roles, code roles (category id), tracked columns of the
# change hash, and the measure columns. Category ids are the reference's seed ids.
FACT_SPECS = {
    "registration": {
        "id": "registration_id", "key": "registration_key",
        "dates": {"registration_date": "registration_date_key", "birth_date": "birth_date_key"},
        "codes": {"registration_status": ("REG_STATUS", "registration_status_code_key"),
                  "registration_type": ("REG_TYPE", "registration_type_code_key"),
                  "classification": ("CLASSIFICATION", "classification_code_key")},
        "tracked": ["registration_id", "registration_status"],
        "key_order": [],
    },
    "compliance": {
        "id": "compliance_id", "key": "compliance_key",
        "dates": {"compliance_date": "compliance_date_key", "due_date": "due_date_key",
                  "completion_date": "completion_date_key"},
        "codes": {"compliance_status": ("COMP_STATUS", "compliance_status_code_key"),
                  "compliance_result": ("COMP_RESULT", "compliance_result_code_key")},
        "tracked": ["compliance_id", "compliance_status", "compliance_result"],
        "key_order": ["compliance_date_key", "completion_date_key", "compliance_score", "state_key",
                      "registration_id"],
    },
    "verification": {
        "id": "verification_id", "key": "verification_key",
        "dates": {"verification_date": "verification_date_key", "request_date": "request_date_key",
                  "response_date": "response_date_key"},
        "codes": {"verification_method": ("VERIF_METHOD", "verification_method_code_key"),
                  "verification_status": ("VERIF_STATUS", "verification_status_code_key"),
                  "verification_result": ("VERIF_RESULT", "verification_result_code_key")},
        "tracked": ["verification_id", "verification_status", "verification_result"],
        "key_order": [],
    },
}


def _ts(v) -> Column:
    if v is None:
        return F.current_timestamp()
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def first_time(df: DataFrame, person: Sequence[str], date: str, id_col: str) -> DataFrame:
    """``previous_registration_count`` and ``is_first_time_registration`` (W-07).

    Previous count = rows of the same person (NULL parts equal) earlier in
    ``(date, id)`` order; rows that tie on both don't count one another. The
    counts are prefix sums over narrow rows, one per (person, date, id), in
    range-partitioned order, so neither a prolific person nor the rows
    without one land in a single task; they join back on the same three columns.
    """
    rows = df.withColumn("_ft_person", change_hash(list(person), "safe"))
    steps = (rows.groupBy("_ft_person", F.col(date).alias("_ft_date"), F.col(id_col).alias("_ft_id")).agg(F.count(F.lit(1)).alias("_ft_n"))
             .withColumnRenamed("_ft_person", "_ft_key"))
    before = prefix_sum(steps, ["_ft_key"], ["_ft_date", "_ft_id"], "_ft_n", "_ft_prev", "person-counts")
    same = ((F.col("_ft_person") == F.col("_ft_key")) & F.col(date).eqNullSafe(F.col("_ft_date")) & F.col(id_col).eqNullSafe(F.col("_ft_id")))
    prev = F.col("_ft_prev").cast("int")
    return (rows.join(before, same, "left").withColumn("previous_registration_count", prev)
            .withColumn("is_first_time_registration", prev == 0)
            .drop("_ft_person", "_ft_key", "_ft_date", "_ft_id", "_ft_n", "_ft_prev"))


PERSON = ("first_name", "last_name", "birth_date")


def person_rows(staging: DataFrame, person: Sequence[str] = PERSON, only_valid: bool = True) -> DataFrame:
    """(registration_id, registration_date, person_key) of a load's rows. The key
    is a hash of the person's columns (NULL-safe), so later loads can count a
    person's earlier registrations without keeping personal data."""
    df = valid(staging) if only_valid else staging
    return df.select("registration_id", "registration_date", change_hash(list(person), "safe").alias("person_key"))


def next_persons(earlier: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Person rows after a load: the batch's rows replace those of the same ids."""
    if earlier is None:
        return batch
    return earlier.join(batch.select("registration_id"), "registration_id", "left_anti").unionByName(batch)


def first_time_after(df: DataFrame, earlier: DataFrame, person: Sequence[str]) -> DataFrame:
    """:func:`first_time` over the rows of ``df`` and the earlier loads' rows
    (see :func:`person_rows`) of the same persons. Earlier rows with an id of
    ``df`` are replaced by it. Only the batch's persons are read on; rows of
    earlier loads keep the counts they were loaded with."""
    batch = df.withColumn("_person", change_hash(list(person), "safe"))
    past = (earlier.join(batch.select("registration_id"), "registration_id", "left_anti")
            .join(batch.select(F.col("_person").alias("person_key")).distinct(), "person_key", "left_semi")
            .select("registration_id", "registration_date", F.col("person_key").alias("_person"), F.lit(True).alias("_past")))
    both = batch.withColumn("_past", F.lit(False)).unionByName(past, allowMissingColumns=True)
    return first_time(both, ["_person"], "registration_date", "registration_id").filter(~F.col("_past")).drop("_past", "_person")


def build_fact(staging: DataFrame, dims: Mapping[str, DataFrame], subject: str, batch_ts=None,
               hash_mode: str = "safe", assign: bool = True, key_start=0,
               state_match: str = "state_code", source_match: str = "source_system",
               person: Sequence[str] = PERSON,
               only_valid: bool = True, person_counts: bool = True,
               skip: Sequence[str] = (), earlier: DataFrame | None = None,
               codes: Sequence[str] | None = None,
               layout: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Fact rows of one subject from valid staging rows (X-01..X-03).

    Surrogate lookups (dates, codes per category, zip, state with its
    country, data source, file) are left joins against active dimension rows;
    the bounded dimensions are broadcast behind a size check, so the staging
    side is never shuffled for them. No personal column survives.
    ``person_counts=False`` skips the per-person window (W-07) for callers
    that only aggregate; ``earlier`` (:func:`person_rows` of the loads before)
    makes it count their registrations too; ``assign=False`` leaves the surrogate key NULL;
    ``skip`` (``codes``, ``zipcode``, ``state``, ``source``, ``file``) leaves
    those keys NULL for callers that do not read them, and ``codes`` looks up
    only some code categories. ``layout`` deals the rows (for a
    partitioned write) before the lookups and the change hash widen them. Dimensions listed in
    ``dims.small`` were counted once by their builder and are broadcast
    without another count.
    ``dims``: ``d_date, d_code, d_code_category, d_state, d_data_source,
    d_file`` and, for registration, ``d_zipcode``.
    """
    spec = FACT_SPECS[subject]
    ts = _ts(batch_ts)
    small = getattr(dims, "small", set())

    def bc(name):  # dimensions already counted against the bound broadcast directly
        return True if name in small else None

    def null_key(frame, col):
        return frame.withColumn(col, F.lit(None).cast("long"))

    df = valid(staging) if only_valid else staging
    if subject == "registration":  # before the lookups: the counts read staging rows only
        if person_counts and earlier is not None:
            df = first_time_after(df, earlier, person)
        elif person_counts:
            df = first_time(df, list(person), "registration_date", "registration_id")
        else:
            df = df.withColumns({"previous_registration_count": F.lit(None).cast("int"),
                                 "is_first_time_registration": F.lit(None).cast("boolean")})
    for col, out in spec["dates"].items():
        df = lookup_date(df, dims["d_date"], col, out, broadcast=bc("d_date") or True,
                         span=getattr(dims, "calendar_span", None))
    if "state" in skip:
        df = null_key(df, "state_key")
        if subject == "registration":
            df = null_key(df, "country_key")
    else:
        df = lookup(df, dims["d_state"], {"state": state_match}, "state_key", active_only=True,
                    extra=["country_key"] if subject == "registration" else (), broadcast=bc("d_state"))

    if subject == "registration":
        df = df.withColumn("age_at_registration", completed_years("birth_date", "registration_date"))
        df = df.withColumns({"effective_date_key": F.col("registration_date_key"),
                             "source_record_version": F.lit(1)})
        cols = [c.name for c in schemas.F_REGISTRATION.fields]
    elif subject == "compliance":
        df = df.withColumn("days_to_completion",
                           F.datediff("completion_date", "compliance_date").cast("int"))
        if "compliance_score" not in df.columns:
            df = df.withColumn("compliance_score", F.lit(None).cast("decimal(5,2)"))
        cols = ["compliance_key", "compliance_id", "registration_id", "compliance_date_key",
                "due_date_key", "completion_date_key", "compliance_status_code_key",
                "compliance_result_code_key", "state_key", "data_source_key", "file_key",
                "is_doj_referral", "compliance_score", "days_to_completion", "source_list_type",
                "source_year", "error_message", "retry_count", "source_system_id", "record_hash",
                "created_dt", "updated_dt"]
    else:
        df = df.withColumn("response_time_seconds",
                           (F.unix_timestamp(F.col("response_date").cast("timestamp"))
                            - F.unix_timestamp(F.col("request_date").cast("timestamp"))).cast("int"))
        cols = ["verification_key", "verification_id", "registration_id", "verification_date_key",
                "request_date_key", "response_date_key", "verification_method_code_key",
                "verification_status_code_key", "verification_result_code_key", "state_key",
                "data_source_key", "file_key", "is_match", "match_score", "interim_status",
                "verification_flags", "response_time_seconds", "error_message", "retry_count",
                "source_system_id", "record_hash", "created_dt", "updated_dt"]
    key = spec["key"]
    body = [c for c in cols if c != key]
    # The key comes before the other lookups: range sampling and the numbering
    # pass then run on the staging rows' narrow columns, and each lookup runs once.
    inputs = [*spec["codes"], "source_system", "source_file_name"] + (["zipcode"] if subject == "registration" else [])
    df = df.select(*dict.fromkeys([*[c for c in body if c in df.columns], *inputs]))
    if assign:
        # ids may repeat in staging (the uniqueness check reports them); the
        # tie-breakers make the order total, so keys are reproducible
        order = [spec["id"], change_hash(spec["tracked"], hash_mode)] + [F.col(c).asc_nulls_first() for c in spec["key_order"]]
        df = assign_keys(df, key, order, key_start)
    else:
        df = df.withColumn(key, F.lit(None).cast("long"))
    if layout is not None:
        df = layout(df)
    # what other columns or the load give is added behind the shuffles, not carried through them
    df = df.withColumns({"record_hash": change_hash(spec["tracked"], hash_mode),
                         "source_system_id": F.col("source_system"), "created_dt": ts, "updated_dt": ts})
    if subject != "registration":
        df = df.withColumn("retry_count", F.lit(0))
    for col, (cat, out) in spec["codes"].items():
        if "codes" in skip or (codes is not None and cat not in codes):
            df = null_key(df, out)
        else:
            df = lookup_code(df, dims["d_code"], dims["d_code_category"], cat, col, out,
                             broadcast=bc("d_code"))
    if subject == "registration":
        if "d_zipcode" in dims and "zipcode" not in skip:
            df = lookup(df, dims["d_zipcode"], {"zipcode": "zipcode"}, "zipcode_key", active_only=True)
        else:
            df = null_key(df, "zipcode_key")
    if "source" in skip:
        df = null_key(df, "data_source_key")
    else:
        df = lookup(df, dims["d_data_source"], {"source_system": source_match}, "data_source_key",
                    active_only=True, broadcast=bc("d_data_source"))
    if "file" in skip:
        df = null_key(df, "file_key")
    else:
        df = lookup(df, dims["d_file"], {"source_file_name": "file_name"}, "file_key",
                    broadcast=bc("d_file"))
    return strip_pii(df.select(*cols), schemas.PII_COLUMNS)


def split_changes(new: DataFrame, existing: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    """Incremental split (X-04): each incoming row tagged NEW / CHANGED / UNCHANGED.

    One left join on the business key (J-09 and J-10 in one pass); the count
    per key of the target uses the same partitioning. A key that the target
    holds twice is an error. Rows without a key are NEW.
    """
    twice = F.raise_error(F.concat(F.lit(f"repeated {key} in the target: "), F.col(key).cast("string")))
    ex = (existing.filter(F.col(key).isNotNull()).groupBy(key)
          .agg(F.max(hash_col).alias("_ex_hash"), F.count(F.lit(1)).alias("_ex_n"))
          .select(key, "_ex_hash", F.when(F.col("_ex_n") > 1, twice.cast("boolean")).otherwise(F.lit(True)).alias("_ex_hit")))
    j = new.join(ex, key, "left")
    action = (F.when(F.col("_ex_hit").isNull(), F.lit(NEW))
              .when(~F.col(hash_col).eqNullSafe(F.col("_ex_hash")), F.lit(CHANGED))
              .otherwise(F.lit(UNCHANGED)))
    return j.withColumn("action", action).drop("_ex_hit", "_ex_hash")


def new_rows(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the target (J-09)."""
    return src.join(tgt.select(key), key, "left_anti")


def changed_rows(src: DataFrame, tgt: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    """Rows present in both with a different hash (J-10)."""
    t = tgt.select(key, F.col(hash_col).alias("_t_hash"))
    return src.join(t, key, "inner").filter(~F.col(hash_col).eqNullSafe(F.col("_t_hash"))).drop("_t_hash")


def history_rows(changes: DataFrame, existing: DataFrame, hist: DataFrame | None, key: str, sk: str,
                 cols: Sequence[str], batch_ts) -> DataFrame:
    """Next state of a fact history (X-05) for the CHANGED rows of a split.

    For each changed business key: its current history row is closed
    (``effective_end_dt = batch_ts``, not current); when it has none, the
    prior fact row is written as a closed INSERT row so the pair
    (closed prior, open UPDATE) exists. The new row is opened with
    ``change_type='UPDATE'`` and the batch's snapshot date key. Untouched
    history rows pass through. All joins are on the business key.
    Rows that an unfinished run of the same ``batch_ts`` wrote for these keys
    are undone first, so the history may be written before the fact and the
    batch run again.
    """
    ts = _ts(batch_ts)
    snap = date_key(ts)
    chg = changes.filter(F.col("action") == CHANGED)
    chg_keys = chg.select(key)
    hist_cols = [sk, key, "snapshot_date_key", *cols, "change_type", "effective_start_dt",
                 "effective_end_dt", "is_current", "created_dt"]
    opened = chg.drop(sk).join(existing.select(key, sk), key, "inner").select(
        F.col(sk), F.col(key), snap.alias("snapshot_date_key"), *[F.col(c) for c in cols],
        F.lit("UPDATE").alias("change_type"), ts.alias("effective_start_dt"),
        F.lit(None).cast("timestamp").alias("effective_end_dt"), F.lit(True).alias("is_current"),
        ts.alias("created_dt"))
    if hist is None:
        hist = opened.limit(0)
    hist = hist.select(*hist_cols)
    touched = hist.join(chg_keys, key, "left_semi")
    own = (((F.col("change_type") == "UPDATE") & F.col("effective_start_dt").eqNullSafe(ts))
           | ((F.col("change_type") == "INSERT") & F.col("effective_end_dt").eqNullSafe(ts)))
    closed_here = F.col("effective_end_dt").eqNullSafe(ts)
    touched = touched.filter(~own).withColumns({
        "is_current": F.col("is_current") | closed_here,
        "effective_end_dt": F.when(~closed_here, F.col("effective_end_dt"))})
    untouched = hist.join(chg_keys, key, "left_anti")
    closed = touched.withColumns({
        "effective_end_dt": F.when(F.col("is_current"), ts).otherwise(F.col("effective_end_dt")),
        "is_current": F.lit(False)})
    has_current = touched.filter("is_current").select(key).distinct()
    prior = (existing.join(chg_keys, key, "left_semi").join(has_current, key, "left_anti")
             .select(F.col(sk), F.col(key), date_key(F.col("created_dt")).alias("snapshot_date_key"),
                     *[F.col(c) for c in cols], F.lit("INSERT").alias("change_type"),
                     F.col("created_dt").alias("effective_start_dt"), ts.alias("effective_end_dt"),
                     F.lit(False).alias("is_current"), F.col("created_dt")))
    return untouched.unionByName(closed).unionByName(prior).unionByName(opened)


def upsert_fact(existing: DataFrame, split: DataFrame, key: str, sk: str, batch_ts=None,
                update_current: bool = True) -> DataFrame:
    """Next fact state after an incremental batch (K-05 for facts, X-06).

    CHANGED rows replace their existing row and keep its surrogate key
    (``update_current=False`` keeps the old row, the as-written behaviour);
    NEW rows get keys after the current maximum, in business-key order.
    """
    ts = _ts(batch_ts)
    cols = existing.columns
    changed = split.filter(F.col("action") == CHANGED)
    fresh = split.filter(F.col("action") == NEW).drop(sk)
    start = existing.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()
    fresh = assign_keys(fresh, sk, [key], start).withColumn("updated_dt", ts)
    if not update_current:
        return existing.unionByName(fresh.select(*cols))
    repl = changed.drop(sk).join(existing.select(key, sk, F.col("created_dt").alias("_c0")), key, "inner") \
        .withColumn("created_dt", F.col("_c0")).withColumn("updated_dt", ts).drop("_c0")
    keep = existing.join(changed.select(key), key, "left_anti")
    return keep.unionByName(repl.select(*cols)).unionByName(fresh.select(*cols))


def load_fact(staging: DataFrame, dims: Mapping[str, DataFrame], subject: str, mode: str,
              existing: DataFrame | None = None, hist: DataFrame | None = None, batch_ts=None,
              hash_mode: str = "safe", update_current: bool = True, materialize_split: bool = True, **kw):
    """INITIAL: the whole fact (written with overwrite, so a rerun does not
    double it). INCREMENTAL: ``(fact, history)`` next states (X-06). Of rows
    with the same business id the latest valid one is loaded (A-13). An
    incremental load of registrations needs ``earlier`` to count a person's
    registrations of the loads before."""
    spec = FACT_SPECS[subject]
    if kw.get("only_valid", True):
        staging = valid(staging)
    staging = latest_rows(staging, spec["id"], [schemas.subject(subject)["date"]])
    mode = mode.upper()
    if mode == "INITIAL":
        return build_fact(staging, dims, subject, batch_ts, hash_mode, **kw)
    if mode != "INCREMENTAL":
        raise ValueError(f"mode must be INITIAL or INCREMENTAL, not {mode!r}")
    if existing is None:
        raise ValueError("INCREMENTAL needs the existing fact")
    built = build_fact(staging, dims, subject, batch_ts, hash_mode, assign=False, **kw)
    split = split_changes(built, existing, spec["id"])
    if materialize_split:
        # the split feeds both the fact upsert and the history: write it once
        # (shared checkpoint folder) so the batch is built and compared once
        split = materialize(split, f"split-{subject}")
    fact = upsert_fact(existing, split, spec["id"], spec["key"], batch_ts, update_current)
    hist_cols = {"registration": ["registration_date_key", "registration_status_code_key",
                                  "registration_type_code_key", "zipcode_key", "state_key"],
                 "compliance": ["compliance_date_key", "compliance_status_code_key",
                                "compliance_result_code_key"],
                 "verification": ["verification_date_key", "verification_status_code_key",
                                  "verification_result_code_key"]}[subject]
    new_hist = history_rows(split, existing, hist, spec["id"], spec["key"], hist_cols, batch_ts)
    return fact, new_hist
