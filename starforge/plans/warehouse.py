"""Warehouse builds on the driver's tables: staging → dimensions → facts → star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.facts import FACT_SPECS, build_fact
from ..operators.lookup import star
from . import domain

SUBJECTS = ("registration", "compliance", "verification")
# Dimensions the report datasets read (the file dimension is operational only).
REPORT_DIMS = {"d_date", "d_code", "d_code_category", "d_state", "d_country", "d_data_source"}
# Roles of the registration star: dimension, fact key, dimension key, columns.
REGISTRATION_ROLES = {
    "reg": ("d_date", "registration_date_key", "date_key", ["date_value", "year", "quarter", "month", "month_name"]),
    "state": ("d_state", "state_key", "state_key", ["state_name", "state_code"]),
    "country": ("d_country", "country_key", "country_key", ["country_name"]),
    "status": ("d_code", "registration_status_code_key", "code_key", ["code_value"]),
    "type": ("d_code", "registration_type_code_key", "code_key", ["code_value"]),
}


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s: domain.staging(spark, sf_dir, s) for s in SUBJECTS}


def fact(spark: SparkSession, sf_dir: str, subject: str, keys: bool = False,
         zipcode: bool = False, person_counts: bool = False, skip=(),
         stg: DataFrame | None = None, dims: dict | None = None, codes=None, whole: bool = False, layout=None) -> DataFrame:
    """A fact as the daily load builds it. Aggregating callers leave out the
    surrogate key, the zipcode lookup, the per-person counts, lookups in
    ``skip`` and code categories not in ``codes``; none of these changes any
    other column. ``whole`` keys codes and files over all subjects."""
    stg = stg if stg is not None else domain.staging(spark, sf_dir, subject)
    if dims is None:
        need = {"d_date", "d_code", "d_code_category", "d_state", "d_country", "d_data_source", "d_file"}
        if "file" in skip:
            need.discard("d_file")
        if "codes" in skip:
            need -= {"d_code", "d_code_category"}
        if zipcode:
            need.add("d_zipcode")
        dims = domain.dims(spark, sf_dir, with_zipcode=zipcode, need=need, subject=subject, whole=whole)
    return build_fact(stg, dims, subject, domain.BATCH_TS, assign=keys,
                      person_counts=person_counts, skip=skip, codes=codes, layout=layout)


def _skips(codes, state: bool) -> tuple:
    """Lookups that a report's star leaves out."""
    out = ["file", "source"] + ([] if state else ["state"])
    return (*out, *([] if codes else ["codes"]))


def registration_star(spark: SparkSession, sf_dir: str, roles=None) -> DataFrame:
    """Registration fact with the names of the given ``REGISTRATION_ROLES`` (all
    by default). Lookups and dimensions of other roles are not planned."""
    used = {r: REGISTRATION_ROLES[r] for r in (REGISTRATION_ROLES if roles is None else roles)}
    need = {dim for dim, *_rest in used.values()}
    codes = [cat for col, (cat, key) in FACT_SPECS["registration"]["codes"].items() if key in {fk for _d, fk, *_r in used.values()}]
    places = bool(need & {"d_state", "d_country"})
    dm = domain.dims(spark, sf_dir, with_zipcode=False, subject="registration", code_categories=codes,
                     need={"d_date"} | need | ({"d_state"} if places else set()) | ({"d_code_category"} if codes else set()))
    f = fact(spark, sf_dir, "registration", dims=dm, skip=_skips(codes, places), codes=codes)
    return star(f, {r: (dm[dim], fk, pk, cols) for r, (dim, fk, pk, cols) in used.items()}, how="left",
                broadcast=True if need <= dm.small else None)


def subject_star(spark: SparkSession, sf_dir: str, subject: str, codes: dict[str, str], day: bool = True,
                 state: bool = True) -> DataFrame:
    """Compliance or verification fact with its calendar, state and code names.

    ``codes``: ``{role: fact code-key column}``; each brings ``<role>_code_value``.
    ``day`` and ``state`` off leave out those roles with their lookups.
    """
    cats = [cat for _c, (cat, key) in FACT_SPECS[subject]["codes"].items() if key in codes.values()]
    need = {"d_date"} | ({"d_state"} if state else set()) | ({"d_code", "d_code_category"} if cats else set())
    dm = domain.dims(spark, sf_dir, with_zipcode=False, need=need, subject=subject, code_categories=cats)
    f = fact(spark, sf_dir, subject, dims=dm, skip=_skips(cats, state), codes=cats)
    roles = {}
    if day:
        roles["day"] = (dm["d_date"], f"{subject}_date_key", "date_key", ["date_value", "year", "month"])
    if state:
        roles["state"] = (dm["d_state"], "state_key", "state_key", ["state_name"])
    for role, col in codes.items():
        roles[role] = (dm["d_code"], col, "code_key", ["code_value"])
    return star(f, roles, how="left", broadcast=True if need <= dm.small else None)
