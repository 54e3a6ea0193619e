"""Table schemas of the warehouse and the per-subject configuration.

Staging, dimension, fact, history and control tables as ``StructType``.
Lengths of VARCHAR columns are kept as field metadata (``max_length``) so the
type-conformity check can test them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DateType(),
                     T.TimestampType(), T.BooleanType())


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def vc(name: str, n: int, nullable: bool = True) -> T.StructField:
    """A VARCHAR(n) column: string with its declared length as metadata."""
    return T.StructField(name, S, nullable, {"max_length": n})


def f(name: str, dtype, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


_METADATA = [
    vc("source_system", 100), vc("source_file_name", 500), f("load_timestamp", TS),
    vc("processing_status", 50), vc("error_message", 2000),
    f("dq_is_valid", B), vc("dq_validation_errors", 2000),
]

STG_REGISTRATION = T.StructType([
    vc("registration_id", 100), vc("first_name", 100), vc("last_name", 100), vc("email", 200),
    vc("phone", 20), vc("street_address", 500), vc("city", 100), vc("state", 50),
    vc("zipcode", 10), vc("country", 50), f("registration_date", D), f("birth_date", D),
    vc("registration_status", 50), vc("registration_type", 50), vc("classification", 50),
    vc("registration_method", 50),
] + _METADATA)

STG_COMPLIANCE = T.StructType([
    vc("compliance_id", 100), vc("registration_id", 100), f("compliance_date", D),
    f("due_date", D), f("completion_date", D), vc("compliance_status", 50),
    vc("compliance_result", 50), f("is_doj_referral", B), vc("source_list_type", 50),
    f("source_year", I), vc("state", 50),
] + _METADATA)

STG_VERIFICATION = T.StructType([
    vc("verification_id", 100), vc("registration_id", 100), f("verification_date", D),
    f("request_date", D), f("response_date", D), vc("verification_method", 50),
    vc("verification_status", 50), vc("verification_result", 50), vc("interim_status", 50),
    f("is_match", B), f("match_score", dec(5, 2)), vc("verification_flags", 500), vc("state", 50),
] + _METADATA)

STG_ZIP_GEOGRAPHY = T.StructType([
    vc("zipcode", 10), vc("city", 100), vc("state_code", 2), vc("county", 100),
    vc("timezone", 50), vc("area_code", 10), f("load_timestamp", TS)])

STG_CENSUS = T.StructType([
    vc("census_tract", 20), vc("zipcode", 10), f("population", I), f("median_income", dec(12, 2)),
    f("median_age", dec(5, 2)), f("census_year", I), f("load_timestamp", TS)])

STG_COUNTY_DEMOGRAPHICS = T.StructType([
    vc("county_fips", 10), vc("county_name", 100), vc("state_code", 2), f("total_population", I),
    f("median_household_income", dec(12, 2)), f("unemployment_rate", dec(5, 2)),
    f("education_level_pct", dec(5, 2)), f("demo_year", I), f("load_timestamp", TS)])

STG_CODES = T.StructType([
    vc("code_id", 50), f("code_category_key", I), vc("code_value", 100),
    vc("code_description", 500), f("display_order", I)])

ETL_CONTROL = T.StructType([
    vc("job_name", 200, False), vc("job_type", 50), f("start_timestamp", TS, False),
    f("end_timestamp", TS), vc("status", 50), f("records_read", L), f("records_written", L),
    f("records_rejected", L), vc("error_message", 2000), f("last_processed_date", D)])

DQ_RESULTS = T.StructType([
    vc("table_name", 100), vc("check_name", 200), vc("check_type", 50),
    f("check_timestamp", TS), f("records_checked", L), f("records_passed", L),
    f("records_failed", L), f("pass_rate", dec(5, 2)), f("threshold", dec(5, 2)),
    vc("status", 20), vc("details", 2000)])

_SCD2 = [f("effective_start_dt", TS, False), f("effective_end_dt", TS), f("is_active", B, False)]

D_DATE = T.StructType([
    f("date_key", I, False), f("date_value", D, False), f("year", I, False),
    f("quarter", I, False), f("month", I, False), vc("month_name", 20), f("week_of_year", I),
    f("day_of_month", I), f("day_of_week", I), vc("day_name", 20), f("is_weekend", B),
    f("is_holiday", B), f("fiscal_year", I), f("fiscal_quarter", I)])

D_CODE_CATEGORY = T.StructType([
    f("code_category_key", L, False), vc("code_category_id", 50, False),
    vc("category_name", 100, False), vc("category_type", 50), vc("description", 500)] + _SCD2)

D_CODE = T.StructType([
    f("code_key", L, False), vc("code_id", 50, False), f("code_category_key", L, False),
    vc("code_value", 100, False), vc("code_description", 500), f("display_order", I)] + _SCD2)

D_COUNTRY = T.StructType([
    f("country_key", L, False), vc("country_id", 10, False), vc("country_name", 100, False),
    vc("country_code_iso2", 2), vc("country_code_iso3", 3)] + _SCD2)

D_STATE = T.StructType([
    f("state_key", L, False), vc("state_id", 10, False), vc("state_name", 100, False),
    vc("state_code", 2), f("country_key", L, False)] + _SCD2)

D_ZIPCODE = T.StructType([
    f("zipcode_key", L, False), vc("zipcode_id", 20, False), vc("zipcode", 10, False),
    vc("city", 100), f("state_key", L, False), f("latitude", dec(10, 6)),
    f("longitude", dec(10, 6))] + _SCD2)

D_DATA_SOURCE = T.StructType([
    f("data_source_key", L, False), vc("data_source_id", 50, False), vc("source_name", 100, False),
    vc("source_type", 50), vc("source_system", 100), vc("connection_string", 500),
    vc("schedule_frequency", 50), f("is_enabled", B)] + _SCD2)

D_FILE_INFORMATION = T.StructType([
    f("file_key", L, False), vc("file_id", 100, False), f("data_source_key", L),
    vc("file_name", 500, False), vc("file_path", 1000), f("file_size_bytes", L),
    f("record_count", L), f("load_timestamp", TS, False), vc("processing_status", 50),
    vc("error_message", 2000)])

F_REGISTRATION = T.StructType([
    f("registration_key", L, False), vc("registration_id", 100, False),
    f("registration_date_key", I), f("birth_date_key", I), f("effective_date_key", I),
    f("registration_status_code_key", L), f("registration_type_code_key", L),
    f("classification_code_key", L), f("zipcode_key", L), f("state_key", L),
    f("country_key", L), f("data_source_key", L), f("file_key", L),
    f("age_at_registration", I), vc("registration_method", 50),
    f("is_first_time_registration", B), f("previous_registration_count", I),
    vc("source_system_id", 100), f("source_record_version", I), vc("record_hash", 64),
    f("created_dt", TS), f("updated_dt", TS)])

F_REGISTRATION_HIST = T.StructType([
    f("registration_key", L, False), vc("registration_id", 100, False),
    f("snapshot_date_key", I, False), f("registration_date_key", I),
    f("registration_status_code_key", L), f("registration_type_code_key", L),
    f("zipcode_key", L), f("state_key", L), vc("change_type", 20),
    f("effective_start_dt", TS, False), f("effective_end_dt", TS), f("is_current", B),
    f("created_dt", TS)])

# Enrichment dimensions, overwritten in place (type 1).
D_ZIP_GEOGRAPHY = T.StructType([
    f("zip_geography_key", L, False), vc("zipcode", 10, False), vc("city", 100), vc("state_code", 2),
    vc("county", 100), vc("timezone", 50), vc("area_code", 10), f("last_updated_dt", TS)])

D_CENSUS = T.StructType([
    f("census_key", L, False), vc("census_tract", 20, False), vc("zipcode", 10), f("population", I),
    f("median_income", dec(12, 2)), f("median_age", dec(5, 2)), f("census_year", I), f("last_updated_dt", TS)])

D_COUNTY_DEMOGRAPHICS = T.StructType([
    f("county_demo_key", L, False), vc("county_fips", 10, False), vc("county_name", 100), vc("state_code", 2),
    f("total_population", I), f("median_household_income", dec(12, 2)), f("unemployment_rate", dec(5, 2)),
    f("education_level_pct", dec(5, 2)), f("demo_year", I), f("last_updated_dt", TS)])

_FACT_END = [vc("error_message", 2000), f("retry_count", I), vc("source_system_id", 100), vc("record_hash", 64),
             f("created_dt", TS), f("updated_dt", TS)]

F_COMPLIANCE = T.StructType([
    f("compliance_key", L, False), vc("compliance_id", 100, False), vc("registration_id", 100),
    f("compliance_date_key", I), f("due_date_key", I), f("completion_date_key", I),
    f("compliance_status_code_key", L), f("compliance_result_code_key", L), f("state_key", L),
    f("data_source_key", L), f("file_key", L), f("is_doj_referral", B), f("compliance_score", dec(5, 2)),
    f("days_to_completion", I), vc("source_list_type", 50), f("source_year", I)] + _FACT_END)

F_VERIFICATION = T.StructType([
    f("verification_key", L, False), vc("verification_id", 100, False), vc("registration_id", 100),
    f("verification_date_key", I), f("request_date_key", I), f("response_date_key", I),
    f("verification_method_code_key", L), f("verification_status_code_key", L), f("verification_result_code_key", L),
    f("state_key", L), f("data_source_key", L), f("file_key", L), f("is_match", B), f("match_score", dec(5, 2)),
    vc("interim_status", 50), vc("verification_flags", 500), f("response_time_seconds", I)] + _FACT_END)


def _history(subject: str, codes: list[str]) -> T.StructType:
    return T.StructType([
        f(f"{subject}_key", L, False), vc(f"{subject}_id", 100, False), f("snapshot_date_key", I, False),
        f(f"{subject}_date_key", I), *[f(c, L) for c in codes], vc("change_type", 20),
        f("effective_start_dt", TS, False), f("effective_end_dt", TS), f("is_current", B), f("created_dt", TS)])


F_COMPLIANCE_HIST = _history("compliance", ["compliance_status_code_key", "compliance_result_code_key"])
F_VERIFICATION_HIST = _history("verification", ["verification_status_code_key", "verification_result_code_key"])

# Subject configuration (S-09): which columns the daily checks look at.
SUBJECTS = {
    "registration": {
        "table": "stg_registration", "schema": STG_REGISTRATION,
        "id": "registration_id", "date": "registration_date",
        "required": ["registration_id", "registration_date", "registration_status"],
    },
    "compliance": {
        "table": "stg_compliance", "schema": STG_COMPLIANCE,
        "id": "compliance_id", "date": "compliance_date",
        "required": ["compliance_id", "compliance_date", "compliance_status"],
    },
    "verification": {
        "table": "stg_verification", "schema": STG_VERIFICATION,
        "id": "verification_id", "date": "verification_date",
        "required": ["verification_id", "verification_date", "verification_status"],
    },
}

TABLES = {
    "staging": {
        "stg_registration": STG_REGISTRATION, "stg_compliance": STG_COMPLIANCE,
        "stg_verification": STG_VERIFICATION, "stg_zip_geography": STG_ZIP_GEOGRAPHY,
        "stg_census": STG_CENSUS, "stg_county_demographics": STG_COUNTY_DEMOGRAPHICS,
        "stg_codes": STG_CODES, "etl_control": ETL_CONTROL, "dq_results": DQ_RESULTS,
    },
    "dw": {
        "d_date": D_DATE, "d_code_category": D_CODE_CATEGORY, "d_code": D_CODE,
        "d_country": D_COUNTRY, "d_state": D_STATE, "d_zipcode": D_ZIPCODE,
        "d_data_source_configuration": D_DATA_SOURCE, "d_file_information": D_FILE_INFORMATION,
        "d_zip_geography": D_ZIP_GEOGRAPHY, "d_census": D_CENSUS, "d_county_demographics": D_COUNTY_DEMOGRAPHICS,
        "f_registration": F_REGISTRATION, "f_registration_hist": F_REGISTRATION_HIST,
        "f_compliance": F_COMPLIANCE, "f_compliance_hist": F_COMPLIANCE_HIST,
        "f_verification": F_VERIFICATION, "f_verification_hist": F_VERIFICATION_HIST,
    },
}

# Columns holding personal data; facts must not carry them (P-03).
PII_COLUMNS = ["first_name", "last_name", "email", "phone", "street_address", "birth_date"]


def subject(name: str) -> dict:
    """Config of one subject; unknown names raise, like the daily job does."""
    try:
        return SUBJECTS[name]
    except KeyError:
        raise ValueError(f"unknown subject {name!r}; expected one of {sorted(SUBJECTS)}") from None
