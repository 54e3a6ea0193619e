"""Registered queries: census and county enrichment of zipcodes, and its type 1 load.

The stand-in rows: a zipcode is a customer, its county the market segment inside
the state (customers with a debt are not assigned to one), its census tracts the
customer's order priorities, a vintage a year of orders. Customers without orders
have no tract.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import enrich, scd
from ..operators.keys import assign_keys
from ..operators.staging import conform
from . import domain
from .catalog import query

LOAD_YEAR = 1997
LOADED = "1997-06-01 00:00:00"

_AREAS = """areas AS (SELECT CAST(o_custkey AS VARCHAR) AS zipcode, o_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code, c_mktsegment AS county,
  CAST(o_custkey AS VARCHAR) || '-' || left(o_orderpriority, 1) AS census_tract, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
tracts AS (SELECT census_tract, zipcode, CAST(count(*) * 100 AS INTEGER) AS population, CAST(max(o_totalprice) AS DECIMAL(12,2)) AS median_income,
  CAST(20 + o_custkey % 50 AS DECIMAL(5,2)) AS median_age, yr AS census_year FROM areas GROUP BY census_tract, zipcode, o_custkey, yr)"""
_MEAN = "CAST(CAST(sum(CAST({v} * 100 AS HUGEINT) * {w}) // sum({w}) AS DECIMAL(16,0)) / 100 AS DECIMAL(12,2))"


def _orders(spark, sf):
    o, c = domain.table(spark, sf, "orders"), domain.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")


def stg_census(spark, sf):
    rows = domain.table(spark, sf, "orders").select(
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.left("o_orderpriority", F.lit(1))).alias("census_tract"), F.col("o_custkey").cast("string").alias("zipcode"),
        F.year("o_orderdate").alias("census_year"), "o_totalprice", "o_custkey")
    return conform(rows.groupBy("census_tract", "zipcode", "census_year", "o_custkey").agg(
        (F.count(F.lit(1)) * 100).alias("population"), F.max("o_totalprice").alias("median_income")).withColumn("median_age", 20 + F.col("o_custkey") % 50), schemas.STG_CENSUS)


def stg_county_demographics(spark, sf):
    rows = _orders(spark, sf).groupBy(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code"), F.col("c_mktsegment").alias("county_name"),
                                      F.year("o_orderdate").alias("demo_year"))
    return conform(rows.agg((F.count(F.lit(1)) * 1000).alias("total_population"), F.max("o_totalprice").alias("median_household_income")), schemas.STG_COUNTY_DEMOGRAPHICS)


def stg_zip_geography(spark, sf):
    c = domain.table(spark, sf, "customer")
    return conform(c.select(F.col("c_custkey").cast("string").alias("zipcode"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code"),
                            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("county")), schemas.STG_ZIP_GEOGRAPHY)


@query("enrich_census", "J-18 T-04", f"""
WITH {_AREAS},
tract AS (SELECT * FROM tracts QUALIFY row_number() OVER (PARTITION BY zipcode, census_tract ORDER BY census_year DESC) = 1),
zip AS (SELECT zipcode, max(census_year) AS vintage, CAST(sum(population) AS BIGINT) AS population, {_MEAN.format(v='median_income', w='population')} AS income FROM tract GROUP BY 1),
county_all AS (SELECT state_code, county, yr, count(*) * 1000 AS population, CAST(max(o_totalprice) AS DECIMAL(12,2)) AS income FROM areas GROUP BY 1, 2, 3),
cty AS (SELECT * FROM county_all QUALIFY row_number() OVER (PARTITION BY state_code, county ORDER BY yr DESC) = 1),
st AS (SELECT state_code, max(yr) AS yr, CAST(sum(population) AS BIGINT) AS population, {_MEAN.format(v='income', w='population')} AS income FROM cty WHERE state_code IS NOT NULL GROUP BY 1),
z AS (SELECT CAST(c_custkey AS VARCHAR) AS zipcode, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS county FROM customer)
SELECT z.zipcode, z.state_code, z.county,
  CASE WHEN zip.zipcode IS NOT NULL THEN 'ZIP' WHEN cty.county IS NOT NULL THEN 'COUNTY' WHEN st.state_code IS NOT NULL THEN 'STATE' END AS level,
  CASE WHEN zip.zipcode IS NOT NULL THEN zip.vintage WHEN cty.county IS NOT NULL THEN cty.yr ELSE st.yr END AS vintage,
  CASE WHEN zip.zipcode IS NOT NULL THEN zip.population WHEN cty.county IS NOT NULL THEN cty.population ELSE st.population END AS population,
  CASE WHEN zip.zipcode IS NOT NULL THEN zip.income WHEN cty.county IS NOT NULL THEN cty.income ELSE st.income END AS median_income
FROM z LEFT JOIN zip ON z.zipcode = zip.zipcode LEFT JOIN cty ON z.state_code = cty.state_code AND z.county = cty.county LEFT JOIN st ON z.state_code = st.state_code""")
def enrich_census(spark, sf):
    """Each zipcode with the census figures of its tracts, else of its county, else of its state."""
    tracts = enrich.latest_vintage(stg_census(spark, sf).drop("load_timestamp"), ["zipcode", "census_tract"], "census_year")
    zips = enrich.roll_up(tracts, ["zipcode"], "census_year", "population", ["median_income"])
    county = (stg_county_demographics(spark, sf).select("state_code", F.col("county_name").alias("county"), "demo_year", F.col("total_population").cast("long").alias("population"),
                                                        F.col("median_household_income").alias("median_income")))
    county = enrich.latest_vintage(county, ["state_code", "county"], "demo_year")
    states = enrich.roll_up(county, ["state_code"], "demo_year", "population", ["median_income"])
    levels = [("ZIP", zips.withColumnRenamed("census_year", "vintage"), ["zipcode"]), ("COUNTY", county.withColumnRenamed("demo_year", "vintage"), ["state_code", "county"]),
              ("STATE", states.withColumnRenamed("demo_year", "vintage"), ["state_code"])]
    base = stg_zip_geography(spark, sf).select("zipcode", "state_code", "county")
    return enrich.enrich_levels(base, levels, ["vintage", "population", "median_income"])


@query("load_census", "D-04 J-18 K-05", f"""
WITH {_AREAS},
old AS (SELECT census_tract, row_number() OVER (ORDER BY census_tract) AS census_key FROM (SELECT DISTINCT census_tract FROM tracts WHERE census_year < {LOAD_YEAR})),
src AS (SELECT * FROM tracts QUALIFY row_number() OVER (PARTITION BY census_tract ORDER BY census_year DESC) = 1)
SELECT coalesce(o.census_key, (SELECT coalesce(max(census_key), 0) FROM old) + row_number() OVER (PARTITION BY o.census_key IS NULL ORDER BY s.census_tract)) AS census_key,
  s.census_tract, s.zipcode, s.population, s.median_income, s.median_age, s.census_year, TIMESTAMP '{domain.BATCH_TS}' AS last_updated_dt
FROM src s LEFT JOIN old o USING (census_tract)""")
def load_census(spark, sf):
    """Two loads of the census dimension (type 1): the second brings the latest
    vintage of every tract, overwrites known tracts and keeps their keys."""
    rows = stg_census(spark, sf).drop("load_timestamp")
    first = enrich.latest_vintage(rows.where(F.col("census_year") < LOAD_YEAR), ["census_tract"], "census_year")
    old = assign_keys(first, "census_key", ["census_tract"]).withColumn("last_updated_dt", F.lit(LOADED).cast("timestamp"))
    names = [f.name for f in schemas.D_CENSUS.fields]
    return scd.scd1_apply(old.select(*names), enrich.latest_vintage(rows, ["census_tract"], "census_year"), ["census_tract"], "census_key", domain.BATCH_TS).select(*names)
