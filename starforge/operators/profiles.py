"""Profiles that are kept per partition and merged (Q-09, A-05).

One aggregate pass makes a row per (partition, column): rows, NULLs, smallest
and largest value, a HyperLogLog sketch of the distinct values and, for
numbers, a KLL quantile sketch. Stored, such rows answer for any union of
partitions without reading the data again: counts add, extremes combine,
sketches merge. A load of one day profiles that day only.

The sketches have a fixed size, so a hot partition or value is combined map-side
like any other and a row never grows with the data.

Defined results: an empty table gives no rows; a column of NULLs has distinct
count 0 and NULL extremes and quantiles; NaN is left out of the quantiles;
rows without a partition value form the NULL partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a sketch's bucket number: 2^12 buckets, 4 KB at most.
LG_BUCKETS = 12
#: Size parameter of the quantile sketches.
KLL_SIZE = 200
#: Bound on the rank error of a merged quantile sketch of that size (99 percent confidence).
KLL_RANK_ERROR = 0.0165


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Three relative standard errors of a merged sketch's distinct count."""
    return 3 * 1.04 / math.sqrt(2 ** lg_buckets)


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _sketched(c: Column, dtype: T.DataType) -> Column:
    """The value as the distinct sketch takes it: integers as they are, the rest as text."""
    return c.cast("long") if isinstance(dtype, T.IntegralType) else c.cast("string")


def _number(c: Column, dtype: T.DataType) -> Column:
    if not _is_number(dtype):
        return F.lit(None).cast("double")
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def profile_partitions(df: DataFrame, part: Column | str, cols: Sequence[str] | None = None,
                       lg_buckets: int = LG_BUCKETS, kll_size: int = KLL_SIZE) -> DataFrame:
    """A row per (part_value, column_name), to be stored and merged later.

    ``part`` is cast to text, so profiles of tables partitioned by month and by
    day are of one schema. Extremes are numbers for numeric columns (``min_number``)
    and text otherwise (``min_text``), since the text of numbers sorts differently.
    """
    cols = list(cols if cols is not None else df.columns)
    value = (F.col(part) if isinstance(part, str) else part).cast("string")
    types = {c: df.schema[c].dataType for c in cols}
    source = df.select(value.alias("_part"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        v, number = F.col(f"_c{i}"), _is_number(types[c])
        none = F.lit(None)
        aggs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(v.isNull()).alias("null_count"),
            (F.min(v).cast("double") if number else none.cast("double")).alias("min_number"),
            (F.max(v).cast("double") if number else none.cast("double")).alias("max_number"),
            (none.cast("string") if number else F.min(v.cast("string"))).alias("min_text"),
            (none.cast("string") if number else F.max(v.cast("string"))).alias("max_text"),
            F.hll_sketch_agg(_sketched(v, types[c]), F.lit(lg_buckets)).alias("distinct_sketch"),
            F.kll_sketch_agg_double(_number(v, types[c]), F.lit(kll_size)).alias("quantile_sketch"),
        ).alias(f"_p{i}"))
    wide = source.groupBy("_part").agg(*aggs)
    return (wide.select(F.col("_part").alias("part_value"), F.col("_rows").alias("row_count"),
                        F.explode(F.array(*[f"_p{i}" for i in range(len(cols))])).alias("_p"))
            .select("part_value", "row_count", "_p.*"))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.25, 0.5, 0.75),
                   lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """Stored rows merged to one per column (and per ``by``): counts, extremes,
    distinct count and quantiles with their error bounds. Reads profiles only."""
    merged = profiles.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch", F.lit(False))).alias("distinct_estimate"),
        F.kll_merge_agg_double("quantile_sketch").alias("_kll"))
    filled = F.kll_sketch_get_n_double("_kll") > 0
    points = F.array(*[F.lit(float(q)) for q in quantiles])
    return (merged.withColumn("quantiles", F.when(filled, F.kll_sketch_get_quantile_double("_kll", points)))
            .withColumns({"distinct_error": F.lit(distinct_error(lg_buckets)), "rank_error": F.lit(KLL_RANK_ERROR)}).drop("_kll"))


def exact_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct counts, for the columns where a bound won't do: one
    (column, value) aggregation with map-side combination."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    return (pairs.select("p.*").where("v IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))


def quantile_ranks(df: DataFrame, merged: DataFrame) -> DataFrame:
    """(column_name, ranks): for each quantile of a merged profile, the share of
    the column's values below it and the share up to it, counted over ``df``.
    A quantile q is within the bound if below - error <= q <= upto + error."""
    names = [c for c in df.columns if _is_number(df.schema[c].dataType)]
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _number(F.col(c), df.schema[c].dataType).alias("v")) for c in names])).alias("p"))
    points = merged.select("column_name", F.posexplode("quantiles").alias("at", "point"))  # a row per column and quantile
    wide = points.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct("at", "point"))).alias("points"))
    counted = (values.select("p.*").where("v IS NOT NULL").join(F.broadcast(wide), "column_name")
               .select("column_name", "v", F.explode("points").alias("q")).groupBy("column_name", "q.at")
               .agg(F.avg((F.col("v") < F.col("q.point")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("q.point")).cast("double")).alias("upto")))
    return counted.groupBy("column_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "below", "upto"))), lambda x: F.struct(x["below"], x["upto"])).alias("ranks"))
