"""Report measures: counts, ratios, shares, matrices, histograms, funnels, top-n (A-*, T-*, U-*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import divide
from ..session import materialize


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A-01 as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


AGGS = {
    "count": lambda c: F.count(F.lit(1)),
    "count_col": lambda c: F.count(_c(c)),
    "count_distinct": lambda c: F.count_distinct(_c(c)),
    "approx_count_distinct": lambda c: F.approx_count_distinct(_c(c)),
    "count_if": lambda c: F.count_if(_c(c)),
    "sum": lambda c: F.sum(_c(c)),
    "min": lambda c: F.min(_c(c)),
    "max": lambda c: F.max(_c(c)),
    "avg": lambda c: F.avg(_c(c)),
}


def measure(df: DataFrame, by: Sequence, aggs: Mapping[str, tuple], where: Column | None = None) -> DataFrame:
    """Grouped measures (A-01..A-08): ``aggs={'n': ('count', None), 'active': ('count_if', cond)}``.

    A hash aggregate with map-side partial aggregation: each task combines its
    rows before the shuffle, so a hot group costs one row per task.
    """
    if where is not None:
        df = df.filter(where)
    cols = [AGGS[kind](arg).alias(name) for name, (kind, arg) in aggs.items()]
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def duplicates(df: DataFrame, key: Sequence[str], name: str = "row_count") -> DataFrame:
    """Keys seen more than once with their count (A-06, HAVING count > 1)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def with_share(df: DataFrame, value: str, within: Sequence[str] | None = None, name: str = "share",
               scale: int = 4) -> DataFrame:
    """Share of total (A-10). With ``within``, a window per group. Without it the
    grouped rows are written once and the grand total is a scalar subquery over
    them, so their source is read once and no task holds all groups."""
    if within:
        total = F.sum(value).over(Window.partitionBy(*within))
    else:
        df = materialize(df, "share")
        total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.round(divide(F.col(value), total), scale).cast(f"decimal(10,{scale})"))


def matrix(df: DataFrame, rows: Sequence[str], col: str, members: Sequence, value: str = "count",
           with_share_of_total: bool = True) -> DataFrame:
    """Rows × columns count matrix (A-11). ``members`` lists the column values,
    so Spark does not collect them first; each cell also gets its share of the
    grand total (of all rows, members or not) as ``<member>_share``. One
    aggregate, written once, gives the cells and the total."""
    cells = df.groupBy(*rows).agg(*[F.count_if(F.col(col).eqNullSafe(F.lit(m))).alias(str(m)) for m in members],
                                  F.count(F.lit(1)).alias("_row_total"))
    if not with_share_of_total:
        return cells.drop("_row_total")
    cells = materialize(cells, "matrix")
    total = cells.agg(F.sum("_row_total")).scalar()
    for m in members:
        cells = cells.withColumn(f"{m}_share", F.round(divide(F.col(str(m)), total), 4).cast("decimal(10,4)"))
    return cells.drop("_row_total")


def to_date_kpis(df: DataFrame, date_col: str, conditions: Mapping[str, Column], to_date: str) -> DataFrame:
    """Rows that meet each condition, and as ``to_date`` the rows of the last
    day's year up to that day (A-18). That year is the last one there is, so
    counts per year answer both in one pass over ``df``; rows without a date
    only count for the conditions."""
    per_year = df.groupBy(F.year(date_col).alias("_year")).agg(F.count(F.lit(1)).alias("_rows"),
                                                               *[F.count_if(c).alias(name) for name, c in conditions.items()])
    none = F.lit(0).cast("long")
    return per_year.agg(*[F.coalesce(F.sum(name), none).alias(name) for name in conditions],
                        F.coalesce(F.max_by("_rows", "_year"), none).alias(to_date))


def histogram(df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str] | None = None,
              name: str = "bucket", below: str = "below", above: str = "above", missing: str = "unknown") -> DataFrame:
    """Counts by fixed bins (A-12). Bin i holds ``edges[i] <= c < edges[i+1]``;
    values under the first and from the last edge on and NULLs have buckets of
    their own, so the counts sum to the rows."""
    if labels is None:
        labels = [f"{edges[i]}-{edges[i + 1]}" for i in range(len(edges) - 1)]
    expr = F.when(_c(c).isNull(), F.lit(missing)).when(_c(c) < edges[0], F.lit(below))
    for i, lab in enumerate(labels):
        expr = expr.when(_c(c) < edges[i + 1], F.lit(lab))
    return df.groupBy(expr.otherwise(F.lit(above)).alias(name)).agg(F.count(F.lit(1)).alias("row_count"))


def funnel(df: DataFrame, c: str, stages: Sequence[str]) -> DataFrame:
    """Ordered funnel (A-16): rows at or beyond each stage and conversion from
    the previous stage. One aggregate pass; the stage list is small."""
    rank = F.array_position(F.array(*[F.lit(s) for s in stages]), _c(c))
    aggs = [F.count_if(rank >= i + 1).alias(f"s{i}") for i in range(len(stages))]
    wide = df.agg(*aggs)
    args = ", ".join(f"{i + 1}, '{s}', s{i}, {('s' + str(i - 1)) if i else 's0'}" for i, s in enumerate(stages))
    long = wide.selectExpr(f"stack({len(stages)}, {args}) as (stage_no, stage, reached, previous)")
    return long.select(F.col("stage_no").cast("int"), "stage", F.col("reached").cast("long"),
                       F.round(divide(F.col("reached"), F.col("previous")), 4).cast("decimal(10,4)")
                       .alias("conversion"))


def rate(df: DataFrame, by: Sequence[str], condition: Column, name: str = "rate") -> DataFrame:
    """Grouped ratio (A-17): rows meeting ``condition`` over all rows, 0 when none."""
    return (df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(condition).alias("hits"))
            .withColumn(name, F.round(divide(F.col("hits"), F.col("total")), 4).cast("decimal(10,4)")))


def drill_down(df: DataFrame, levels: Sequence[str], aggs: Mapping[str, tuple]) -> DataFrame:
    """Subtotals at each level of a hierarchy (A-22): ``rollup`` with the level id."""
    cols = [AGGS[kind](arg).alias(name) for name, (kind, arg) in aggs.items()]
    return df.rollup(*levels).agg(F.grouping_id().alias("grouping_level"), *cols)


def error_frequency(df: DataFrame, col: str = "dq_validation_errors", sep: str = ";") -> DataFrame:
    """How often each error text occurs (A-15), most frequent first."""
    e = df.select(F.explode(F.split(F.col(col), sep)).alias("error")).filter(F.col("error") != "")
    return e.groupBy("error").agg(F.count(F.lit(1)).alias("occurrences"))


def top_n(df: DataFrame, value: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The ``n`` largest by ``value`` with a full tie-break (T-02). Spark plans
    ``orderBy + limit`` as a top-k per task plus a final merge (no full sort)."""
    return df.orderBy(F.col(value).desc(), *[F.col(t).asc() for t in tie]).limit(n)


def latest(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Newest ``n`` rows (T-01)."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """A deterministic sample of ``n`` rows for inspection (T-03)."""
    return df.orderBy(*order).limit(n)


def ordered(df: DataFrame, order: Sequence) -> DataFrame:
    """Ordered listing (T-05); a range-partitioned sort, no single task."""
    return df.orderBy(*order)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (U-01)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def table_counts(frames: Mapping[str, DataFrame], name: str = "table_name") -> DataFrame:
    """Row count per named frame as one frame (U-03)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias(name), "row_count")
             for t, df in frames.items()]
    return union_by_name(*parts)


def date_stats(df: DataFrame, date_col: str, key: str, approx: bool = False) -> DataFrame:
    """Min / max date, rows and distinct keys (A-04, A-05)."""
    dc = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count(F.lit(1)).alias("row_count"), dc(key).alias("distinct_keys"))
