"""Aggregations.

All group-bys are plain ``groupBy().agg()``: Spark combines map-side (partial
aggregation) before the shuffle, so the shuffled volume is bounded by the
number of groups per task, not by the number of facts. Group keys here are
branch x month x product sized, i.e. small, even at full scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, div0, rnd


def monthly_by_branch(fact: DataFrame, dim_filials: DataFrame | None = None) -> DataFrame:
    """A1: revenue, count and rows per branch x month.

    Aggregates before the branch-name join: the dim is unique on filial_id, so
    joining the ~branches x months result equals the reference's join-first form.
    """
    m = fact.groupBy("filial_id", "period", "period_idx").agg(
        F.sum("summa").alias("monthly_rev"),
        F.sum("cnt").cast("bigint").alias("monthly_cnt"),
        F.count(F.lit(1)).alias("rows_cnt"),
    )
    if dim_filials is not None:
        m = m.join(F.broadcast(dim_filials.select("filial_id", "filial_name")), "filial_id")
    return m


def product_direction_period(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """A2: revenue by product x direction x month (inner join to the product dim)."""
    from branchbook.operators.joins import checked_broadcast

    per_account = fact.groupBy("inc_gk", "period", "period_idx").agg(F.sum("summa").alias("revenue"))
    d = checked_broadcast(dim_products.select("inc_gk", "product", "direction"))
    return (
        per_account.join(d, "inc_gk")
        .groupBy("product", "direction", "period", "period_idx")
        .agg(F.sum("revenue").alias("revenue"))
    )


def kpi_aggregate(fact: DataFrame) -> DataFrame:
    """A3 (materialized KPI view): revenue, operations, weight by branch x month x account."""
    return fact.groupBy("filial_id", "period", "period_idx", "inc_gk").agg(
        F.sum("summa").alias("revenue"),
        F.sum("cnt").cast("bigint").alias("operations"),
        F.sum("weight").alias("total_weight"),
    )


def share_of_total(df: DataFrame, value: str, out: str, scale: int | None = 2, over: list[str] | None = None) -> DataFrame:
    """Value / total over the group (``SUM(x) / SUM(SUM(x)) OVER ()``) in percent.

    ``over=None`` means the grand total; the input must then be an aggregated,
    small frame (a window without keys runs in one task).
    """
    w = Window.partitionBy(*(over or []))
    pct = F.lit(100.0) * dbl(value) / dbl(F.sum(value).over(w))
    return df.withColumn(out, rnd(pct, scale) if scale is not None else pct)


def concentration_index(df: DataFrame, share_col: str, by: str) -> DataFrame:
    """Sum of squared row shares per group."""
    return df.groupBy(by).agg(F.sum(F.col(share_col) * F.col(share_col)).alias("concentration_ratio"))


def min_distinct_periods(fact: DataFrame, by: str = "filial_id", period: str = "period") -> DataFrame:
    """The minimum over branches of their distinct period count (one row)."""
    per = fact.groupBy(by).agg(F.countDistinct(period).alias("n_periods"))
    return per.agg(F.min("n_periods").cast("bigint").alias("min_periods"))


def safe_avg_check(revenue: str, rows: str):
    return div0(dbl(revenue), dbl(rows))


# log2 of the sketches' registers: a standard error of about 1.6 percent.
SKETCH_LG_K = 12


def distinct_sketches(fact: DataFrame, by: list[str], col: str) -> DataFrame:
    """A7 on S6: one mergeable distinct-count sketch for each group of the aggregate table.

    Distinct counts don't add up over groups, sketches do: any slice of the groups is
    united without a look at the facts. A sketch has a bounded size (about 2.5 KB).
    """
    return fact.groupBy(*by).agg(F.hll_sketch_agg(col, F.lit(SKETCH_LG_K)).alias("sketch"))


def united_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Estimated distinct counts of coarser groups (``by`` empty: of everything) from stored sketches."""
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    return sketches.groupBy(*by).agg(united) if by else sketches.agg(united)
