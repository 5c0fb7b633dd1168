"""BI measures (B1-B11) as aggregates over a chosen grouping.

A measure in the BI model is evaluated in a filter context; here the context
is explicit: the group-by keys and the window partitions are what remains of
it. ``ALL(dim)`` lifts a key, i.e. the window partition leaves it out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, div0, rnd
from branchbook.operators.windows import prior_period

# Fixed values of the measures.
KPI_COLOURS = ("#27AE60", "#F39C12", "#E67E22", "#C0392B")
KPI_BANDS = (0.05, 0.0, -0.10)  # >= each bound, else the last colour
PRODUCT_STATUS = ("fast_growth", "growth", "decline", "crisis")
PRODUCT_BANDS = (0.10, 0.0, -0.10)  # > each bound, else the last status
TOP_N_FLAG = 5
TOP_LABELS = ("top5", "other")
SEGMENT_LABELS = {"B2B": "B2B", "B2C": "B2C"}
SEGMENT_ALL = "all"
TITLE_EXEC = "Revenue - "
TITLE_ALL_PERIODS = "All periods"
TITLE_SEP = " | "
TITLE_DRILL = "Analytics - "
TITLE_ALL_BRANCHES = "All branches"


def base_measures(fact: DataFrame, by: list[str]) -> DataFrame:
    """B1: total revenue, total count, average check (revenue / rows), active branches."""
    return fact.groupBy(*by).agg(
        F.sum("summa").alias("total_revenue"),
        F.sum("cnt").cast("bigint").alias("total_cnt"),
        F.count(F.lit(1)).alias("rows_cnt"),
        F.countDistinct("filial_id").alias("active_filials"),
    ).withColumn("avg_summa", div0(dbl("total_revenue"), dbl("rows_cnt")))


def with_prior(df: DataFrame, value: str, keys: list[str], idx: str = "period_idx") -> DataFrame:
    """B2: value of the previous calendar month and the MoM change (DIVIDE: blank on 0/blank)."""
    return df.withColumn(f"{value}_prior", prior_period(value, keys, idx)).withColumn(
        "mom_change", div0(dbl(value) - dbl(f"{value}_prior"), dbl(f"{value}_prior"))
    )


def kpi_colour(mom: str | Column) -> Column:
    """Colour band of the MoM change; a blank compares as 0."""
    m = F.coalesce(F.col(mom) if isinstance(mom, str) else mom, F.lit(0.0))
    return (
        F.when(m >= KPI_BANDS[0], KPI_COLOURS[0])
        .when(m >= KPI_BANDS[1], KPI_COLOURS[1])
        .when(m >= KPI_BANDS[2], KPI_COLOURS[2])
        .otherwise(KPI_COLOURS[3])
    )


def product_status(growth: str | Column) -> Column:
    """Status band of a product's growth; a blank compares as 0."""
    g = F.coalesce(F.col(growth) if isinstance(growth, str) else growth, F.lit(0.0))
    return (
        F.when(g > PRODUCT_BANDS[0], PRODUCT_STATUS[0])
        .when(g > PRODUCT_BANDS[1], PRODUCT_STATUS[1])
        .when(g > PRODUCT_BANDS[2], PRODUCT_STATUS[2])
        .otherwise(PRODUCT_STATUS[3])
    )


def rank_share(df: DataFrame, value: str, context: list[str]) -> DataFrame:
    """Dense rank in the context, top-5 flag, share of the context total and
    cumulative share by rank (ties enter together: RANGE frame on the rank)."""
    wc = Window.partitionBy(*context)
    ranked = df.withColumn("revenue_rank", F.dense_rank().over(wc.orderBy(F.desc(value))))
    cum = F.sum(value).over(wc.orderBy("revenue_rank").rangeBetween(Window.unboundedPreceding, 0))
    return ranked.select(
        "*",
        F.when(F.col("revenue_rank") <= TOP_N_FLAG, TOP_LABELS[0]).otherwise(TOP_LABELS[1]).alias("top5_flag"),
        div0(dbl(value), dbl(F.sum(value).over(wc))).alias("revenue_share"),
        div0(dbl(cum), dbl(F.sum(value).over(wc))).alias("cumulative_share"),
    )


def selected_value(col: str, default: Column | None = None) -> Column:
    """``SELECTEDVALUE`` — the value when the group holds exactly one, else the default."""
    one = F.count_distinct(col) == 1
    return F.when(one, F.min(col)).otherwise(default if default is not None else F.lit(None))


def segment_label() -> Column:
    """Client segment label of the group; 'all' when it holds several."""
    one = F.count_distinct("sender_category") == 1
    return F.when(one, F.min("sender_category")).otherwise(F.lit(SEGMENT_ALL))


def titles() -> list[Column]:
    """Page titles of the group (aggregate expressions)."""
    period = selected_value("period", F.lit(TITLE_ALL_PERIODS))
    one_branch = F.count_distinct("filial_name") == 1
    branch = F.when(one_branch, F.concat(F.lit(TITLE_SEP), F.min("filial_name"))).otherwise(F.lit(""))
    return [
        F.concat(F.lit(TITLE_EXEC), period, branch).alias("title_executive"),
        F.concat(F.lit(TITLE_DRILL), selected_value("filial_name", F.lit(TITLE_ALL_BRANCHES))).alias("title_drillthrough"),
    ]


def plan_measures(actual: DataFrame, plan: DataFrame, key: str = "period") -> DataFrame:
    """Planned revenue (plan rows of the periods present, J7), variance, variance %,
    achievement %. ``actual`` has one row per key with ``total_revenue``."""
    from branchbook.operators.joins import semi_by_values

    p = semi_by_values(plan, actual, key, key).groupBy(key).agg(F.sum("planned_summa").alias("planned_revenue"))
    j = actual.join(p, key, "left")
    return j.withColumns({
        "plan_variance": F.col("total_revenue") - F.col("planned_revenue"),
        "plan_variance_pct": div0(dbl(F.col("total_revenue") - F.col("planned_revenue")), dbl("planned_revenue")),
        "plan_achievement_pct": div0(dbl("total_revenue"), dbl("planned_revenue")),
    })


def round6(c: str) -> Column:
    return rnd(c, 6).alias(c)
