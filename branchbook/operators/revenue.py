"""The four analytical reports (Q1-Q4) as DataFrame plans.

Each works on the month aggregate (branches x months or products x months), so
the only pass over the facts is one partially aggregated scan; the windows run
on thousands of rows. Month order uses ``period_idx`` (year*12+month), not the
month number alone, because the data spans several years.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, millions, pct_change, rnd
from branchbook.operators.aggregates import monthly_by_branch, product_direction_period

# Fixed values of the reports (labels in plain ASCII).
STAR_TOP_SHARE = 0.20
RFM_WINDOW_DAYS = 90
RFM_SEGMENTS = ("Champions", "Loyal", "Potential", "At Risk", "Lost")
PARETO_TOP = "top80"
PARETO_TAIL = "long_tail"
PARETO_CUTOFF_PCT = 80
ANOMALY = "anomaly"
NORMAL = "normal"
VOLATILITY_Z = 1.5


def rolling_revenue(fact: DataFrame, dim_filials: DataFrame) -> DataFrame:
    """Q1: 3-month rolling revenue, MoM %, rank in month, star flag."""
    m = monthly_by_branch(fact, dim_filials)
    w = Window.partitionBy("filial_id").orderBy("period_idx")
    wp = Window.partitionBy("period_idx")
    r = (
        m.withColumn("rolling_3m_revenue", F.sum("monthly_rev").over(w.rowsBetween(-2, 0)))
        .withColumn("prev_month_rev", F.lag("monthly_rev", 1).over(w))
        .withColumn("mom_change_pct", pct_change("monthly_rev", "prev_month_rev"))
        .withColumn("revenue_rank", F.dense_rank().over(wp.orderBy(F.desc("monthly_rev"))))
        .withColumn("total_filials", F.count(F.lit(1)).over(wp))
    )
    is_star = F.coalesce(
        (F.col("revenue_rank") <= F.ceil(F.col("total_filials") * F.lit(STAR_TOP_SHARE)))
        & (F.col("mom_change_pct") > 0),
        F.lit(False),
    )
    return r.orderBy(F.desc("period_idx"), "revenue_rank", "filial_id").select(
        "filial_id",
        "filial_name",
        "period",
        millions("monthly_rev").alias("revenue_mln"),
        millions("rolling_3m_revenue").alias("rolling_3m_mln"),
        "mom_change_pct",
        F.col("revenue_rank").cast("int").alias("revenue_rank"),
        is_star.alias("is_star"),
    )


def latest_date(fact: DataFrame) -> _dt.date:
    """``as_of`` default: the last operation date (one scalar to the driver).

    Taking it as a literal lets the date filter reach the parquet scan and
    prune month partitions, which a scalar subquery would not.
    """
    return fact.agg(F.max("operation_date")).first()[0]


def recent(fact: DataFrame, as_of: _dt.date, days: int) -> DataFrame:
    """Operations on or after ``as_of - days``; also prunes month partitions."""
    lo = as_of - _dt.timedelta(days=days)
    return fact.filter(
        (F.col("period_idx") >= F.lit(lo.year * 12 + lo.month)) & (F.col("operation_date") >= F.lit(lo))
    )


def rfm_scores(fact: DataFrame, dim_filials: DataFrame, as_of: _dt.date, days: int = RFM_WINDOW_DAYS,
               high_is_good: bool = False) -> DataFrame:
    """Q2 inner part: per-branch recency, frequency, monetary and quintiles.

    As written in the reference, the quintiles give 1 to the freshest, most
    frequent and largest branch; ``high_is_good=True`` flips the three orders.
    Ties are broken by filial_id so the quintiles are deterministic.
    """
    raw = (
        recent(fact, as_of, days)
        .groupBy("filial_id")
        .agg(
            F.datediff(F.lit(as_of), F.max("operation_date")).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("summa").alias("monetary"),
        )
        .join(F.broadcast(dim_filials.select("filial_id", "filial_name")), "filial_id")
    )
    r_ord = F.desc("recency_days") if high_is_good else F.asc("recency_days")
    f_ord = F.asc("frequency") if high_is_good else F.desc("frequency")
    m_ord = F.asc("monetary") if high_is_good else F.desc("monetary")
    whole = Window.partitionBy()  # one row per branch: small by construction
    return (
        raw.withColumn("monetary_mln", millions("monetary"))
        .withColumn("r_score", F.ntile(5).over(whole.orderBy(r_ord, "filial_id")))
        .withColumn("f_score", F.ntile(5).over(whole.orderBy(f_ord, "filial_id")))
        .withColumn("m_score", F.ntile(5).over(whole.orderBy(m_ord, "filial_id")))
        .withColumn(
            "segment",
            F.when((F.col("r_score") >= 4) & (F.col("f_score") >= 4) & (F.col("m_score") >= 4), RFM_SEGMENTS[0])
            .when((F.col("r_score") >= 3) & (F.col("f_score") >= 3), RFM_SEGMENTS[1])
            .when((F.col("r_score") >= 3) & (F.col("f_score") < 3), RFM_SEGMENTS[2])
            .when((F.col("r_score") < 3) & (F.col("f_score") >= 3), RFM_SEGMENTS[3])
            .otherwise(RFM_SEGMENTS[4]),
        )
    )


def rfm_segments(fact: DataFrame, dim_filials: DataFrame, as_of: _dt.date, days: int = RFM_WINDOW_DAYS,
                 high_is_good: bool = False) -> DataFrame:
    """Q2: segment rollup (A5) with the ordered branch list and share of total."""
    s = rfm_scores(fact, dim_filials, as_of, days, high_is_good)
    g = s.groupBy("segment").agg(
        F.count(F.lit(1)).alias("filial_count"),
        F.expr("listagg(filial_name, ', ') within group (order by monetary_mln desc, filial_id)").alias("filials"),
        F.round(F.avg("recency_days"), 0).alias("avg_recency_days"),
        F.round(F.avg("frequency"), 0).alias("avg_frequency"),
        rnd(F.avg("monetary_mln"), 1).alias("avg_monetary_mln"),
        F.sum("monetary_mln").alias("_sum_m"),
    )
    share = F.lit(100.0) * F.col("_sum_m") / F.sum("_sum_m").over(Window.partitionBy())
    return g.orderBy(F.desc("avg_monetary_mln"), "segment").select(
        "segment",
        "filial_count",
        "filials",
        "avg_recency_days",
        "avg_frequency",
        "avg_monetary_mln",
        rnd("_sum_m", 1).alias("total_monetary_mln"),
        rnd(share, 1).alias("revenue_share_pct"),
    )


def product_pareto(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Q3: MoM growth by product x direction, share, cumulative share, Pareto bucket."""
    pp = product_direction_period(fact, dim_products)
    w = Window.partitionBy("product", "direction").orderBy("period_idx")
    growth = pp.withColumn("growth_pct", pct_change("revenue", F.lag("revenue", 1).over(w)))
    totals = growth.groupBy("product").agg(
        F.sum("revenue").alias("total_rev"),
        F.round(F.avg("growth_pct"), 2).alias("avg_mom_growth_pct"),
    )
    whole = Window.partitionBy()  # one row per product: small by construction
    running = Window.orderBy(F.desc("total_rev"), "product").rowsBetween(Window.unboundedPreceding, 0)
    t = totals.withColumn("_grand", F.sum("total_rev").over(whole)).withColumn(
        "_cum", dbl(F.sum("total_rev").over(running)) / dbl("_grand") * F.lit(100.0)
    )
    return t.orderBy(F.desc("total_rev"), "product").select(
        "product",
        millions("total_rev", 1).alias("total_rev_mln"),
        rnd(F.lit(100.0) * dbl("total_rev") / dbl("_grand"), 2).alias("rev_share_pct"),
        rnd("_cum", 1).alias("cumulative_pct"),
        F.when(F.col("_cum") <= PARETO_CUTOFF_PCT, PARETO_TOP).otherwise(PARETO_TAIL).alias("pareto_bucket"),
        (F.col("avg_mom_growth_pct") + F.lit(0.0)).alias("avg_mom_growth_pct"),
    )


def revenue_volatility(fact: DataFrame, dim_filials: DataFrame, z_limit: float = VOLATILITY_Z) -> DataFrame:
    """Q4: MoM %, z-score against the expanding mean / sample std, CV %, flag.

    The lag and the expanding frame share one partition + order, so Spark
    evaluates them after a single shuffle and sort.
    """
    m = monthly_by_branch(fact, dim_filials).withColumn("rev", dbl("monthly_rev"))
    w = Window.partitionBy("filial_id").orderBy("period_idx")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    a = (
        m.withColumn("prev_1m", F.lag("rev", 1).over(w))
        .withColumn("rolling_avg", F.avg("rev").over(upto))
        .withColumn("rolling_std", F.stddev_samp("rev").over(upto))
    )
    z = (F.col("rev") - F.col("rolling_avg")) / F.nullif(F.col("rolling_std"), F.lit(0.0))
    return a.orderBy("filial_id", "period_idx").select(
        "filial_id",
        "filial_name",
        "period",
        millions("rev").alias("revenue_mln"),
        pct_change("rev", "prev_1m").alias("mom_pct"),
        rnd(z, 2).alias("z_score"),
        rnd(F.col("rolling_std") / F.nullif(F.col("rolling_avg"), F.lit(0.0)) * F.lit(100.0), 1).alias(
            "volatility_cv_pct"
        ),
        F.when(F.abs(z) > z_limit, ANOMALY).otherwise(NORMAL).alias("anomaly_flag"),
    )
