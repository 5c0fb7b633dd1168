"""Feature engineering.

Group values broadcast back to rows (``transform("sum")`` in pandas) are
computed as a group-by joined back to the rows: the per-month and per-branch
totals are tiny, while a window partitioned by month would put a whole month
of facts into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, one_row, rnd
from branchbook.functions.periods import period_start

# The analysis contract's column names.
CONTRACT_NAMES = {
    "FILIAL": "filial_id",
    "FILIAL_NAME": "filial_name",
    "product": "service_type",
    "PERIOD": "period",
    "SUMMA": "revenue",
    "CNT": "operations_count",
    "direction": "region",
}
MAX_LAGS = 3


def to_contract(df: DataFrame) -> DataFrame:
    """Rename raw/enriched columns to the analysis contract."""
    return df.withColumnsRenamed({k: v for k, v in CONTRACT_NAMES.items() if k in df.columns})


def temporal_features(df: DataFrame, period: str = "period") -> DataFrame:
    """period_dt (first of month), month, quarter, year, weekend start flag."""
    d = period_start(period)
    return df.withColumns({
        "period_dt": d,
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend_start": F.weekday(d) >= 5,
    })


def interaction_features(df: DataFrame, revenue: str = "revenue", period: str = "period",
                         branch: str = "filial_id") -> DataFrame:
    """Revenue share of the month (0 -> null), branch-month revenue, concentration.

    concentration_ratio = sum over the month's rows of share^2
                        = sum(revenue^2) / total^2, computed exactly in decimal.

    The totals hold one row per month and per branch and month. Their size is bounded by
    calendar and branch list, not by the facts, so they are broadcast; the size estimate
    of a grouped frame grows with its input and would send every fact through a shuffle.
    """
    per = df.groupBy(period).agg(
        F.sum(revenue).alias("__tot"),
        F.sum(F.col(revenue) * F.col(revenue)).alias("__sq"),
    ).select(
        period,
        "__tot",
        (dbl("__sq") / F.nullif(dbl("__tot") * dbl("__tot"), F.lit(0.0))).alias("concentration_ratio"),
    )
    fm = df.groupBy(branch, period).agg(F.sum(revenue).alias("revenue_per_filial"))
    out = (
        df.join(F.broadcast(per), period, "left")
        .join(F.broadcast(fm), [branch, period], "left")
        .withColumn("revenue_share", dbl(revenue) / F.nullif(dbl("__tot"), F.lit(0.0)))
        .drop("__tot")
    )
    return out


def standardise(df: DataFrame, cols: list[str], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std with nulls as 0; the stats are one scalar subquery."""
    aggs = []
    for c in cols:
        x = F.coalesce(dbl(c), F.lit(0.0))
        aggs += [F.avg(x).alias(f"__mu_{c}"), F.stddev_pop(x).alias(f"__sd_{c}")]
    st = one_row(df.agg(*aggs))
    scaled = []
    for c in cols:
        x = F.coalesce(dbl(c), F.lit(0.0))
        sd = st[f"__sd_{c}"]
        # a constant column scales to 0, as the standard scaler does
        scaled.append(F.when(sd == 0, F.lit(0.0)).otherwise((x - st[f"__mu_{c}"]) / sd).alias(f"{c}{suffix}"))
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *scaled)


def lag_count(monthly: DataFrame, branch: str = "filial_id", period: str = "period") -> int:
    """A13 + W11 rule: k = min(min over branches of distinct periods - 1, 3); error if k < 1."""
    n = monthly.groupBy(branch).agg(F.countDistinct(period).alias("n")).agg(F.min("n")).first()[0]
    n = int(n or 0)
    k = min(n - 1, MAX_LAGS)
    if k < 1:
        raise ValueError(f"not enough periods for a forecast: {n}, at least 2 are needed")
    return k


def lag_frame(df: DataFrame, revenue: str = "revenue", branch: str = "filial_id",
              order: str = "period_dt") -> tuple[DataFrame, list[str]]:
    """Branch-month sums with revenue lags 1..k; rows with a null lag dropped.

    Returns the frame and the feature column list. The window is per branch
    over its months (tens of rows per branch).
    """
    monthly = df.groupBy(branch, "period", "period_dt", "month", "quarter", "year").agg(
        F.sum(revenue).alias(revenue)
    )
    k = lag_count(monthly, branch, "period")
    w = Window.partitionBy(branch).orderBy(order)
    feats = [branch, "month", "quarter", "year"]
    for i in range(1, k + 1):
        monthly = monthly.withColumn(f"{revenue}_lag{i}", F.lag(revenue, i).over(w))
        feats.append(f"{revenue}_lag{i}")
    return monthly.dropna(subset=feats), feats


def round_cols(df: DataFrame, cols: list[str], scale: int) -> DataFrame:
    return df.withColumns({c: rnd(c, scale) for c in cols})
