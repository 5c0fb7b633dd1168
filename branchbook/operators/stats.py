"""Statistics.

Correlations are single aggregates: Pearson on the values, Spearman as Pearson
on average ranks; the value counts of all columns are stacked and ranked by one
prefix scan (one range exchange, no global sort of every row). The trend and
seasonal jobs run for every branch at once: per-branch windows over its months
(tens of rows) and per-branch aggregates, no driver loop.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, rnd

# Fixed values of the exploratory analysis.
CORR_COLUMNS = ("SUMMA", "CNT", "WEIGHT")
Z_THRESHOLD = 3.0
SEASON = 12
MIN_TREND_PERIODS = 3
STATUS_SKIPPED = "skipped"
STATUS_ROLLING = "rolling_trend_only"
STATUS_FULL = "full_decomposition"


def pearson_pairs(df: DataFrame, cols: list[str]) -> list[tuple[str, str, float | None]]:
    """M1: Pearson r for each pair of the strict upper triangle, one aggregate pass."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(dbl(a), dbl(b)).alias(f"{a}__{b}") for a, b in pairs]).first()
    return [(a, b, row[f"{a}__{b}"]) for a, b in pairs]


def average_ranks(df: DataFrame, rankings: dict[str, tuple[str, Column]]) -> DataFrame:
    """(ranking, value, rank): 1-based ranks of ranking name -> (column, which rows), ties sharing their mean rank.

    Nulls have no rank. Distinct values are counted first (a value held by a third of
    the rows collapses to one row map-side); the counts of all rankings are stacked and
    put in order by one range exchange, and one running total over them, less what the
    rankings before hold, ranks them all.
    """
    from branchbook.operators.windows import running_total

    names = list(rankings)
    entries = [F.struct(F.lit(i).alias("k"), F.when(among, dbl(c)).alias("value")) for i, (c, among) in enumerate(rankings.values())]
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.k", "e.value").where("value is not null")
    counts = long.groupBy("k", "value").agg(F.count(F.lit(1)).alias("__c"))
    cum = running_total(counts, "__c", [F.asc("k"), F.asc("value")], out="__cum")
    first = cum.groupBy("k").agg(F.min(F.col("__cum") - F.col("__c")).alias("__before"))  # one row per ranking
    own = dbl(F.col("__cum") - F.col("__before"))
    ranks = cum.join(F.broadcast(first), "k").select("k", "value", (own - dbl("__c") + (dbl("__c") + F.lit(1.0)) / F.lit(2.0)).alias("rank"))
    return ranks.withColumn("ranking", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)).select("ranking", "k", "value", "rank")


def spearman_pairs(df: DataFrame, cols: list[str]) -> list[tuple[str, str, float | None]]:
    """M2: Spearman rho (average ranks for ties) = Pearson r of the average ranks, one aggregate.

    Rows with a null are left out pair by pair: a column is ranked among the rows
    where its partner is present. Partners without a null beside a value of the
    column leave all its rows, so one ranking serves all of those pairs.
    """
    from branchbook.operators.joins import checked_broadcast

    x = df.select(*[dbl(c).alias(c) for c in cols])
    pairs = list(combinations(cols, 2))
    both_ways = [p for a, b in pairs for p in ((a, b), (b, a))]
    gaps = x.agg(*[F.count_if(F.col(a).isNotNull() & F.col(b).isNull()).alias(f"{a}__{b}") for a, b in both_ways]).first()
    names: dict[tuple[str, str], str] = {}
    rankings: dict[str, tuple[str, Column]] = {}
    for a, b in both_ways:
        names[a, b] = f"__r_{a}__{b}" if gaps[f"{a}__{b}"] else f"__r_{a}"
        rankings.setdefault(names[a, b], (a, F.col(b).isNotNull() if gaps[f"{a}__{b}"] else F.lit(True)))
    ranks = average_ranks(x, rankings)
    for k, (name, (c, _)) in enumerate(rankings.items()):
        # joined back on the value; AQE splits a hot value's partition on the row side
        x = x.join(checked_broadcast(ranks.where(F.col("k") == k).select(F.col("value").alias(f"__v{k}"), F.col("rank").alias(name))),
                   F.col(c) == F.col(f"__v{k}"), "left").drop(f"__v{k}")
    both = [F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs]
    row = x.agg(*[
        F.corr(F.when(ok, F.col(names[a, b])), F.when(ok, F.col(names[b, a]))).alias(f"{a}__{b}") for ok, (a, b) in zip(both, pairs)
    ]).first()
    return [(a, b, row[f"{a}__{b}"]) for a, b in pairs]


def corr_pairs(df: DataFrame, cols: list[str] = list(CORR_COLUMNS), n: int = 5) -> DataFrame:
    """M3/M4/K2: top-n pairs by |Pearson|, with Spearman alongside (a left join on the pair)."""
    spark = df.sparkSession
    p = spark.createDataFrame(pearson_pairs(df, cols), "col_a string, col_b string, pearson double")
    s = spark.createDataFrame(spearman_pairs(df, cols), "col_a string, col_b string, spearman double")
    j = p.filter(F.col("pearson").isNotNull()).join(s, ["col_a", "col_b"], "left")
    top = j.orderBy(F.desc(F.abs("pearson")), "col_a", "col_b").limit(n)
    return top.select("col_a", "col_b", rnd("pearson", 6).alias("pearson"), rnd("spearman", 6).alias("spearman"))


def z_summary(df: DataFrame, col: str = "SUMMA", limit: float = Z_THRESHOLD) -> DataFrame:
    """M6/M7 (z part): flagged rows and their share of the total, one row."""
    from branchbook.operators.quality import zscores

    z = zscores(df, col)
    flag = F.abs("z") > limit
    return z.agg(
        F.sum(F.when(flag, 1).otherwise(0)).cast("bigint").alias("z_count"),
        rnd(F.lit(100.0) * dbl(F.sum(F.when(flag, F.col(col)))) / dbl(F.sum(col)), 2).alias("z_summa_share"),
    ).withColumn("z_threshold", F.lit(limit))


def monthly_series(fact_named: DataFrame, key: str = "filial_name") -> DataFrame:
    """Per branch: months in calendar order with position 0..n-1 (gaps closed) and n."""
    m = fact_named.groupBy(key, "period_idx").agg(F.sum("summa").alias("rev"))
    w = Window.partitionBy(key).orderBy("period_idx")
    return m.withColumn("x", dbl("rev")).withColumn("pos", F.row_number().over(w) - 1).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy(key))
    )


def trend_summary(series: DataFrame, key: str = "filial_name") -> DataFrame:
    """M10 for every branch: mean, sample std, CV, centred-rolling trend start/end, change %.

    The centred rolling mean (window w = max(2, n // 2), min_periods 1) is only
    needed at the first and last position: the mean of the first o + 1 values
    and of the last w - o values, o = (w - 1) // 2. Those are conditional
    averages, so the per-branch window size needs no per-row frame.
    """
    w = F.greatest(F.lit(2), F.floor(F.col("n") / 2))
    o = F.floor((w - 1) / 2)
    first = F.avg(F.when(F.col("pos") <= o, F.col("x")))
    last = F.avg(F.when(F.col("pos") >= F.col("n") - (w - o), F.col("x")))
    g = series.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        first.alias("t0"),
        last.alias("t1"),
    )
    ok = F.col("n_periods") >= MIN_TREND_PERIODS
    return g.select(
        key,
        F.col("n_periods").cast("int").alias("n_periods"),
        F.when(ok, rnd("mean", 2)).alias("revenue_mean"),
        F.when(ok, rnd("std", 2)).alias("revenue_std"),
        F.when(ok, F.when(F.col("mean") != 0, rnd(F.col("std") / F.col("mean"), 4)).otherwise(F.lit(0.0))).alias("revenue_cv"),
        F.when(ok, rnd("t0", 2)).alias("trend_start"),
        F.when(ok, rnd("t1", 2)).alias("trend_end"),
        F.when(ok, F.when(F.col("t0") != 0, rnd((F.col("t1") - F.col("t0")) / F.col("t0") * 100, 2)).otherwise(F.lit(0.0)))
        .alias("trend_change_pct"),
        F.when(~ok, STATUS_SKIPPED).when(F.col("n_periods") >= 2 * SEASON, STATUS_FULL).otherwise(STATUS_ROLLING)
        .alias("status"),
    )


def seasonal_decompose(series: DataFrame, key: str = "filial_name", period: int = SEASON) -> DataFrame:
    """M11 for every branch with n >= 2 * period: additive decomposition.

    (a) trend = centred 2x12 moving average (weights 1/2, 1 x 11, 1/2 over 12),
        null for the first and last period/2 positions;
    (b) both ends extrapolated by least-squares lines over the nearest
        ``period`` trend points (front: the first ones; back: the ones before
        the last defined point);
    (c) seasonal = mean of (x - trend) by position mod period, centred;
    (d) residual = x - trend - seasonal.
    Returns seasonal amplitude (max - min) and the residual sample std.
    """
    h = period // 2
    s = series.filter(F.col("n") >= 2 * period)
    w = Window.partitionBy(key).orderBy("pos")
    tot = F.sum("x").over(w.rowsBetween(-h, h))
    ends = F.lag("x", h).over(w) + F.lead("x", h).over(w)
    t = s.withColumn(
        "trend",
        F.when((F.col("pos") >= h) & (F.col("pos") <= F.col("n") - 1 - h), (tot - F.lit(0.5) * ends) / F.lit(float(period))),
    )
    front_lo, back = F.lit(h), F.col("n") - 1 - h
    front_hi = F.least(front_lo + period, back)
    back_lo = F.greatest(front_lo, back - period)
    in_front = (F.col("pos") >= front_lo) & (F.col("pos") < front_hi)
    in_back = (F.col("pos") >= back_lo) & (F.col("pos") < back)
    pos_d = dbl("pos")
    lines = t.groupBy(key).agg(
        F.regr_slope(F.when(in_front, F.col("trend")), F.when(in_front, pos_d)).alias("k0"),
        F.regr_intercept(F.when(in_front, F.col("trend")), F.when(in_front, pos_d)).alias("c0"),
        F.regr_slope(F.when(in_back, F.col("trend")), F.when(in_back, pos_d)).alias("k1"),
        F.regr_intercept(F.when(in_back, F.col("trend")), F.when(in_back, pos_d)).alias("c1"),
    )
    full = t.join(lines, key).withColumn(
        "trend_full",
        F.when(F.col("pos") < h, F.col("k0") * pos_d + F.col("c0"))
        .when(F.col("pos") > back, F.col("k1") * pos_d + F.col("c1"))
        .otherwise(F.col("trend")),
    ).withColumn("detr", F.col("x") - F.col("trend_full")).withColumn("season_pos", F.col("pos") % period)
    seas = full.groupBy(key, "season_pos").agg(F.avg("detr").alias("sm"))
    seas = seas.withColumn("seasonal", F.col("sm") - F.avg("sm").over(Window.partitionBy(key)))
    res = full.join(seas, [key, "season_pos"]).withColumn("resid", F.col("detr") - F.col("seasonal"))
    amp = seas.groupBy(key).agg((F.max("seasonal") - F.min("seasonal")).alias("amp"))
    rs = res.groupBy(key).agg(F.stddev_samp("resid").alias("rstd"), F.first("n").alias("n"))
    return rs.join(amp, key).select(
        key, F.col("n").cast("int").alias("n_periods"), rnd("amp", 2).alias("seasonal_amplitude"),
        rnd("rstd", 2).alias("residual_std"),
    )
