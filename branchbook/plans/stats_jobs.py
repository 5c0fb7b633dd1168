"""M1-M4, M6, M7 (z part), M10, M11, J9, K2, W12: the exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from branchbook.operators import stats as st
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import cte, with_ctes
from branchbook.sources.star import star


def eda_frame(spark, sf_dir):
    """Operations with the raw measure names (SUMMA, CNT, WEIGHT)."""
    f = star(spark, sf_dir).fact()
    return f.select(F.col("summa").alias("SUMMA"), F.col("cnt").alias("CNT"), F.col("weight").alias("WEIGHT"))


def _rank(c: str) -> str:
    return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0"


cte("eda_ranks", f"""
select SUMMA, CNT, WEIGHT, {_rank('SUMMA')} as rs, {_rank('CNT')} as rc, {_rank('WEIGHT')} as rw
from (select cast(summa as double) as SUMMA, cast(cnt as double) as CNT, cast(weight as double) as WEIGHT from fact_operations)
""", ("fact_operations",))


@register("corr_pairs", "M1 M2 M3 M4 J9 K2", with_ctes("""
with p as (select corr(SUMMA, CNT) as p1, corr(SUMMA, WEIGHT) as p2, corr(CNT, WEIGHT) as p3,
                  corr(rs, rc) as s1, corr(rs, rw) as s2, corr(rc, rw) as s3 from eda_ranks)
select 'SUMMA' as col_a, 'CNT' as col_b, round(p1, 6) + 0.0 as pearson, round(s1, 6) + 0.0 as spearman from p
union all select 'SUMMA', 'WEIGHT', round(p2, 6) + 0.0, round(s2, 6) + 0.0 from p
union all select 'CNT', 'WEIGHT', round(p3, 6) + 0.0, round(s3, 6) + 0.0 from p
""", "eda_ranks"))
def q_corr_pairs(spark, sf_dir):
    return st.corr_pairs(eda_frame(spark, sf_dir))


@register("anomaly_summary_z", "M6 M7 V7", with_ctes("""
with f as (select summa, cast(summa as double) as x from fact_operations),
s as (select avg(coalesce(x, 0)) as mu, stddev_pop(coalesce(x, 0)) as sd from f)
select cast(count(*) filter (where abs((coalesce(x, 0) - mu) / nullif(sd, 0)) > 3) as bigint) as z_count,
  round(100.0 * cast(sum(case when abs((coalesce(x, 0) - mu) / nullif(sd, 0)) > 3 then summa end) as double)
        / cast(sum(summa) as double), 2) + 0.0 as z_summa_share,
  3.0 as z_threshold
from f, s
""", "fact_operations"))
def q_anomaly_summary_z(spark, sf_dir):
    return st.z_summary(eda_frame(spark, sf_dir), "SUMMA")


def branch_series(spark, sf_dir):
    s = star(spark, sf_dir)
    named = s.fact().select("filial_id", "period_idx", "summa").join(
        F.broadcast(s.dim_filials().select("filial_id", "filial_name")), "filial_id"
    )
    return st.monthly_series(named)


cte("branch_series", """
select filial_name, period_idx, x, row_number() over (partition by filial_name order by period_idx) - 1 as pos,
       count(*) over (partition by filial_name) as n
from (select d.filial_name, f.period_idx, cast(sum(f.summa) as double) as x
      from fact_operations f join dim_filials d on f.filial_id = d.filial_id group by d.filial_name, f.period_idx)
""", ("fact_operations", "dim_filials"))


@register("trend_summary", "M10 W12 K3", with_ctes("""
with q as (select *, greatest(2, n // 2) as w, (greatest(2, n // 2) - 1) // 2 as o from branch_series),
g as (select filial_name, count(*) as np, avg(x) as mean, stddev_samp(x) as sd,
        avg(x) filter (where pos <= o) as t0, avg(x) filter (where pos >= n - (w - o)) as t1
      from q group by filial_name)
select filial_name, cast(np as int) as n_periods, round(mean, 2) + 0.0 as revenue_mean, round(sd, 2) + 0.0 as revenue_std,
  case when mean <> 0 then round(sd / mean, 4) + 0.0 else 0.0 end as revenue_cv,
  round(t0, 2) + 0.0 as trend_start, round(t1, 2) + 0.0 as trend_end,
  case when t0 <> 0 then round((t1 - t0) / t0 * 100, 2) + 0.0 else 0.0 end as trend_change_pct,
  case when np < 3 then 'skipped' when np >= 24 then 'full_decomposition' else 'rolling_trend_only' end as status
from g
""", "branch_series"))
def q_trend_summary(spark, sf_dir):
    return st.trend_summary(branch_series(spark, sf_dir))


@register("seasonal_decompose", "M11", with_ctes("""
with t as (
  select *, case when pos >= 6 and pos <= n - 7 then
      (sum(x) over (partition by filial_name order by pos rows between 6 preceding and 6 following)
       - 0.5 * (lag(x, 6) over (partition by filial_name order by pos) + lead(x, 6) over (partition by filial_name order by pos))) / 12.0
    end as trend
  from branch_series where n >= 24),
b as (select *, (pos >= 6 and pos < least(18, n - 7)) as inf, (pos >= greatest(6, n - 19) and pos < n - 7) as inb from t),
l as (select filial_name,
    regr_slope(case when inf then trend end, case when inf then cast(pos as double) end) as k0,
    regr_intercept(case when inf then trend end, case when inf then cast(pos as double) end) as c0,
    regr_slope(case when inb then trend end, case when inb then cast(pos as double) end) as k1,
    regr_intercept(case when inb then trend end, case when inb then cast(pos as double) end) as c1
  from b group by filial_name),
d as (select b.filial_name, b.n, b.pos % 12 as sp,
    b.x - case when b.pos < 6 then l.k0 * b.pos + l.c0 when b.pos > b.n - 7 then l.k1 * b.pos + l.c1 else b.trend end as detr
  from b join l on b.filial_name = l.filial_name),
se as (select filial_name, sp, avg(detr) as sm from d group by filial_name, sp),
se2 as (select *, sm - avg(sm) over (partition by filial_name) as seasonal from se),
amp as (select filial_name, max(seasonal) - min(seasonal) as amp from se2 group by filial_name),
r as (select d.filial_name, d.n, d.detr - se2.seasonal as resid from d join se2 on d.filial_name = se2.filial_name and d.sp = se2.sp)
select r.filial_name, cast(max(r.n) as int) as n_periods, round(max(amp.amp), 2) + 0.0 as seasonal_amplitude,
  round(stddev_samp(r.resid), 2) + 0.0 as residual_std
from r join amp on r.filial_name = amp.filial_name group by r.filial_name
""", "branch_series"))
def q_seasonal_decompose(spark, sf_dir):
    return st.seasonal_decompose(branch_series(spark, sf_dir))
