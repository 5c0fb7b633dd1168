"""BI measures (B1-B11) and dashboard datasets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, div0, rnd
from branchbook.operators import aggregates as ag
from branchbook.operators import dashboards as db
from branchbook.operators import measures as ms
from branchbook.operators.joins import checked_broadcast
from branchbook.operators.ml import branch_matrix
from branchbook.operators.windows import year_to_date
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import with_ctes
from branchbook.session import stored
from branchbook.sources import fixtures as fx
from branchbook.sources.star import star

R6 = "round({x}, 6) + 0.0"


def _r6(x: str) -> str:
    return R6.format(x=x)


@register("kpi_cards", "B1 B2 B11 D1 D4 W15 J7 F4", with_ctes(f"""
with m as (
  select period, period_idx, sum(summa) as rev, cast(sum(cnt) as bigint) as total_cnt, count(*) as n,
         cast(count(distinct filial_id) as bigint) as af
  from fact_operations group by period, period_idx),
mp as (select *, sum(rev) over (order by period_idx range between 1 preceding and 1 preceding) as prior from m),
p as (select period, sum(planned_summa) as planned from dim_plan
      where period in (select period from fact_operations) group by period)
select mp.period, cast(rev as double) as total_revenue, total_cnt,
  {_r6("cast(rev as double) / nullif(cast(n as double), 0)")} as avg_summa, af as active_filials,
  cast(prior as double) as total_revenue_prior,
  {_r6("(cast(rev as double) - cast(prior as double)) / nullif(cast(prior as double), 0)")} as mom_change,
  cast(planned as double) as planned_revenue, cast(rev - planned as double) as plan_variance,
  {_r6("cast(rev - planned as double) / nullif(cast(planned as double), 0)")} as plan_variance_pct,
  {_r6("cast(rev as double) / nullif(cast(planned as double), 0)")} as plan_achievement_pct
from mp left join p on mp.period = p.period
""", "fact_operations", "dim_plan"))
def q_kpi_cards(spark, sf_dir):
    s = star(spark, sf_dir)
    m = ms.base_measures(s.fact(), ["period", "period_idx"])
    m = ms.with_prior(m, "total_revenue", [])  # one row per month
    m = ms.plan_measures(m, fx.dim_plan(s))
    return m.select(
        "period", dbl("total_revenue").alias("total_revenue"), "total_cnt", ms.round6("avg_summa"),
        F.col("active_filials").cast("bigint").alias("active_filials"),
        dbl("total_revenue_prior").alias("total_revenue_prior"), ms.round6("mom_change"),
        dbl("planned_revenue").alias("planned_revenue"), dbl("plan_variance").alias("plan_variance"),
        ms.round6("plan_variance_pct"), ms.round6("plan_achievement_pct"),
    )


_BRANCH_MONTH = """bm as (select filial_id, period, period_idx, sum(summa) as rev from fact_operations
        group by filial_id, period, period_idx)"""


def _branch_month(spark, sf_dir):
    return star(spark, sf_dir).fact().groupBy("filial_id", "period", "period_idx").agg(F.sum("summa").alias("rev"))


@register("mom_prior_period", "B2 W15 F4", with_ctes(f"""
with {_BRANCH_MONTH},
x as (select *, sum(rev) over (partition by filial_id order by period_idx range between 1 preceding and 1 preceding) as prior from bm)
select filial_id, period, cast(rev as double) as revenue, cast(prior as double) as revenue_prior,
  {_r6("(cast(rev as double) - cast(prior as double)) / nullif(cast(prior as double), 0)")} as mom_change
from x
""", "fact_operations"))
def q_mom_prior_period(spark, sf_dir):
    m = ms.with_prior(_branch_month(spark, sf_dir), "rev", ["filial_id"])
    return m.select("filial_id", "period", dbl("rev").alias("revenue"), dbl("rev_prior").alias("revenue_prior"),
                    ms.round6("mom_change"))


@register("ytd", "B3 W14", with_ctes(f"""
with {_BRANCH_MONTH}
select filial_id, period, cast(rev as double) as revenue,
  cast(sum(rev) over (partition by filial_id, (period_idx - 1) // 12 order by period_idx
                      range between unbounded preceding and current row) as double) as revenue_ytd
from bm
""", "fact_operations"))
def q_ytd(spark, sf_dir):
    m = _branch_month(spark, sf_dir).withColumn("year", F.expr("(period_idx - 1) div 12"))
    return m.select("filial_id", "period", dbl("rev").alias("revenue"),
                    dbl(year_to_date("rev", ["filial_id"], "year")).alias("revenue_ytd"))


@register("branch_rank_share", "B4 B5 B6 W3 W13", with_ctes(f"""
with {_BRANCH_MONTH},
r as (select *, dense_rank() over (partition by period order by rev desc) as rk from bm)
select filial_id, period, cast(rev as double) as revenue, cast(rk as int) as revenue_rank,
  case when rk <= 5 then 'top5' else 'other' end as top5_flag,
  {_r6("cast(rev as double) / nullif(cast(sum(rev) over (partition by period) as double), 0)")} as revenue_share,
  {_r6("cast(sum(rev) over (partition by period order by rk range between unbounded preceding and current row) as double)"
       " / nullif(cast(sum(rev) over (partition by period) as double), 0)")} as cumulative_share
from r
""", "fact_operations"))
def q_branch_rank_share(spark, sf_dir):
    r = ms.rank_share(_branch_month(spark, sf_dir), "rev", ["period"])
    return r.select("filial_id", "period", dbl("rev").alias("revenue"), F.col("revenue_rank").cast("int").alias("revenue_rank"),
                    "top5_flag", ms.round6("revenue_share"), ms.round6("cumulative_share"))


@register("kpi_bands", "B7", with_ctes(f"""
with {_BRANCH_MONTH},
x as (select *, (cast(rev as double) - cast(prior as double)) / nullif(cast(prior as double), 0) as mom
      from (select *, sum(rev) over (partition by filial_id order by period_idx range between 1 preceding and 1 preceding) as prior from bm))
select filial_id, period, {_r6("mom")} as mom_change,
  case when coalesce(mom, 0) >= 0.05 then '#27AE60' when coalesce(mom, 0) >= 0 then '#F39C12'
       when coalesce(mom, 0) >= -0.10 then '#E67E22' else '#C0392B' end as kpi_colour
from x
""", "fact_operations"))
def q_kpi_bands(spark, sf_dir):
    m = ms.with_prior(_branch_month(spark, sf_dir), "rev", ["filial_id"])
    return m.select("filial_id", "period", ms.round6("mom_change"), ms.kpi_colour("mom_change").alias("kpi_colour"))


@register("segment_labels", "B8 F11", with_ctes("""
select filial_id, sender_category, cast(grouping(filial_id, sender_category) as int) as level_id,
  case when count(distinct sender_category) = 1 then min(sender_category) else 'all' end as client_segment_label,
  cast(sum(summa) as double) as revenue
from fact_operations group by rollup (filial_id, sender_category)
""", "fact_operations"))
def q_segment_labels(spark, sf_dir):
    pre = star(spark, sf_dir).fact().groupBy("filial_id", "sender_category").agg(F.sum("summa").alias("rev"))
    r = pre.rollup("filial_id", "sender_category").agg(
        F.grouping_id().cast("int").alias("level_id"), ms.segment_label().alias("client_segment_label"),
        F.sum("rev").alias("rev"),
    )
    return r.select("filial_id", "sender_category", "level_id", "client_segment_label", dbl("rev").alias("revenue"))


@register("titles", "B10 F11", with_ctes("""
with pairs as (select f.period, d.filial_name, sum(f.summa) as rev
               from fact_operations f join dim_filials d on f.filial_id = d.filial_id group by f.period, d.filial_name)
select period, filial_name, cast(grouping(period, filial_name) as int) as level_id,
  'Revenue - ' || case when count(distinct period) = 1 then min(period) else 'All periods' end
    || case when count(distinct filial_name) = 1 then ' | ' || min(filial_name) else '' end as title_executive,
  'Analytics - ' || case when count(distinct filial_name) = 1 then min(filial_name) else 'All branches' end as title_drillthrough,
  cast(sum(rev) as double) as revenue
from pairs group by cube (period, filial_name)
""", "fact_operations", "dim_filials"))
def q_titles(spark, sf_dir):
    s = star(spark, sf_dir)
    pairs = s.fact().groupBy("filial_id", "period").agg(F.sum("summa").alias("rev")).join(
        F.broadcast(s.dim_filials().select("filial_id", "filial_name")), "filial_id"
    ).groupBy("period", "filial_name").agg(F.sum("rev").alias("rev"))
    c = pairs.cube("period", "filial_name").agg(
        F.grouping_id().cast("int").alias("level_id"), *ms.titles(), F.sum("rev").alias("rev")
    )
    return c.select("period", "filial_name", "level_id", "title_executive", "title_drillthrough", dbl("rev").alias("revenue"))


@register("plan_variance", "B11 J7 D4", with_ctes(f"""
with a as (select sum(summa) as rev from fact_operations),
p as (select sum(planned_summa) as planned from dim_plan where period in (select period from fact_operations))
select cast(rev as double) as total_revenue, cast(planned as double) as planned_revenue,
  cast(rev - planned as double) as plan_variance,
  {_r6("cast(rev - planned as double) / nullif(cast(planned as double), 0)")} as plan_variance_pct,
  {_r6("cast(rev as double) / nullif(cast(planned as double), 0)")} as plan_achievement_pct
from a, p
""", "fact_operations", "dim_plan"))
def q_plan_variance(spark, sf_dir):
    s = star(spark, sf_dir)
    fact = s.fact()
    actual = fact.groupBy("period").agg(F.sum("summa").alias("total_revenue"))
    pm = ms.plan_measures(actual, fx.dim_plan(s))
    g = pm.agg(F.sum("total_revenue").alias("total_revenue"), F.sum("planned_revenue").alias("planned_revenue"))
    return g.select(
        dbl("total_revenue").alias("total_revenue"), dbl("planned_revenue").alias("planned_revenue"),
        dbl(F.col("total_revenue") - F.col("planned_revenue")).alias("plan_variance"),
        rnd(div0(dbl(F.col("total_revenue") - F.col("planned_revenue")), dbl("planned_revenue")), 6).alias("plan_variance_pct"),
        rnd(div0(dbl("total_revenue"), dbl("planned_revenue")), 6).alias("plan_achievement_pct"),
    )


def _by_product(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = s.fact().groupBy("inc_gk").agg(F.sum("summa").alias("revenue"))
    return db.with_product(acct, s.dim_products(), ("product",)).groupBy("product").agg(F.sum("revenue").alias("revenue"))


@register("waterfall", "D2 W6", with_ctes("""
with p as (select d.product, sum(f.summa) as rev from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by d.product)
select product, cast(rev as double) as revenue,
  cast(coalesce(sum(rev) over (order by rev desc, product rows between unbounded preceding and 1 preceding), 0) as double) as step_start,
  cast(coalesce(sum(rev) over (order by rev desc, product rows between unbounded preceding and 1 preceding), 0) + rev as double) as step_end
from p
""", "fact_operations", "dim_products"))
def q_waterfall(spark, sf_dir):
    w = db.waterfall(_by_product(spark, sf_dir))
    return w.select("product", dbl("revenue").alias("revenue"), dbl("step_start").alias("step_start"),
                    dbl("step_end").alias("step_end"))


@register("matrix_branch_product", "D3 A9", with_ctes("""
select f.filial_id,
  coalesce(cast(sum(case when d.product = 'ECONOMY' then f.summa end) as double), 0) as "ECONOMY",
  coalesce(cast(sum(case when d.product = 'LARGE' then f.summa end) as double), 0) as "LARGE",
  coalesce(cast(sum(case when d.product = 'MEDIUM' then f.summa end) as double), 0) as "MEDIUM",
  coalesce(cast(sum(case when d.product = 'PROMO' then f.summa end) as double), 0) as "PROMO",
  coalesce(cast(sum(case when d.product = 'SMALL' then f.summa end) as double), 0) as "SMALL",
  coalesce(cast(sum(case when d.product = 'STANDARD' then f.summa end) as double), 0) as "STANDARD"
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by f.filial_id
""", "fact_operations", "dim_products"))
def q_matrix_branch_product(spark, sf_dir):
    s = star(spark, sf_dir)
    # the pivot values: distinct products of the dim (a bounded code list)
    products = sorted(r[0] for r in s.dim_products().select("product").distinct().collect())
    acct = s.fact().groupBy("filial_id", "inc_gk").agg(F.sum("summa").alias("rev"))
    long = db.with_product(acct, s.dim_products(), ("product",)).select("filial_id", "product", "rev")
    m = db.pivot_sum(long, "filial_id", "product", "rev", products)
    return m.select("filial_id", *[dbl(F.col(f"`{p}`")).alias(p) for p in products])


@register("top10_branches", "D5 K4 K1", with_ctes("""
select f.filial_id, d.filial_name, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_filials d on f.filial_id = d.filial_id
group by f.filial_id, d.filial_name order by sum(f.summa) desc, f.filial_id limit 10
""", "fact_operations", "dim_filials"))
def q_top10_branches(spark, sf_dir):
    s = star(spark, sf_dir)
    b = s.fact().groupBy("filial_id").agg(F.sum("summa").alias("rev")).join(
        F.broadcast(s.dim_filials().select("filial_id", "filial_name")), "filial_id")
    return db.top_n(b, "rev", 10, "filial_id").select("filial_id", "filial_name", dbl("rev").alias("revenue"))


@register("top_branch", "K3 K2", with_ctes("""
select d.filial_name, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_filials d on f.filial_id = d.filial_id
group by d.filial_name order by sum(f.summa) desc, d.filial_name limit 1
""", "fact_operations", "dim_filials"))
def q_top_branch(spark, sf_dir):
    s = star(spark, sf_dir)
    b = s.fact().groupBy("filial_id").agg(F.sum("summa").alias("rev")).join(
        F.broadcast(s.dim_filials().select("filial_id", "filial_name")), "filial_id"
    ).groupBy("filial_name").agg(F.sum("rev").alias("rev"))
    return db.top_n(b, "rev", 1, "filial_name").select("filial_name", dbl("rev").alias("revenue"))


@register("product_lines", "D6 A2", with_ctes("""
select d.product, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by d.product, f.period
""", "fact_operations", "dim_products"))
def q_product_lines(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = s.fact().groupBy("inc_gk", "period").agg(F.sum("summa").alias("rev"))
    g = db.with_product(acct, s.dim_products(), ("product",)).groupBy("product", "period").agg(F.sum("rev").alias("rev"))
    return g.select("product", "period", dbl("rev").alias("revenue"))


@register("branch_scatter", "D7", with_ctes(f"""
select f.filial_id, d.product, cast(sum(f.summa) as double) as revenue, cast(sum(f.cnt) as bigint) as operations,
  cast(count(*) as bigint) as rows_cnt, {_r6("cast(sum(f.summa) as double) / count(*)")} as avg_check
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by f.filial_id, d.product
""", "fact_operations", "dim_products"))
def q_branch_scatter(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = s.fact().groupBy("filial_id", "inc_gk").agg(
        F.sum("summa").alias("rev"), F.sum("cnt").alias("ops"), F.count(F.lit(1)).alias("n"))
    g = db.with_product(acct, s.dim_products(), ("product",)).groupBy("filial_id", "product").agg(
        F.sum("rev").alias("rev"), F.sum("ops").alias("ops"), F.sum("n").alias("n"))
    return g.select("filial_id", "product", dbl("rev").alias("revenue"), F.col("ops").cast("bigint").alias("operations"),
                    F.col("n").cast("bigint").alias("rows_cnt"), rnd(dbl("rev") / dbl("n"), 6).alias("avg_check"))


@register("stack_direction", "D8", with_ctes("""
select d.direction, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by d.direction, f.period
""", "fact_operations", "dim_products"))
def q_stack_direction(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = s.fact().groupBy("inc_gk", "period").agg(F.sum("summa").alias("rev"))
    g = db.with_product(acct, s.dim_products(), ("direction",)).groupBy("direction", "period").agg(F.sum("rev").alias("rev"))
    return g.select("direction", "period", dbl("rev").alias("revenue"))


@register("stack_client", "D9", with_ctes("""
select sender_category, period, cast(sum(summa) as double) as revenue
from fact_operations group by sender_category, period
""", "fact_operations"))
def q_stack_client(spark, sf_dir):
    g = star(spark, sf_dir).fact().groupBy("sender_category", "period").agg(F.sum("summa").alias("rev"))
    return g.select("sender_category", "period", dbl("rev").alias("revenue"))


_CENTS2 = "cast(cast(summa * 100 as bigint) as hugeint) * cast(summa * 100 as bigint)"


@register("influencers", "D11", with_ctes(f"""
with fp as (select f.filial_id, f.summa, d.product, d.direction, f.sender_category
            from fact_operations f join dim_products d on f.inc_gk = d.inc_gk),
long as (select filial_id, 'product' as factor, product as factor_value, summa from fp
         union all select filial_id, 'direction', direction, summa from fp
         union all select filial_id, 'sender_category', sender_category, summa from fp),
per as (select filial_id, factor, factor_value, sum(summa) as rev, count(*) as n, sum({_CENTS2}) as sq from long group by filial_id, factor, factor_value),
b as (select filial_id, sum(summa) as b_rev, count(*) as b_n, sum({_CENTS2}) as b_sq from fp group by filial_id),
x as (select per.filial_id, factor, factor_value, n, rev, b_rev, b_n, cast(n as double) as n1, cast(b_n - n as double) as n2,
        cast(rev * 100 as double) as s1, cast((b_rev - rev) * 100 as double) as s2, cast(sq as double) as q1, cast(b_sq - sq as double) as q2
      from per join b on per.filial_id = b.filial_id),
e as (select *, s1 / n1 as m1, s2 / nullif(n2, 0) as m2, (q1 - s1 * s1 / n1) / nullif(n1 - 1, 0) / n1 as e1,
        (q2 - s2 * s2 / nullif(n2, 0)) / nullif(n2 - 1, 0) / nullif(n2, 0) as e2 from x)
select filial_id, factor, factor_value, cast(n as bigint) as rows_cnt,
  {_r6("cast(rev as double) / cast(n as double)")} as avg_check,
  {_r6("(cast(rev as double) / cast(n as double)) / (cast(b_rev as double) / cast(b_n as double))")} as lift,
  round((m1 - m2) / nullif(sqrt(e1 + e2), 0), 4) + 0.0 as t_stat,
  round((e1 + e2) * (e1 + e2) / nullif(e1 * e1 / nullif(n1 - 1, 0) + e2 * e2 / nullif(n2 - 1, 0), 0), 2) + 0.0 as welch_df
from e
""", "fact_operations", "dim_products"))
def q_influencers(spark, sf_dir):
    s = star(spark, sf_dir)
    by_account = s.fact().groupBy("filial_id", "inc_gk", "sender_category").agg(
        F.sum("summa").alias("summa"), F.count(F.lit(1)).alias("rows"), F.sum(db.cents_squared()).alias("squares"))
    fp = db.with_product(by_account, s.dim_products())
    r = db.influencers(fp, ["product", "direction", "sender_category"], rows="rows", squares="squares")
    return r.select("filial_id", "factor", "factor_value", "rows_cnt", ms.round6("avg_check"), ms.round6("lift"),
                    rnd("t_stat", 4).alias("t_stat"), rnd("welch_df", 2).alias("welch_df"))


@register("top3_products", "D12 K5", with_ctes("""
with g as (select f.filial_id, d.product, sum(f.summa) as rev
           from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by f.filial_id, d.product)
select filial_id, product, cast(rev as double) as revenue, cast(rn as int) as rank_in_group from (
  select *, row_number() over (partition by filial_id order by rev desc, product) as rn from g) where rn <= 3
""", "fact_operations", "dim_products"))
def q_top3_products(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = db.sums_of_many(s.fact(), ["filial_id", "inc_gk"], "summa")
    g = db.with_product(acct, s.dim_products(), ("product",)).groupBy("filial_id", "product").agg(F.sum("summa").alias("rev"))
    t = db.top_n_per_group(g, "filial_id", "rev", 3, "product")
    return t.select("filial_id", "product", dbl("rev").alias("revenue"), F.col("rank_in_group").cast("int").alias("rank_in_group"))


@register("account_pareto", "D13 W6", with_ctes("""
with a as (select inc_gk, sum(summa) as rev from fact_operations group by inc_gk)
select inc_gk, cast(rev as double) as revenue,
  round(cast(sum(rev) over (order by rev desc, inc_gk rows between unbounded preceding and current row) as double)
        / cast(sum(rev) over () as double) * 100.0, 4) + 0.0 as cumulative_pct,
  case when cast(sum(rev) over (order by rev desc, inc_gk rows between unbounded preceding and current row) as double)
        / cast(sum(rev) over () as double) * 100.0 <= 80 then 'top80' else 'long_tail' end as pareto_bucket
from a
""", "fact_operations"))
def q_account_pareto(spark, sf_dir):
    a = star(spark, sf_dir).fact().groupBy("inc_gk").agg(F.sum("summa").alias("rev"))
    p = db.account_pareto(a, "rev", "inc_gk")
    return p.select("inc_gk", dbl("rev").alias("revenue"), rnd("cumulative_pct", 4).alias("cumulative_pct"),
                    F.when(F.col("cumulative_pct") <= 80, "top80").otherwise("long_tail").alias("pareto_bucket"))


@register("matrix_account_branch", "D14", with_ctes("""
select inc_gk, filial_id, cast(sum(summa) as double) as revenue from fact_operations group by inc_gk, filial_id
""", "fact_operations"))
def q_matrix_account_branch(spark, sf_dir):
    g = db.sums_of_many(star(spark, sf_dir).fact(), ["inc_gk", "filial_id"], "summa")
    return g.select("inc_gk", "filial_id", dbl("summa").alias("revenue"))


# The branch codes and calendar months that the matrices below spread over columns.
BRANCHES = list(range(25))
MONTHS = [f"{y}_{m}" for y in range(1992, 1999) for m in range(1, 13)]


@register("matrix_account_branch_wide", "D14 A9", with_ctes("select inc_gk, " + ", ".join(
    f"coalesce(cast(sum(case when filial_id = {b} then summa end) as double), 0) as branch_{b}" for b in BRANCHES)
    + " from fact_operations group by inc_gk", "fact_operations"))
def q_matrix_account_branch_wide(spark, sf_dir):
    m = db.pivot_sum(star(spark, sf_dir).fact(), "inc_gk", "filial_id", "summa", BRANCHES, many_rows=True)
    return m.select("inc_gk", *[dbl(F.col(f"`{b}`")).alias(f"branch_{b}") for b in BRANCHES])


@register("matrix_branch_period", "A9", with_ctes("select filial_id, " + ", ".join(
    f"coalesce(cast(sum(case when period = '{p}' then summa end) as double), 0) as \"m_{p}\"" for p in MONTHS)
    + " from fact_operations group by filial_id", "fact_operations"))
def q_matrix_branch_period(spark, sf_dir):
    m = branch_matrix(star(spark, sf_dir).fact(), MONTHS, key="filial_id")
    return m.select("filial_id", *[F.col(f"`{p}`").alias(f"m_{p}") for p in MONTHS])


@register("product_trend", "D15 B9 W2", with_ctes(f"""
with g as (select d.product, f.period, f.period_idx, sum(f.summa) as rev
           from fact_operations f join dim_products d on f.inc_gk = d.inc_gk group by d.product, f.period, f.period_idx),
x as (select *, (cast(rev as double) - cast(lag(rev) over w as double)) / nullif(cast(lag(rev) over w as double), 0) as growth
      from g window w as (partition by product order by period_idx))
select product, period, cast(rev as double) as revenue, {_r6("growth")} as growth,
  case when coalesce(growth, 0) > 0.10 then 'fast_growth' when coalesce(growth, 0) > 0 then 'growth'
       when coalesce(growth, 0) > -0.10 then 'decline' else 'crisis' end as product_status
from x
""", "fact_operations", "dim_products"))
def q_product_trend(spark, sf_dir):
    s = star(spark, sf_dir)
    acct = s.fact().groupBy("inc_gk", "period", "period_idx").agg(F.sum("summa").alias("rev"))
    g = db.with_product(acct, s.dim_products(), ("product",)).groupBy("product", "period", "period_idx").agg(
        F.sum("rev").alias("rev"))
    prev = F.lag("rev").over(Window.partitionBy("product").orderBy("period_idx"))
    x = g.withColumn("growth", div0(dbl("rev") - dbl(prev), dbl(prev)))
    return x.select("product", "period", dbl("rev").alias("revenue"), ms.round6("growth"),
                    ms.product_status("growth").alias("product_status"))


# Bookmark: international B2B operations of three branches.
BOOKMARK = db.Slicers(direction="INT", sender_category="B2B", filial_ids=[1, 2, 3])


@register("filtered_view", "P3", with_ctes("""
select f.filial_id, d.product, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk
where d.direction = 'INT' and f.sender_category = 'B2B' and f.filial_id in (1, 2, 3)
group by f.filial_id, d.product, f.period
""", "fact_operations", "dim_products"))
def q_filtered_view(spark, sf_dir):
    s = star(spark, sf_dir)
    v = BOOKMARK.apply(s.fact(), s.dim_products())
    return v.groupBy("filial_id", "product", "period").agg(dbl(F.sum("summa")).alias("revenue"))


# Bookmark: two months of one product.
MONTHS_BOOKMARK = db.Slicers(periods=["1995_3", "1996_11"], product="PROMO")


@register("filtered_view_months", "P3", with_ctes("""
select f.filial_id, d.product, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f join dim_products d on f.inc_gk = d.inc_gk
where d.product = 'PROMO' and f.period in ('1995_3', '1996_11')
group by f.filial_id, d.product, f.period
""", "fact_operations", "dim_products"))
def q_filtered_view_months(spark, sf_dir):
    s = star(spark, sf_dir)
    v = MONTHS_BOOKMARK.apply(s.fact(), s.dim_products())
    return v.groupBy("filial_id", "product", "period").agg(dbl(F.sum("summa")).alias("revenue"))


@register("row_security", "P4", with_ctes("""
select g.user_name, f.filial_id, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f join user_grants g on f.filial_id = g.filial_id
group by g.user_name, f.filial_id, f.period
""", "fact_operations", "user_grants"))
def q_row_security(spark, sf_dir):
    s = star(spark, sf_dir)
    bm = s.fact().groupBy("filial_id", "period").agg(F.sum("summa").alias("rev"))
    v = db.row_security(bm, checked_broadcast(fx.user_grants(s)))
    return v.select("user_name", "filial_id", "period", dbl("rev").alias("revenue"))


@register("distinct_by_slice", "A7 S6", with_ctes("""
select d.region, cast(floor((f.period_idx - 1) / 12) as int) as year, cast(count(distinct f.inc_gk) as bigint) as accounts, true as sketch_within_5_pct
from fact_operations f join dim_filials d on f.filial_id = d.filial_id group by d.region, floor((f.period_idx - 1) / 12)
union all
select 'all', null, cast(count(distinct inc_gk) as bigint), true from fact_operations
""", "fact_operations", "dim_filials"))
def q_distinct_by_slice(spark, sf_dir):
    """Distinct accounts of slices: exact, and united from the sketches kept by branch and month."""
    s = star(spark, sf_dir)
    sketched = stored(ag.distinct_sketches(s.fact(), ["filial_id", "period_idx"], "inc_gk"), "account-sketches")
    regions = F.broadcast(s.dim_filials().select("filial_id", "region"))  # 25 branches
    year = F.floor((F.col("period_idx") - 1) / 12).cast("int").alias("year")
    exact = s.fact().select("filial_id", "period_idx", "inc_gk").join(regions, "filial_id").select("region", year, "inc_gk")
    pieces = sketched.join(regions, "filial_id").select("region", year, "sketch")
    one = exact.groupBy("region", "year").agg(F.countDistinct("inc_gk").alias("accounts"))
    near = ag.united_distinct(pieces, ["region", "year"])
    by = one.join(near, ["region", "year"])
    top = exact.agg(F.countDistinct("inc_gk").alias("accounts")).select(F.lit("all").alias("region"), F.lit(None).cast("int").alias("year"), "accounts")
    top = top.withColumn("distinct_estimate", ag.united_distinct(pieces, []).scalar())
    return by.unionByName(top).select("region", "year", F.col("accounts").cast("bigint").alias("accounts"),
                                      (F.abs(F.col("distinct_estimate") / F.col("accounts") - 1) <= 0.05).alias("sketch_within_5_pct"))
