"""Enrichment, aggregate tables and features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, pct_change, rnd
from branchbook.operators import aggregates as ag
from branchbook.operators import features as fe
from branchbook.operators.joins import checked_broadcast, enrich_left
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import cte, with_ctes
from branchbook.sources import fixtures as fx
from branchbook.sources.star import star


def contract_frame(spark, sf_dir):
    """Facts enriched with branch and product attributes, renamed to the analysis contract."""
    s = star(spark, sf_dir)
    e = enrich_left(s.fact(), s.dim_filials().select("filial_id", "filial_name"), "filial_id")
    e = enrich_left(e, s.dim_products().select("inc_gk", "product", "direction"), "inc_gk")
    return fe.to_contract(e.withColumnsRenamed({"summa": "SUMMA", "cnt": "CNT"}))


cte("contract", """
select f.filial_id, f.inc_gk, f.operation_date, f.period, f.period_idx, f.sender_category, f.weight,
       f.cnt as operations_count, f.summa as revenue, d.filial_name, p.product as service_type, p.direction as region
from fact_operations f
left join dim_filials d on f.filial_id = d.filial_id
left join dim_products p on f.inc_gk = p.inc_gk
""", ("fact_operations", "dim_filials", "dim_products"))


@register("enrich_left", "J3 J8", with_ctes("""
select f.filial_id, f.inc_gk, f.operation_date, f.sender_category, f.summa, d.filial_name, d.region, p.product, p.direction
from fact_operations f
left join filials_missing_one d on f.filial_id = d.filial_id
left join products_missing_some p on f.inc_gk = p.inc_gk
""", "fact_operations", "filials_missing_one", "products_missing_some"))
def q_enrich_left(spark, sf_dir):
    s = star(spark, sf_dir)
    f = s.fact().select("filial_id", "inc_gk", "operation_date", "sender_category", "summa")
    e = enrich_left(f, fx.filials_missing_one(s).select("filial_id", "filial_name", "region"), "filial_id")
    return enrich_left(e, fx.products_missing_some(s).select("inc_gk", "product", "direction"), "inc_gk")


@register("kpi_monthly", "A3 S6", with_ctes("""
select filial_id, period, inc_gk, cast(sum(summa) as double) as revenue, cast(sum(cnt) as bigint) as operations,
       cast(sum(weight) as double) as total_weight
from fact_operations group by filial_id, period, inc_gk
""", "fact_operations"))
def q_kpi_monthly(spark, sf_dir):
    k = ag.kpi_aggregate(star(spark, sf_dir).fact())
    return k.select("filial_id", "period", "inc_gk", dbl("revenue").alias("revenue"), "operations",
                    dbl("total_weight").alias("total_weight"))


@register("agg_branch_product_period", "A4", with_ctes("""
select f.filial_id, p.product, f.period, cast(sum(f.summa) as double) as revenue,
       cast(sum(f.cnt) as bigint) as operations, cast(count(*) as bigint) as rows_cnt
from fact_operations f join dim_products p on f.inc_gk = p.inc_gk
group by f.filial_id, p.product, f.period
""", "fact_operations", "dim_products"))
def q_agg_branch_product_period(spark, sf_dir):
    s = star(spark, sf_dir)
    per_acct = s.fact().groupBy("filial_id", "inc_gk", "period").agg(
        F.sum("summa").alias("revenue"), F.sum("cnt").alias("operations"), F.count(F.lit(1)).alias("rows_cnt")
    )
    p = checked_broadcast(s.dim_products().select("inc_gk", "product"))
    g = per_acct.join(p, "inc_gk").groupBy("filial_id", "product", "period").agg(
        F.sum("revenue").alias("revenue"), F.sum("operations").alias("operations"), F.sum("rows_cnt").alias("rows_cnt")
    )
    return g.select("filial_id", "product", "period", dbl("revenue").alias("revenue"),
                    F.col("operations").cast("bigint").alias("operations"), F.col("rows_cnt").cast("bigint").alias("rows_cnt"))


@register("period_totals", "A11 W2", with_ctes("""
select period, cast(rev as double) as revenue,
  round(100.0 * (cast(rev as double) - cast(prev as double)) / nullif(cast(prev as double), 0), 2) + 0.0 as mom_pct
from (select period, period_idx, sum(summa) as rev, lag(sum(summa)) over (order by period_idx) as prev
      from fact_operations group by period, period_idx)
""", "fact_operations"))
def q_period_totals(spark, sf_dir):
    per = star(spark, sf_dir).fact().groupBy("period", "period_idx").agg(F.sum("summa").alias("rev"))
    w = Window.orderBy("period_idx")  # one row per month
    return per.withColumn("prev", F.lag("rev").over(w)).orderBy("period_idx").select(
        "period", dbl("rev").alias("revenue"), pct_change("rev", "prev").alias("mom_pct")
    )


@register("product_share", "A12 A6", with_ctes("""
select product, cast(rev as double) as revenue,
  round(100.0 * cast(rev as double) / cast(sum(rev) over () as double), 2) + 0.0 as share_pct
from (select p.product, sum(f.summa) as rev
      from fact_operations f left join products_missing_some p on f.inc_gk = p.inc_gk
      where p.product is not null group by p.product)
""", "fact_operations", "products_missing_some"))
def q_product_share(spark, sf_dir):
    s = star(spark, sf_dir)
    per_acct = s.fact().groupBy("inc_gk").agg(F.sum("summa").alias("rev"))
    e = enrich_left(per_acct, fx.products_missing_some(s).select("inc_gk", "product"), "inc_gk")
    g = e.filter(F.col("product").isNotNull()).groupBy("product").agg(F.sum("rev").alias("rev"))
    g = ag.share_of_total(g, "rev", "share_pct", 2)
    return g.orderBy(F.desc("rev")).select("product", dbl("rev").alias("revenue"), "share_pct")


@register("hierarchy_rollup", "A14 D10", with_ctes("""
select product, subcategory, inc_gk, cast(grouping(product, subcategory, inc_gk) as int) as level_id,
       cast(sum(summa) as double) as revenue, cast(count(*) as bigint) as rows_cnt
from fact_operations f join dim_products p using (inc_gk)
group by rollup (product, subcategory, inc_gk)
""", "fact_operations", "dim_products"))
def q_hierarchy_rollup(spark, sf_dir):
    s = star(spark, sf_dir)
    per_acct = s.fact().groupBy("inc_gk").agg(F.sum("summa").alias("rev"), F.count(F.lit(1)).alias("n"))
    e = per_acct.join(checked_broadcast(s.dim_products().select("inc_gk", "product", "subcategory")), "inc_gk")
    r = e.rollup("product", "subcategory", "inc_gk").agg(
        F.grouping_id().cast("int").alias("level_id"), F.sum("rev").alias("rev"), F.sum("n").alias("n")
    )
    return r.select("product", "subcategory", "inc_gk", "level_id", dbl("rev").alias("revenue"),
                    F.col("n").cast("bigint").alias("rows_cnt"))


_PERIOD_DT = "make_date(cast(split_part(period, '_', 1) as int), cast(split_part(period, '_', 2) as int), 1)"


@register("temporal_features", "X1 F9 F10 P1", with_ctes(f"""
select filial_id, inc_gk, operation_date, sender_category, period, revenue,
  {_PERIOD_DT} as period_dt, cast(month({_PERIOD_DT}) as int) as month,
  cast(quarter({_PERIOD_DT}) as int) as quarter, cast(year({_PERIOD_DT}) as int) as year,
  isodow({_PERIOD_DT}) >= 6 as is_weekend_start
from contract
""", "contract"))
def q_temporal_features(spark, sf_dir):
    c = contract_frame(spark, sf_dir).select("filial_id", "inc_gk", "operation_date", "sender_category", "period", "revenue")
    return fe.temporal_features(c)


@register("interaction_features", "X2 W10 J5 A8", with_ctes("""
with per as (select period, sum(revenue) as tot,
               cast(sum(revenue * revenue) as double) / nullif(cast(sum(revenue) as double) * cast(sum(revenue) as double), 0) as cr
             from contract group by period),
fm as (select filial_id, period, sum(revenue) as rpf from contract group by filial_id, period)
select c.filial_id, c.inc_gk, c.operation_date, c.sender_category, c.period, c.revenue,
  round(cast(c.revenue as double) / nullif(cast(per.tot as double), 0), 10) + 0.0 as revenue_share,
  cast(fm.rpf as double) as revenue_per_filial,
  round(per.cr, 10) + 0.0 as concentration_ratio
from contract c join per on c.period = per.period join fm on c.filial_id = fm.filial_id and c.period = fm.period
""", "contract"))
def q_interaction_features(spark, sf_dir):
    c = contract_frame(spark, sf_dir).select("filial_id", "inc_gk", "operation_date", "sender_category", "period", "revenue")
    x = fe.interaction_features(c)
    return x.select("filial_id", "inc_gk", "operation_date", "sender_category", "period", "revenue",
                    rnd("revenue_share", 10).alias("revenue_share"),
                    dbl("revenue_per_filial").alias("revenue_per_filial"),
                    rnd("concentration_ratio", 10).alias("concentration_ratio"))


@register("scaled_features", "X3", with_ctes("""
with st as (select avg(cast(revenue as double)) as mr, stddev_pop(cast(revenue as double)) as sr,
                   avg(cast(operations_count as double)) as mo, stddev_pop(cast(operations_count as double)) as so from contract)
select filial_id, inc_gk, operation_date, sender_category, period, revenue, operations_count,
  round(case when sr = 0 then 0.0 else (coalesce(cast(revenue as double), 0) - mr) / sr end, 8) + 0.0 as revenue_scaled,
  round(case when so = 0 then 0.0 else (coalesce(cast(operations_count as double), 0) - mo) / so end, 8) + 0.0 as operations_count_scaled
from contract, st
""", "contract"))
def q_scaled_features(spark, sf_dir):
    c = contract_frame(spark, sf_dir).select(
        "filial_id", "inc_gk", "operation_date", "sender_category", "period", "revenue", "operations_count"
    )
    x = fe.standardise(c, ["revenue", "operations_count"])
    return fe.round_cols(x, ["revenue_scaled", "operations_count_scaled"], 8)


@register("lag_frame", "X4 W11 A13", with_ctes(f"""
with m as (
  select filial_id, period, {_PERIOD_DT} as period_dt, sum(revenue) as revenue
  from contract group by filial_id, period)
select filial_id, period, cast(month(period_dt) as int) as month, cast(quarter(period_dt) as int) as quarter,
  cast(year(period_dt) as int) as year, cast(revenue as double) as revenue,
  cast(lag(revenue, 1) over w as double) as revenue_lag1, cast(lag(revenue, 2) over w as double) as revenue_lag2,
  cast(lag(revenue, 3) over w as double) as revenue_lag3
from m
window w as (partition by filial_id order by period_dt)
qualify lag(revenue, 3) over w is not null
""", "contract"))
def q_lag_frame(spark, sf_dir):
    c = fe.temporal_features(contract_frame(spark, sf_dir).select("filial_id", "period", "revenue"))
    lf, feats = fe.lag_frame(c)
    lags = [f for f in feats if "_lag" in f]
    return lf.select("filial_id", "period", "month", "quarter", "year", dbl("revenue").alias("revenue"),
                     *[dbl(x).alias(x) for x in lags])
