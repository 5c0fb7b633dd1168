"""Warehouse upkeep as registered jobs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl
from branchbook.operators import warehouse as wh
from branchbook.operators.joins import as_of_merge, point_in_time
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import cte, with_ctes
from branchbook.sources import fixtures as fx
from branchbook.session import stored
from branchbook.sources.star import star

# Fixed value: the change date used by the point-in-time example.
PIT_CHANGE_DATE = _dt.date(1998, 1, 1)


def load_day(spark, sf_dir) -> _dt.date:
    """The load date: the day after the last operation (one scalar)."""
    return star(spark, sf_dir).fact().agg(F.max("operation_date")).first()[0] + _dt.timedelta(days=1)


def load_time(spark, sf_dir) -> _dt.datetime:
    return _dt.datetime.combine(load_day(spark, sf_dir), _dt.time(6, 0))


def branch_versions(s):
    return wh.initial_versions(s.dim_filials().select(
        "filial_id", "filial_name", "region", F.lit(None).cast("string").alias("filial_type"),
        F.lit(True).alias("is_active")))


cte("branch_versions", """
select filial_id, filial_name, region, cast(null as varchar) as filial_type, true as is_active,
       date '1900-01-01' as valid_from, date '9999-12-31' as valid_to, true as is_current
from dim_filials
""", ("dim_filials",))


def _scd2_sql(as_of: str) -> str:
    return f"""
select filial_id, filial_name, region, filial_type, is_active, valid_from, valid_to, is_current
from branch_versions where not is_current
union all
select filial_id, filial_name, region, filial_type, is_active, valid_from, valid_to, is_current
from (select v.*, coalesce(v.filial_name <> s.filial_name, false) as chg
      from branch_versions v left join stg_filials s on v.filial_id = s.filial_id where v.is_current) where not chg
union all
select filial_id, filial_name, region, filial_type, is_active, valid_from, cast({as_of} - 1 as date), false
from (select v.*, coalesce(v.filial_name <> s.filial_name, false) as chg
      from branch_versions v left join stg_filials s on v.filial_id = s.filial_id where v.is_current)
where chg and valid_from <> {as_of}
union all
select v.filial_id, s.filial_name, v.region, v.filial_type, v.is_active, {as_of}, date '9999-12-31', true
from branch_versions v join stg_filials s on v.filial_id = s.filial_id
where v.is_current and coalesce(v.filial_name <> s.filial_name, false)
union all
select s.filial_id, s.filial_name, cast(null as varchar), cast(null as varchar), cast(null as boolean), {as_of},
       date '9999-12-31', true
from stg_filials s where s.filial_id not in (select filial_id from branch_versions where is_current)
"""


cte("load_day", "select cast(max(operation_date) + 1 as date) as d from fact_operations", ("fact_operations",))


@register("scd2_branches", "E1 J6 P5", with_ctes(_scd2_sql("(select d from load_day)"),
                                                 "branch_versions", "stg_filials", "load_day"))
def q_scd2_branches(spark, sf_dir):
    s = star(spark, sf_dir)
    return wh.scd_merge(branch_versions(s), fx.stg_filials(s), "filial_id", ["filial_name"], [], load_day(spark, sf_dir))


def product_versions(s):
    return wh.initial_versions(s.dim_products())


def stg_products(s):
    """Staged product dim: renamed accounts (type 1), moved directions (type 2),
    some accounts absent, one new account."""
    d = s.dim_products()
    changed = d.filter(F.col("inc_gk") % 17 != 0).select(
        "inc_gk",
        F.when(F.col("inc_gk") % 11 == 0, F.concat("inc_name", F.lit(" v2"))).otherwise(F.col("inc_name")).alias("inc_name"),
        "product", "subcategory",
        F.when(F.col("inc_gk") % 13 == 0, F.when(F.col("direction") == "DOM", "INT").otherwise("DOM"))
        .otherwise(F.col("direction")).alias("direction"),
    )
    first = d.agg(F.min("inc_gk").alias("g"))
    # the new account: -(smallest key + 1), i.e. -1 (a column expression, not a literal key)
    new = d.join(first, d.inc_gk == first.g).select(
        (-(F.col("inc_gk") + 1)).alias("inc_gk"), F.lit("NEW ACCOUNT").alias("inc_name"),
        "product", "subcategory", "direction")
    return changed.unionByName(new)


cte("product_versions", """
select *, date '1900-01-01' as valid_from, date '9999-12-31' as valid_to, true as is_current from dim_products
""", ("dim_products",))
cte("stg_products", """
select inc_gk, case when inc_gk % 11 = 0 then inc_name || ' v2' else inc_name end as inc_name, product, subcategory,
       case when inc_gk % 13 = 0 then case when direction = 'DOM' then 'INT' else 'DOM' end else direction end as direction
from dim_products where inc_gk % 17 <> 0
union all
select -(inc_gk + 1), 'NEW ACCOUNT', product, subcategory, direction
from dim_products where inc_gk = (select min(inc_gk) from dim_products)
""", ("dim_products",))


@register("scd1_overwrite", "E2 E1", with_ctes("""
with j as (select v.*, s.product as s_product, s.direction as s_direction,
             coalesce(v.product <> s.product, false) or coalesce(v.direction <> s.direction, false) as chg
           from product_versions v left join stg_products s on v.inc_gk = s.inc_gk where v.is_current),
allv as (
  select inc_gk, inc_name, product, subcategory, direction, valid_from, valid_to, is_current from product_versions where not is_current
  union all select inc_gk, inc_name, product, subcategory, direction, valid_from, valid_to, is_current from j where not chg
  union all select inc_gk, inc_name, product, subcategory, direction, valid_from, cast((select d from load_day) - 1 as date), false
            from j where chg and valid_from <> (select d from load_day)
  union all select inc_gk, inc_name, s_product, subcategory, s_direction, (select d from load_day), date '9999-12-31', true from j where chg
  union all select s.inc_gk, s.inc_name, s.product, s.subcategory, s.direction, (select d from load_day), date '9999-12-31', true
            from stg_products s where s.inc_gk not in (select inc_gk from product_versions where is_current))
select a.inc_gk, coalesce(s.inc_name, a.inc_name) as inc_name, a.product, a.subcategory, a.direction,
       a.valid_from, a.valid_to, a.is_current
from allv a left join stg_products s on a.inc_gk = s.inc_gk
""", "product_versions", "stg_products", "load_day"))
def q_scd1_overwrite(spark, sf_dir):
    s = star(spark, sf_dir)
    return wh.scd_merge(product_versions(s), stg_products(s), "inc_gk", ["product", "direction"], ["inc_name"],
                        load_day(spark, sf_dir))


# The days of the snapshots that come out of order, as they are loaded.
SNAPSHOT_DAYS = (_dt.date(1997, 6, 1), _dt.date(1995, 6, 1), _dt.date(1996, 6, 1), _dt.date(1995, 6, 1))
SNAPSHOT_RULES = {1995: 2, 1996: 3, 1997: 5}  # accounts of these multiples have moved to the other direction


def product_snapshot(s, day: _dt.date):
    """The product dim as exported on ``day``: moved directions, renamed accounts, some absent, some that exist since then only."""
    d, m = s.dim_products(), SNAPSHOT_RULES[day.year]
    flipped = F.when(F.col("direction") == "DOM", "INT").otherwise("DOM")
    rows = d.where(F.col("inc_gk") % (m + 14) != 0).select(
        "inc_gk", F.concat("inc_name", F.lit(f" {day.year}")).alias("inc_name"), "product", "subcategory",
        F.when(F.col("inc_gk") % m == 0, flipped).when(F.col("inc_gk") % 29 == 0, F.lit(None)).otherwise(F.col("direction")).alias("direction"))
    new = d.where(F.col("inc_gk") % 23 == m).select((-F.col("inc_gk") - 1).alias("inc_gk"), F.lit(f"NEW {day.year}").alias("inc_name"),
                                                   "product", "subcategory", "direction")
    return rows.unionByName(new)


def product_history(spark, sf_dir):
    """Versions of the accounts after all snapshots, in the order of SNAPSHOT_DAYS."""
    s = star(spark, sf_dir)
    v = wh.observed_versions(product_versions(s), "inc_gk")
    for day in SNAPSHOT_DAYS:
        v = stored(wh.scd_merge_any_order(v, product_snapshot(s, day), "inc_gk", ["direction"], ["inc_name"], day), "product-versions")
    return v.drop("observed")


def _snapshot_sql(year: int) -> str:
    m = SNAPSHOT_RULES[year]
    return f"""
select inc_gk, date '{year}-06-01' as day, inc_name || ' {year}' as inc_name, product, subcategory,
       case when inc_gk % {m} = 0 then case when direction = 'DOM' then 'INT' else 'DOM' end
            when inc_gk % 29 = 0 then null else direction end as direction
from dim_products where inc_gk % {m + 14} <> 0
union all
select -inc_gk - 1, date '{year}-06-01', 'NEW {year}', product, subcategory, direction from dim_products where inc_gk % 23 = {m}
"""


cte("product_history", """
with o as (select inc_gk, date '1900-01-01' as day, inc_name, product, subcategory, direction from dim_products
           union all """ + " union all ".join(f"({_snapshot_sql(y)})" for y in SNAPSHOT_RULES) + """),
f as (select inc_gk, day, product, subcategory, last_value(direction ignore nulls) over (partition by inc_gk order by day) as direction from o),
c as (select *, coalesce(direction <> lag(direction) over (partition by inc_gk order by day), row_number() over (partition by inc_gk order by day) = 1) as chg from f),
v as (select inc_gk, product, subcategory, direction, day as valid_from from c where chg),
n as (select inc_gk, arg_max(inc_name, day) as inc_name from o group by inc_gk)
select v.inc_gk, n.inc_name, product, subcategory, direction, valid_from,
       cast(coalesce(lead(valid_from) over (partition by v.inc_gk order by valid_from) - 1, date '9999-12-31') as date) as valid_to,
       lead(valid_from) over (partition by v.inc_gk order by valid_from) is null as is_current
from v join n on v.inc_gk = n.inc_gk
""", ("dim_products",))


@register("scd2_any_order", "E1 E2 J6", with_ctes("select * from product_history", "product_history"))
def q_scd2_any_order(spark, sf_dir):
    """Snapshots of three years loaded as 1997, 1995, 1996 and 1995 again."""
    return product_history(spark, sf_dir)


@register("pit_accounts", "J10 E1", with_ctes("""
select f.period, v.direction, cast(count(*) as bigint) as rows_cnt, cast(sum(f.summa) as double) as revenue
from fact_operations f left join product_history v
  on f.inc_gk = v.inc_gk and f.operation_date between v.valid_from and v.valid_to
group by f.period, v.direction
""", "fact_operations", "product_history"))
def q_pit_accounts(spark, sf_dir):
    """Every fact with its account's direction on that day, by the as-of merge."""
    fact = star(spark, sf_dir).fact().select("inc_gk", "operation_date", "period", "summa")
    versions = product_history(spark, sf_dir).select("inc_gk", "direction", "valid_from", "valid_to")
    j = as_of_merge(fact, versions, "inc_gk", "operation_date")
    return j.groupBy("period", "direction").agg(F.count(F.lit(1)).alias("rows_cnt"), dbl(F.sum("summa")).alias("revenue"))


@register("pit_join", "J10 E1", with_ctes(f"""
with v as ({_scd2_sql("date '1998-01-01'")})
select f.filial_id, v.filial_name, f.period, cast(sum(f.summa) as double) as revenue
from fact_operations f left join v
  on f.filial_id = v.filial_id and f.operation_date between v.valid_from and v.valid_to
group by f.filial_id, v.filial_name, f.period
""", "fact_operations", "branch_versions", "stg_filials"))
def q_pit_join(spark, sf_dir):
    s = star(spark, sf_dir)
    versions = wh.scd_merge(branch_versions(s), fx.stg_filials(s), "filial_id", ["filial_name"], [], PIT_CHANGE_DATE)
    bm = s.fact().groupBy("filial_id", "period", "operation_date").agg(F.sum("summa").alias("rev"))
    j = point_in_time(bm, versions.select("filial_id", "filial_name", "valid_from", "valid_to"), "filial_id",
                      "operation_date")
    return j.groupBy("filial_id", "filial_name", "period").agg(dbl(F.sum("rev")).alias("revenue"))


def loaded_fact(spark, sf_dir):
    return star(spark, sf_dir).fact().withColumn(
        "loaded_at", F.to_timestamp(F.concat(F.date_format("operation_date", "yyyy-MM-dd"), F.lit(" 06:00:00"))))


def upserted(spark, sf_dir):
    s = star(spark, sf_dir)
    first = fx.last_months(s, 2)
    return wh.upsert_facts(loaded_fact(spark, sf_dir), fx.stg_operations(s, first), load_time(spark, sf_dir))


cte("upserted", """
with t as (select *, cast(operation_date as timestamp) + interval 6 hour as loaded_at, 1 as m from fact_operations
           where period_idx in (select distinct period_idx from stg_operations)),
s as (select *, 1 as m from (
        select *, row_number() over (partition by operation_date, filial_id, inc_gk, sender_category
          order by period nulls first, period_idx nulls first, weight nulls first, cnt nulls first, summa nulls first) as rn
        from stg_operations)
      where rn = 1 or operation_date is null or filial_id is null or inc_gk is null or sender_category is null),
nw as (select cast(d as timestamp) + interval 6 hour as ts from load_day),
j as (select t.filial_id as t_f, t.inc_gk as t_g, t.operation_date as t_d, t.period as t_p, t.period_idx as t_pi,
             t.sender_category as t_c, t.weight as t_w, t.cnt as t_cnt, t.summa as t_s, t.loaded_at as t_l, t.m as tm,
             s.filial_id as s_f, s.inc_gk as s_g, s.operation_date as s_d, s.period as s_p, s.period_idx as s_pi,
             s.sender_category as s_c, s.weight as s_w, s.cnt as s_cnt, s.summa as s_s, s.m as sm
      from t full outer join s
        on t.operation_date is not distinct from s.operation_date and t.filial_id is not distinct from s.filial_id
       and t.inc_gk is not distinct from s.inc_gk and t.sender_category is not distinct from s.sender_category),
k as (select *, (tm is not null and sm is not null and coalesce(t_s <> s_s, false)) or (tm is null and sm is not null) as w
      from j)
select case when tm is not null then t_f else s_f end as filial_id,
       case when tm is not null then t_g else s_g end as inc_gk,
       case when tm is not null then t_d else s_d end as operation_date,
       case when tm is not null then t_p else s_p end as period,
       case when tm is not null then t_pi else s_pi end as period_idx,
       case when tm is not null then t_c else s_c end as sender_category,
       case when tm is not null then t_w else s_w end as weight,
       case when w then s_cnt else t_cnt end as cnt,
       case when w then s_s else t_s end as summa,
       case when w then (select ts from nw) else t_l end as loaded_at
from k
""", ("fact_operations", "stg_operations", "load_day"))


@register("fact_upsert", "E3 V3 S4", with_ctes("select * from upserted", "upserted"))
def q_fact_upsert(spark, sf_dir):
    return upserted(spark, sf_dir)


@register("kpi_refresh", "E4 A3 S6", with_ctes("""
select filial_id, period, period_idx, inc_gk, cast(sum(summa) as double) as revenue, cast(sum(cnt) as bigint) as operations,
       cast(sum(weight) as double) as total_weight
from upserted group by filial_id, period, period_idx, inc_gk
""", "upserted"))
def q_kpi_refresh(spark, sf_dir):
    s = star(spark, sf_dir)
    staged = fx.stg_operations(s, fx.last_months(s, 2))  # the touched months, without running the upsert twice
    k = wh.refresh_kpi(upserted(spark, sf_dir), staged.select("period_idx"))
    return k.select("filial_id", "period", "period_idx", "inc_gk", dbl("revenue").alias("revenue"), "operations",
                    dbl("total_weight").alias("total_weight"))


@register("kpi_delta", "E4 A3 S6", with_ctes("""
select filial_id, period, period_idx, inc_gk, cast(sum(summa) as double) as revenue, cast(sum(cnt) as bigint) as operations,
       cast(sum(weight) as double) as total_weight
from upserted group by filial_id, period, period_idx, inc_gk
""", "upserted"))
def q_kpi_delta(spark, sf_dir):
    """The stored aggregate of the touched months plus the signed changes of the upsert."""
    from branchbook.operators.aggregates import kpi_aggregate

    s = star(spark, sf_dir)
    staged = fx.stg_operations(s, fx.last_months(s, 2))
    traced = wh.upsert_facts(loaded_fact(spark, sf_dir), staged, load_time(spark, sf_dir), traced=True)
    k = wh.apply_kpi_delta(kpi_aggregate(loaded_fact(spark, sf_dir)), stored(wh.kpi_delta(traced), "kpi-delta"))
    return k.select(*wh.KPI_KEY, dbl("revenue").alias("revenue"), "operations", dbl("total_weight").alias("total_weight"))


@register("watermark", "E5", with_ctes("""
with cur as (
  select 'fact_operations' as table_name, max(cast(operation_date as timestamp) + interval 6 hour) as loaded_at,
         cast(count(*) as bigint) as rows_loaded from fact_operations
  union all
  select 'dim_filials', max(cast(operation_date as timestamp) + interval 6 hour), cast((select count(*) from dim_filials) as bigint)
  from fact_operations),
nw as (select 'fact_operations' as table_name, cast(d as timestamp) + interval 6 hour as loaded_at,
              cast((select count(*) from stg_operations) as bigint) as rows_loaded from load_day),
u as (select * from cur union all select * from nw)
select table_name, loaded_at, rows_loaded from u
qualify row_number() over (partition by table_name order by loaded_at desc) = 1
""", "fact_operations", "dim_filials", "stg_operations", "load_day"))
def q_watermark(spark, sf_dir):
    s = star(spark, sf_dir)
    lf = loaded_fact(spark, sf_dir)
    cur = lf.agg(F.lit("fact_operations").alias("table_name"), F.max("loaded_at").alias("loaded_at"),
                 F.count(F.lit(1)).alias("rows_loaded")).unionByName(
        lf.agg(F.max("loaded_at").alias("loaded_at")).select(
            F.lit("dim_filials").alias("table_name"), "loaded_at",
            s.dim_filials().agg(F.count(F.lit(1))).scalar().alias("rows_loaded")))
    stg = fx.stg_operations(s, fx.last_months(s, 2))
    new = stg.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        F.lit("fact_operations").alias("table_name"), F.lit(load_time(spark, sf_dir)).alias("loaded_at"), "rows_loaded")
    return wh.upsert_last_wins(cur, new, "table_name", "loaded_at").select("table_name", "loaded_at", "rows_loaded")


@register("adjusted_facts", "E6", with_ctes("""
with k as (select operation_date, filial_id, inc_gk, sender_category, period, sum(summa) as original_summa
           from fact_operations group by operation_date, filial_id, inc_gk, sender_category, period),
a as (select operation_date, filial_id, inc_gk, sender_category, arg_max(adjusted_summa, adjusted_at) as adjusted_summa
      from fact_adjustments group by operation_date, filial_id, inc_gk, sender_category)
select k.filial_id, k.period, cast(sum(original_summa) as double) as revenue_original,
       cast(sum(coalesce(a.adjusted_summa, k.original_summa)) as double) as revenue_current,
       cast(count(a.adjusted_summa) as bigint) as adjusted_keys
from k left join a on k.operation_date = a.operation_date and k.filial_id = a.filial_id and k.inc_gk = a.inc_gk
  and k.sender_category is not distinct from a.sender_category
group by k.filial_id, k.period
""", "fact_operations", "fact_adjustments"))
def q_adjusted_facts(spark, sf_dir):
    s = star(spark, sf_dir)
    key = wh.UPSERT_KEY + ["period"]
    adj = fx.fact_adjustments(s)
    per_key = s.fact().groupBy(*key).agg(F.sum("summa").alias("original_summa"))
    cur = wh.current_adjustments(adj)
    cond = [per_key[k].eqNullSafe(cur[k]) for k in wh.UPSERT_KEY]
    j = per_key.join(cur, cond, "left").select(per_key["filial_id"], per_key["period"], "original_summa",
                                              cur["adjusted_summa"])
    return j.groupBy("filial_id", "period").agg(
        dbl(F.sum("original_summa")).alias("revenue_original"),
        dbl(F.sum(F.coalesce("adjusted_summa", "original_summa"))).alias("revenue_current"),
        F.count("adjusted_summa").cast("bigint").alias("adjusted_keys"),
    )


@register("dim_date", "E7 F9", with_ctes("""
with r as (select min(operation_date) as lo, max(operation_date) as hi from fact_operations),
d as (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as date_id from r)
select date_id, cast(year(date_id) as int) as year, cast(quarter(date_id) as int) as quarter, cast(month(date_id) as int) as month,
  cast(weekofyear(date_id) as int) as week,
  case when month(date_id) in (12, 1, 2) then 'winter' when month(date_id) in (3, 4, 5) then 'spring'
       when month(date_id) in (6, 7, 8) then 'summer' else 'autumn' end as season,
  false as is_holiday
from d
""", "fact_operations"))
def q_dim_date(spark, sf_dir):
    r = star(spark, sf_dir).fact().agg(F.min("operation_date").alias("lo"), F.max("operation_date").alias("hi")).first()
    return wh.date_dimension(r["lo"], r["hi"], spark=spark)


# The (month, day) of the public holidays in the calendar example.
HOLIDAYS = ((1, 1), (1, 7), (2, 23), (3, 8), (5, 1), (5, 9), (6, 12), (11, 4))


@register("dim_date_holidays", "E7 F9", with_ctes("""
with r as (select min(operation_date) as lo, max(operation_date) as hi from fact_operations),
d as (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as date_id from r)
select date_id, cast(year(date_id) as int) as year, cast(quarter(date_id) as int) as quarter, cast(month(date_id) as int) as month,
  cast(weekofyear(date_id) as int) as week,
  case when month(date_id) in (12, 1, 2) then 'winter' when month(date_id) in (3, 4, 5) then 'spring'
       when month(date_id) in (6, 7, 8) then 'summer' else 'autumn' end as season,
  month(date_id) * 100 + day(date_id) in (""" + ", ".join(str(100 * m + d) for m, d in HOLIDAYS) + """) as is_holiday
from d
""", "fact_operations"))
def q_dim_date_holidays(spark, sf_dir):
    """The calendar with the public holidays of its years; holidays outside it and repeated ones change nothing."""
    r = star(spark, sf_dir).fact().agg(F.min("operation_date").alias("lo"), F.max("operation_date").alias("hi")).first()
    years = range(r["lo"].year - 1, r["hi"].year + 2)
    days = [(_dt.date(y, m, d),) for y in years for m, d in HOLIDAYS]
    return wh.date_dimension(r["lo"], r["hi"], spark.createDataFrame(days + days[:3], "date_id date"), spark=spark)


@register("full_load", "E8 S3 S4 S5 S6 V9 V10 E1 E3 E4 E5", with_ctes("""
with raw as (select * from raw_operations union all select * from raw_operations where INC_GK % 97 = 0),
f as (select distinct * from raw),
k as (select *, row_number() over (partition by DATA, INC_GK, FILIAL, SNDRCTG
        order by PERIOD nulls first, WEIGHT nulls first, CNT nulls first, SUMMA nulls first) as rn from f)
select PERIOD as period, cast(count(*) as bigint) as rows_cnt, cast(sum(SUMMA) as double) as revenue
from k where rn = 1 group by PERIOD
""", "raw_operations"))
def q_full_load(spark, sf_dir):
    """The monthly job on an empty warehouse; returns the loaded fact by month."""
    from branchbook.sources.warehouse import monthly_load, new_root

    s = star(spark, sf_dir)
    raw = stored(fx.raw_operations(s), "landed")  # lands as a file, which gate and staging read
    landed = raw.unionByName(raw.filter(F.col("INC_GK") % fx.DUP_MOD == 0))
    root = new_root(spark, "full_load")
    day = load_day(spark, sf_dir)
    monthly_load(spark, root, landed, fx.stg_filials(s), s.dim_products(), day,
                 _dt.datetime.combine(day, _dt.time(6, 0)))
    fact = spark.read.parquet(f"{root}/fact_operations")
    return fact.groupBy("period").agg(F.count(F.lit(1)).alias("rows_cnt"), dbl(F.sum("summa")).alias("revenue"))


_TWO_LOADS = """
with m as (select max(period_idx) as hi from fact_operations),
r as (select *, cast(split_part(PERIOD, '_', 1) as int) * 12 + cast(split_part(PERIOD, '_', 2) as int) as pidx from raw_operations),
one as (select * exclude (rn) from (
  select *, row_number() over (partition by DATA, INC_GK, FILIAL, SNDRCTG order by WEIGHT, CNT, SUMMA) as rn
  from (select distinct r.* from r, m where pidx < hi)) where rn = 1),
two as (select * exclude (rn) from (
  select *, row_number() over (partition by DATA, INC_GK, FILIAL, SNDRCTG order by WEIGHT, CNT, SUMMA) as rn
  from (select distinct DATA, INC_GK, INC_NAME, WEIGHT, CNT, SUMMA + case when INC_GK % 5 = 0 then 1.00 else 0.00 end as SUMMA, FILIAL, PERIOD, SNDRCTG, pidx
        from r, m where pidx >= hi - 1)) where rn = 1),
fin as (
  select coalesce(o.FILIAL, t.FILIAL) as filial_id, coalesce(o.PERIOD, t.PERIOD) as period, coalesce(o.WEIGHT, t.WEIGHT) as weight,
         case when o.FILIAL is null or coalesce(t.SUMMA <> o.SUMMA, false) then t.CNT else o.CNT end as cnt,
         case when o.FILIAL is null or coalesce(t.SUMMA <> o.SUMMA, false) then t.SUMMA else o.SUMMA end as summa,
         o.FILIAL is null or coalesce(t.SUMMA <> o.SUMMA, false) as second
  from one o full outer join two t on o.DATA = t.DATA and o.INC_GK = t.INC_GK and o.FILIAL = t.FILIAL and o.SNDRCTG = t.SNDRCTG)
select filial_id, period, cast(sum(summa) as double) as revenue, cast(sum(cnt) as bigint) as operations, cast(sum(weight) as double) as total_weight,
       cast(count(*) as bigint) as fact_rows, cast(count(*) filter (where second) as bigint) as second_load_rows
from fin group by filial_id, period
"""


@register("second_load", "E8 E3 E4 E5 S3 S4 S5 S6", with_ctes(_TWO_LOADS, "fact_operations", "raw_operations"))
def q_second_load(spark, sf_dir):
    """The monthly job twice: all months but the last, then the last two with changed values.

    Revenue, operations and weight come from the KPI aggregate, which the second load keeps
    up by signed changes; the rows from the fact.
    """
    from branchbook.sources.warehouse import monthly_load, new_root

    s = star(spark, sf_dir)
    raw = stored(fx.raw_operations(s), "landed")  # lands as a file, which gates and stagings read
    last = fx.last_months(s, 1)
    pidx = F.split("PERIOD", "_")[0].cast("int") * 12 + F.split("PERIOD", "_")[1].cast("int")
    first = raw.filter(pidx < last)
    second = raw.filter(pidx >= last - 1).withColumn(
        "SUMMA", (F.col("SUMMA") + F.when(F.col("INC_GK") % 5 == 0, F.lit("1.00")).otherwise(F.lit("0.00")).cast("decimal(18,2)")).cast("decimal(18,2)"))
    root = new_root(spark, "second_load")
    day = load_day(spark, sf_dir)
    one, two = (_dt.datetime.combine(day, _dt.time(h, 0)) for h in (5, 6))
    for landed, now in ((first, one), (second, two)):
        monthly_load(spark, root, landed, fx.stg_filials(s), s.dim_products(), day, now, min_rows=1)
    kpi = spark.read.parquet(f"{root}/mv_filial_monthly_kpi").groupBy("filial_id", "period").agg(
        dbl(F.sum("revenue")).alias("revenue"), F.sum("operations").alias("operations"), dbl(F.sum("total_weight")).alias("total_weight"))
    rows = spark.read.parquet(f"{root}/fact_operations").groupBy("filial_id", "period").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col("loaded_at") == F.lit(two)).alias("second_load_rows"))
    return kpi.join(rows, ["filial_id", "period"])


@register("raw_csv_load", "S1 S2 F1 F2", with_ctes("""
select PERIOD as period, cast(split_part(PERIOD, '_', 2) as int) as month_num, cast(count(*) as bigint) as rows_cnt,
       cast(sum(SUMMA) as double) as revenue,
       min(strptime(DATA, '%d.%m.%y')::date) as first_date, max(strptime(DATA, '%d.%m.%y')::date) as last_date
from raw_operations group by PERIOD
""", "raw_operations"))
def q_raw_csv_load(spark, sf_dir):
    """The raw operations as the source system exports them (CSV with a header),
    read back by suffix with the explicit schema, dates parsed from dd.MM.yy."""
    from branchbook.functions.periods import month_of_raw_period
    from branchbook.sources.warehouse import RAW_SCHEMA, new_root, raw_to_fact, read_table

    path = f"{new_root(spark, 'raw_csv')}/opdata.csv"
    fx.raw_operations(star(spark, sf_dir)).write.option("header", True).csv(path)
    raw = read_table(spark, path, RAW_SCHEMA)
    f = raw_to_fact(raw)
    return f.groupBy("period").agg(
        month_of_raw_period(F.first("period")).alias("month_num"),
        F.count(F.lit(1)).alias("rows_cnt"),
        dbl(F.sum("summa")).alias("revenue"),
        F.min("operation_date").alias("first_date"),
        F.max("operation_date").alias("last_date"),
    )
