"""Derived inputs of the reference's other jobs, built from the star schema.

The driver tables hold no nulls, duplicates or rule breaks, so the quality and
warehouse jobs get inputs with faults injected by fixed rules over the whole
table (every row is read; the rules only decide which rows carry a fault).
Each builder has a twin CTE (registered with ``cte``) so DuckDB derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.plans.oracle_base import cte
from branchbook.sources.star import Star

# Fault-injection rules (see FIXTURES.md).
DUP_MOD = 97  # rows whose account % 97 = 0 are loaded twice
NULL_MOD = 89  # account % 89 = 0/1/2 blanks branch / period / revenue
ZERO_MOD = 61  # account % 61 = 0 has zero revenue
NEG_MOD = 83  # negative revenue
BAD_PERIOD_MOD = 79  # period text '06-2023'
EMPTY_NAME_MOD = 67  # empty branch name
NULL_REGION_MOD = 53  # region missing (allowed by the contract)
OUTLIER_MOD = 500  # revenue x 50
OUTLIER_FACTOR = 50
BAD_PERIOD_TEXT = "06-2023"
ORPHAN_BRANCH = 3  # dropped from one copy of the branch dim
ORPHAN_PART_MOD = 50  # parts with partkey % 50 = 0 dropped from one copy of the product dim
NEW_ACCOUNT = -1  # account that exists only in the staged operations
NEW_BRANCH = 999  # branch that exists only in the staged branch dim
RENAME_MOD = 7  # staged branch names change where filial_id % 7 = 0
ADJUST_MOD = 100  # facts with account % 100 = 0 carry adjustments
PLAN_FACTOR = 1.05


def _twice(rows: DataFrame, which: Column) -> DataFrame:
    """The rows, and those of ``which`` once more, in one pass over them."""
    copies = F.when(which, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", F.explode(copies).alias("__copy")).drop("__copy")


# -- raw operations (source file layout) -------------------------------------
def raw_operations(s: Star) -> DataFrame:
    """Facts in the raw layout: DATA as dd.MM.yy text, PERIOD as YYYY_M."""
    f = s.fact()
    names = s.dim_products().select("inc_gk", "inc_name")
    from branchbook.operators.joins import checked_broadcast

    return f.join(checked_broadcast(names), "inc_gk", "left").select(
        F.date_format("operation_date", "dd.MM.yy").alias("DATA"),
        F.col("inc_gk").alias("INC_GK"),
        F.col("inc_name").alias("INC_NAME"),
        F.col("weight").alias("WEIGHT"),
        F.col("cnt").alias("CNT"),
        F.col("summa").alias("SUMMA"),
        F.col("filial_id").alias("FILIAL"),
        F.col("period").alias("PERIOD"),
        F.col("sender_category").alias("SNDRCTG"),
    )


cte("raw_operations", """
select strftime(f.operation_date, '%d.%m.%y') as DATA, f.inc_gk as INC_GK, p.inc_name as INC_NAME,
       f.weight as WEIGHT, f.cnt as CNT, f.summa as SUMMA, f.filial_id as FILIAL, f.period as PERIOD,
       f.sender_category as SNDRCTG
from fact_operations f left join dim_products p on f.inc_gk = p.inc_gk
""", ("fact_operations", "dim_products"))


def faulty_operations(s: Star) -> DataFrame:
    """Raw operations with duplicates, blanks, zero and negative revenue injected."""
    r = raw_operations(s)
    g = F.col("INC_GK")
    r = r.select(
        "DATA", "INC_GK", "INC_NAME", "WEIGHT", "CNT",
        F.when(g % NULL_MOD == 2, F.lit(None))
        .when(g % ZERO_MOD == 0, F.lit(0).cast("decimal(18,2)"))
        .when(g % NEG_MOD == 0, -F.col("SUMMA"))
        .otherwise(F.col("SUMMA")).alias("SUMMA"),
        F.when(g % NULL_MOD == 0, F.lit(None)).otherwise(F.col("FILIAL")).alias("FILIAL"),
        F.when(g % NULL_MOD == 1, F.lit(None)).otherwise(F.col("PERIOD")).alias("PERIOD"),
        "SNDRCTG",
    )
    return _twice(r, g % DUP_MOD == 0)


cte("faulty_ops_base", """
select DATA, INC_GK, INC_NAME, WEIGHT, CNT,
  case when INC_GK % 89 = 2 then null when INC_GK % 61 = 0 then cast(0 as decimal(18,2))
       when INC_GK % 83 = 0 then -SUMMA else SUMMA end as SUMMA,
  case when INC_GK % 89 = 0 then null else FILIAL end as FILIAL,
  case when INC_GK % 89 = 1 then null else PERIOD end as PERIOD,
  SNDRCTG
from raw_operations
""", ("raw_operations",))
cte("faulty_operations", """
select * from faulty_ops_base union all select * from faulty_ops_base where INC_GK % 97 = 0
""", ("faulty_ops_base",))


# -- validated monthly records (the row contract's input) --------------------
def revenue_records(s: Star) -> DataFrame:
    """Branch x product x month sums with period as yyyy-MM and the branch region."""
    from branchbook.operators.joins import checked_broadcast

    f = s.fact().select("filial_id", "inc_gk", "period_idx", "operation_date", "summa", "cnt")
    per_acct = f.groupBy("filial_id", "inc_gk", "period_idx").agg(
        F.sum("summa").alias("revenue"), F.sum("cnt").alias("ops"), F.min("operation_date").alias("d0")
    )
    prod = checked_broadcast(s.dim_products().select("inc_gk", "product"))
    g = per_acct.join(prod, "inc_gk").groupBy("filial_id", "product", "period_idx").agg(
        F.sum("revenue").alias("revenue"), F.sum("ops").alias("ops"), F.min("d0").alias("d0")
    )
    return g.join(F.broadcast(s.dim_filials()), "filial_id").select(
        "filial_id",
        "filial_name",
        F.col("product").alias("service_type"),
        F.date_format("d0", "yyyy-MM").alias("period"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("ops").cast("bigint").alias("operations_count"),
        "region",
        (F.col("period_idx") * 31 + F.col("filial_id")).cast("bigint").alias("rid"),
    )


cte("revenue_records", """
select g.filial_id, d.filial_name, g.product as service_type, strftime(g.d0, '%Y-%m') as period,
       cast(g.revenue as double) as revenue, cast(g.ops as bigint) as operations_count, d.region,
       cast(g.period_idx * 31 + g.filial_id as bigint) as rid
from (select f.filial_id, p.product, f.period_idx, sum(f.summa) as revenue, sum(f.cnt) as ops,
             min(f.operation_date) as d0
      from fact_operations f join dim_products p on f.inc_gk = p.inc_gk
      group by f.filial_id, p.product, f.period_idx) g
join dim_filials d on g.filial_id = d.filial_id
""", ("fact_operations", "dim_products", "dim_filials"))


def faulty_records(s: Star) -> DataFrame:
    """Monthly records with rule breaks, blanks, outliers and duplicates injected.

    Branch 0 (the nation with key 0) breaks the ``filial_id > 0`` rule by itself.
    """
    r = revenue_records(s)
    rid = F.col("rid")
    r = r.select(
        "filial_id",
        F.when(rid % EMPTY_NAME_MOD == 0, F.lit("")).otherwise(F.col("filial_name")).alias("filial_name"),
        "service_type",
        F.when(rid % BAD_PERIOD_MOD == 0, F.lit(BAD_PERIOD_TEXT)).otherwise(F.col("period")).alias("period"),
        F.when(rid % NULL_MOD == 0, F.lit(None).cast("double"))
        .when(rid % NEG_MOD == 0, -F.col("revenue"))
        .when(rid % OUTLIER_MOD == 0, F.col("revenue") * OUTLIER_FACTOR)
        .otherwise(F.col("revenue")).alias("revenue"),
        "operations_count",
        F.when(rid % NULL_REGION_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("region")).alias("region"),
        "rid",
    )
    return _twice(r, rid % DUP_MOD == 0)


cte("faulty_rec_base", """
select filial_id,
  case when rid % 67 = 0 then '' else filial_name end as filial_name,
  service_type,
  case when rid % 79 = 0 then '06-2023' else period end as period,
  case when rid % 89 = 0 then cast(null as double) when rid % 83 = 0 then -revenue
       when rid % 500 = 0 then revenue * 50 else revenue end as revenue,
  operations_count,
  case when rid % 53 = 0 then cast(null as varchar) else region end as region,
  rid
from revenue_records
""", ("revenue_records",))
cte("faulty_records", """
select * from faulty_rec_base union all select * from faulty_rec_base where rid % 97 = 0
""", ("faulty_rec_base",))


# -- dimension copies with orphans -------------------------------------------
def filials_missing_one(s: Star) -> DataFrame:
    return s.dim_filials().filter(F.col("filial_id") != ORPHAN_BRANCH)


cte("filials_missing_one", "select * from dim_filials where filial_id <> 3", ("dim_filials",))


def products_missing_some(s: Star) -> DataFrame:
    return s.dim_products().filter(F.col("inc_gk") % ORPHAN_PART_MOD != 0)


cte("products_missing_some", "select * from dim_products where inc_gk % 50 <> 0", ("dim_products",))


# -- plan -----------------------------------------------------------------------
def dim_plan(s: Star) -> DataFrame:
    """Per period: 1.05 x revenue of the previous month; the first month has no plan."""
    per = s.fact().groupBy("period", "period_idx").agg(F.sum("summa").alias("rev"))
    w = Window.orderBy("period_idx")  # one row per month: small by construction
    return per.withColumn("prev", F.lag("rev").over(w)).filter(F.col("prev").isNotNull()).select(
        "period",
        "period_idx",
        (F.col("prev") * F.lit(PLAN_FACTOR).cast("decimal(3,2)")).cast("decimal(18,2)").alias("planned_summa"),
    )


cte("dim_plan", """
select period, period_idx, cast(prev * cast(1.05 as decimal(3,2)) as decimal(18,2)) as planned_summa
from (select period, period_idx, lag(rev) over (order by period_idx) as prev
      from (select period, period_idx, sum(summa) as rev from fact_operations group by period, period_idx))
where prev is not null
""", ("fact_operations",))


# -- staging for the warehouse jobs ------------------------------------------
def stg_filials(s: Star) -> DataFrame:
    """Staged branch names: ' (new)' appended where filial_id % 7 = 0, plus branch 999."""
    d = s.dim_filials()
    renamed = d.select(
        F.col("filial_id"),
        F.when(F.col("filial_id") % RENAME_MOD == 0, F.concat("filial_name", F.lit(" (new)")))
        .otherwise(F.col("filial_name")).alias("filial_name"),
    )
    # derived from branch 0's row (0 + 999), so the key stays a column expression
    extra = d.filter(F.col("filial_id") == 0).select(
        (F.col("filial_id") + F.lit(NEW_BRANCH)).cast("int").alias("filial_id"),
        F.lit(f"NATION_{NEW_BRANCH}").alias("filial_name"),
    )
    return renamed.unionByName(extra)


cte("stg_filials", """
select filial_id, case when filial_id % 7 = 0 then filial_name || ' (new)' else filial_name end as filial_name
from dim_filials
union all
select cast(999 as int) as filial_id, 'NATION_999' as filial_name from dim_filials where filial_id = 0
""", ("dim_filials",))


def last_months(s: Star, n: int = 2) -> int:
    """First period_idx of the last ``n`` months (one scalar)."""
    return int(s.fact().agg(F.max("period_idx")).first()[0]) - n + 1


def stg_operations(s: Star, first_idx: int) -> DataFrame:
    """Staged facts: the last two months, summa + 1.00 on even accounts, plus a new account."""
    f = s.fact().filter(F.col("period_idx") >= F.lit(first_idx))
    changed = f.withColumn(
        "summa",
        F.when(F.col("inc_gk") % 2 == 0, (F.col("summa") + F.lit(1).cast("decimal(18,2)")).cast("decimal(18,2)"))
        .otherwise(F.col("summa")),
    )
    new_acct = f.filter(F.col("inc_gk") % DUP_MOD == 0).withColumn("inc_gk", F.lit(NEW_ACCOUNT).cast("bigint"))
    return changed.unionByName(new_acct)


cte("stg_operations", """
select filial_id, inc_gk, operation_date, period, period_idx, sender_category, weight, cnt,
  case when inc_gk % 2 = 0 then cast(summa + 1 as decimal(18,2)) else summa end as summa
from fact_operations where period_idx >= (select max(period_idx) - 1 from fact_operations)
union all
select filial_id, cast(-1 as bigint) as inc_gk, operation_date, period, period_idx, sender_category, weight, cnt, summa
from fact_operations where period_idx >= (select max(period_idx) - 1 from fact_operations) and inc_gk % 97 = 0
""", ("fact_operations",))


def fact_adjustments(s: Star) -> DataFrame:
    """Two adjustment versions (0.95x then 0.9x) for facts with account % 100 = 0."""
    f = s.fact().filter(F.col("inc_gk") % ADJUST_MOD == 0)
    key = ["operation_date", "filial_id", "inc_gk", "sender_category"]
    base = f.groupBy(*key).agg(F.sum("summa").alias("original_summa"))
    v1 = base.select(*key, "original_summa",
                     (F.col("original_summa") * F.lit(0.95).cast("decimal(3,2)")).cast("decimal(18,2)").alias("adjusted_summa"),
                     F.lit("R1").alias("reason_code"),
                     (F.col("operation_date").cast("timestamp") + F.expr("interval 1 day")).alias("adjusted_at"))
    v2 = base.select(*key, "original_summa",
                     (F.col("original_summa") * F.lit(0.9).cast("decimal(3,2)")).cast("decimal(18,2)").alias("adjusted_summa"),
                     F.lit("R2").alias("reason_code"),
                     (F.col("operation_date").cast("timestamp") + F.expr("interval 2 day")).alias("adjusted_at"))
    return v1.unionByName(v2)


cte("fact_adjustments", """
with base as (
  select operation_date, filial_id, inc_gk, sender_category, sum(summa) as original_summa
  from fact_operations where inc_gk % 100 = 0
  group by operation_date, filial_id, inc_gk, sender_category)
select operation_date, filial_id, inc_gk, sender_category, original_summa,
  cast(original_summa * cast(0.95 as decimal(3,2)) as decimal(18,2)) as adjusted_summa, 'R1' as reason_code,
  cast(operation_date as timestamp) + interval 1 day as adjusted_at
from base
union all
select operation_date, filial_id, inc_gk, sender_category, original_summa,
  cast(original_summa * cast(0.9 as decimal(3,2)) as decimal(18,2)), 'R2',
  cast(operation_date as timestamp) + interval 2 day
from base
""", ("fact_operations",))


def user_grants(s: Star) -> DataFrame:
    """User ``u<region>`` may see the branches of that region."""
    return s.dim_filials().select(F.concat(F.lit("u"), F.col("region")).alias("user_name"), "filial_id")


cte("user_grants", "select 'u' || region as user_name, filial_id from dim_filials", ("dim_filials",))
