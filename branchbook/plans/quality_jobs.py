"""Dedup, validation and quality gates on inputs with injected faults."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from branchbook.operators import quality as q
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import with_ctes
from branchbook.sources import fixtures as fx
from branchbook.session import stored
from branchbook.sources.star import star

RAW_KEY = ["DATA", "INC_GK", "FILIAL", "PERIOD", "SNDRCTG"]
RAW_REST = ["INC_NAME", "WEIGHT", "CNT", "SUMMA"]


@register("dedup_exact", "V1", with_ctes("select distinct * from faulty_operations", "faulty_operations"))
def q_dedup_exact(spark, sf_dir):
    s = star(spark, sf_dir)
    return q.dedup_exact(fx.faulty_operations(s), s.fact().count())  # and the few loaded twice


@register("dup_stats", "V2", with_ctes("""
select cast(count(*) as bigint) as total_rows,
  cast(count(*) - (select count(*) from (select distinct * from faulty_operations)) as bigint) as duplicate_rows,
  round(100.0 * cast(count(*) - (select count(*) from (select distinct * from faulty_operations)) as double)
        / cast(count(*) as double), 2) + 0.0 as duplicate_pct
from faulty_operations
""", "faulty_operations"))
def q_dup_stats(spark, sf_dir):
    return q.duplicate_stats(fx.faulty_operations(star(spark, sf_dir)))


@register("dedup_keyed", "V3 P5", with_ctes("""
select DATA, INC_GK, INC_NAME, WEIGHT, CNT, SUMMA, FILIAL, PERIOD, SNDRCTG from (
  select *, row_number() over (partition by DATA, INC_GK, FILIAL, PERIOD, SNDRCTG
    order by INC_NAME nulls first, WEIGHT nulls first, CNT nulls first, SUMMA nulls first) as rn
  from faulty_operations)
where rn = 1 or DATA is null or INC_GK is null or FILIAL is null or PERIOD is null or SNDRCTG is null
""", "faulty_operations"))
def q_dedup_keyed(spark, sf_dir):
    return q.dedup_keyed(fx.faulty_operations(star(spark, sf_dir)), RAW_KEY, RAW_REST)


_RULES_SQL = """
concat_ws(',',
  case when not coalesce(filial_id > 0, false) then 'filial_id' end,
  case when not coalesce(length(filial_name) >= 1, false) then 'filial_name' end,
  case when not coalesce(length(service_type) >= 1, false) then 'service_type' end,
  case when not coalesce(regexp_matches(period, '^\\d{4}-(0?[1-9]|1[0-2])$'), false) then 'period' end,
  case when not coalesce(not isnan(revenue) and revenue >= 0, false) then 'revenue' end,
  case when not coalesce(operations_count >= 0, false) then 'operations_count' end)
"""

_DEDUP_RECORDS = "dedup_rec as (select distinct * from faulty_records), " \
                 f"checked_rec as (select *, {_RULES_SQL} as errors from dedup_rec), " \
                 "valid_rec as (select * exclude (errors) from checked_rec where errors = ''), " \
                 "bad_rec as (select * from checked_rec where errors <> '')"


@register("rule_violations", "V4", with_ctes(f"""
with {_DEDUP_RECORDS}
select rid, filial_id, service_type, period, errors from bad_rec
""", "faulty_records"))
def q_rule_violations(spark, sf_dir):
    _, bad = q.split_valid(fx.faulty_records(star(spark, sf_dir)).dropDuplicates())
    return bad.select("rid", "filial_id", "service_type", "period", F.array_join("errors", ",").alias("errors"))


_RAW_COLS = ["DATA", "INC_GK", "INC_NAME", "WEIGHT", "CNT", "SUMMA", "FILIAL", "PERIOD", "SNDRCTG"]


@register("null_counts", "V5", with_ctes(" union all ".join(
    f"select '{c}' as column_name, cast(count(*) - count({c}) as bigint) as null_count from faulty_operations"
    for c in _RAW_COLS), "faulty_operations"))
def q_null_counts(spark, sf_dir):
    return q.null_counts(fx.faulty_operations(star(spark, sf_dir)))


_PROFILE_COLS = ["filial_id", "revenue", "operations_count"]


def _profile_sql(c: str) -> str:
    x = f"cast({c} as double)"
    return (f"select '{c}' as column_name, round(min({x}), 6) + 0.0 as min, round(max({x}), 6) + 0.0 as max, "
            f"round(avg({x}), 6) + 0.0 as mean, round(quantile_cont({x}, 0.5), 6) + 0.0 as median, "
            f"round(stddev_samp({x}), 6) + 0.0 as std, round(quantile_cont({x}, 0.25), 6) + 0.0 as q25, "
            f"round(quantile_cont({x}, 0.75), 6) + 0.0 as q75 from valid_rec")


@register("numeric_profile", "V6", with_ctes(
    f"with {_DEDUP_RECORDS} " + " union all ".join(_profile_sql(c) for c in _PROFILE_COLS), "faulty_records"))
def q_numeric_profile(spark, sf_dir):
    valid, _ = q.split_valid(fx.faulty_records(star(spark, sf_dir)).dropDuplicates())
    return q.numeric_profile(valid, _PROFILE_COLS)


@register("zscore_outliers", "V7 M6", with_ctes(f"""
with {_DEDUP_RECORDS},
st as (select avg(coalesce(revenue, 0)) as mu, stddev_pop(coalesce(revenue, 0)) as sd from valid_rec)
select rid, filial_id, service_type, period, revenue,
  round((coalesce(revenue, 0) - mu) / nullif(sd, 0), 4) + 0.0 as z
from valid_rec, st
where abs((coalesce(revenue, 0) - mu) / nullif(sd, 0)) > 3
""", "faulty_records"))
def q_zscore_outliers(spark, sf_dir):
    valid, _ = q.split_valid(fx.faulty_records(star(spark, sf_dir)).dropDuplicates())
    # mean and outliers both read the valid records: the facts are aggregated once for both
    return q.zscore_outliers(stored(valid, "valid-records"), "revenue").select(
        "rid", "filial_id", "service_type", "period", "revenue", (F.round("z", 4) + F.lit(0.0)).alias("z")
    )


@register("dataset_profile", "V8 A7", with_ctes("""
select cast(count(*) as bigint) as total_rows,
  (select string_agg(PERIOD, ',' order by pidx) from (
     select distinct PERIOD, cast(split_part(PERIOD, '_', 1) as int) * 12 + cast(split_part(PERIOD, '_', 2) as int) as pidx
     from faulty_operations where PERIOD is not null)) as periods,
  cast(count(distinct FILIAL) as bigint) as unique_filials,
  cast(count(distinct INC_GK) as bigint) as unique_products,
  round(min(cast(SUMMA as double)), 2) + 0.0 as summa_min,
  round(max(cast(SUMMA as double)), 2) + 0.0 as summa_max,
  round(avg(cast(SUMMA as double)), 4) + 0.0 as summa_mean,
  round(stddev_samp(cast(SUMMA as double)), 4) + 0.0 as summa_std,
  cast(count(*) * 9 - count(DATA) - count(INC_GK) - count(INC_NAME) - count(WEIGHT) - count(CNT) - count(SUMMA)
       - count(FILIAL) - count(PERIOD) - count(SNDRCTG) as bigint) as missing_cells,
  round(quantile_cont(cast(SUMMA as double), 0.5), 4) + 0.0 as summa_median,
""" + ", ".join(f"cast(count(*) - count({c}) as bigint) as missing_{c}" for c in _RAW_COLS) + """
from faulty_operations
""", "faulty_operations"))
def q_dataset_profile(spark, sf_dir):
    return q.dataset_profile(fx.faulty_operations(star(spark, sf_dir)))


@register("preload_checks", "V9", with_ctes("""
with a as (
  select count(*) as n,
    count(*) * 4 - count(INC_GK) - count(SUMMA) - count(FILIAL) - count(PERIOD) as key_nulls,
    count(*) filter (where SUMMA < 0) as neg,
    count(*) - (select count(*) from (select distinct * from faulty_operations)) as dups
  from faulty_operations)
select 'row_count' as check_name, cast(n as double) as value, 10000.0 as threshold, 'error' as severity, n >= 10000 as passed from a
union all select 'missing_columns', 0.0, 0.0, 'error', true from a
union all select 'key_nulls', cast(key_nulls as double), 0.0, 'error', key_nulls = 0 from a
union all select 'negative_summa', cast(neg as double), 0.0, 'error', neg = 0 from a
union all select 'duplicate_pct', round(100.0 * cast(dups as double) / cast(n as double), 2) + 0.0, 1.0, 'warning',
  round(100.0 * cast(dups as double) / cast(n as double), 2) <= 1.0 from a
""", "faulty_operations"))
def q_preload_checks(spark, sf_dir):
    return q.preload_checks(fx.faulty_operations(star(spark, sf_dir)))


def loaded_fact(spark, sf_dir):
    """The fact as loaded by the monthly job: loaded_at = 06:00 of the operation day."""
    return star(spark, sf_dir).fact().withColumn(
        "loaded_at", F.to_timestamp(F.concat(F.date_format("operation_date", "yyyy-MM-dd"), F.lit(" 06:00:00")))
    )


@register("postload_checks", "V10 J4 F7", with_ctes("""
with f as (select *, cast(operation_date as timestamp) + interval 6 hour as loaded_at from fact_operations),
ob as (select count(*) as v from f where not exists (select 1 from filials_missing_one d where d.filial_id = f.filial_id)),
op as (select count(*) as v from f where not exists (select 1 from products_missing_some d where d.inc_gk = f.inc_gk)),
z as (select count(*) filter (where summa = 0) as zero, max(loaded_at) as last_load,
             cast(max(operation_date) + interval 1 day as timestamp) as as_of from f)
select 'orphaned_filials' as check_name, cast(v as double) as value, 0.0 as threshold, 'error' as severity, v = 0 as passed from ob
union all select 'orphaned_products', cast(v as double), 100.0, 'error', v <= 100 from op
union all select 'zero_revenue_rows', cast(zero as double), cast(null as double), 'info', true from z
union all select 'freshness_hours', round(date_diff('second', last_load, as_of) / 3600.0, 4) + 0.0, cast(null as double), 'info', true from z
""", "fact_operations", "filials_missing_one", "products_missing_some"))
def q_postload_checks(spark, sf_dir):
    s = star(spark, sf_dir)
    fact = loaded_fact(spark, sf_dir)
    last = s.fact().agg(F.max("operation_date")).first()[0]
    as_of = _dt.datetime.combine(last + _dt.timedelta(days=1), _dt.time())
    return q.postload_checks(fact, fx.filials_missing_one(s), fx.products_missing_some(s), as_of)


@register("quality_report", "V11 K6", with_ctes(f"""
with {_DEDUP_RECORDS},
st as (select avg(coalesce(revenue, 0)) as mu, stddev_pop(coalesce(revenue, 0)) as sd from valid_rec)
select (select cast(count(*) as bigint) from faulty_records) as total_rows,
  (select cast(count(*) as bigint) from valid_rec) as valid_rows,
  (select cast(count(*) as bigint) from faulty_records) - (select cast(count(*) as bigint) from dedup_rec) as duplicate_rows,
  (select cast(count(*) * 7 - count(filial_id) - count(filial_name) - count(service_type) - count(period)
          - count(revenue) - count(operations_count) - count(region) as bigint) from dedup_rec) as missing_cells,
  {', '.join(f'(select cast(count(*) - count({c}) as bigint) from dedup_rec) as missing_{c}' for c in q.RECORD_FIELDS)},
  {', '.join(f'(select round({fn}(cast({c} as double)), 6) + 0.0 from valid_rec) as {c}_{k}' for c in _PROFILE_COLS
             for k, fn in (('min', 'min'), ('max', 'max'), ('mean', 'avg'), ('std', 'stddev_samp')))},
  {', '.join(f'(select round(quantile_cont(cast({c} as double), {v}), 6) + 0.0 from valid_rec) as {c}_{k}' for c in _PROFILE_COLS
             for k, v in (('q25', 0.25), ('median', 0.5), ('q75', 0.75)))},
  (select cast(count(*) as bigint) from valid_rec, st where abs((coalesce(revenue, 0) - mu) / nullif(sd, 0)) > 3) as outlier_count,
  (select cast(count(*) as bigint) from bad_rec) as validation_error_count,
  (select string_agg(cast(rid as varchar), ',' order by rid) from (select rid from bad_rec order by rid limit 5)) as validation_errors_sample,
  (select string_agg(cast(rid as varchar) || ': ' || errors, '; ' order by rid) from
     (select rid, errors from bad_rec order by rid limit 5)) as validation_messages_sample
""", "faulty_records"))
def q_quality_report(spark, sf_dir):
    return q.quality_report(fx.faulty_records(star(spark, sf_dir)))
