"""E6 as a stream: the latest adjustment of every fact key, kept as keyed streaming state.

Adjustments arrive in files of any order; some arrive twice. The state holds one entry
per adjusted key, its latest version by event time (``adjusted_at``), so a late file
changes nothing that a newer one has set, and facts are never read. Each micro-batch
writes the keys it changed to a folder of its own; a batch that is replayed after a
failure overwrites that folder. The current adjustments are the latest entry per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl
from branchbook.operators.warehouse import UPSERT_KEY
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import with_ctes
from branchbook.sources.warehouse import new_root

ADJUSTMENT_SCHEMA = (
    "operation_date date, filial_id int, inc_gk bigint, sender_category string, "
    "adjusted_summa decimal(18,2), reason_code string, adjusted_at timestamp"
)


def latest_adjustments(events: DataFrame, key: list[str] = UPSERT_KEY) -> DataFrame:
    """The latest event per key, batch or streaming: equal times go by the greater value, so order never counts."""
    last = F.max(F.struct("adjusted_at", "adjusted_summa", "reason_code")).alias("last")
    return events.groupBy(*key).agg(last).select(*key, "last.adjusted_at", "last.adjusted_summa", "last.reason_code")


def run_adjustments(spark: SparkSession, landing: str, changes: str, checkpoint: str, files_per_batch: int = 1) -> None:
    """Take in every adjustment file that landed since the last run, then stop."""
    events = spark.readStream.schema(ADJUSTMENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(landing)

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/epoch={epoch_id}")

    q = (
        latest_adjustments(events).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def current_state(spark: SparkSession, changes: str) -> DataFrame:
    """The adjustments in force: state entries only grow in time, so the latest written one counts."""
    schema = "operation_date date, filial_id int, inc_gk bigint, sender_category string, adjusted_at timestamp, adjusted_summa decimal(18,2), reason_code string"
    return latest_adjustments(spark.read.schema(schema).parquet(f"{changes}/epoch=*"))


@register("adjusted_stream", "E6 T1", with_ctes("""
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
def q_adjusted_stream(spark, sf_dir):
    """Adjustments land newest version first, the older ones after them and the newest once more."""
    from branchbook.sources import fixtures as fx
    from branchbook.sources.star import star

    s = star(spark, sf_dir)
    root = new_root(spark, "adjustments")
    events = fx.fact_adjustments(s).selectExpr(*[c.split(" ")[0] for c in ADJUSTMENT_SCHEMA.split(", ")])
    for reason in ("R2", "R1", "R2"):
        events.filter(F.col("reason_code") == reason).write.mode("append").parquet(f"{root}/landing")
    run_adjustments(spark, f"{root}/landing", f"{root}/changes", f"{root}/_checkpoint", files_per_batch=8)
    current = current_state(spark, f"{root}/changes")
    per_key = s.fact().groupBy(*UPSERT_KEY, "period").agg(F.sum("summa").alias("original_summa"))
    cond = [per_key[k].eqNullSafe(current[k]) for k in UPSERT_KEY]
    j = per_key.join(current, cond, "left").select(per_key["filial_id"], per_key["period"], "original_summa", current["adjusted_summa"])
    return j.groupBy("filial_id", "period").agg(
        dbl(F.sum("original_summa")).alias("revenue_original"),
        dbl(F.sum(F.coalesce("adjusted_summa", "original_summa"))).alias("revenue_current"),
        F.count("adjusted_summa").cast("bigint").alias("adjusted_keys"),
    )
