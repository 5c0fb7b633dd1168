"""Incremental load of newly landed files into the fact table.

A file stream over the landing folder with ``trigger(availableNow=True)``: each
run processes what landed since the last run (the stream checkpoint plays the
role of the ETL watermark table) and stops. Every micro-batch is upserted by key
into the month partitions it touches, so a batch replayed after a failure
leaves the same table.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.operators.warehouse import UPSERT_KEY, upsert_facts
from branchbook.plans.catalog import register
from branchbook.plans.oracle_base import with_ctes
from branchbook.sources.warehouse import new_root, write_fact_months


def upsert_batch_writer(spark: SparkSession, fact_path: str, work_dir: str, now: _dt.datetime):
    """The ``foreachBatch`` function: keyed upsert of one micro-batch."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        target = spark.read.parquet(fact_path)
        merged = upsert_facts(target.select(*batch.columns, "loaded_at"), batch.withColumn("loaded_at", F.lit(now)), now)
        # the merge reads the partitions it replaces: write it aside first (cuts the lineage)
        tmp = f"{work_dir}/epoch={epoch_id}-{uuid.uuid4().hex[:8]}"
        merged.write.mode("overwrite").parquet(tmp)
        write_fact_months(spark.read.parquet(tmp), fact_path)

    return run


def run_incremental(spark: SparkSession, landing: str, fact_path: str, checkpoint: str, now: _dt.datetime,
                    schema, files_per_batch: int = 1) -> None:
    """Process every file that landed since the last run, then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    q = (
        stream.writeStream.foreachBatch(upsert_batch_writer(spark, fact_path, f"{checkpoint}/_work", now))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


@register("incremental_load", "T1 E3 S4", with_ctes("select * from upserted", "upserted"))
def q_incremental_load(spark, sf_dir):
    """Lands the staged months one by one, streams them into a copy of the fact's
    touched months and returns these."""
    from branchbook.plans.warehouse_jobs import load_time, loaded_fact
    from branchbook.sources import fixtures as fx
    from branchbook.sources.star import star

    s = star(spark, sf_dir)
    root = new_root(spark, "incremental")
    fact_path = f"{root}/fact_operations"
    first = fx.last_months(s, 2)
    staged = fx.stg_operations(s, first)
    months = [r[0] for r in staged.select("period_idx").distinct().orderBy("period_idx").collect()]
    # only the months that will change are copied: the load reads and replaces no others
    write_fact_months(loaded_fact(spark, sf_dir).filter(F.col("period_idx").isin(months)), fact_path)
    landing = f"{root}/landing"
    for m in months:  # a month lands at a time, as the monthly export does; rows of one key share a file
        staged.filter(F.col("period_idx") == m).repartition(*UPSERT_KEY).write.mode("append").parquet(landing)
    run_incremental(spark, landing, fact_path, f"{root}/_checkpoint", load_time(spark, sf_dir), staged.schema)
    return spark.read.parquet(fact_path).select(
        "filial_id", "inc_gk", "operation_date", "period", "period_idx", "sender_category", "weight", "cnt", "summa",
        "loaded_at")
