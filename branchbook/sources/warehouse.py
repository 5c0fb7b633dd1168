"""Warehouse sources and sinks (S1-S6) and the monthly load job.

Writers are thin: the fact is written by month partition with dynamic
partition overwrite (only touched months are replaced), dimensions go to a new
versioned folder (a job never overwrites the folder it reads), staging is a
plain overwrite. Row counts are taken with ``Observation`` in the same job.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.functions.periods import period_index_of_date, raw_date
from branchbook.session import scratch_dir

# Layout of the raw operations file.
RAW_SCHEMA = T.StructType([
    T.StructField("DATA", T.StringType()),
    T.StructField("INC_GK", T.LongType()),
    T.StructField("INC_NAME", T.StringType()),
    T.StructField("WEIGHT", T.DecimalType(10, 3)),
    T.StructField("CNT", T.IntegerType()),
    T.StructField("SUMMA", T.DecimalType(18, 2)),
    T.StructField("FILIAL", T.IntegerType()),
    T.StructField("PERIOD", T.StringType()),
    T.StructField("SNDRCTG", T.StringType()),
])
BRANCH_REF_SCHEMA = "FILIAL int, FILIAL_NAME string"
DIM_VERSION_SCHEMA = (
    "filial_id int, filial_name string, region string, filial_type string, is_active boolean, "
    "valid_from date, valid_to date, is_current boolean"
)
PRODUCT_REF_SCHEMA = "account bigint, product string, direction string"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read by suffix. CSV with a header and an explicit schema (no
    inference pass, fail fast on bad rows); parquet as is; anything else raises."""
    p = path.lower().rstrip("/")
    if p.endswith(".csv"):
        r = spark.read.option("header", True).option("mode", "FAILFAST")
        return (r.schema(schema) if schema is not None else r).csv(path)
    if p.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"Unsupported file type: {path}")


INGEST_COLUMNS = ("ingest_file", "ingest_block", "ingest_seq")


def with_ingest_order(scan: DataFrame) -> DataFrame:
    """V3's "earliest physical row": source file, split start and a scan-time id.

    Apply directly on a file scan (``_metadata`` is a column of file sources).
    Ordering by the three columns follows the physical order even when a file
    is read as several splits in tasks of any order.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("ingest_file"),
        F.col("_metadata.file_block_start").alias("ingest_block"),
        F.monotonically_increasing_id().alias("ingest_seq"),
    )


def stage(df: DataFrame, path: str) -> dict[str, int]:
    """S3: exact dedup and full refresh of a staging folder; returns row counts
    before and after, observed in the write job itself. Ingest-order columns are
    not part of the row for the dedup; the earliest copy's are kept."""
    before, after = Observation("before"), Observation("after")
    obs_in = df.observe(before, F.count(F.lit(1)).alias("rows"))
    data_cols = [c for c in df.columns if c not in INGEST_COLUMNS]
    order_cols = [c for c in INGEST_COLUMNS if c in df.columns]
    if order_cols:
        one = obs_in.groupBy(*data_cols).agg(F.min(F.struct(*order_cols)).alias("__first"))
        one = one.select(*[F.col(f"__first.{c}").alias(c) if c in order_cols else F.col(c) for c in df.columns])
    else:
        one = obs_in.dropDuplicates(data_cols)
    out = one.observe(after, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(path)
    return {"rows_in": int(before.get["rows"]), "rows_staged": int(after.get["rows"])}


def write_fact_months(df: DataFrame, path: str) -> None:
    """Write the fact by month; only the months present in ``df`` are replaced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period_idx")
        .parquet(path)
    )


def write_versioned(df: DataFrame, base: str) -> str:
    """Dimensions: a new folder per version, so a job never overwrites what it reads."""
    path = f"{base.rstrip('/')}/v={_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_report(df: DataFrame, path: str) -> None:
    """A small metrics / quality report (a checks table, one row of metrics) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def raw_to_fact(raw: DataFrame) -> DataFrame:
    """Raw layout -> fact columns (dates parsed with the two-digit-year rule);
    ingest-order columns, when present, come first."""
    d = raw_date("DATA")
    return raw.select(
        *[c for c in INGEST_COLUMNS if c in raw.columns],
        F.col("FILIAL").alias("filial_id"),
        F.col("INC_GK").alias("inc_gk"),
        d.alias("operation_date"),
        F.col("PERIOD").alias("period"),
        period_index_of_date(d).alias("period_idx"),
        F.col("SNDRCTG").alias("sender_category"),
        F.col("WEIGHT").alias("weight"),
        F.col("CNT").alias("cnt"),
        F.col("SUMMA").alias("summa"),
    )


def _settle(checks: DataFrame) -> DataFrame:
    """A checks table (a handful of rows) computed once and reused for report, gate and count."""
    return checks.sparkSession.createDataFrame(checks.collect(), checks.schema)


def new_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}/{uuid.uuid4().hex[:12]}"


def read_fact(spark: SparkSession, root: str) -> DataFrame | None:
    from branchbook.sources.star import path_exists

    p = f"{root}/fact_operations"
    return spark.read.parquet(p) if path_exists(spark, p) else None


# What a load publishes, and how: fact and KPI months are replaced, the others whole.
PUBLISHED = {"fact": "fact_operations", "kpi": "mv_filial_monthly_kpi", "dim": "dim_filials_current", "watermark": "etl_watermark"}
TRACE = ("old_summa", "old_cnt", "changed")  # what the upsert did to a fact
_COMMITTED = "_COMMITTED"


def _files(spark: SparkSession, path: str) -> list[str]:
    from branchbook.sources.star import _fs

    p, fs = _fs(spark, path)
    return sorted(f.getPath().toString() for f in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    from branchbook.sources.star import _fs

    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _publish(spark: SparkSession, root: str, redo: str) -> None:
    """Put a committed load's results in their places; each write replaces, so doing it again changes nothing."""
    from branchbook.sources.star import path_exists

    for part, place in PUBLISHED.items():
        if not path_exists(spark, f"{redo}/{part}"):
            continue
        new = spark.read.parquet(f"{redo}/{part}")
        if part in ("fact", "kpi"):
            write_fact_months(new.drop(*TRACE), f"{root}/{place}")
        elif part == "dim":
            new.coalesce(1).write.mode("overwrite").text(f"{root}/{place}")
        else:
            new.write.mode("overwrite").parquet(f"{root}/{place}")
    _delete(spark, redo)


def recover(spark: SparkSession, root: str) -> int:
    """Finish loads that were cut off: committed ones are published (again), others leave nothing. Returns how many were published."""
    from branchbook.sources.star import path_exists

    done = 0
    for redo in _files(spark, f"{root}/_redo"):
        if path_exists(spark, f"{redo}/{_COMMITTED}"):
            _publish(spark, root, redo)
            done += 1
        else:
            _delete(spark, redo)
    return done


def monthly_load(spark: SparkSession, root: str, landed_raw: DataFrame, stg_branches: DataFrame,
                 dim_products: DataFrame, as_of: _dt.date, now: _dt.datetime,
                 min_rows: int | None = None) -> DataFrame:
    """Gate -> stage -> SCD2 branches -> fact upsert -> gate on the result -> KPI -> watermark,
    against the warehouse under ``root``.

    Everything a load changes is first written aside as it will be (the touched months
    of the fact and the KPI aggregate, the pointer to the dimension version, the watermark)
    and marked as committed; only then is it published. A load that is killed or fails a
    gate before the mark changes nothing; one killed after it is published by the next
    load (``recover``). The KPI aggregate is kept up by the upsert's signed changes,
    after a first load that makes it from the facts.

    Returns the step report (step, rows). Running it twice with the same input
    leaves the same warehouse (the upsert is keyed and null-safe; the second
    run changes no summa, the SCD2 finds no change).
    """
    from branchbook.operators import quality as q
    from branchbook.operators import warehouse as wh
    from branchbook.sources.star import _fs, path_exists

    recover(spark, root)
    redo = f"{root}/_redo/{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    report: list[tuple[str, int]] = []
    checks = _settle(q.preload_checks(landed_raw, **({"min_rows": min_rows} if min_rows is not None else {})))
    write_report(checks, f"{root}/reports/preload_checks")
    q.assert_checks(checks)
    report.append(("preload_checks", checks.count()))

    counts = stage(landed_raw, f"{root}/stg_operations")
    report.append(("staged_rows", counts["rows_staged"]))
    staged = raw_to_fact(spark.read.parquet(f"{root}/stg_operations"))

    # dimensions: SCD2 on the branch names, new version folder
    current = spark.createDataFrame([], DIM_VERSION_SCHEMA)  # first load: every staged branch opens a version on as_of
    if path_exists(spark, f"{root}/{PUBLISHED['dim']}"):
        current = spark.read.parquet(spark.read.text(f"{root}/{PUBLISHED['dim']}").first()[0])
    versions = wh.scd_merge(current, stg_branches, "filial_id", ["filial_name"], [], as_of)
    new_dim = write_versioned(versions, f"{root}/dim_filials")
    spark.createDataFrame([(new_dim,)], "value string").write.parquet(f"{redo}/dim")
    report.append(("dim_filials_versions", spark.read.parquet(new_dim).count()))

    # the touched months of the fact
    target = read_fact(spark, root)
    staged_l = staged.withColumn("loaded_at", F.lit(now))
    fact_cols = [c for c in staged_l.columns if c not in INGEST_COLUMNS]
    if target is None:  # first load: every key is an insert (after the keyed-dedup rule)
        rest = [c for c in staged_l.columns if c not in wh.UPSERT_KEY]  # ingest order first when present
        merged = q.dedup_keyed(staged_l, wh.UPSERT_KEY, rest).select(*fact_cols)
    else:
        merged = wh.upsert_facts(target.select(*fact_cols), staged_l, now, traced=True)
    written = Observation("fact")
    merged.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(f"{redo}/fact")
    merged = spark.read.parquet(f"{redo}/fact")
    fact_new = merged.select(*fact_cols)
    report.append(("fact_rows_written", int(written.get["rows"])))
    months = merged.select("period_idx").distinct()

    # the gate sees the fact as it will be, with the new dimension versions
    fact = fact_new
    if target is not None:
        fact = fact.unionByName(target.select(*fact_cols).join(F.broadcast(months), "period_idx", "left_anti"))  # a month list
    post = _settle(q.postload_checks(fact, spark.read.parquet(new_dim).filter("is_current"), dim_products, now))
    write_report(post, f"{root}/reports/postload_checks")
    q.assert_checks(post)
    report.append(("postload_checks", post.count()))

    # the KPI aggregate of the months that changed
    kpi_path = f"{root}/{PUBLISHED['kpi']}"
    if target is not None and path_exists(spark, kpi_path):
        kpi = wh.apply_kpi_delta(spark.read.parquet(kpi_path), wh.kpi_delta(merged))
    else:
        kpi = wh.refresh_kpi(fact, months)
    kpi_rows = Observation("kpi")
    kpi.observe(kpi_rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{redo}/kpi")
    report.append(("kpi_rows_refreshed", int(kpi_rows.get["rows"])))

    # watermark: last row wins per table
    wm_path = f"{root}/{PUBLISHED['watermark']}"
    new_wm = spark.createDataFrame([("fact_operations", now, counts["rows_staged"])],
                                   "table_name string, loaded_at timestamp, rows_loaded bigint")
    old_wm = spark.read.parquet(wm_path) if path_exists(spark, wm_path) else new_wm.limit(0)
    wh.upsert_last_wins(old_wm, new_wm, "table_name", "loaded_at").write.parquet(f"{redo}/watermark")
    report.append(("watermark_rows", spark.read.parquet(f"{redo}/watermark").count()))

    p, fs = _fs(spark, f"{redo}/{_COMMITTED}")
    fs.create(p).close()  # from here on the load counts
    _publish(spark, root, redo)
    return spark.createDataFrame(report, "step string, rows bigint")
