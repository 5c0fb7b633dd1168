"""Cleaning, validation and data quality.

Everything is an aggregate or a filter: duplicate counts are
group-bys with map-side combine (a key holding a third of all rows collapses
before the shuffle), exact dedup groups rows dealt by their content, keyed dedup keeps the earliest row with ``min(struct)``
instead of a window, and the reports are one-row aggregates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, one_row, rnd
from branchbook.operators.joins import dealt
from branchbook.operators.quantiles import column_quantiles, exact_quantiles
from branchbook.session import stored

# Thresholds of the reference's load gates.
MIN_EXPECTED_ROWS = 10_000
MAX_DUPLICATE_PCT = 1.0
REQUIRED_RAW_COLUMNS = ("DATA", "INC_GK", "INC_NAME", "WEIGHT", "CNT", "SUMMA", "FILIAL", "PERIOD", "SNDRCTG")
KEY_RAW_COLUMNS = ("INC_GK", "SUMMA", "FILIAL", "PERIOD")
MAX_ORPHAN_PRODUCTS = 100
Z_LIMIT = 3.0
# Row contract of a monthly record: YYYY-MM, month with or without a leading zero.
PERIOD_PATTERN = r"^\d{4}-(0?[1-9]|1[0-2])$"
RECORD_FIELDS = ("filial_id", "filial_name", "service_type", "period", "revenue", "operations_count", "region")
NUMERIC_FIELDS = ("filial_id", "revenue", "operations_count")
PROFILE_QUANTILES = (0.25, 0.5, 0.75)


def dedup_exact(df: DataFrame, rows: int | None = None) -> DataFrame:
    """V1: one row per distinct row (nulls compare equal).

    Most rows are distinct, so a map-side combine would hold each task's rows and save little:
    rows are dealt by their whole content into counted slices instead. Copies of one row
    meet in one task, which holds it once. ``rows`` is about how many there are, if known.
    """
    return dealt(df, df.columns, rows).dropDuplicates()


def duplicate_stats(df: DataFrame) -> DataFrame:
    """V2: total rows, duplicate rows (total - distinct) and their percent (2 places)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    t = g.agg(F.sum("__n").alias("total_rows"), F.sum(F.col("__n") - 1).alias("duplicate_rows"))
    return t.select(
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
        rnd(F.lit(100.0) * dbl("duplicate_rows") / F.nullif(dbl("total_rows"), F.lit(0.0)), 2).alias("duplicate_pct"),
    )


def dedup_keyed(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """V3: keep the first row per key by ``order``; rows with a null key are all kept.

    SQL ``=`` never matches nulls, so the reference's self-join delete leaves
    them alone. The first row comes from ``min(struct(order..., rest...))``, an
    aggregate Spark combines map-side, so a hot key never lands whole in a task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    keep_all = df.filter(any_null)
    firsts = (
        df.filter(~any_null)
        .groupBy(*key)
        .agg(F.min(F.struct(*[F.col(c) for c in order + rest])).alias("__r"))
        .select(*key, *[F.col(f"__r.{c}").alias(c) for c in order + rest])
    )
    return keep_all.unionByName(firsts.select(*df.columns))


def record_rules() -> list[tuple[str, Column]]:
    """V4: the row contract of a monthly record, one null-safe boolean per field."""
    c = F.col
    return [
        ("filial_id", c("filial_id").isNotNull() & (c("filial_id") > 0)),
        ("filial_name", c("filial_name").isNotNull() & (F.length("filial_name") >= 1)),
        ("service_type", c("service_type").isNotNull() & (F.length("service_type") >= 1)),
        ("period", c("period").isNotNull() & c("period").rlike(PERIOD_PATTERN)),
        ("revenue", c("revenue").isNotNull() & ~F.isnan("revenue") & (c("revenue") >= 0)),
        ("operations_count", c("operations_count").isNotNull() & (c("operations_count") >= 0)),
    ]


def with_errors(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Adds ``errors``: the names of the failed rules, in field order."""
    rules = rules or record_rules()
    arr = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    return df.withColumn("errors", F.filter(arr, lambda x: x.isNotNull()))


def split_valid(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """V4: (valid rows, quarantined rows with their error list)."""
    e = with_errors(df, rules)
    valid = e.filter(F.size("errors") == 0).drop("errors")
    bad = e.filter(F.size("errors") > 0)
    return valid, bad


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """V5: null (and NaN for doubles) count per column, long form (column_name, null_count)."""
    cols = cols or df.columns
    types = dict(df.dtypes)
    exprs = []
    for c in cols:
        miss = F.col(c).isNull()
        if types[c] in ("double", "float"):
            miss = miss | F.isnan(c)
        exprs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias(c))
    wide = df.agg(*exprs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)")


def numeric_profile(df: DataFrame, cols: list[str], spark: SparkSession | None = None,
                    approx_accuracy: int | None = None) -> DataFrame:
    """V6: min, max, mean, median, sample std, q25, q75 per numeric column (long form).

    Moments come from one aggregate, the quantiles of all columns from four further
    passes (``column_quantiles``). With ``approx_accuracy`` the quantiles come from
    ``percentile_approx`` in the same single pass instead (rank error about
    1 / accuracy). Values are rounded to 6 places.
    """
    if approx_accuracy is not None:
        parts = []
        for c in cols:
            x = dbl(c)
            q = F.percentile_approx(x, list(PROFILE_QUANTILES), approx_accuracy)
            parts.append(df.agg(
                F.lit(c).alias("column_name"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                q[1].alias("median"), F.stddev_samp(x).alias("std"), q[0].alias("q25"), q[2].alias("q75"),
            ))
        out = parts[0]
        for p_ in parts[1:]:
            out = out.unionByName(p_)
        return out.select("column_name", *[rnd(k, 6).alias(k) for k in ("min", "max", "mean", "median", "std", "q25", "q75")])
    from pyspark import StorageLevel

    spark = spark or df.sparkSession
    aggs = []
    for c in cols:
        x = dbl(c)
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std")]
    src = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)  # read by every pass below
    try:
        m = src.agg(*aggs).first()
        quantiles = column_quantiles(src, {c: list(PROFILE_QUANTILES) for c in cols})
    finally:
        src.unpersist()
    schema = "column_name string, min double, max double, mean double, median double, std double, q25 double, q75 double"
    rows = []
    for c in cols:
        q25, q50, q75 = quantiles[c]
        rows.append((c, m[f"{c}__min"], m[f"{c}__max"], m[f"{c}__mean"], q50, m[f"{c}__std"], q25, q75))
    out = spark.createDataFrame(rows, schema)
    return out.select("column_name", *[rnd(k, 6).alias(k) for k in ("min", "max", "mean", "median", "std", "q25", "q75")])


def zscores(df: DataFrame, col: str, out: str = "z") -> DataFrame:
    """V7: z = (x - mean) / population std over the whole frame, nulls as 0.

    The mean and std are a one-row aggregate attached as a scalar subquery (no
    keyless window, which would pull every row into one task).
    """
    x = F.coalesce(dbl(col), F.lit(0.0))
    st = one_row(df.agg(F.avg(x).alias("mu"), F.stddev_pop(x).alias("sd")))
    return df.withColumn(out, (x - st["mu"]) / F.nullif(st["sd"], F.lit(0.0)))


def zscore_outliers(df: DataFrame, col: str, limit: float = Z_LIMIT) -> DataFrame:
    """V7/M6: rows whose |z| is above the limit."""
    return zscores(df, col).filter(F.abs("z") > limit)


def sorted_periods(period: str = "PERIOD") -> Column:
    """Distinct periods joined by ',' in calendar order (bounded by the month count)."""
    from branchbook.functions.periods import period_index

    item = F.when(F.col(period).isNotNull(), F.struct(period_index(period).alias("i"), F.col(period).alias("p")))
    s = F.array_sort(F.collect_set(item))
    return F.array_join(F.transform(s, lambda x: x["p"]), ",")


def dataset_profile(raw: DataFrame, approx: bool = False) -> DataFrame:
    """V8: rows, periods, distinct branches and accounts, SUMMA stats, blanks in total and per column (``missing_<column>``).

    ``approx=True`` switches the distinct counts to HyperLogLog++
    (``approx_count_distinct``) and the median to ``percentile_approx``: one pass,
    bounded memory, for tables where the exact answers are not needed.
    """
    if approx:
        distinct = F.approx_count_distinct
        median_col = F.percentile_approx(dbl("SUMMA"), 0.5, 10_000)
    else:
        distinct = F.countDistinct
        median_col = F.lit(exact_quantiles(raw, "SUMMA", [0.5])[0]).cast("double")
    blanks = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in raw.columns]
    profile = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        sorted_periods("PERIOD").alias("periods"),
        distinct("FILIAL").alias("unique_filials"),
        distinct("INC_GK").alias("unique_products"),
        rnd(F.min(dbl("SUMMA")), 2).alias("summa_min"),
        rnd(F.max(dbl("SUMMA")), 2).alias("summa_max"),
        rnd(F.avg(dbl("SUMMA")), 4).alias("summa_mean"),
        rnd(F.stddev_samp(dbl("SUMMA")), 4).alias("summa_std"),
        rnd(median_col, 4).alias("summa_median"),
        *blanks,
    )
    return profile.withColumn("missing_cells", sum((F.col(f"missing_{c}") for c in raw.columns), F.lit(0)).cast("bigint"))


def preload_checks(raw: DataFrame, min_rows: int = MIN_EXPECTED_ROWS, max_dup_pct: float = MAX_DUPLICATE_PCT) -> DataFrame:
    """V9: the gate before staging, as a checks table (check, value, threshold, severity, passed).

    One pass over the file: its distinct rows with their multiplicity give every
    check; ``assert_checks`` raises on failed ``error`` rows. A check that needs an
    absent column has a null value and fails.
    """
    present = set(raw.columns)
    missing_cols = len([c for c in REQUIRED_RAW_COLUMNS if c not in present])
    unknown = F.lit(None).cast("bigint")
    key_nulls = unknown
    if present.issuperset(KEY_RAW_COLUMNS):
        key_nulls = sum((F.sum(F.when(F.col(c).isNull(), F.col("__n")).otherwise(0)) for c in KEY_RAW_COLUMNS), F.lit(0))
    negative = F.sum(F.when(F.col("SUMMA") < 0, F.col("__n")).otherwise(0)) if "SUMMA" in present else unknown
    g = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("__n"))
    a = g.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.sum(F.col("__n") - 1).alias("duplicates"),
              key_nulls.alias("key_nulls"), negative.alias("negative_summa"))
    j = a.withColumn("duplicate_pct", rnd(F.lit(100.0) * dbl("duplicates") / F.nullif(dbl("rows"), F.lit(0.0)), 2))
    checks = f"""stack(5,
        'row_count', cast(rows as double), cast({min_rows} as double), 'error', rows >= {min_rows},
        'missing_columns', cast({missing_cols} as double), 0D, 'error', {missing_cols} = 0,
        'key_nulls', cast(key_nulls as double), 0D, 'error', coalesce(key_nulls = 0, false),
        'negative_summa', cast(negative_summa as double), 0D, 'error', coalesce(negative_summa = 0, false),
        'duplicate_pct', duplicate_pct, cast({max_dup_pct} as double), 'warning', duplicate_pct <= {max_dup_pct}
    ) as (check_name, value, threshold, severity, passed)"""
    return j.selectExpr(checks)


def assert_checks(checks: DataFrame) -> None:
    """Raise if any ``error`` check failed (warnings only log)."""
    failed = checks.filter((F.col("severity") == "error") & ~F.col("passed")).collect()
    if failed:
        raise ValueError("data quality FAIL: " + "; ".join(f"{r.check_name}={r.value}" for r in failed))


def postload_checks(fact: DataFrame, dim_filials: DataFrame, dim_products: DataFrame,
                    as_of: _dt.datetime, loaded_at: str = "loaded_at",
                    max_orphan_products: int = MAX_ORPHAN_PRODUCTS) -> DataFrame:
    """Orphan branches (fail > 0), orphan products (fail > limit), zero revenue and freshness hours."""
    from branchbook.operators.joins import orphans

    ob = orphans(fact, dim_filials, "filial_id", "filial_id").agg(F.count(F.lit(1)).alias("v"))
    op = orphans(fact, dim_products, "inc_gk", "inc_gk").agg(F.count(F.lit(1)).alias("v"))
    zr = fact.agg(
        F.sum(F.when(F.col("summa") == 0, 1).otherwise(0)).alias("zero"),
        F.max(loaded_at).alias("last_load"),
    )
    fresh = F.timestamp_diff("SECOND", F.col("last_load"), F.lit(as_of)) / F.lit(3600.0)
    j = zr.select(F.col("zero"), rnd(fresh, 4).alias("fresh"), one_row(ob)["v"].alias("ob"), one_row(op)["v"].alias("op"))
    return j.selectExpr(f"""stack(4,
        'orphaned_filials', cast(ob as double), 0D, 'error', ob = 0,
        'orphaned_products', cast(op as double), cast({max_orphan_products} as double), 'error', op <= {max_orphan_products},
        'zero_revenue_rows', cast(coalesce(zero, 0) as double), cast(null as double), 'info', true,
        'freshness_hours', fresh, cast(null as double), 'info', true
    ) as (check_name, value, threshold, severity, passed)""")


REPORT_QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def quality_report(records: DataFrame, id_col: str = "rid", sample: int = 5) -> DataFrame:
    """The report of the record validation, one row.

    Order as in the reference: dedup -> blanks counted on the deduped rows ->
    rule filter -> z-score outliers on the valid rows. One group-by over all
    columns gives the distinct rows with their multiplicity (total = sum, distinct
    = count), written to the shared folder; every other statistic reads the columns it
    needs from there. Blanks are given in total and as ``missing_<column>``; the numeric
    columns of the valid rows as ``<column>_min``, ``_max``, ``_mean``, ``_std``, ``_q25``,
    ``_median`` and ``_q75`` (the quantiles of all columns in four passes while the report
    is built); the first failed rows by id and with their messages.
    """
    g = stored(records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("__n")), "quality-rows")
    fields = [c for c in RECORD_FIELDS if c in records.columns]
    types = dict(records.dtypes)
    blanks = [
        F.count_if(F.col(c).isNull() | (F.isnan(c) if types[c] == "double" else F.lit(False))).alias(f"missing_{c}")
        for c in fields
    ]
    e = with_errors(g)
    ok = F.size("errors") == 0
    numeric = []
    for c in (c for c in NUMERIC_FIELDS if c in fields):
        x = F.when(ok, dbl(c))
        numeric += [rnd(fn(x), 6).alias(f"{c}_{k}") for k, fn in
                    (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))]
    valid = e.filter(ok).drop("errors", "__n")
    profiled = [c for c in NUMERIC_FIELDS if c in fields]
    quantiles = column_quantiles(valid, {c: list(REPORT_QUANTILES.values()) for c in profiled})
    found = [
        rnd(F.lit(v).cast("double"), 6).alias(f"{c}_{k}") for c in profiled for k, v in zip(REPORT_QUANTILES, quantiles[c])
    ]
    message = F.concat(F.col(id_col).cast("string"), F.lit(": "), F.array_join("errors", ","))
    # distributed top-k
    first = e.filter(~ok).select(F.col(id_col).alias("id"), message.alias("message")).orderBy("id", "message").limit(sample)
    f = one_row(first.agg(F.sort_array(F.collect_list(F.struct("id", "message"))).alias("s")).select(
        F.array_join(F.col("s.id").cast("array<string>"), ",").alias("sample"),
        F.array_join(F.col("s.message"), "; ").alias("messages"),
    ))
    o = one_row(zscore_outliers(valid, "revenue").agg(F.count(F.lit(1)).alias("outlier_count")))
    return e.agg(
        F.sum("__n").cast("bigint").alias("total_rows"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("valid_rows"),
        (F.sum("__n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.sum(F.when(~ok, 1).otherwise(0)).cast("bigint").alias("validation_error_count"),
        *blanks, *numeric,
    ).select(
        "total_rows", "valid_rows", "duplicate_rows",
        sum((F.col(f"missing_{c}") for c in fields), F.lit(0)).cast("bigint").alias("missing_cells"),
        *[f"missing_{c}" for c in fields],
        *[f"{c}_{k}" for c in profiled for k in ("min", "max", "mean", "std")],
        *found,
        o["outlier_count"].cast("bigint").alias("outlier_count"),
        "validation_error_count",
        f["sample"].alias("validation_errors_sample"),
        f["messages"].alias("validation_messages_sample"),
    )
