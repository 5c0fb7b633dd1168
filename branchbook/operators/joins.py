"""Joins (J1-J10) with size-checked broadcasts.

A dimension is broadcast only when its size is bounded: either by definition
(the branch dimension is keyed by a fixed code list) or by the optimizer's size
estimate of the plan and its counted rows, checked here before the hint is given. Anything
of a greater estimate is left to Catalyst and AQE (sort-merge join, runtime conversion to a
broadcast or shuffled-hash join, skew splitting); a frame of more rows is asked to be
sort-merged, as its estimate may be small enough for Catalyst to broadcast it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest plan estimate that we hint as broadcast (AQE may still broadcast
# smaller sides at run time by their measured size).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Most rows of a frame that we hint as broadcast. The estimate is of compressed files, often a
# twentieth of what the rows take in the driver's memory, so the rows are counted as well.
BROADCAST_LIMIT_ROWS = 500_000
# Rows that one task groups, sorts or holds where they are dealt in counted slices.
ROWS_A_TASK = 500_000
# Hash buckets by which the rows of keys are counted.
KEY_BUCKETS = 65_536


def plan_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan, or None when unavailable."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - e.g. Spark Connect, where the plan is remote
        return None
    # py4j hands a Scala BigInt over as a Python int; older gateways as an object
    return int(v) if isinstance(v, int) else int(str(v.toString()))


def checked_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is known and under the limit, and the rows are counted and few."""
    size = plan_size_bytes(df)
    if size is None or size > limit_bytes:
        return df
    return F.broadcast(df) if df.count() <= BROADCAST_LIMIT_ROWS else df.hint("merge")


def enrich_left(fact: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Left join keeping unmatched facts (attributes null).

    SQL semantics: a null key never matches. The dimension goes through the
    checked broadcast; it is expected to be unique on its key (see
    ``duplicate_keys``), otherwise matching facts fan out as in SQL.
    """
    return fact.join(checked_broadcast(dim), on=key, how="left")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose key has no row in the dimension (``left_anti``)."""
    d = checked_broadcast(dim.select(F.col(dim_key).alias("__k")).distinct())
    return fact.join(d, fact[fact_key] == d["__k"], "left_anti")


def duplicate_keys(dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once in a dimension (empty when unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def semi_by_values(target: DataFrame, source: DataFrame, target_col: str, source_col: str) -> DataFrame:
    """Keep ``target`` rows whose ``target_col`` is among the distinct ``source_col`` values.

    DAX ``TREATAS(VALUES(source), target)``; Spark plans it as a left-semi join
    with the distinct values aggregated map-side first.
    """
    vals = source.select(F.col(source_col).alias("__v")).distinct()
    return target.join(vals, F.col(target_col) == F.col("__v"), "left_semi")


# Versions of one key up to which each fact may look at all of them.
FEW_VERSIONS = 16


def point_in_time(fact: DataFrame, dim_versions: DataFrame, key: str, date_col: str,
                  valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Fact joined to the dimension version valid on the fact's date, null where there is none.

    Versions of a key don't overlap, as SCD2 leaves them. A version table of a checked
    size with few versions of any key is broadcast and met by equi-join and range
    condition; otherwise ``as_of_merge`` looks each fact's version up without fan-out.
    """
    size = plan_size_bytes(dim_versions)
    if size is not None and size <= BROADCAST_LIMIT_BYTES:
        most = dim_versions.groupBy(key).count().agg(F.max("count")).first()[0]
        if (most or 0) <= FEW_VERSIONS:
            v = F.broadcast(dim_versions)
            cond: Column = (
                (fact[key] == v[key])
                & (fact[date_col] >= v[valid_from])
                & (fact[date_col] <= v[valid_to])
            )
            return fact.join(v, cond, "left").drop(v[key])
    return as_of_merge(fact, dim_versions, key, date_col, valid_from, valid_to)


def dealt(df: DataFrame, keys: list[str], rows: int | None = None, rows_a_task: int | None = None) -> DataFrame:
    """The rows in counted slices of about ``ROWS_A_TASK``, those of equal keys in one; grouping by the keys (or more) needs no other exchange."""
    n = df.count() if rows is None else rows
    return df.repartition(max(1, -(-n // (rows_a_task or ROWS_A_TASK))), *keys)


def as_of_merge(fact: DataFrame, dim_versions: DataFrame, key: str, date_col: str,
                valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """J10 for versions of any number: facts and versions in one order by date, the last version of the key carried forward.

    Both are dealt by key into slices of a counted number of rows, where a window carries the
    versions on. Each fact costs one row however many versions its key has. Keys are counted
    first, by ``KEY_BUCKETS`` hash buckets: the facts of a bucket that fills more than a slice
    are dealt into several places by their content, each with a copy of the bucket's versions.
    Facts without a key or date match nothing and are not moved.
    """
    attrs = [c for c in dim_versions.columns if c != key]
    vtype = T.StructType([T.StructField(f"c{i}", dim_versions.schema[c].dataType) for i, c in enumerate(attrs)])
    held = [f"__f{i}" for i in range(len(fact.columns))]
    placed = fact.where(F.col(key).isNotNull() & F.col(date_col).isNotNull())
    rows = placed.select(
        F.col(key).alias("__k"), F.col(date_col).alias("__d"), F.lit(1).alias("__kind"), F.xxhash64(*fact.columns).alias("__spread"),
        F.lit(None).cast(vtype).alias("__v"), *[F.col(c).alias(f) for c, f in zip(fact.columns, held)],
    )
    versions = dim_versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("__k"), F.col(valid_from).cast(fact.schema[date_col].dataType).alias("__d"), F.lit(0).alias("__kind"),
        F.unix_date(F.col(valid_to).cast("date")).cast("bigint").alias("__spread"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(attrs)]).alias("__v"),
        *[F.lit(None).cast(fact.schema[c].dataType).alias(f) for c, f in zip(fact.columns, held)],
    )
    both = rows.unionByName(versions).withColumn("__bucket", F.pmod(F.xxhash64("__k"), F.lit(KEY_BUCKETS)).cast("int"))
    counts = both.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("__kind").alias("facts"))
    full = F.when(F.col("facts") > ROWS_A_TASK, F.struct("__bucket", F.ceil(F.col("facts") / ROWS_A_TASK).cast("int").alias("__places")))
    total, hot = counts.agg(F.sum("n"), F.collect_list(full)).first()  # at most a bucket for each slice
    hot = both.sparkSession.createDataFrame(hot, "__bucket int, __places int")
    places = F.coalesce("__places", F.lit(1))
    at = F.when(F.col("__kind") == 1, F.array(F.pmod("__spread", places).cast("int"))).otherwise(F.sequence(F.lit(0), places - 1))
    spread = both.join(F.broadcast(hot), "__bucket", "left").select("__k", "__d", "__kind", "__spread", "__v", *held, F.explode(at).alias("__place"))
    upto = Window.partitionBy("__k", "__place").orderBy("__d", "__kind", "__spread").rowsBetween(Window.unboundedPreceding, 0)
    j = dealt(spread, ["__k", "__place"], total or 0).withColumn("__found", F.last("__v", ignorenulls=True).over(upto)).where("__kind = 1")
    end = F.col(f"__found.c{attrs.index(valid_to)}")
    j = j.withColumn("__found", F.when(F.col("__d") <= end, F.col("__found")))
    out = j.select(*[F.col(f).alias(c) for c, f in zip(fact.columns, held)], *[F.col(f"__found.c{i}").alias(c) for i, c in enumerate(attrs)])
    unplaced = fact.where(F.col(key).isNull() | F.col(date_col).isNull())
    return out.union(unplaced.select(*fact.columns, *[F.lit(None).cast(dim_versions.schema[c].dataType).alias(c) for c in attrs]))
