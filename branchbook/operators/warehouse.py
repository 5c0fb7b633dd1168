"""Warehouse upkeep (E1-E7, J6, J10) as pure DataFrame functions.

Parquet has no MERGE, so each change is a function ``(current, staged, as_of)
-> new state``: testable against SQL, and written by the thin writers in
``branchbook.sources.warehouse`` (dynamic partition overwrite for the fact,
a new versioned folder for dimensions).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.operators.joins import checked_broadcast, dealt

# Fixed values of the slowly changing dimensions.
OPEN_END = _dt.date(9999, 12, 31)
HISTORY_START = _dt.date(1900, 1, 1)
KPI_KEY = ["filial_id", "period", "period_idx", "inc_gk"]
UPSERT_KEY = ["operation_date", "filial_id", "inc_gk", "sender_category"]
SEASONS = ("winter", "spring", "summer", "autumn")  # Dec-Feb, Mar-May, Jun-Aug, Sep-Nov


def initial_versions(dim: DataFrame, start: _dt.date = HISTORY_START) -> DataFrame:
    """A dimension as its first SCD2 version set (open, current)."""
    return dim.withColumns({
        "valid_from": F.lit(start),
        "valid_to": F.lit(OPEN_END),
        "is_current": F.lit(True),
    })


def scd_merge(versions: DataFrame, staged: DataFrame, key: str, type2: list[str], type1: list[str],
              as_of: _dt.date) -> DataFrame:
    """E1 + E2: apply a staged snapshot to an SCD table.

    * type-2 change (any ``type2`` column differs, SQL ``<>``: a null never
      differs): the current version is closed on ``as_of - 1`` and a new one
      opens on ``as_of``; if the current version opened on ``as_of`` itself it
      is overwritten instead (a second change on one day).
    * new keys open a version on ``as_of``; keys gone from the snapshot stay open.
    * attributes not in the snapshot are carried over from the closed version.
    * type-1 columns take the staged value on every version of the key.
    """
    stg = staged.select(key, *type2, *type1)
    cur = versions.filter(F.col("is_current"))
    hist = versions.filter(~F.col("is_current"))
    s = stg.select(key, *[F.col(c).alias(f"__s_{c}") for c in type2 + type1])
    j = cur.join(s, key, "left")
    differs = F.lit(False)
    for c in type2:
        differs = differs | F.coalesce(F.col(c) != F.col(f"__s_{c}"), F.lit(False))
    j = j.withColumn("__chg", differs)
    same_day = F.col("valid_from") == F.lit(as_of)
    base_cols = versions.columns
    closed = j.filter(F.col("__chg") & ~same_day).select(
        *[F.col(c) for c in base_cols if c not in ("valid_to", "is_current")],
        F.lit(as_of - _dt.timedelta(days=1)).alias("valid_to"),
        F.lit(False).alias("is_current"),
    )
    opened = j.filter(F.col("__chg")).select(
        *[F.col(f"__s_{c}").alias(c) if c in type2 else F.col(c) for c in base_cols
          if c not in ("valid_from", "valid_to", "is_current")],
        F.lit(as_of).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    kept = j.filter(~F.col("__chg")).select(*base_cols)
    new_keys = staged.join(cur.select(key), key, "left_anti")  # new keys take every staged attribute
    fresh = new_keys.select(
        *[F.col(c) if c in staged.columns else F.lit(None).cast(dict(versions.dtypes)[c]).alias(c)
          for c in base_cols if c not in ("valid_from", "valid_to", "is_current")],
        F.lit(as_of).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    out = hist.select(*base_cols).unionByName(kept).unionByName(closed.select(*base_cols)).unionByName(
        opened.select(*base_cols)).unionByName(fresh.select(*base_cols))
    if type1:
        t1 = stg.select(key, *[F.col(c).alias(f"__t1_{c}") for c in type1])
        out = out.join(t1, key, "left").select(
            *[F.coalesce(F.col(f"__t1_{c}"), F.col(c)).alias(c) if c in type1 else F.col(c) for c in base_cols]
        )
    return out


VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "observed")
VERSIONS_A_TASK = 50_000  # versions and staged rows that one task merges


def _known(attrs: list[str], prefix: str = "") -> Column:
    """Which attributes are not null, a bit for each."""
    return sum((F.when(F.col(f"{prefix}{c}").isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(attrs)), F.lit(0)).cast("bigint")


def observed_versions(versions: DataFrame, key: str) -> DataFrame:
    """A version table with ``observed``: the days on which snapshots confirmed each version, and which attributes they knew."""
    attrs = [c for c in versions.columns if c not in (key, *VERSION_COLUMNS)]
    return versions.withColumn("observed", F.array(F.struct(F.col("valid_from").alias("day"), _known(attrs).alias("known"))))


def scd_history(observations: DataFrame, key: str, type2: list[str], schema_of: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """SCD2 versions from (key, __day, __prio, attributes): one version for each stretch of days with the same type-2 values.

    A null means "not known" and keeps the value before it. Of rows of one key and day,
    the greatest ``__prio`` wins column by column. The rows of a key are as many as
    the snapshots that hold it (one per load). ``carried`` columns, one value for a key, are handed on.
    """
    attrs = [c for c in schema_of.columns if c not in (key, *VERSION_COLUMNS)]
    carried = carried or []
    hand_on = [F.first(c).alias(c) for c in carried]
    known = [F.max(F.when(F.col(c).isNotNull(), F.struct("__prio", F.col(c).alias("v")))).getField("v").alias(c) for c in attrs]
    days = observations.groupBy(key, "__day").agg(*known, *hand_on).withColumn("__known", _known(attrs))
    w = Window.partitionBy(key).orderBy("__day")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    filled = days.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in attrs})
    changed = F.row_number().over(w) == 1
    for c in type2:
        changed = changed | F.coalesce(F.col(c) != F.lag(c).over(w), F.lit(False))
    numbered = filled.withColumn("__changed", changed).withColumn("__version", F.sum(F.col("__changed").cast("int")).over(upto))
    spans = numbered.groupBy(key, "__version").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__day"))).alias(c) for c in attrs],
        F.min("__day").alias("valid_from"), F.sort_array(F.collect_list(F.struct(F.col("__day").alias("day"), F.col("__known").alias("known")))).alias("observed"),
        *hand_on,
    )
    after = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    out = spans.withColumn("valid_to", F.coalesce(F.date_sub(after, 1), F.lit(OPEN_END)))
    return out.withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END)).select(*schema_of.columns, *carried)


def scd_merge_any_order(versions: DataFrame, staged: DataFrame, key: str, type2: list[str], type1: list[str],
                        as_of: _dt.date) -> DataFrame:
    """E1 + E2 for snapshots that may come late: the table depends on the snapshots, not on their order.

    ``versions`` carries ``observed``, the days that confirmed each version and what
    they knew (see ``observed_versions``). A snapshot of a later day than all of a key's either
    confirms the open version (its row takes one more day) or changes it. For a changed
    key, a new key and a snapshot of an earlier day the key's observations are taken
    apart and put together anew (``scd_history``): a day inside a version splits it,
    its last part starting on the next day that confirmed it, and neighbours of
    the same values become one. A later snapshot of the same day overwrites. Type-1 columns
    take the values of the key's latest day on every version. A column of neither type
    has one value in a version, the last known. Keys that are not in the snapshot stay
    as they are. Versions and snapshot meet by one exchange on the key, without a join, so
    that neither is broadcast however small its files are; the snapshot has a row for a key.
    """
    attrs = [c for c in versions.columns if c not in (key, *VERSION_COLUMNS)]
    types = dict(versions.dtypes)
    staged_row = F.struct(*[(F.col(c) if c in staged.columns else F.lit(None)).cast(types[c]).alias(c) for c in attrs])
    none = F.lit(None)
    rows = versions.select(key, *attrs, *VERSION_COLUMNS, none.cast(T.StructType([versions.schema[c] for c in attrs])).alias("__staged")).unionByName(
        staged.select(F.col(key).cast(types[key]).alias(key), *[none.cast(types[c]).alias(c) for c in (*attrs, *VERSION_COLUMNS)], staged_row.alias("__staged")))
    rows = dealt(rows, [key], versions.count() + staged.count(), VERSIONS_A_TASK)
    # what a key's rows need of each other, by one exchange on the key; rows without a key meet nothing
    of_key = Window.partitionBy(key)
    is_staged, has_key = F.col("__staged").isNotNull(), F.col(key).isNotNull()
    rows = rows.withColumns({
        "__version": ~is_staged,
        "__s": F.when(has_key, F.first("__staged", ignorenulls=True).over(of_key)),
        "__known_key": F.when(has_key, F.max(~is_staged).over(of_key)),
        "__last": F.when(has_key, F.max(F.array_max("observed.day")).over(of_key)),
        **{f"__t0_{c}": F.when(has_key, F.max_by(c, "valid_from").over(of_key)) for c in type1},
    })
    differs = F.lit(False)
    for c in type2:
        differs = differs | F.coalesce(F.col(c) != F.col(f"__s.{c}"), F.lit(False))
    late = F.array_max("observed.day") >= F.lit(as_of)
    met = F.col("__version") & F.col("is_current") & F.col("__s").isNotNull()
    rows = rows.withColumn("__redo", F.when(has_key, F.max(F.when(met, late | differs)).over(of_key)))
    redo = F.coalesce("__redo", F.lit(False))
    # type 1: the latest day's values, the snapshot's unless the key has been seen on a later day
    newest = F.col("__last").isNull() | (F.col("__last") <= F.lit(as_of))
    over = {f"__t1_{c}": F.coalesce(F.when(has_key & newest, F.col(f"__s.{c}")), F.col(f"__t0_{c}")) for c in type1}
    rows = rows.withColumns(over)
    seen = F.struct(F.lit(as_of).alias("day"), _known(attrs, "__s.").alias("known"))
    kept = rows.where(F.col("__version") & ~redo).withColumn(
        "observed", F.when(met, F.array_append("observed", seen)).otherwise(F.col("observed")))
    # a redone key's versions are taken apart by the days that confirmed them, its snapshot is one more day
    own = F.transform("observed", lambda o: F.struct(o["day"].alias("day"), F.lit(0).alias("prio"), F.struct(
        *[F.when(o["known"].bitwiseAND(F.lit(1 << i)) != 0, F.col(c)).alias(c) for i, c in enumerate(attrs)]).alias("row")))
    fresh = F.array(F.struct(F.lit(as_of).alias("day"), F.lit(1).alias("prio"), F.col("__staged").alias("row")))
    apart = rows.where(redo | (~F.col("__version") & ~F.coalesce("__known_key", F.lit(False)))).select(
        key, *over, F.explode(F.when(F.col("__version"), own).otherwise(fresh)).alias("__o"))
    apart = apart.select(key, *over, F.col("__o.day").alias("__day"), F.col("__o.prio").alias("__prio"), *[F.col(f"__o.row.{c}").alias(c) for c in attrs])
    out = kept.select(*versions.columns, *over).unionByName(scd_history(apart, key, type2, versions, list(over)))
    return out.select(*[F.coalesce(f"__t1_{c}", c).alias(c) if c in type1 else F.col(c) for c in versions.columns])


def changed_or_new(current: DataFrame, staged: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Staged rows whose key has no current row or whose attributes differ."""
    cur = current.filter(F.col("is_current")).select(key, *[F.col(c).alias(f"__c_{c}") for c in cols])
    j = staged.join(cur, key, "left")
    differs = F.col(f"__c_{cols[0]}").isNull()
    for c in cols:
        differs = differs | F.coalesce(F.col(c) != F.col(f"__c_{c}"), F.lit(False))
    return j.filter(differs).select(*staged.columns)


def upsert_facts(target: DataFrame, staged: DataFrame, now: _dt.datetime, key: list[str] = UPSERT_KEY,
                 only_if_changed: bool = True, traced: bool = False) -> DataFrame:
    """Keyed upsert of staged facts into the months they touch.

    Staged rows are first reduced to one per key (least by the remaining
    columns); grouping takes null keys as equal, as the null-safe match (``<=>``)
    after it does, so reloads stay idempotent with a null category. Matched rows take the staged summa,
    cnt and the load time (only where summa differs when ``only_if_changed``);
    weight and period keep the stored value. Unmatched staged rows are inserted.
    Returns the new content of the touched month partitions only. ``traced`` adds what the
    upsert did to a row: ``old_summa`` and ``old_cnt`` (null for an insert) and ``changed``.

    Written as a left join from the table (AQE can split a hot key on that
    side) plus an anti join of the staged rows against the table's distinct
    keys (a hot key collapses map-side), not as a full outer join, which AQE
    cannot split. Both are asked to be sort-merged: staged rows and keys grow with the
    table, and the size of their files would let Catalyst broadcast them through the driver.
    """
    rest = [c for c in staged.columns if c not in key]
    s = staged.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r")).select(*key, "__r.*").select(*staged.columns)
    months = s.select("period_idx").distinct()
    t = target.join(F.broadcast(months), "period_idx", "left_semi")  # month count: small
    ss = s.select(*[F.col(c).alias(f"s_{c}") for c in s.columns], F.lit(1).alias("s__m")).hint("merge")

    def on(left: DataFrame, right_prefix: str) -> Column:
        cond: Column = F.lit(True)
        for k in key:
            cond = cond & left[k].eqNullSafe(F.col(f"{right_prefix}{k}"))
        return cond

    j = t.join(ss, on(t, "s_"), "left")
    matched = F.col("s__m").isNotNull()
    changed = F.col("summa") != F.col("s_summa") if only_if_changed else F.lit(True)
    upd = matched & F.coalesce(changed, F.lit(False))
    kept = j.select(*[
        F.when(upd, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in ("summa", "cnt")
        else F.when(upd, F.lit(now)).otherwise(F.col(c)).alias(c) if c == "loaded_at"
        else F.col(c)
        for c in target.columns
    ], *([F.col("summa").alias("old_summa"), F.col("cnt").alias("old_cnt"), upd.alias("changed")] if traced else []))
    t_keys = t.select(*[F.col(k).alias(f"t_{k}") for k in key]).distinct().hint("merge")
    new = s.join(t_keys, on(s, "t_"), "left_anti")
    inserted = new.select(*[
        F.lit(now).alias(c) if c == "loaded_at" and c not in new.columns else F.col(c) for c in target.columns
    ], *([F.lit(None).cast(target.schema[c].dataType).alias(f"old_{c}") for c in ("summa", "cnt")] + [F.lit(True).alias("changed")] if traced else []))
    return kept.unionByName(inserted)


def kpi_delta(traced: DataFrame) -> DataFrame:
    """Signed changes of the KPI aggregate from a traced upsert: new values less replaced ones, by group.

    Only changed rows are read. An update keeps the stored weight, so only inserts add to it.
    """
    rows = traced.where("changed")
    none = F.lit(0)
    return rows.groupBy(*KPI_KEY).agg(
        F.sum(F.col("summa") - F.coalesce("old_summa", none)).alias("revenue"),
        F.sum(F.col("cnt") - F.coalesce("old_cnt", none)).alias("operations"),
        F.sum(F.when(F.col("old_summa").isNull(), F.col("weight"))).alias("total_weight"),
    )


def apply_kpi_delta(kpi: DataFrame, delta: DataFrame) -> DataFrame:
    """The KPI groups of the months that a delta touches, with it added; a sum of both, no join."""
    months = F.broadcast(delta.select("period_idx").distinct())  # a month list
    cols = [*KPI_KEY, "revenue", "operations", "total_weight"]
    both = kpi.select(*cols).join(months, "period_idx", "left_semi").select(*cols).unionByName(delta.select(*cols))
    types = dict(kpi.dtypes)
    return both.groupBy(*KPI_KEY).agg(*[F.sum(c).cast(types[c]).alias(c) for c in ("revenue", "operations", "total_weight")])


def refresh_kpi(fact: DataFrame, touched_months: DataFrame) -> DataFrame:
    """The KPI aggregate (A3) recomputed for the touched months only."""
    from branchbook.operators.aggregates import kpi_aggregate

    return kpi_aggregate(fact.join(F.broadcast(touched_months.select("period_idx").distinct()), "period_idx", "left_semi"))


def upsert_last_wins(current: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """E5: one row per key, the one with the latest ``order`` value (map-side combined)."""
    u = current.unionByName(new)
    others = [c for c in u.columns if c != key]
    return u.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("__r")).select(
        key, *[F.col(f"__r.{c}").alias(c) for c in others]
    )


def current_adjustments(adjustments: DataFrame, key: list[str] = UPSERT_KEY) -> DataFrame:
    """The latest adjustment per fact key."""
    return adjustments.groupBy(*key).agg(F.max_by("adjusted_summa", "adjusted_at").alias("adjusted_summa"))


def adjusted_values(fact: DataFrame, adjustments: DataFrame, key: list[str] = UPSERT_KEY) -> DataFrame:
    """Per fact key, original sum and current value (latest adjustment, else original)."""
    per_key = fact.groupBy(*key).agg(F.sum("summa").alias("original_summa"))
    adj = current_adjustments(adjustments, key)
    cond = [per_key[k].eqNullSafe(adj[k]) for k in key]
    j = per_key.join(adj, cond, "left").select(
        *[per_key[k] for k in key], "original_summa", adj["adjusted_summa"]
    )
    return j.withColumn("current_summa", F.coalesce("adjusted_summa", "original_summa")).withColumn(
        "is_adjusted", F.col("adjusted_summa").isNotNull()
    )


def date_dimension(lo: _dt.date, hi: _dt.date, holidays: DataFrame | None = None, spark=None) -> DataFrame:
    """One row per day from ``lo`` to ``hi`` with calendar attributes."""
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    d = spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("date_id"))
    m = F.month("date_id")
    out = d.select(
        "date_id",
        F.year("date_id").alias("year"),
        F.quarter("date_id").alias("quarter"),
        m.alias("month"),
        F.weekofyear("date_id").alias("week"),
        F.when(m.isin(12, 1, 2), SEASONS[0]).when(m.isin(3, 4, 5), SEASONS[1])
        .when(m.isin(6, 7, 8), SEASONS[2]).otherwise(SEASONS[3]).alias("season"),
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    h = holidays.select(F.col("date_id").alias("__h")).distinct()
    return out.join(checked_broadcast(h), out.date_id == h.__h, "left").withColumn(
        "is_holiday", F.col("__h").isNotNull()
    ).drop("__h")
