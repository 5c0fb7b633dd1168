"""Warehouse jobs: running twice equals running once; the gates raise."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from branchbook.operators import quality as q
from branchbook.operators import warehouse as wh
from branchbook.plans import catalog
from branchbook.plans.warehouse_jobs import branch_versions, load_day, load_time, loaded_fact
from branchbook.session import scratch_dir
from branchbook.sources import fixtures as fx
from branchbook.sources.star import star

SMALL = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def test_scd2_twice_equals_once(spark):
    s = star(spark, SMALL)
    d = load_day(spark, SMALL)
    once = wh.scd_merge(branch_versions(s), fx.stg_filials(s), "filial_id", ["filial_name"], [], d)
    twice = wh.scd_merge(once, fx.stg_filials(s), "filial_id", ["filial_name"], [], d)
    assert _rows(once) == _rows(twice)
    # a change on a later day closes the version the day before
    later = wh.scd_merge(once, fx.stg_filials(s).withColumn("filial_name", F.concat("filial_name", F.lit("!"))),
                         "filial_id", ["filial_name"], [], d + dt.timedelta(days=3))
    closed = later.filter(~F.col("is_current") & (F.col("valid_to") == F.lit(d + dt.timedelta(days=2))))
    assert closed.count() == fx.stg_filials(s).count()


def test_same_day_change_overwrites_open_version(spark):
    s = star(spark, SMALL)
    d = load_day(spark, SMALL)
    once = wh.scd_merge(branch_versions(s), fx.stg_filials(s), "filial_id", ["filial_name"], [], d)
    again = wh.scd_merge(once, fx.stg_filials(s).withColumn("filial_name", F.concat("filial_name", F.lit("?"))),
                         "filial_id", ["filial_name"], [], d)
    bad = again.filter(F.col("valid_to") < F.col("valid_from")).count()
    assert bad == 0


def test_upsert_twice_equals_once(spark):
    s = star(spark, SMALL)
    now = load_time(spark, SMALL)
    stg = fx.stg_operations(s, fx.last_months(s, 2))
    once = wh.upsert_facts(loaded_fact(spark, SMALL), stg, now)
    # the second run sees the first run's months in the table
    target = loaded_fact(spark, SMALL).join(once.select("period_idx").distinct(), "period_idx", "left_anti")
    target = target.unionByName(once)
    twice = wh.upsert_facts(target, stg, now)
    assert _rows(once) == _rows(twice)


def test_monthly_load_twice_equals_once(spark):
    from branchbook.sources.warehouse import monthly_load, new_root

    s = star(spark, SMALL)
    raw = fx.raw_operations(s)
    root = new_root(spark, "test_load")
    args = (raw, fx.stg_filials(s), s.dim_products(), load_day(spark, SMALL), load_time(spark, SMALL))
    monthly_load(spark, root, *args, min_rows=1000)
    first = _rows(spark.read.parquet(f"{root}/fact_operations"))
    monthly_load(spark, root, *args, min_rows=1000)
    assert _rows(spark.read.parquet(f"{root}/fact_operations")) == first
    wm = spark.read.parquet(f"{root}/etl_watermark").collect()
    assert len(wm) == 1 and wm[0].table_name == "fact_operations"


def test_preload_gate_raises_on_bad_file(spark):
    s = star(spark, SMALL)
    with pytest.raises(ValueError):
        q.assert_checks(q.preload_checks(fx.faulty_operations(s)))


def test_incremental_stream_rerun_changes_nothing(spark):
    from branchbook.streaming.incremental import run_incremental

    catalog.load_all()
    first = _rows(catalog.QUERIES["incremental_load"](spark, SMALL))
    second = _rows(catalog.QUERIES["fact_upsert"](spark, SMALL))
    assert first == second
    s = star(spark, SMALL)
    from branchbook.sources.warehouse import new_root, write_fact_months

    root = new_root(spark, "test_stream")
    fact_path = f"{root}/fact_operations"
    write_fact_months(loaded_fact(spark, SMALL), fact_path)
    stg = fx.stg_operations(s, fx.last_months(s, 2))
    stg.coalesce(1).write.parquet(f"{root}/landing/a")
    now = load_time(spark, SMALL)
    run_incremental(spark, f"{root}/landing/a", fact_path, f"{root}/ck", now, stg.schema)
    after_one = _rows(spark.read.parquet(fact_path))
    run_incremental(spark, f"{root}/landing/a", fact_path, f"{root}/ck", now, stg.schema)  # nothing new
    assert _rows(spark.read.parquet(fact_path)) == after_one


def test_upsert_with_null_keys_twice_equals_once(spark):
    """Two staged rows of one key with a null category do not multiply on reloads."""
    s = star(spark, SMALL)
    now = load_time(spark, SMALL)
    stg = fx.stg_operations(s, fx.last_months(s, 1)).withColumn("sender_category", F.lit(None).cast("string"))
    stg = stg.unionByName(stg.withColumn("cnt", F.col("cnt") + 1))
    target = loaded_fact(spark, SMALL)
    once = wh.upsert_facts(target, stg, now)
    rest = target.join(once.select("period_idx").distinct(), "period_idx", "left_anti")
    twice = wh.upsert_facts(rest.unionByName(once), stg, now)
    assert _rows(once) == _rows(twice)


def test_as_of_merge_equals_the_range_join(spark):
    """Null keys and dates, gaps, facts before and after all versions, hot keys, decimals; many slices."""
    from branchbook.operators.joins import as_of_merge

    versions = spark.range(40).selectExpr(
        "cast(id % 5 as int) as k", "date_add(date'2020-01-01', cast(id * 11 as int)) as valid_from",
        "date_add(date'2020-01-01', cast(id * 11 + if(id % 4 = 0, 20, 54) as int)) as valid_to", "concat('v', id) as name", "cast(id as decimal(9,2)) as rate")
    fact = spark.range(3000).selectExpr(
        "id", "cast(if(id % 17 = 0, null, if(id % 3 = 0, 2, id % 7)) as int) as k",
        "if(id % 19 = 0, null, date_add(date'2019-12-01', cast(pmod(id * 37, 600) as int))) as d", "cast(id as decimal(18,2)) as summa")
    v = versions.alias("v")
    plain = fact.join(v, (fact.k == F.col("v.k")) & (fact.d >= F.col("v.valid_from")) & (fact.d <= F.col("v.valid_to")), "left").drop(F.col("v.k"))
    got = as_of_merge(fact, versions, "k", "d")
    assert got.columns == plain.columns and got.schema["rate"].dataType == plain.schema["rate"].dataType
    key = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert key(got.collect()) == key(plain.collect())
    assert as_of_merge(fact, versions.limit(0), "k", "d").where("name is null").count() == 3000
    assert as_of_merge(fact.limit(0), versions, "k", "d").count() == 0


def test_as_of_merge_of_a_key_with_many_versions(spark):
    """10,000 versions of one key: each fact stays one row, with no join on the key."""
    from branchbook.operators.joins import point_in_time

    versions = spark.range(10_000).selectExpr("1 as k", "date_add(date'1990-01-01', cast(id as int)) as valid_from",
                                              "date_add(date'1990-01-01', cast(id as int)) as valid_to", "id as version")
    fact = spark.range(20_000).selectExpr("1 as k", "date_add(date'1989-12-01', cast(id % 12000 as int)) as d", "id")
    got = point_in_time(fact, versions, "k", "d")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    rows = got.collect()
    assert len(rows) == 20_000
    for r in rows:
        day = r.id % 12000 - 31
        assert r.version == (day if 0 <= day < 10_000 else None)


def test_snapshots_in_any_order_give_one_table(spark):
    """All orders of four snapshots and a repeated one, with nulls, missing and new keys; intervals neither overlap nor gap."""
    import itertools

    base = spark.createDataFrame([(k, f"n{k}", "a", "x") for k in range(6)], "k int, name string, kind string, region string")
    days = [dt.date(2020, m, 1) for m in (2, 4, 6, 8)]
    kinds = ["ab-aab", "babba-", "bb-baa", "aabbab"]  # by day: one kind per key, - for unknown
    snaps = {
        d: spark.createDataFrame([(k, f"n{k}@{d.month}", None if c == "-" else c) for k, c in enumerate(row) if (k + d.month) % 5]
                                 + ([(9, f"new@{d.month}", "z")] if d.month > 3 else []), "k int, name string, kind string")
        for d, row in zip(days, kinds)
    }

    def after(order):
        v = wh.observed_versions(wh.initial_versions(base), "k")
        for d in order:
            v = wh.scd_merge_any_order(v, snaps[d], "k", ["kind"], ["name"], d).checkpoint()
        return v

    scratch_dir(spark)
    in_order = _rows(after(days))
    orders = list(itertools.permutations(days))
    for order in [orders[-1], [*orders[10], orders[10][0], orders[10][2]]]:
        assert _rows(after(order)) == in_order
    # in order and without unknown values it is what the plain merge makes
    plain = wh.initial_versions(base)
    for d in days:
        plain = wh.scd_merge(plain, snaps[d], "k", ["kind"], ["name"], d)
    same = [c for c in plain.columns if c not in ("name",)]
    assert _rows(after(days).select(same)) == _rows(plain.select(same))
    spans = {}
    for r in after(orders[-1]).orderBy("k", "valid_from").collect():
        assert r.valid_from <= r.valid_to
        if r.k in spans:
            assert spans[r.k] == r.valid_from - dt.timedelta(days=1)
        spans[r.k] = r.valid_to
    assert set(spans.values()) == {wh.OPEN_END}


def test_kpi_delta_equals_a_recomputation(spark):
    """Changed, equal, new and null-keyed staged rows; only changed rows enter the delta."""
    from branchbook.operators.aggregates import kpi_aggregate

    s = star(spark, SMALL)
    fact = loaded_fact(spark, SMALL)
    staged = fx.stg_operations(s, fx.last_months(s, 2))
    staged = staged.unionByName(staged.limit(3).withColumn("sender_category", F.lit(None).cast("string")))
    traced = wh.upsert_facts(fact, staged, load_time(spark, SMALL), traced=True)
    merged = wh.upsert_facts(fact, staged, load_time(spark, SMALL))
    assert _rows(traced.drop("old_summa", "old_cnt", "changed")) == _rows(merged)
    delta = wh.kpi_delta(traced)
    changed = traced.where("changed").count()
    assert 0 < delta.count() <= changed < merged.count()
    want = kpi_aggregate(merged)
    got = wh.apply_kpi_delta(kpi_aggregate(fact), delta)
    assert got.dtypes == kpi_aggregate(fact).dtypes and _rows(got) == _rows(want)
    again = wh.upsert_facts(merged, staged, load_time(spark, SMALL), traced=True)
    assert wh.kpi_delta(again).count() == 0


def test_a_load_cut_off_anywhere_is_undone_or_finished(spark, monkeypatch):
    """Before the commit mark nothing changes; after it the next load publishes the rest, once."""
    from branchbook.sources import warehouse as sw

    s = star(spark, SMALL)
    raw = fx.raw_operations(s)
    last = f"{(fx.last_months(s, 1) - 1) // 12}_{(fx.last_months(s, 1) - 1) % 12 + 1}"
    changed = raw.where(F.col("PERIOD") == last).withColumn("SUMMA", (F.col("SUMMA") + 1).cast("decimal(18,2)"))
    root = sw.new_root(spark, "test_cut")
    day, now = load_day(spark, SMALL), load_time(spark, SMALL)

    def load(landed, at):
        sw.monthly_load(spark, root, landed, fx.stg_filials(s), s.dim_products(), day, at, min_rows=1)

    def state():
        return [_rows(spark.read.parquet(f"{root}/{sw.PUBLISHED[p]}")) for p in ("fact", "kpi", "watermark")]

    load(raw, now)
    before = state()
    boom = RuntimeError("killed")

    def fail(*a, **k):
        raise boom

    with monkeypatch.context() as m:  # before the mark
        m.setattr(sw, "_publish", fail)
        m.setattr(sw, "_COMMITTED", "not-the-mark")
        with pytest.raises(RuntimeError):
            load(changed, now + dt.timedelta(hours=1))
    assert sw.recover(spark, root) == 0 and state() == before
    with monkeypatch.context() as m:  # after the mark, when the fact is written and the KPI is not
        write = sw.write_fact_months
        m.setattr(sw, "write_fact_months", lambda df, path: fail() if "kpi" in path else write(df, path))
        with pytest.raises(RuntimeError):
            load(changed, now + dt.timedelta(hours=2))
    assert sw.recover(spark, root) == 1
    after = state()
    assert after != before and sw.recover(spark, root) == 0
    from branchbook.operators.aggregates import kpi_aggregate

    assert after[1] == _rows(kpi_aggregate(spark.read.parquet(f"{root}/fact_operations")))
    load(changed, now + dt.timedelta(hours=2))  # the same input again
    assert state() == after
    assert not sw._files(spark, f"{root}/_redo")


def test_source_key_follows_the_files(spark, tmp_path):
    """A changed, added or touched part file of a partitioned input gives another warehouse copy."""
    import os
    import shutil

    from branchbook.sources.star import _source_key

    for t in ("region", "nation"):
        os.makedirs(tmp_path / f"{t}.parquet")
        shutil.copy(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet" / "part-0.parquet")
    one = _source_key(spark, str(tmp_path))
    assert one == _source_key(spark, str(tmp_path)) == _source_key(spark, f"file://{tmp_path}")
    shutil.copy(f"{SMALL}/nation.parquet", tmp_path / "nation.parquet" / "part-1.parquet")
    two = _source_key(spark, str(tmp_path))
    os.utime(tmp_path / "nation.parquet" / "part-1.parquet", (1, 1))
    assert len({one, two, _source_key(spark, str(tmp_path))}) == 3


def test_adjustment_stream_in_any_order(spark):
    """Files out of order, replayed and landing between runs give the batch result."""
    from branchbook.sources.warehouse import new_root
    from branchbook.streaming import adjustments as adj

    events = spark.range(300).selectExpr(
        "date_add(date'2020-01-01', cast(id % 7 as int)) as operation_date", "cast(id % 5 as int) as filial_id", "id % 3 as inc_gk",
        "if(id % 4 = 0, null, 'B2B') as sender_category", "cast(pmod(id * 37, 101) as decimal(18,2)) as adjusted_summa",
        "concat('R', id % 6) as reason_code", "timestamp'2020-02-01 00:00:00' + make_interval(0, 0, 0, cast(pmod(id * 13, 50) as int)) as adjusted_at")
    want = _rows(adj.latest_adjustments(events))
    for order in ((0, 1, 2, 3, 4, 5), (5, 3, 4, 0, 1, 2, 5, 0)):
        root = new_root(spark, "test_adjustments")
        for i, part in enumerate(order):
            events.where(F.col("reason_code") == f"R{part}").coalesce(1).write.mode("append").parquet(f"{root}/landing")
            if i in (2, 3, len(order) - 1):  # runs in between
                adj.run_adjustments(spark, f"{root}/landing", f"{root}/changes", f"{root}/ck", files_per_batch=1)
        assert _rows(adj.current_state(spark, f"{root}/changes").select(*adj.latest_adjustments(events).columns)) == want


def test_model_document_round_trip(spark, tmp_path):
    from branchbook.operators.ml import model_document
    from branchbook.sources.warehouse import write_report

    metrics = spark.createDataFrame([("RF", "KFold(n_splits=5)", 23, "lag1,lag2", 0.5, 0.1, 2.0, 0.2, 3.0, None)],
                                    "model string, cv_method string, n_samples bigint, features string, r2_mean double, r2_std double, "
                                    "mae_mean double, mae_std double, rmse_mean double, rmse_std double")
    imp = spark.createDataFrame([("lag2", 0.25), ("lag1", 0.75)], "feature string, importance double")
    doc = model_document(metrics, imp)
    write_report(doc, str(tmp_path / "r"))
    got = spark.read.schema(doc.schema).json(str(tmp_path / "r")).first()
    assert got == doc.first()
    assert got.metrics.r2.mean == 0.5 and got.metrics.rmse.std is None
    assert got.feature_importances == {"lag1": 0.75, "lag2": 0.25} and got.cross_validation.features == ["lag1", "lag2"]


def test_report_files_hold_the_checks(spark, tmp_path):
    """The gate's report file, read back, is the checks table."""
    from branchbook.sources.warehouse import write_report

    checks = q.preload_checks(fx.faulty_operations(star(spark, SMALL)))
    write_report(checks, str(tmp_path / "checks"))
    assert _rows(spark.read.schema(checks.schema).json(str(tmp_path / "checks"))) == _rows(checks)
