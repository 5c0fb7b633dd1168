"""Edge cases on small literal frames (null, tie, zero divisor, one row, gaps)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchbook.functions.periods import period_index, period_start, raw_date
from branchbook.operators import features as fe
from branchbook.operators import quality as q
from branchbook.operators import revenue as rv
from branchbook.operators.quantiles import exact_quantiles
from branchbook.operators.windows import running_total

FACT_SCHEMA = (
    "filial_id int, inc_gk bigint, operation_date date, period string, period_idx int, "
    "sender_category string, weight decimal(10,3), cnt int, summa decimal(18,2)"
)
DIM = "filial_id int, filial_name string, region string"


def fact_row(fid, year, month, summa, day=1, gk=1):
    d = dt.date(year, month, day)
    return (fid, gk, d, f"{year}_{month}", year * 12 + month, "B2B", Decimal("1.000"), 1, Decimal(str(summa)))


def dims(spark, ids):
    return spark.createDataFrame([(i, f"B{i}", "R") for i in ids], DIM)


def test_first_month_has_blank_mom_and_normal_flag(spark):
    f = spark.createDataFrame([fact_row(1, 2001, 1, "100.00")], FACT_SCHEMA)
    r1 = rv.rolling_revenue(f, dims(spark, [1])).collect()[0]
    assert r1.mom_change_pct is None and r1.is_star is False
    r4 = rv.revenue_volatility(f, dims(spark, [1])).collect()[0]
    assert r4.z_score is None and r4.volatility_cv_pct is None and r4.anomaly_flag == "normal"


def test_previous_month_zero_gives_blank_mom(spark):
    f = spark.createDataFrame([fact_row(1, 2001, 1, "0.00"), fact_row(1, 2001, 2, "50.00")], FACT_SCHEMA)
    rows = {r.period: r for r in rv.rolling_revenue(f, dims(spark, [1])).collect()}
    assert rows["2001_2"].mom_change_pct is None


def test_ties_share_a_dense_rank(spark):
    f = spark.createDataFrame(
        [fact_row(1, 2001, 1, "10.00"), fact_row(2, 2001, 1, "10.00"), fact_row(3, 2001, 1, "5.00")], FACT_SCHEMA
    )
    ranks = {r.filial_id: r.revenue_rank for r in rv.rolling_revenue(f, dims(spark, [1, 2, 3])).collect()}
    assert ranks == {1: 1, 2: 1, 3: 2}


def test_month_order_is_calendar_not_text(spark):
    df = spark.createDataFrame([("2001_9",), ("2001_10",)], "p string")
    got = [r.p for r in df.orderBy(period_index("p")).collect()]
    assert got == ["2001_9", "2001_10"]


def test_both_period_spellings_normalise(spark):
    df = spark.createDataFrame([("2025_3",), ("2025-03",)], "p string")
    assert {r.d for r in df.select(period_start("p").alias("d")).collect()} == {dt.date(2025, 3, 1)}


def test_two_digit_years(spark):
    df = spark.createDataFrame([("31.03.95",), ("04.11.01",), ("01.01.69",)], "t string")
    got = [r.d for r in df.select(raw_date("t").alias("d")).collect()]
    assert got == [dt.date(1995, 3, 31), dt.date(2001, 11, 4), dt.date(2069, 1, 1)]


def test_row_rules_quarantine(spark):
    rows = [
        (1, "B", "X", "2023-06", 100.0, 10, "North"),
        (1, "B", "X", "06-2023", 100.0, 10, None),
        (1, "B", "X", "2023-01", -500.0, 5, None),
        (1, "B", "X", "2023-01", float("nan"), 5, None),
        (1, "B", "X", "2023-1", 1.0, 5, None),
    ]
    df = spark.createDataFrame(rows, "filial_id int, filial_name string, service_type string, period string, "
                                     "revenue double, operations_count bigint, region string")
    valid, bad = q.split_valid(df)
    assert valid.count() == 2
    errs = sorted(tuple(r.errors) for r in bad.collect())
    assert errs == [("period",), ("revenue",), ("revenue",)]


def test_keyed_dedup_keeps_null_keys_and_first_row(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 3), (None, "a", 1), (None, "a", 1)], "k int, k2 string, v int"
    )
    got = sorted(((r.k is None, r.k or 0), r.v) for r in q.dedup_keyed(df, ["k", "k2"], ["v"]).collect())
    assert got == [((False, 1), 3), ((True, 0), 1), ((True, 0), 1)]


def test_lag_frame_needs_two_periods(spark):
    df = spark.createDataFrame([(1, "2001-01", 5.0), (2, "2001-02", 6.0)], "filial_id int, period string, revenue double")
    with pytest.raises(ValueError):
        fe.lag_frame(fe.temporal_features(df))


def test_exact_quantiles_match_numpy_when_bracketing(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.lognormal(3, 1, 5000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(4)
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert np.allclose(got, np.quantile(vals, [0.25, 0.5, 0.75]), rtol=0, atol=1e-9)


def test_exact_quantiles_hot_value(spark):
    vals = [1.0] * 3000 + [float(i) for i in range(2, 1002)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    got = exact_quantiles(df, "x", [0.5])
    assert got[0] == float(np.quantile(vals, 0.5))


def test_running_total_equals_cumsum(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(1, 50, 800)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(vals)], "k int, v bigint")
    out = running_total(df, "v", [F.desc("v"), F.asc("k")], partitions=5).collect()
    order = sorted(range(len(vals)), key=lambda i: (-vals[i], i))
    expect = {}
    acc = 0
    for i in order:
        acc += int(vals[i])
        expect[i] = acc
    assert {r.k: r.running for r in out} == expect


def test_rfm_high_is_good_flips_scores(spark):
    f = spark.createDataFrame(
        [fact_row(i, 2001, 11, f"{10 * i}.00", day=i) for i in range(1, 6)], FACT_SCHEMA
    )
    as_of = dt.date(2001, 11, 10)
    a = {r.filial_id: r.m_score for r in rv.rfm_scores(f, dims(spark, range(1, 6)), as_of).collect()}
    b = {r.filial_id: r.m_score for r in rv.rfm_scores(f, dims(spark, range(1, 6)), as_of, high_is_good=True).collect()}
    assert a[5] == 1 and b[5] == 5


def test_exact_quantiles_hot_value_at_the_bracket_edge(spark):
    # a third of the rows hold one value and the median falls just past it
    vals = [5.0] * 2000 + [float(i) for i in range(6, 4007)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.3333])
    assert np.allclose(got, np.quantile(vals, [0.25, 0.5, 0.3333]))


def test_feature_columns_present(spark):
    from branchbook.plans.enrichment import contract_frame

    c = contract_frame(spark, "/root/testdata/sf0.001").select("filial_id", "period", "revenue", "operations_count")
    out = fe.interaction_features(fe.temporal_features(c))
    for col in ("month", "quarter", "year", "revenue_per_filial", "concentration_ratio", "revenue_share"):
        assert col in out.columns, col
    scaled = fe.standardise(out, ["revenue", "operations_count"])
    assert {"revenue_scaled", "operations_count_scaled"} <= set(scaled.columns)
    assert scaled.count() == c.count()


@pytest.mark.parametrize("kind", ["decimal(28,2)", "bigint", "double"])
def test_running_total_of_many_rows_with_one_exchange(spark, kind):
    """Negative values, nulls and ties; 600,000 rows against the window over one partition."""
    from pyspark.sql import Window

    df = spark.range(600_000).selectExpr("id as k", f"cast(if(id % 11 = 0, null, cast(pmod(id * 7919, 100003) - 30000 as decimal(18,2)) / 4) as {kind}) as v")
    order = [F.desc("v"), F.asc("k")]
    got = running_total(df, "v", order)
    window = F.sum(F.coalesce("v", F.lit(0).cast(kind))).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    expect = df.select("k", window.alias("expect"))
    off = got.join(expect, "k").where(F.abs(F.col("running") - F.col("expect")) > (1e-3 if kind == "double" else 0))
    assert got.count() == 600_000 and off.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.splitlines() if "Exchange" in line]
    assert "rangepartitioning" not in plan and len(rows) == 3  # after the stored slices: one row per slice, then its broadcast


def test_running_total_refuses_to_wrap_around(spark):
    df = spark.createDataFrame([(1, 2**62), (2, 2**62), (3, 1)], "k int, v bigint")
    with pytest.raises(Exception, match="beyond 64 bits"):
        running_total(df, "v", [F.asc("k")], partitions=1)


def test_running_total_with_further_columns(spark):
    """The slices of both steps are the same rows whatever columns travel along."""
    df = spark.range(20000).selectExpr("id as k", "cast(pmod(id * 7919, 1009) as bigint) as v", "concat('n', id) as name", "id % 3 as c").repartition(7)
    rows = running_total(df, "v", [F.desc("v"), F.asc("k")], partitions=6).collect()
    rows.sort(key=lambda r: (-r["v"], r["k"]))
    total = 0
    for r in rows:
        total += r["v"]
        assert r["running"] == total


def test_order_statistics(spark):
    from branchbook.operators.quantiles import order_statistics

    df = spark.createDataFrame([(float(v % 700),) for v in range(2000)], "x double")
    ranks = [0, 3, 999, 1000, 1999]
    expect = sorted(float(v % 700) for v in range(2000))
    assert order_statistics(df, "x", ranks) == {r: expect[r] for r in ranks}


def test_quantiles_of_several_columns_in_four_passes(spark, monkeypatch):
    """Signs, tiny and huge values, hot values, nulls, NaN and empty columns; the passes don't grow with any of them."""
    from branchbook.operators import quantiles as qn

    rng = np.random.default_rng(12)
    wide = np.concatenate([rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000), [-0.0, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]])
    hot = np.where(rng.random(len(wide)) < 0.7, -3.25, rng.normal(size=len(wide)))
    rows = [(float(a), float(b), None, float("nan") if i % 9 == 0 else (None if i % 7 == 0 else float(i))) for i, (a, b) in enumerate(zip(wide, hot))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    passes = []
    once = qn._histograms
    monkeypatch.setattr(qn, "_histograms", lambda *a: passes.append(1) or once(*a))
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = qn.column_quantiles(df, {"a": probs, "b": probs, "c": [0.5], "d": [0.5]})
    assert len(passes) == 4
    a = np.sort(wide)
    assert got["a"][0] == a[0] and got["a"][-1] == a[-1] and got["a"][2] == np.quantile(a, 0.25)
    assert np.allclose(got["b"], np.quantile(hot, probs), rtol=0, atol=1e-12)
    assert got["c"] == [None]
    assert got["d"] == [float(np.median([i for i in range(len(wide)) if i % 9 and i % 7]))]
    assert qn.column_quantiles(df.limit(0), {"a": [0.5]}) == {"a": [None]}


def test_preload_checks_report_missing_columns(spark):
    from branchbook.operators.quality import preload_checks

    df = spark.createDataFrame([("a", 1)], "FILIAL string, other int")
    got = {r.check_name: r for r in preload_checks(df).collect()}
    assert got["missing_columns"].value > 0 and not got["missing_columns"].passed
    assert got["key_nulls"].passed is False and got["negative_summa"].passed is False


def test_stage_keeps_the_earliest_copy(spark, tmp_path):
    from branchbook.sources.warehouse import stage

    rows = [("k", 1, f"f{i % 5}", 0, i) for i in range(200)] + [("z", 2, "f9", 0, 7)]
    df = spark.createDataFrame(rows, "key string, v int, ingest_file string, ingest_block bigint, ingest_seq bigint").repartition(6)
    assert stage(df, str(tmp_path / "s")) == {"rows_in": 201, "rows_staged": 2}
    got = {r.key: (r.ingest_file, r.ingest_seq) for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert got == {"k": ("f0", 0), "z": ("f9", 7)}
