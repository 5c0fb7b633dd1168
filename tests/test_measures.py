"""BI measures on literal frames: bands with blanks, calendar prior period, labels, titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from branchbook.operators import measures as ms
from branchbook.operators.windows import centred_mean, prior_period


def test_kpi_colour_blank_counts_as_zero(spark):
    df = spark.createDataFrame([(None,), (0.05,), (0.0,), (-0.10,), (-0.2,)], "m double")
    got = [r.c for r in df.select(ms.kpi_colour("m").alias("c")).collect()]
    assert got == ["#F39C12", "#27AE60", "#F39C12", "#E67E22", "#C0392B"]


def test_product_status_bands(spark):
    df = spark.createDataFrame([(None,), (0.2,), (0.05,), (-0.05,), (-0.5,)], "g double")
    got = [r.s for r in df.select(ms.product_status("g").alias("s")).collect()]
    assert got == ["decline", "fast_growth", "growth", "decline", "crisis"]


def test_prior_period_is_blank_across_a_gap_unlike_lag(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (1, 4, 40.0)], "b int, period_idx int, v double")
    out = df.select(
        "period_idx",
        prior_period("v", ["b"]).alias("prior"),
        F.lag("v").over(Window.partitionBy("b").orderBy("period_idx")).alias("lag"),
    )
    rows = {r.period_idx: (r.prior, r.lag) for r in out.collect()}
    assert rows[2] == (10.0, 10.0) and rows[4] == (None, 20.0)


def test_segment_label_and_titles(spark):
    df = spark.createDataFrame(
        [("2001_1", "B1", "B2B"), ("2001_1", "B1", "B2C"), ("2001_2", "B2", "B2C")],
        "period string, filial_name string, sender_category string",
    )
    one = df.filter("filial_name = 'B2'").agg(ms.segment_label().alias("l"), *ms.titles()).first()
    assert one.l == "B2C" and one.title_executive == "Revenue - 2001_2 | B2"
    allrows = df.agg(ms.segment_label().alias("l"), *ms.titles()).first()
    assert allrows.l == "all" and allrows.title_executive == "Revenue - All periods"
    assert allrows.title_drillthrough == "Analytics - All branches"


def test_centred_mean_matches_pandas(spark):
    import numpy as np
    import pandas as pd

    x = np.arange(1.0, 11.0) ** 1.5
    w = 5
    expect = pd.Series(x).rolling(window=w, center=True, min_periods=1).mean().to_numpy()
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "b int, pos int, x double")
    got = [r.t for r in df.select("pos", centred_mean("x", ["b"], "pos", w).alias("t")).orderBy("pos").collect()]
    assert np.allclose(got, expect)


def test_welch_test_of_the_influencers(spark):
    """t and degrees of freedom against the textbook formula, from rows and from sums by account alike."""
    import numpy as np

    from branchbook.operators import dashboards as db

    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 3)), str(rng.choice(["a", "b", "c"])), f"{rng.normal(1e5, 3e4):.2f}", int(rng.integers(0, 20))) for _ in range(600)]
    rows += [(7, "only", "5.00", 1), (8, "x", "1.00", 1), (8, "y", "1.00", 1), (8, "y", "1.00", 2)]
    df = spark.createDataFrame(rows, "filial_id int, kind string, s string, account int").selectExpr("filial_id", "kind", "cast(s as decimal(18,2)) as summa", "account")
    summed = df.groupBy("filial_id", "kind", "account").agg(F.sum("summa").alias("summa"), F.count("*").alias("rows"), F.sum(db.cents_squared()).alias("squares"))
    for got in (db.influencers(df, ["kind"]), db.influencers(summed, ["kind"], rows="rows", squares="squares")):
        for r in got.collect():
            x = np.array([float(s) for f, k, s, _ in rows if f == r.filial_id and k == r.factor_value])
            y = np.array([float(s) for f, k, s, _ in rows if f == r.filial_id and k != r.factor_value])
            if min(len(x), len(y)) < 2:
                assert r.t_stat is None and r.welch_df is None
                continue
            a, b = x.var(ddof=1) / len(x), y.var(ddof=1) / len(y)
            assert np.isclose(r.t_stat, (x.mean() - y.mean()) / np.sqrt(a + b), rtol=1e-9)
            assert np.isclose(r.welch_df, (a + b) ** 2 / (a**2 / (len(x) - 1) + b**2 / (len(y) - 1)), rtol=1e-9)


def test_distinct_sketches_unite(spark):
    """Sketches of 40 groups unite to any slice with an error of a few percent; empty slices have none."""
    from branchbook.operators.aggregates import distinct_sketches, united_distinct

    df = spark.range(60_000).selectExpr("id % 40 as g", "cast(pmod(id * 7919, 20011) as bigint) as account")
    sk = distinct_sketches(df, ["g"], "account")
    assert sk.count() == 40
    for cond in ("g < 40", "g in (3, 4, 5)", "g = 7"):
        exact = df.where(cond).select("account").distinct().count()
        near = united_distinct(sk.where(cond), []).first().distinct_estimate
        assert abs(near / exact - 1) < 0.05
    assert united_distinct(sk.where("g > 99"), ["g"]).count() == 0
