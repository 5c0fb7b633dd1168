"""Invariants of the models that have no SQL oracle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from branchbook.operators import ml
from branchbook.plans import catalog

SMALL = "/root/testdata/sf0.001"


def _frame(spark, n=3000, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, float(v), float(c)) for i, (v, c) in enumerate(zip(rng.normal(100, 10, n), rng.normal(50, 5, n)))]
    rows.append((n, 10_000.0, 5_000.0))  # far out
    return spark.createDataFrame(rows, "id int, SUMMA double, CNT double")


def test_isolation_forest_flags_share_and_planted_outlier(spark):
    df = _frame(spark)
    out = ml.isolation_forest(df, ["SUMMA", "CNT"], n_trees=50, id_cols=["id"])
    n = df.count()
    flagged = out.filter(F.col("anomaly_iso") == -1).count()
    assert abs(flagged - 0.05 * n) <= 2
    assert out.filter(F.col("id") == 3000).first()["anomaly_iso"] == -1


def test_isolation_forest_same_seed_same_result_under_repartition(spark):
    df = _frame(spark)
    a = ml.isolation_forest(df, ["SUMMA", "CNT"], n_trees=20, id_cols=["id"])
    b = ml.isolation_forest(df.repartition(7), ["SUMMA", "CNT"], n_trees=20, id_cols=["id"])
    ja = {r.id: round(r.iso_score, 12) for r in a.collect()}
    jb = {r.id: round(r.iso_score, 12) for r in b.collect()}
    assert ja == jb


def test_avg_path_length_small_cases():
    got = ml.avg_path_length(np.array([1.0, 2.0, 256.0]))
    assert got[0] == 0.0 and got[1] == 1.0 and 10.2 < got[2] < 10.3


def test_kmeans_and_cluster_stats_cover_every_branch(spark):
    catalog.load_all()
    labels = catalog.QUERIES["kmeans_branches"](spark, SMALL).collect()
    clusters = {r.cluster for r in labels}
    assert clusters == {0, 1, 2}
    stats = catalog.QUERIES["cluster_stats"](spark, SMALL).collect()
    assert sum(r.filial_count for r in stats) == len(labels)
    from branchbook.sources.star import star

    total = star(spark, SMALL).fact().agg(F.sum("summa")).first()[0]
    assert abs(sum(r.total_revenue for r in stats) - float(total)) < 0.05


def test_forest_metrics_are_floats(spark):
    catalog.load_all()
    m = catalog.QUERIES["rf_forecast_cv"](spark, SMALL).first()
    for k in ("r2_mean", "mae_mean", "rmse_mean"):
        assert isinstance(m[k], float)
    imp = catalog.QUERIES["feature_importance"](spark, SMALL).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 0.01


def test_eda_run_trend_is_the_top_branch(spark):
    from branchbook.api import eda_run

    out = eda_run(spark, SMALL)
    top = catalog.QUERIES["top_branch"](spark, SMALL).first().filial_name
    trend = out["trend"].collect()
    assert len(trend) == 1 and trend[0].filial_name == top
    assert out["period_totals"].count() > 0


def test_analysis_run_returns_every_frame(spark):
    from branchbook.api import analysis_run

    out = analysis_run(spark, SMALL)
    assert set(out) == {"profile", "temporal_features", "interaction_features", "scaled_features",
                        "model_metrics", "feature_importances"}
    m = out["model_metrics"].first()
    assert m.n_samples > 0 and m.cv_method.startswith(("KFold", "LeaveOneOut"))
    assert out["profile"].first().total_rows > 0


def _tree_rows(df, n, trees=100):
    x = df.select("id", F.col("SUMMA").alias("__f0"))
    got = ml._tree_samples(x, ["__f0"], ["__f0"], n, trees, min(256, n), 42).groupBy("tree").count().collect()
    return [r["count"] for r in got]


def test_isolation_forest_every_tree_draws_its_own_sample_at_every_size(spark):
    for n in (100, 500, 6000, 60_000):
        df = spark.range(n).select("id", F.rand(3).alias("SUMMA"))
        assert _tree_rows(df, n) == [min(256, n)] * 100


def test_isolation_forest_samples_copies_in_proportion(spark):
    n = 150_000  # beyond the pool; a third of the rows are equal
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1.0)).otherwise(F.col("id").cast("double")).alias("__f0"))
    got = ml._tree_samples(df, ["__f0"], ["__f0"], n, 100, 256, 42).agg(F.avg((F.col("__f0") == -1.0).cast("int"))).first()[0]
    assert abs(got - 1 / 3) < 0.02


def test_isolation_forest_of_few_distinct_rows_samples_copies(spark):
    """Each of 300 rows occurs 200 times, spread over all tasks: copies come one by one, not as blocks."""
    n = 60_000
    df = spark.range(n).select((F.col("id") % 300).cast("double").alias("__f0")).repartition(8)
    got = ml._tree_samples(df, ["__f0"], ["__f0"], n, 60, 256, 42).groupBy("tree").agg(F.countDistinct("__f0"), F.count("*")).collect()
    assert all(r[2] == 256 for r in got)
    # of 300 values, 256 draws meet 300 * (1 - exp(-256 / 300)) = 172
    assert abs(np.mean([r[1] for r in got]) - 172) < 6


def test_isolation_sketches_leave_few_rows(spark):
    """No task hands on more than trees x psi rows, and all together about twice that."""
    n, trees, psi = 40_000, 20, 64
    x = spark.range(n).select(F.xxhash64("id").alias("__h"), F.col("id").cast("double").alias("__f0")).repartition(10)
    for limit, most in ((2**64 - 1, 10 * trees * psi), (int((2 * psi + 64) / n * 2**64), 3.5 * trees * psi)):
        got = x.mapInArrow(lambda it, limit=limit: ml._sketches(it, trees, psi, 1, limit, False), "g bigint, __f0 double, tree int")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id(), "tree").count().collect()]
        assert max(sizes) <= psi and trees * psi <= sum(sizes) <= most


def test_isolation_forest_of_an_empty_table_is_empty(spark):
    df = spark.createDataFrame([], "id int, SUMMA double, CNT double")
    out = ml.isolation_forest(df, ["SUMMA", "CNT"], id_cols=["id"])
    assert out.count() == 0 and out.columns == ["id", "SUMMA", "CNT", "iso_score", "anomaly_iso"]


def _best_split(x, y, w):
    """The largest drop of the weighted squared error over all features and cuts, in plain Python."""
    def sse(i):
        return float((w[i] * (y[i] - np.average(y[i], weights=w[i])) ** 2).sum()) if w[i].sum() else 0.0

    everything = np.arange(len(y))
    return max((sse(everything) - sse(everything[x[:, f] <= b]) - sse(everything[x[:, f] > b]), -f, -b)
               for f in range(x.shape[1]) for b in range(32) if w[x[:, f] <= b].sum() and w[x[:, f] > b].sum())


def test_tree_takes_the_best_split_and_fits_its_rows():
    from branchbook.operators.forest import Tree

    rng = np.random.default_rng(2)
    for seed in range(20):
        x = rng.integers(0, 32, (60, 3)).astype(np.uint8)
        y = rng.normal(size=60) + (x[:, 1] > 11)
        w = rng.poisson(1.0, 60)
        gain, f, b = _best_split(x, y, w)
        one = Tree(x, y, w, 1)
        assert one.feature[0] == -f and np.isclose(one.importance.sum(), gain)
        left = x[:, -f] <= one.bin[0]
        assert np.allclose(one.predict(x)[left], np.average(y[left], weights=w[left]))
        full = Tree(x, y, w, 30)
        alike = {tuple(r): np.average(y[(x == r).all(axis=1) & (w > 0)], weights=w[(x == r).all(axis=1) & (w > 0)]) for r in x[w > 0]}
        assert np.allclose(full.predict(x[w > 0]), [alike[tuple(r)] for r in x[w > 0]])
    flat = Tree(x, np.ones(60), w, 30)
    assert len(flat.feature) == 1 and flat.predict(x).tolist() == [1.0] * 60
    assert Tree(x, y, np.zeros(60, dtype=int), 5).predict(x).tolist() == [0.0] * 60


def test_local_forest_agrees_with_spark_ml(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(size=3)
        rows.append((i, float(a), float(b), float(c), float(10 * a + 3 * abs(b) + rng.normal())))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double")
    got = {}
    for limit in (100_000, 0):
        monkeypatch.setattr(ml, "LOCAL_FRAME", limit)
        m = ml.rf_cross_validate(df, ["a", "b", "c"], "y", ["id"], max_depth=10, trees=40).first()
        imp = {r.feature: r.importance for r in ml.rf_importances(df, ["a", "b", "c"], "y", max_depth=10, trees=40).collect()}
        got[limit] = (m.r2_mean, m.mae_mean, m.rmse_mean, imp["a"])
        assert abs(sum(imp.values()) - 1) < 0.001 and m.n_samples == 400
    assert np.allclose(got[100_000], got[0], rtol=0.06)
    monkeypatch.setattr(ml, "LOCAL_FRAME", 100_000)
    again = ml.rf_cross_validate(df.repartition(7), ["a", "b", "c"], "y", ["id"], max_depth=10, trees=40).first()
    assert (again.r2_mean, again.mae_mean, again.rmse_mean) == got[100_000][:3]
    few = ml.rf_cross_validate(df.limit(6), ["a", "b", "c"], "y", ["id"], trees=5).first()
    assert few.cv_method == "LeaveOneOut" and few.r2_mean is None and few.mae_mean > 0
