"""Machine learning jobs.

* Isolation forest (Liu, Ting and Zhou, ICDM 2008) has no Spark ML class. The
  tree samples come from mergeable bottom-k sketches (one per tree and task, no
  shuffle of the rows), each tree is grown by ``applyInPandas`` on its 256 rows, the node table (at most trees x
  511 rows: a proven bound) is broadcast, and all rows are scored by a pandas
  UDF over the feature columns.
* K-means is Spark ML, on branches x months, cached for the repeated fits. The
  random forest grows all folds' trees in one job on frames of a checked size
  (``forest``) and is Spark ML beyond it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, rnd
from branchbook.session import stored

# Fixed values of the models.
N_TREES = 100
SAMPLE_SIZE = 256
CONTAMINATION = 0.05
SEED = 42
N_CLUSTERS = 3
N_STARTS = 10
RF_TREES = 100
RF_MAX_DEPTH = 30  # the most Spark allows
SPARE = 64  # isolation forest: draws that a sketch keeps beyond twice the sample
REPEATED = 1.1  # rows per distinct row above which a table counts as one of repeated rows
# Training knobs that change speed, not the model: cache node ids per row and let
# one pass over the data split more nodes at a time.
RF_SPEED = {"cacheNodeIds": True, "maxMemoryInMB": 1024}
LOCAL_FRAME = 100_000  # rows of a frame that a task may hold whole to grow trees from
FOREST_ROWS = 50_000  # rows of a partition that a forest is worth a task for
EULER_GAMMA = 0.5772156649015329


def avg_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): average path length of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, int]]:
    """One isolation tree as rows (feature, threshold, left, right, size); leaves have feature -1."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, False)]
    while stack:
        idx, depth, parent, is_right = stack.pop()
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx)])
        if parent >= 0:
            nodes[parent][3 if is_right else 2] = me
        if depth >= limit or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        nodes[me][0], nodes[me][1] = f, thr
        left = idx[sub[:, f] < thr]
        right = idx[sub[:, f] >= thr]
        stack.append((right, depth + 1, me, True))
        stack.append((left, depth + 1, me, False))
    return [tuple(n) for n in nodes]


NODE_SCHEMA = "tree int, node int, feat int, thr double, left int, right int, size int"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _sketches(batches: Iterator[pa.RecordBatch], n_trees: int, psi: int, seed: int, limit: int, by_place: bool) -> Iterator[pa.RecordBatch]:
    """One task's bottom-``psi`` sketch of every tree: (g, features, tree) of its least draws g below ``limit``.

    Column 0 holds the rows' hashes, the others the features. A row draws by its hash
    and the tree; further copies of it in a batch, and with ``by_place`` all rows, by
    their place in the task besides.
    """
    here = TaskContext.get().partitionId()
    stream = _mixed(np.arange(1, n_trees + 1, dtype=np.uint64) + np.uint64(seed << 20))
    sketch = [pa.table({}) for _ in range(n_trees)]
    names: list[str] = []
    at = 0
    for batch in batches:
        names = batch.schema.names
        h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        copy = np.ones(len(h), dtype=bool)
        if not by_place:
            copy[np.unique(h, return_index=True)[1]] = False
        place = _mixed(np.arange(at, at + len(h), dtype=np.uint64) + np.uint64((here + 1) << 40))
        h = np.where(copy, _mixed(h ^ place), h)
        at += len(h)
        for t in range(n_trees):
            g = _mixed(h ^ stream[t])
            low = np.flatnonzero(g <= np.uint64(limit))
            if not len(low):
                continue
            rows = pa.table({"g": (g[low] >> np.uint64(1)).astype(np.int64)} | {c: batch.column(c).take(pa.array(low)) for c in names[1:]})
            rows = pa.concat_tables([sketch[t], rows]) if sketch[t].num_rows else rows
            if rows.num_rows > 2 * psi:  # only the least psi stay
                rows = rows.take(pa.array(np.argsort(rows.column("g").to_numpy(), kind="stable")[:psi]))
            sketch[t] = rows
    for t, rows in enumerate(sketch):
        if rows.num_rows:
            order = np.argsort(rows.column("g").to_numpy(), kind="stable")[:psi]
            rows = rows.take(pa.array(order)).append_column("tree", pa.array(np.full(len(order), t, dtype=np.int32)))
            yield from rows.combine_chunks().to_batches()


def _tree_samples(x: DataFrame, fcols: list[str], id_cols: list[str], n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """(fcols, tree): ``psi`` of the ``n`` rows for each tree, drawn uniformly and on its own.

    Every row has a 64-bit draw for every tree, and a tree takes the rows of the least
    draws. Each task keeps the least ``psi`` of its rows for each tree and lets go of
    draws that can't be among the least of the whole table, so about twice
    trees x psi rows leave all tasks together, never more than trees x psi leave
    one, and rows are not shuffled. Draws come from the row's content, so the sample
    of distinct rows doesn't depend on order or partitions. In a table of repeated rows
    (told by a distinct-count sketch) every copy draws on its own, by its place.
    """
    hashed = x.select(F.xxhash64(*[F.col(c) for c in id_cols], F.lit(seed)).alias("__h"), *fcols)
    distinct = hashed.agg(F.approx_count_distinct("__h", 0.02)).first()[0]
    by_place = n > REPEATED * distinct
    schema = "g bigint, " + ", ".join(f"{c} double" for c in fcols) + ", tree int"
    order = Window.partitionBy("tree").orderBy("g", *fcols)
    share = min(1.0, (2 * psi + SPARE) / n)  # the least psi draws of n lie below twice their expected place
    for limit in dict.fromkeys([min(int(share * 2**64), 2**64 - 1), 2**64 - 1]):
        kept = hashed.mapInArrow(lambda it, limit=limit: _sketches(it, n_trees, psi, seed, limit, by_place), schema)
        picked = stored(kept.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= psi).select(*fcols, "tree"), "tree-samples")
        if picked.count() == n_trees * min(psi, n):
            break
    return picked


def isolation_forest(df: DataFrame, features: list[str], n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                     contamination: float = CONTAMINATION, seed: int = SEED, id_cols: list[str] | None = None
                     ) -> DataFrame:
    """M5: adds ``iso_score`` (higher = more anomalous) and ``anomaly_iso`` (-1 anomaly, 1 normal).

    Each tree draws min(``sample_size``, rows) rows without replacement, on its
    own, by a hash of row copy and tree (see ``_tree_samples``). Nulls in features
    count as 0. The threshold is the (1 - contamination) quantile of the score,
    exact. An empty table stays empty.
    """
    from branchbook.operators.quantiles import exact_quantiles

    spark = df.sparkSession
    x = df.withColumns({f"__f{i}": F.coalesce(dbl(c), F.lit(0.0)) for i, c in enumerate(features)})
    fcols = [f"__f{i}" for i in range(len(features))]
    n = df.count()
    if n == 0:
        return df.withColumn("iso_score", F.lit(None).cast("double")).withColumn("anomaly_iso", F.lit(1))
    psi = min(sample_size, n)
    limit = int(math.ceil(math.log2(max(psi, 2))))
    picked = _tree_samples(x, fcols, id_cols or df.columns, n, n_trees, psi, seed)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, t])
        rows = _grow(pdf[fcols].to_numpy(dtype=float), rng, limit)
        return pd.DataFrame(
            [(t, i, f, thr, l_, r_, s) for i, (f, thr, l_, r_, s) in enumerate(rows)],
            columns=["tree", "node", "feat", "thr", "left", "right", "size"],
        )

    nodes = picked.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()  # <= trees x (2 psi - 1) rows
    nodes = nodes.sort_values(["tree", "node"])
    trees = sorted(nodes["tree"].unique())
    width = int(nodes.groupby("tree")["node"].max().max()) + 1
    arr = {k: np.full((len(trees), width), -1 if k != "thr" else 0.0) for k in ("feat", "thr", "left", "right", "size")}
    for ti, t in enumerate(trees):
        sub = nodes[nodes["tree"] == t]
        for k in arr:
            arr[k][ti, sub["node"].to_numpy()] = sub[k].to_numpy()
    bc = spark.sparkContext.broadcast({k: v for k, v in arr.items()})
    c_psi = float(avg_path_length(np.array([psi]))[0])

    @F.pandas_udf("double")
    def score(f: pd.DataFrame) -> pd.Series:
        a = bc.value
        feat, thr, left, right, size = a["feat"], a["thr"], a["left"], a["right"], a["size"]
        xs = f.to_numpy(dtype=float)
        total = np.zeros(len(f))
        rows = np.arange(len(f))
        for ti in range(feat.shape[0]):
            node = np.zeros(len(f), dtype=int)
            depth = np.zeros(len(f))
            for _ in range(limit + 1):
                at = feat[ti, node].astype(int)
                inner = at >= 0
                if not inner.any():
                    break
                go_left = xs[rows, np.maximum(at, 0)] < thr[ti, node]
                nxt = np.where(go_left, left[ti, node], right[ti, node]).astype(int)
                node = np.where(inner, nxt, node)
                depth = depth + inner
            total += depth + avg_path_length(size[ti, node])
        mean_h = total / feat.shape[0]
        return pd.Series(np.power(2.0, -mean_h / c_psi) if c_psi > 0 else np.full(len(f), 0.5))

    # scored once: the quantile passes read the stored score column, not the forest
    scored = stored(x.withColumn("iso_score", score(F.struct(*fcols))).drop(*fcols), "isolation-scores")
    thr_v = exact_quantiles(scored, "iso_score", [1.0 - contamination])[0]
    return scored.withColumn("anomaly_iso", F.when(F.col("iso_score") > F.lit(thr_v), F.lit(-1)).otherwise(F.lit(1)))


def anomaly_summary(scored: DataFrame, value: str = "SUMMA", z_limit: float = 3.0,
                    contamination: float = CONTAMINATION) -> DataFrame:
    """M7: counts and revenue shares of both detectors, one row."""
    from branchbook.operators.quality import zscores

    z = zscores(scored, value)
    iso, zf = F.col("anomaly_iso") == -1, F.abs("z") > z_limit
    tot = dbl(F.sum(value))
    return z.agg(
        F.sum(F.when(iso, 1).otherwise(0)).cast("bigint").alias("iso_count"),
        rnd(F.lit(100.0) * dbl(F.sum(F.when(iso, F.col(value)))) / tot, 2).alias("iso_summa_share"),
        F.sum(F.when(zf, 1).otherwise(0)).cast("bigint").alias("z_count"),
        rnd(F.lit(100.0) * dbl(F.sum(F.when(zf, F.col(value)))) / tot, 2).alias("z_summa_share"),
    ).withColumns({"z_threshold": F.lit(z_limit), "contamination": F.lit(contamination)})


def branch_matrix(fact_named: DataFrame, periods: list[str], key: str = "filial_name") -> DataFrame:
    """Branch x period revenue matrix, missing = 0 (explicit period list: no extra job)."""
    return (
        fact_named.groupBy(key, "period").agg(F.sum("summa").alias("rev"))
        .groupBy(key).pivot("period", periods).agg(F.first(dbl("rev"))).fillna(0.0)
    )


def branch_vectors(fact_named: DataFrame, period_idx: list[int], key: str = "filial_name") -> DataFrame:
    """A9 as one dense array per branch: revenue by month (calendar order), missing = 0.

    Branch-months are summed first; each branch's months (bounded by the
    calendar) become a map that is read out along the month list, so no cross
    join of branches and months is needed.
    """
    bm = fact_named.groupBy(key, "period_idx").agg(dbl(F.sum("summa")).alias("rev"))
    per = bm.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("period_idx", "rev"))).alias("__m"))
    months = F.array(*[F.lit(int(i)) for i in period_idx])
    return per.select(key, F.transform(months, lambda p: F.coalesce(F.element_at("__m", p), F.lit(0.0))).alias("x"))


def standardise_vectors(vec: DataFrame, col: str = "x") -> DataFrame:
    """X3 on an array column: per position (x - mean) / population std, constant positions -> 0."""
    long = vec.select(F.posexplode(col).alias("__i", "__v"))
    st = long.groupBy("__i").agg(F.avg("__v").alias("mu"), F.stddev_pop("__v").alias("sd")).orderBy("__i").collect()
    mu = F.array(*[F.lit(float(r["mu"])) for r in st])  # one entry per month: bounded
    sd = F.array(*[F.lit(float(r["sd"] or 0.0)) for r in st])
    z = F.transform(col, lambda v, i: F.when(sd[i] == 0, F.lit(0.0)).otherwise((v - mu[i]) / sd[i]))
    return vec.withColumn("z", z)


def kmeans_branches(vec: DataFrame, key: str = "filial_name", k: int = N_CLUSTERS, starts: int = N_STARTS,
                    seed: int = SEED) -> tuple[DataFrame, float]:
    """M8: k-means of branches on the standardised branch x month vectors, best of
    ``starts`` seeds by cost (fitted concurrently). Labels are renumbered by
    mean branch revenue, descending (0 = highest). Returns (labels, inertia)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vec.count()
    if n < k:
        k = max(2, n - 1)
    data = standardise_vectors(vec).select(
        key, F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("__tot"), array_to_vector("z").alias("features")
    ).orderBy(key).cache()
    data.count()  # materialise once before the concurrent fits read it

    def fit(s: int):
        m = KMeans(k=k, seed=s, maxIter=300, tol=1e-6).fit(data)
        return m, m.summary.trainingCost, s

    try:
        # the starts are independent Spark jobs: submit them concurrently
        with ThreadPoolExecutor(max_workers=min(starts, 8)) as pool:
            fits = list(pool.map(fit, range(seed, seed + starts)))
        model, cost, _ = min(fits, key=lambda r: (r[1], r[2]))
        pred = model.transform(data).select(key, F.col("prediction").alias("raw_cluster"), "__tot")
        order = pred.groupBy("raw_cluster").agg(F.avg("__tot").alias("__m"))
        order = order.withColumn("cluster", (F.row_number().over(Window.orderBy(F.desc("__m"), "raw_cluster")) - 1).cast("int"))
        # one row per branch (a bounded dimension): fetched before the cache is released
        labels = pred.join(order, "raw_cluster").select(key, "cluster").toPandas()
    finally:
        data.unpersist()
    return vec.sparkSession.createDataFrame(labels, f"{key} string, cluster int"), float(cost)


def cluster_stats(fact_named: DataFrame, labels: DataFrame, key: str = "filial_name") -> DataFrame:
    """Per cluster: distinct branches, mean row revenue, total (rounded 2)."""
    j = fact_named.join(F.broadcast(labels), key, "left")
    return j.groupBy("cluster").agg(
        F.countDistinct(key).cast("bigint").alias("filial_count"),
        rnd(F.avg(dbl("summa")), 2).alias("avg_revenue"),
        rnd(dbl(F.sum("summa")), 2).alias("total_revenue"),
    )


def cv_folds(frame: DataFrame, id_cols: list[str], seed: int = SEED) -> tuple[DataFrame, int, str]:
    """Fold ids. n < 10: leave-one-out; else shuffled K-fold, k = min(5, n).

    The shuffle is a seeded hash order, ranked by a partitioned running total.
    """
    from branchbook.operators.windows import running_total

    n = frame.count()
    if n < 10:
        k, name = n, "LeaveOneOut"
    else:
        k = min(5, n)
        name = f"KFold(n_splits={k})"
    order = [F.xxhash64(*[F.col(c) for c in id_cols], F.lit(seed)), *[F.col(c) for c in id_cols]]
    ranked = running_total(frame.withColumn("__one", F.lit(1)), "__one", order, out="__rank")
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__one", "__rank"), k, name


def _by_size(df: DataFrame) -> DataFrame:
    """At least FOREST_ROWS rows a partition: each of a forest's many passes costs a task per partition."""
    return df.coalesce(max(1, df.count() // FOREST_ROWS))


def rf_cross_validate(frame: DataFrame, features: list[str], label: str, id_cols: list[str],
                      max_depth: int = RF_MAX_DEPTH, trees: int = RF_TREES, seed: int = SEED,
                      names: list[str] | None = None) -> DataFrame:
    """Random forest regression, K-fold R2 / MAE / RMSE mean and (population) std.

    Leave-one-out folds have no R2 (one held-out row), reported as null. Frames of up to
    LOCAL_FRAME rows grow the trees of all folds in one job (``forest``), larger ones
    are fitted by Spark ML fold by fold.
    """
    n = frame.count()
    folded, k, name = cv_folds(frame, id_cols, seed)
    fit = _cv_local if n <= LOCAL_FRAME else _cv_ml
    arr = fit(folded, features, label, id_cols, k, max_depth, trees, seed)
    if name == "LeaveOneOut":
        arr["r2"] = np.full(k, np.nan)

    def stat(m, fn, nd):
        v = arr[m]
        return None if np.isnan(v).all() else round(float(fn(v)), nd)

    row = ("RandomForestRegressor", name, int(n), ",".join(names or features),
           stat("r2", np.mean, 4), stat("r2", np.std, 4), stat("mae", np.mean, 2), stat("mae", np.std, 2),
           stat("rmse", np.mean, 2), stat("rmse", np.std, 2))
    schema = ("model string, cv_method string, n_samples bigint, features string, r2_mean double, r2_std double, "
              "mae_mean double, mae_std double, rmse_mean double, rmse_std double")
    return frame.sparkSession.createDataFrame([row], schema)


def _cv_local(folded: DataFrame, features: list[str], label: str, id_cols: list[str], k: int, max_depth: int, trees: int, seed: int) -> dict:
    """Metrics by fold, from predictions averaged over the fold's trees."""
    from branchbook.operators.forest import grown

    rows, y = grown(folded, features, label, "fold", id_cols, list(range(k)), trees, max_depth, seed)
    mean = rows.where("row is not null").groupBy("fold", "row").agg(F.avg("prediction").alias("p")).toArrow()  # a row for each of the frame's
    fold, at, p = (mean.column(c).to_numpy() for c in ("fold", "row", "p"))
    out: dict = {"r2": [], "mae": [], "rmse": []}
    for f in range(k):
        t, d = y[at[fold == f]], p[fold == f] - y[at[fold == f]]
        spread = float(((t - t.mean()) ** 2).sum())
        out["r2"].append(1.0 - float((d**2).sum()) / spread if spread else np.nan)
        out["mae"].append(float(np.abs(d).mean()))
        out["rmse"].append(float(np.sqrt((d**2).mean())))
    return {m: np.array(v) for m, v in out.items()}


def _cv_ml(folded: DataFrame, features: list[str], label: str, id_cols: list[str], k: int, max_depth: int, trees: int, seed: int) -> dict:
    """Metrics by fold from Spark ML fits, submitted concurrently."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    data = VectorAssembler(inputCols=features, outputCol="features").transform(
        folded.select(*features, F.col(label).cast("double").alias("label"), "fold")
    )
    data = _by_size(stored(data, "forest-folds")).cache()
    from concurrent.futures import ThreadPoolExecutor

    def run_fold(f: int) -> dict:
        rf = RandomForestRegressor(numTrees=trees, maxDepth=max_depth, seed=seed, featureSubsetStrategy="all",
                                   **RF_SPEED)
        model = rf.fit(data.filter(F.col("fold") != f))
        pred = model.transform(data.filter(F.col("fold") == f))
        return {m: RegressionEvaluator(metricName=m).evaluate(pred) for m in ("r2", "mae", "rmse")}

    try:
        # folds are independent Spark jobs: submit them concurrently
        with ThreadPoolExecutor(max_workers=min(k, 8)) as pool:
            res = list(pool.map(run_fold, range(k)))
    finally:
        data.unpersist()
    return {m: np.array([r[m] for r in res]) for m in ("r2", "mae", "rmse")}


def rf_importances(frame: DataFrame, features: list[str], label: str, max_depth: int = RF_MAX_DEPTH,
                   trees: int = RF_TREES, seed: int = SEED) -> DataFrame:
    """The forest fitted on all rows; importance per feature (rounded 4)."""
    frame = stored(frame, "forest-frame")  # several passes read it
    if frame.count() <= LOCAL_FRAME:
        from branchbook.operators.forest import grown

        others = [c for c in frame.columns if c not in (*features, label)]
        rows, _ = grown(frame.withColumn("__all", F.lit(-2)), features, label, "__all", others, [-1], trees, max_depth, seed)
        mean = {r.feature: r.m for r in rows.where("feature is not null").groupBy("feature").agg(F.avg("importance").alias("m")).collect()}
        total = sum(mean.values()) or 1.0
        got = [(f, round(float(mean[i] / total), 4)) for i, f in enumerate(features)]
        return frame.sparkSession.createDataFrame(got, "feature string, importance double")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    data = VectorAssembler(inputCols=features, outputCol="features").transform(
        frame.select(*features, F.col(label).cast("double").alias("label"))
    )
    data = _by_size(stored(data, "forest-rows"))
    model = RandomForestRegressor(numTrees=trees, maxDepth=max_depth, seed=seed, featureSubsetStrategy="all",
                                  **RF_SPEED).fit(data)
    imp = model.featureImportances.toArray()
    rows = [(f, round(float(imp[i]), 4)) for i, f in enumerate(features)]
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double")


def model_document(metrics: DataFrame, importances: DataFrame) -> DataFrame:
    """Metrics (one row) and importances (one row per feature) as one nested row."""
    by_feature = importances.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", "importance")))))

    def both(k: str) -> Column:
        return F.struct(F.col(f"{k}_mean").alias("mean"), F.col(f"{k}_std").alias("std"))

    return metrics.select(
        "model", "n_samples", F.struct(F.col("cv_method").alias("method"), F.split("features", ",").alias("features")).alias("cross_validation"),
        F.struct(*[both(k).alias(k) for k in ("r2", "mae", "rmse")]).alias("metrics"), by_feature.scalar().alias("feature_importances"),
    )
