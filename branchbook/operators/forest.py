"""Random forest regression for frames of a bounded size: all trees of all folds in one Spark job.

Spark ML grows a forest level by level, a job per level and fold; on the few thousand
rows of a branch-by-month frame nearly all of that is job overhead. Here the frame,
whose size the caller has checked, is cut into bins once and broadcast, and every task
grows whole trees from it: a level of a tree is one pass of weighted histograms over
its open nodes. Trees, folds and the trees of the final fit are rows of one table, so
more of them spread over more tasks. Larger frames go to Spark ML (see ``ml``).

The model is the same kind: bootstrap by Poisson(1) weights, all features at every
node, up to 32 bins a feature, variance reduction, leaves of one row and up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.operators.quantiles import column_quantiles

BINS = 32
OUT_SCHEMA = "fold int, tree int, row int, prediction double, feature int, importance double"


class Tree:
    """Nodes as arrays; a leaf has feature -1. Rows go left up to and including the node's bin."""

    def __init__(self, binned: np.ndarray, y: np.ndarray, weight: np.ndarray, max_depth: int):
        used = np.flatnonzero(weight)
        x, y, w = binned[used], y[used], weight[used].astype(float)
        n_features = x.shape[1]
        self.feature, self.bin, self.child = [np.array([-1])], [np.array([0])], [np.array([-1])]
        self.value = [np.array([np.average(y, weights=w) if len(used) else 0.0])]
        self.importance = np.zeros(n_features)
        node = np.zeros(len(used), dtype=np.int64)  # place among the open nodes
        first = 0  # number of the level's first node
        for _ in range(max_depth):
            n_nodes = len(self.feature[-1])
            cell = (node[:, None] * n_features + np.arange(n_features)) * BINS + x
            shape = (n_nodes, n_features, BINS)
            size = n_nodes * n_features * BINS
            wl = np.bincount(cell.ravel(), np.repeat(w, n_features), size).reshape(shape).cumsum(axis=2)
            sl = np.bincount(cell.ravel(), np.repeat(w * y, n_features), size).reshape(shape).cumsum(axis=2)
            total_w, total_s = wl[:, :, -1:], sl[:, :, -1:]
            wr, sr = total_w - wl, total_s - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((wl > 0) & (wr > 0), sl**2 / wl + sr**2 / wr - total_s**2 / total_w, 0.0)
            best = gain.reshape(n_nodes, -1).argmax(axis=1)
            got = gain.reshape(n_nodes, -1)[np.arange(n_nodes), best]
            split = got > 1e-9 * np.maximum(1e-300, np.abs(total_s[:, 0, 0] ** 2 / np.maximum(total_w[:, 0, 0], 1e-300)))
            if not split.any():
                break
            f, b = best // BINS, best % BINS
            np.add.at(self.importance, f[split], got[split])
            place = np.cumsum(split) - 1  # of a split node's children: two in the next level
            self.feature[-1] = np.where(split, f, -1)
            self.bin[-1] = b
            self.child[-1] = np.where(split, first + n_nodes + 2 * place, -1)
            pick = np.flatnonzero(split)
            w_left, s_left = wl[pick, f[pick], b[pick]], sl[pick, f[pick], b[pick]]
            w_right, s_right = total_w[pick, 0, 0] - w_left, total_s[pick, 0, 0] - s_left
            self.value.append(np.stack([s_left / w_left, s_right / w_right], axis=1).ravel())
            for level, start in ((self.feature, -1), (self.bin, 0), (self.child, -1)):
                level.append(np.full(2 * len(pick), start))
            stays = split[node]
            x, y, w, node = x[stays], y[stays], w[stays], node[stays]
            right = x[np.arange(len(node)), f[node]] > b[node]
            node = 2 * place[node] + right
            first += n_nodes
        self.feature, self.bin, self.child, self.value = (np.concatenate(v) for v in (self.feature, self.bin, self.child, self.value))

    def predict(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.child[at] >= 0)
            if not len(inner):
                return self.value[at]
            n = at[inner]
            at[inner] = self.child[n] + (binned[inner, self.feature[n]] > self.bin[n])


def binned_frame(frame: DataFrame, features: list[str], label: str, fold: str, order: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, label, fold) of a frame of a checked size, its rows in a fixed order."""
    probs = [i / BINS for i in range(1, BINS)]
    cuts = column_quantiles(frame, {f: probs for f in features})
    cols = [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    t = frame.select(*cols, F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    t = t.orderBy(*[f"o{i}" for i in range(len(order))], *[f"f{i}" for i in range(len(features))], "y").toArrow()
    binned = np.empty((t.num_rows, len(features)), dtype=np.uint8)
    for i, f in enumerate(features):
        edges = np.unique(np.array([c for c in cuts[f] if c is not None]))
        binned[:, i] = np.searchsorted(edges, t.column(f"f{i}").fill_null(0.0).to_numpy(), side="left")
    return binned, t.column("y").to_numpy(), t.column("k").to_numpy()


def grown(frame: DataFrame, features: list[str], label: str, fold: str, order: list[str], folds: list[int],
          trees: int, max_depth: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """(fold, tree, row, prediction) of the rows each tree was not trained on and (fold, tree, feature, importance), and the labels.

    A tree of fold k is trained on the other folds' rows; fold -1 stands for all rows. Importances of a
    tree add up to 1. ``frame`` must be of a checked size: it is fetched and broadcast.
    """
    spark = frame.sparkSession
    binned, y, k = binned_frame(frame, features, label, fold, order)
    data = spark.sparkContext.broadcast((binned, y, k))
    n_jobs = len(folds) * trees

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, label, of = data.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                f, t = folds[i // trees], i % trees
                weight = np.random.default_rng([seed, f + 1, t]).poisson(1.0, len(x)) * (of != f)
                tree = Tree(x, label, weight, max_depth)
                rows = np.flatnonzero(of == f)
                n = len(rows) + len(features)
                share = tree.importance / max(tree.importance.sum(), 1e-300)
                none = [None] * len(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, f), pa.int32()), pa.array(np.full(n, t), pa.int32()),
                    pa.array([*rows.tolist(), *[None] * len(features)], pa.int32()),
                    pa.array([*tree.predict(x[rows]).tolist(), *[None] * len(features)], pa.float64()),
                    pa.array([*none, *range(len(features))], pa.int32()), pa.array([*none, *share.tolist()], pa.float64()),
                ], names=[c.split(" ")[0] for c in OUT_SCHEMA.split(", ")])

    n_tasks = min(n_jobs, 4 * spark.sparkContext.defaultParallelism)
    jobs = spark.range(0, n_jobs, 1, n_tasks)
    return jobs.mapInArrow(task, OUT_SCHEMA), y
