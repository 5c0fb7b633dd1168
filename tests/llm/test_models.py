"""Trained and estimated models against plain versions of the same method on the same rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from branchbook.llm import mcdrules, puquality, toxicity
from branchbook.llm.linear import minimised

WORDS = ["rain", "stone", "lamp", "river", "tree", "cloud", "road"]


def quality_rows(spark, n=240, seed=2):
    """Good texts, of which some are labelled, and shouting ones; rows without labels, ids or text."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        words = rng.choices(WORDS, k=rng.randrange(5, 60))
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        if rng.random() < 0.5:
            labels.append((i, int(good)))
    rows += [(None, "rain"), (n + 1, None), (n + 2, ""), (3, "rain on the road")]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([*labels, (5, None), (9999, 1)], "doc_id bigint, quality int")


def plain_rows(rows):
    out = []
    for r in rows.where("half is not null").collect():
        out.append((dict(zip(np.frombuffer(r.place, "<u2").tolist(), np.frombuffer(r.value, "<f2").astype(float).tolist())), r.given))
    return out


def plain_risk(rows, w, prior):
    """The non-negative risk, one row after another."""
    soft = lambda x: math.log1p(math.exp(-abs(x))) + max(x, 0.0)
    g = [(sum(w[p] * v for p, v in x.items()), given) for x, given in rows]
    pos = [s for s, given in g if given]
    rest = sum(soft(s) for s, _ in g) / len(g) - prior * sum(soft(s) for s in pos) / len(pos)
    return prior * sum(soft(-s) for s in pos) / len(pos) + max(0.0, rest) + puquality.DECAY * float(w @ w) / 2, rest


def test_risk_is_that_of_all_rows(spark):
    docs, labels = quality_rows(spark)
    rows = puquality.vectors(docs, labels)
    plain = plain_rows(rows)
    rng = np.random.default_rng(1)
    signs = set()
    for scale, prior in ((0.0, 0.6), (0.05, 0.6), (0.3, 0.3), (0.3, 1.0)):
        w = rng.normal(size=puquality.DIM) * scale
        for shift in (0.0, -3.0):
            w[-1] = shift
            value, grad = puquality.risk(puquality._pass(spark, rows.where("half is not null"), w), w, prior)
            want, rest = plain_risk(plain, w, prior)
            signs.add(rest > 0)
            assert value == pytest.approx(want, abs=1e-5)
            for at in (puquality.DIM - 1, int(np.argmax(np.abs(grad)))):
                e = np.zeros(puquality.DIM)
                e[at] = 1e-4
                slope = (plain_risk(plain, w + e, prior)[0] - plain_risk(plain, w - e, prior)[0]) / 2e-4
                assert grad[at] == pytest.approx(slope, abs=1e-4)
    assert signs == {True, False}


def test_every_learning_row_counts_and_others_do_not(spark):
    import zlib

    docs, labels = quality_rows(spark)
    rows = puquality.vectors(docs, labels)
    learn = sum(r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in docs.collect())
    s = puquality._pass(spark, rows.where("half is not null"), np.zeros(puquality.DIM))
    assert s.n == learn and rows.count() == docs.count()
    given = {r.doc_id for r in labels.collect() if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert {r.doc_id for r in rows.where("given").collect()} == given - {9999}
    without = labels.where("quality is null or quality = 1")  # negative labels are never read
    a, b = (sorted(map(str, puquality.quality(docs, x).collect())) for x in (labels, without))
    assert a == b


def test_prior_is_estimated(spark):
    rng = np.random.default_rng(4)
    for prior in (0.2, 0.5, 0.9):
        pos, other = rng.normal(2, 1, 200_000), rng.normal(-2, 1, 200_000)
        every = np.where(rng.random(200_000) < prior, rng.normal(2, 1, 200_000), other)
        edges = np.linspace(-8, 8, 500)
        got = puquality.threshold_prior(np.histogram(every, edges)[0].astype(float), np.histogram(pos, edges)[0].astype(float))
        assert got == pytest.approx(prior, abs=0.03)
    docs, labels = quality_rows(spark, 3000, seed=8)
    rows = puquality.vectors(docs, labels).where("half is not null")
    assert puquality.estimated_prior(spark, rows) == pytest.approx(0.6, abs=0.06)
    assert puquality.estimated_prior(spark, puquality.vectors(docs, labels.limit(0))) is None


def test_minimum_of_a_quadratic_and_of_a_valley():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(30, 12))
    h, b = a.T @ a + np.eye(12), rng.normal(size=12)
    got = minimised(lambda w: (w @ h @ w / 2 - b @ w, h @ w - b), np.zeros(12), 200, least=1e-14)
    assert np.allclose(got, np.linalg.solve(h, b), atol=1e-4)

    def valley(w):
        x, y = w
        return (1 - x) ** 2 + 100 * (y - x * x) ** 2, np.array([-2 * (1 - x) - 400 * x * (y - x * x), 200 * (y - x * x)])

    assert np.allclose(minimised(valley, np.array([-1.2, 1.0]), 300, least=0.0), [1, 1], atol=1e-3)
    calls = []
    minimised(lambda w: (calls.append(1), valley(w))[1], np.array([-1.2, 1.0]), 7, least=0.0)
    assert len(calls) <= 7


def plain_ftrl(examples, weight, alpha, beta, l1, l2):
    """FTRL-proximal, one coordinate after another."""
    z, n = {}, {}

    def weights(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(toxicity.PASSES):
        for at, y in examples:
            at = [*at.tolist(), "bias"]
            w = [weights(i) for i in at]
            g = weight[y] * (1 / (1 + math.exp(-sum(w))) - y)
            for i, wi in zip(at, w):
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * wi
                n[i] = n.get(i, 0.0) + g * g
    return {i: weights(i) for i in z}


def test_ftrl_is_the_plain_one():
    rng = np.random.default_rng(6)
    examples = []
    for _ in range(120):
        y = int(rng.random() < 0.4)
        examples.append((np.unique(rng.integers(0, 30, 8) + 20 * y).astype(np.int32), y))
    weight = {0: 1.2, 1: 0.5}
    w, bias = toxicity.learnt(examples, weight)
    want = plain_ftrl(examples, weight, toxicity.ALPHA, 1.0, toxicity.L1, 0.1)
    assert bias == pytest.approx(want.pop("bias"))
    assert set(np.flatnonzero(w)) == {i for i, v in want.items() if v} and len(np.flatnonzero(w))
    assert all(w[i] == pytest.approx(v) for i, v in want.items())


def test_a_rare_class_is_learnt(spark):
    """One document in 50 is toxic: the sample holds all of them, the rest by their share."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 50 == 0
        rows.append((i, " ".join(rng.choices(WORDS, k=20) + (["idiot", "fool", "scum"] if bad else []))))
        labels.append((i, int(bad)))
    rows += [(7, rows[7][1])] * 40 + [(11, None)]
    docs, lab = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, lab, limit=600, least=300)
    got = toxicity.scored(docs, model).collect()
    bad = [r.score for r in got if r.doc_id % 50 == 0]
    fine = [r.score for r in got if r.doc_id % 50]
    assert min(bad) > toxicity.LIMIT > max(fine)


def plain_mcd(x, share, starts, seed=0):
    """Concentration steps from random starts until the determinant no longer falls."""
    rng = np.random.default_rng(seed)
    h = math.ceil(share * len(x))
    floor = np.diag(np.square(mcdrules.FLOOR))
    best = None
    for _ in range(starts):
        near = x[rng.choice(len(x), 30, replace=False)]
        last = np.inf
        while True:
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) * mcdrules.CONSISTENCY + floor
            det = np.linalg.slogdet(cov)[1]
            if det >= last - 1e-9:
                break
            last = det
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            near = x[np.argsort(d, kind="stable")[:h]]
        if len(near) == h and (best is None or det < best[0]):
            best = (det, mean, cov)
    return best


def test_mcd_is_as_good_as_the_plain_one(spark):
    """Correlated groups with far and with clustered outliers: determinant and verdicts of a plain estimate with many starts."""
    rng = np.random.default_rng(12)
    mixing = np.array([[1, 0, 0, 0], [0.8, 0.5, 0, 0], [0, 0.3, 1, 0], [0.4, 0, 0.2, 0.6]])
    groups = {}
    for g, n, far in (("a", 800, 0), ("b", 500, 100), ("c", 400, 80), ("d", 300, 0)):
        x = rng.normal(size=(n, 4)) @ mixing.T
        if g == "b":
            x[:far] += 30 * rng.normal(size=(far, 4))
        if g == "c":
            x[:far] = [9, -9, 9, -9] + 0.1 * rng.normal(size=(far, 4))
        if g == "d":
            x[:, 1:] = 0.0  # a flat group
        groups[g] = (x, far)
    rows = spark.createDataFrame([(g, *map(float, v)) for g, (x, _) in groups.items() for v in x], "g string, x0 double, x1 double, x2 double, x3 double")
    got = mcdrules.estimates(rows)
    assert sorted(got.columns) == sorted(["g", *mcdrules.ESTIMATE, "logdet"])
    dist = mcdrules.with_distance(rows.join(got, "g")).select("g", *mcdrules.X, "d2").collect()
    det = {r.g: r.logdet for r in got.collect()}
    for g, (x, far) in groups.items():
        want, mean, cov = plain_mcd(x, mcdrules.SHARE, 60)
        assert det[g] <= want + 0.1
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        mine = {tuple(r[1:5]): r.d2 for r in dist if r.g == g}
        mine = np.array([mine[tuple(v)] for v in x])
        assert ((mine > mcdrules.CUT) == (d > mcdrules.CUT)).mean() > 0.99
        assert (mine[:far] > mcdrules.CUT).sum() >= (d[:far] > mcdrules.CUT).sum() - 0.02 * far and (mine[far:] > mcdrules.CUT).mean() < 0.01
    assert mcdrules.estimates(rows.limit(0)).count() == 0


def test_group_tables_join_alike_at_any_size(spark):
    rows = spark.createDataFrame([("abc"[min(i % 7, 2)], float(i)) for i in range(500)] + [("z", 1.0)], "g string, x0 double")
    groups = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7), ("c", 1, 8)], "g string, start int, m int")
    for how in ("inner", "left"):
        small, large = (sorted(map(str, mcdrules.beside(rows, groups, how, limit).collect())) for limit in (1 << 40, -1))
        assert small == large and len(small) == 500 + 72 + (how == "left")
