"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives are all labelled documents of quality 1 among the learning rows (crc32
of the id modulo 4 is not 2); the unlabelled set is every learning row. Negative labels are
never read. With class prior p the risk of a linear score g is

    p E_pos[l(g)] + max(0, E_all[l(-g)] - p E_pos[l(-g)]) + decay |w|^2 / 2,

with the logistic loss l, so that sigmoid(g) estimates the probability of quality 1. It is
minimised by a quasi-Newton method; each evaluation of risk and gradient is one pass of
Spark over the stored features of all learning rows. A pass sums whole numbers (parts
of 2**-24), so the result depends on neither the partitions nor the order of the rows.

The class prior comes from positives against unlabelled rows: a first model tells the two
apart on one half of the ids; on the other half, of all score thresholds the one whose
upper confidence bound is least gives the prior, as the share of all rows above it divided by
that of the positives above it. Where some region holds nearly only positives this tends to their share.

Features are of two kinds: statistics of the text (length, shares of symbols, capitals,
digits, marks and repeated words, lines and word pairs, word lengths), each cut into
steps, so the model is additive in them; and hashed word shapes (letters to x and X,
digits to 9, other characters kept). Whole texts are read once; features (about 60 places of 4 bytes
a text) are stored, learnt from and scored. The driver holds vectors of ``DIM`` numbers only.

Defined cases: null, empty and wordless texts are scored from their statistics; without
positives in both halves every score is the prior, the share of learning rows labelled 1; null labels are not learnt from; of
repeated label rows the largest counts; repeated document rows count and are scored each; rows without an id
are scored, not learnt from; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.llm.common import BYTE_NAMES, NOT_SPACE, U64, Rolling, Words, chunks, mix, stored, text_buffer
from branchbook.llm.linear import minimised, remainder, sigmoid

SHAPE_BITS = 12
STEPS = 16
STATS = 12
DIM = (1 << SHAPE_BITS) + STATS * STEPS + 1
DECAY = 4e-3
PRIOR_PASSES, RISK_PASSES = 12, 30
PART = 2.0**24  # sums are whole numbers of this part
BINS, REACH = 2000, 10.0  # score thresholds of the prior
DOUBT = 0.1  # of the confidence bounds
LIMIT = 0.7

_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 above ASCII, 5 space
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:], _KIND[~NOT_SPACE] = 1, 2, 3, 4, 5
_SHAPE = np.arange(256)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 120, 88, 57, 120


def _per_text(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _repeats(name: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Occurrences beyond the first of equal values within a text."""
    order = np.lexsort((name, doc))
    a, d = name[order], doc[order]
    again = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[1:][again], minlength=n_docs)


def features(raw: np.ndarray, offs: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, value): about 40 to 60 places a text, statistics' steps and shares of word shapes."""
    w = Words(raw, offs, lo, hi, NOT_SPACE, BYTE_NAMES)
    n = hi - lo
    words, size = np.diff(w.first).astype(float), np.diff(w.doc_bytes).astype(float)
    doc = w.doc_of()
    kind = _KIND[w.data]
    count = [_per_text(w.doc_bytes, kind == k) for k in range(6)]
    visible, some = np.maximum(size - count[5], 1.0), np.maximum(words, 1.0)
    text = np.repeat(np.arange(n), np.diff(w.doc_bytes))
    line_end = np.flatnonzero(w.data == 10)
    line = np.unique(np.concatenate([w.doc_bytes[:-1], line_end + 1, w.doc_bytes[1:]]))
    line = line[line < len(w.data)]
    line_doc = text[line] if len(line) else line
    stop = np.append(line[1:], len(w.data))
    line_name = mix(Rolling(BYTE_NAMES[w.data]).of(line, stop)) if len(line) else np.zeros(0, dtype=U64)
    lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, dtype=np.int64)
    pairs = mix(w.name[pair] * U64(3) + w.name[pair + 1])
    length = (w.end - w.start).astype(float)
    long_ = np.bincount(doc, weights=length > 20, minlength=n)
    short = np.bincount(doc, weights=length <= 1, minlength=n)
    stats = np.stack([
        np.log1p(words) / 10, count[0] / visible, count[2] / visible, count[3] / visible, count[4] / visible, np.log1p(size / some) / 4,
        _repeats(w.name, doc, n) / some, _repeats(pairs, doc[pair], n) / some, _repeats(line_name, line_doc, n) / lines,
        long_ / some, short / some, count[5] / np.maximum(size, 1.0),
    ], axis=1)
    step = np.minimum((np.sqrt(np.clip(stats, 0, 1)) * STEPS).astype(np.int64), STEPS - 1)
    own = np.arange(n)
    texts, places, values = [np.repeat(own, STATS)], [((1 << SHAPE_BITS) + np.arange(STATS) * STEPS + step).reshape(-1)], [np.ones(n * STATS)]
    if len(w.name):
        shape = mix(Rolling(BYTE_NAMES[_SHAPE[w.data]]).of(np.maximum(w.end - 4, w.start), w.end)) >> U64(64 - SHAPE_BITS)  # how a word ends
        key, times = np.unique(doc.astype(np.int64) << SHAPE_BITS | shape.astype(np.int64), return_counts=True)
        texts.append(key >> SHAPE_BITS), places.append(key & ((1 << SHAPE_BITS) - 1)), values.append(2 * np.sqrt(times / some[key >> SHAPE_BITS]))
    texts.append(own), places.append(np.full(n, DIM - 1)), values.append(np.ones(n))
    return np.concatenate(texts), np.concatenate(places), np.concatenate(values)


def _stored_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = text_buffer(batch.column(1))
        for lo, hi in chunks(offs):
            t, p, v = features(raw, offs, lo, hi)
            order = np.argsort(t, kind="stable")
            t, p, v = t[order], p[order].astype("<u2"), v[order].astype("<f2")
            cut = np.searchsorted(t, np.arange(hi - lo + 1))
            cols = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()) for x in (p, v)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *cols], names=["doc_id", "place", "value"])


class _Rows:
    """Rows of stored features as flat arrays, for products with a weight vector."""

    def __init__(self, place: pa.Array, value: pa.Array):
        raw, offs = text_buffer(place)
        self.n = len(offs) - 1
        self.place = np.frombuffer(raw[offs[0] : offs[-1]].tobytes(), dtype="<u2").astype(np.int64)
        raw, offs = text_buffer(value)
        self.value = np.frombuffer(raw[offs[0] : offs[-1]].tobytes(), dtype="<f2").astype(float)
        self.row = np.repeat(np.arange(self.n), np.diff(offs) // 2)

    def score(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.place] * self.value, minlength=self.n)

    def back(self, d: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=np.rint(d[self.row] * self.value * PART), minlength=DIM).astype(np.int64)


def vectors(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, place, value, given, half) of every document row: given is true for trusted positives,
    half is 0 or 1 for learning rows and null for others."""
    known = labels.where(F.col(label).isNotNull()).where(remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    positive = known.where("__label = 1").select(F.col("doc_id").alias("__id"))
    out = docs.select("doc_id", "text").mapInArrow(_stored_features, "doc_id bigint, place binary, value binary")
    half = F.when(remainder("doc_id", 4) != 2, F.xxhash64("doc_id").bitwiseAND(1).cast("int"))
    return out.join(positive, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "place", "value", F.col("__id").isNotNull().alias("given"), half.alias("half"))


class Sums:
    """What one pass over rows gives: numbers of rows, losses and gradients of all rows and of the positives."""

    def __init__(self, total: np.ndarray):
        self.all_back, self.up_back, self.down_back = (total[i, :DIM] / PART for i in range(3))
        self.n, self.n_given = total[0, DIM], total[1, DIM]
        self.loss_all, self.loss_up, self.loss_down = (total[i, DIM + 1] / PART for i in range(3))


def _pass(spark: SparkSession, rows: DataFrame, w: np.ndarray) -> Sums:
    """l(-g) of all rows, l(g) and l(-g) of the positives, and their gradients by g, in one job; at most DIM + 2 rows return."""
    given = spark.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, DIM + 2), dtype=np.int64)
        for batch in batches:
            r = _Rows(batch.column(0), batch.column(1))
            pos = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            g = r.score(given.value)
            down, up = sigmoid(g), -sigmoid(-g)
            loss_down, loss_up = np.logaddexp(0, g), np.logaddexp(0, -g)
            for i, (d, loss, count) in enumerate(((down, loss_down, r.n), (up * pos, loss_up * pos, pos.sum()), (down * pos, loss_down * pos, 0))):
                total[i, :DIM] += r.back(d)
                total[i, DIM] += int(count)
                total[i, DIM + 1] += int(np.rint(loss * PART).sum())
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(t[at]) for t in total)], names=["at", "t0", "t1", "t2"])

    parts = rows.select("place", "value", "given").mapInArrow(run, "at int, t0 bigint, t1 bigint, t2 bigint")
    got = parts.groupBy("at").agg(*[F.sum(f"t{i}").alias(f"t{i}") for i in range(3)]).toArrow()
    given.destroy()
    total = np.zeros((3, DIM + 2))
    for i in range(3):
        total[i, got.column("at").to_numpy()] = got.column(f"t{i}").to_numpy()
    return Sums(total)


def estimated_prior(spark: SparkSession, rows: DataFrame) -> float | None:
    """Share of positives among all ``rows``, from given positives against all; None where a half has no positive."""

    def apart(w: np.ndarray) -> tuple[float, np.ndarray]:
        s = _pass(spark, rows.where("half = 0"), w)
        if not s.n_given:
            return 0.0, np.zeros(DIM)
        loss = s.loss_all / s.n + s.loss_up / s.n_given + DECAY * (w @ w) / 2
        return loss, s.all_back / s.n + s.up_back / s.n_given + DECAY * w

    w = minimised(apart, np.zeros(DIM), PRIOR_PASSES)
    sent = spark.sparkContext.broadcast(w)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, BINS), dtype=np.int64)
        for batch in batches:
            g = _Rows(batch.column(0), batch.column(1)).score(sent.value)
            at = np.clip((g + REACH) / (2 * REACH) * BINS, 0, BINS - 1).astype(np.int64)
            count[0] += np.bincount(at, minlength=BINS)
            count[1] += np.bincount(at[batch.column(2).to_numpy(zero_copy_only=False).astype(bool)], minlength=BINS)
        some = np.flatnonzero(count[0])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[0][some]), pa.array(count[1][some])], names=["at", "every", "pos"])

    part = rows.where("half = 1").select("place", "value", "given").mapInArrow(bins, "at int, every bigint, pos bigint")
    got = part.groupBy("at").agg(F.sum("every").alias("every"), F.sum("pos").alias("pos")).orderBy("at").toArrow()  # at most BINS rows
    every, pos = (got.column(c).to_numpy().astype(float) for c in ("every", "pos"))
    if not w.any() or not pos.sum():
        return None
    return threshold_prior(every, pos)


def threshold_prior(every: np.ndarray, pos: np.ndarray) -> float:
    """The prior from counts of all rows and of positives by rising score."""
    n, m = every.sum(), pos.sum()
    above, pos_above = np.cumsum(every[::-1]) / n, np.cumsum(pos[::-1]) / m
    ok = pos_above > 0
    above, pos_above = above[ok], pos_above[ok]
    spread = np.sqrt(np.log(4 / DOUBT) / (2 * n)) + np.sqrt(np.log(4 / DOUBT) / (2 * m))
    best = int(np.argmin((above + spread) / pos_above))
    return float(min(1.0, above[best] / pos_above[best]))


def risk(s: Sums, w: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk and its gradient."""
    rest = s.loss_all / s.n - prior * s.loss_down / s.n_given  # what the unlabelled rows say of the negatives
    value, grad = prior * s.loss_up / s.n_given + DECAY * (w @ w) / 2, prior * s.up_back / s.n_given + DECAY * w
    if rest > 0:
        value, grad = value + rest, grad + s.all_back / s.n - prior * s.down_back / s.n_given
    return float(value), grad


def train(spark: SparkSession, rows: DataFrame) -> tuple[np.ndarray, float]:
    """(weights, class prior) from rows of ``vectors``."""
    learn = rows.where("half is not null")
    prior = estimated_prior(spark, learn)
    if prior is None:
        known = learn.agg(F.avg(F.col("given").cast("int"))).first()[0]
        prior, w = float(known or 0.0), np.zeros(DIM)
        w[-1] = np.log((prior + 1e-6) / (1 - prior + 1e-6))
        return w, prior
    return minimised(lambda w: risk(_pass(spark, learn, w), w, prior), np.zeros(DIM), RISK_PASSES), prior


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document row."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(vectors(src, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")), "quality")
    w, _ = train(spark, rows)
    given = spark.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = _Rows(batch.column(1), batch.column(2)).score(given.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(g))], names=["doc_id", "score"])

    out = rows.select("doc_id", "place", "value").mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
