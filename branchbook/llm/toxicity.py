"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one word between,
hashed to 2**20 places. Training takes about ``TRAIN_DOCS`` labelled documents (a documented
bound) by class: each label's share of it, or ``LEAST_DOCS``, or all it has, those of the
least hashed ids. Labels are counted over all learning rows, and a class taken above its
share weighs less in every step, so a rare class is learnt from without a shift of the scores.
Training goes in passes over a fixed order. L1 leaves few weights; only those, as places and values, are broadcast.
Every whole text is scored in one pass without a shuffle.

Defined cases: null, empty and wordless texts get the score of the bias; no labelled
row, or labels of one class only, give a constant model; null labels are not learnt
from; of repeated label rows the largest label counts; repeated document rows are
scored each, and the least text of an id is learnt from; further columns are kept by ``scored`` and never used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import ALNUM, FOLDED_NAMES, U64, Words, chunks, mix, text_buffer
from branchbook.llm.linear import Ftrl, class_quotas, class_sample, remainder, sigmoid

BITS = 20
TRAIN_DOCS = 8000
LEAST_DOCS = 2000  # of a class
PASSES = 3
ALPHA, L1 = 0.6, 6.0
LIMIT = 0.3


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(place, text index) of every word, word pair and skip pair."""
    doc = w.doc_of()
    places, owner = [w.name], [doc]
    for gap, salt in ((1, 0x1F), (2, 0x2F)):
        ok = np.flatnonzero(doc[gap:] == doc[:-gap]) if len(doc) > gap else np.zeros(0, dtype=np.int64)
        places.append(mix(w.name[ok] * U64(3 + 2 * salt) + w.name[ok + gap]))
        owner.append(doc[ok])
    return (np.concatenate(places) >> U64(64 - BITS)).astype(np.int32), np.concatenate(owner)


class Model:
    """Sparse weights and a bias."""

    def __init__(self, place: np.ndarray, weight: np.ndarray, bias: float):
        self.place, self.weight, self.bias = place.astype(np.int32), weight.astype(np.float32), bias

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, dtype=np.float32)
        w[self.place] = self.weight
        return w


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = text_buffer(batch.column(1))
        for lo, hi in chunks(offs):
            place, doc = features(Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES))
            key = np.unique(doc.astype(np.int64) << BITS | place)
            cut = np.searchsorted(key >> BITS, np.arange(hi - lo + 1))
            at = (key & ((1 << BITS) - 1)).astype(np.int32)
            blobs = [at[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi].cast(pa.int32()), pa.array(blobs, pa.binary())], names=["doc_id", "label", "places"])


def learnt(examples: list[tuple[np.ndarray, int]], weight: dict[int, float]) -> tuple[np.ndarray, float]:
    """(weights by place, bias) after ``PASSES`` passes over (places, label); a class's gradients are multiplied by its weight."""
    learner = Ftrl((1 << BITS) + 1, alpha=ALPHA, l1=L1, l2=0.1)
    for _ in range(PASSES):
        for at, y in examples:
            idx = np.append(at, 1 << BITS)
            w = learner.weights(idx)
            learner.step(idx, np.ones(len(idx)), weight[y] * (sigmoid(w.sum(axis=0)) - y), w)
    w = learner.weights()[:, 0]
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = TRAIN_DOCS, least: int = LEAST_DOCS) -> Model:
    """Learn from the labels of documents whose crc32 modulo 4 is not 2."""
    known = labels.where(F.col(label).isNotNull()).where(remainder("doc_id", 4) != 2).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # at most two rows
    if len(counts) < 2:
        return Model(np.zeros(0), np.zeros(0), 4.0 if 1 in counts else -4.0)
    picked = class_sample(known, "label", counts, class_quotas(counts, limit, least))
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sample.select("doc_id", "text", "label").mapInArrow(_sparse, "doc_id bigint, label int, places binary").toArrow().sort_by("doc_id")
    y, blobs = rows.column("label").to_pylist(), rows.column("places").to_pylist()
    order = np.argsort([hash((i, 1)) for i in rows.column("doc_id").to_pylist()], kind="stable")
    taken = {c: max(1, y.count(c)) / max(1, len(y)) for c in counts}
    weight = {c: n / sum(counts.values()) / taken[c] for c, n in counts.items()}
    w, bias = learnt([(np.frombuffer(blobs[i], dtype=np.int32), y[i]) for i in order], weight)
    place = np.flatnonzero(w)
    return Model(place, w[place], bias)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """The documents' rows with one more column, the score from 0 to 1."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text)
    score = score if score not in names else f"__{score}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = given.value.dense(), given.value.bias
        for batch in batches:
            raw, offs = text_buffer(batch.column(at))
            out = np.full(batch.num_rows, bias)
            for lo, hi in chunks(offs):
                place, doc = features(Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES))
                used = np.flatnonzero(dense[place])
                key = np.unique(doc[used].astype(np.int64) << BITS | place[used])
                out[lo:hi] += np.bincount(key >> BITS, weights=dense[key & ((1 << BITS) - 1)], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(out))], names=[*batch.schema.names, score])

    return docs.mapInArrow(run, _with(docs, score))


def _with(docs: DataFrame, name: str):
    from pyspark.sql import types as T

    return T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document row."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ids = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    out = scored(src, train(src, ids))
    return out.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score under the limit, their columns unchanged."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = train(src, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"))
    out = scored(docs, model, score="__toxic_score")
    return out.where(F.col(out.columns[-1]) < LIMIT).select(*docs.columns)
