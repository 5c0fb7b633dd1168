"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Words are runs of letters, digits and characters above ASCII; each gives its character
n-grams of 1 to 4 with a mark at both ends, hashed to 2**16 places. Document
frequencies are counted over all learning documents (text with a known language whose
crc32 modulo 3 is not 1), summed by slices of the places on the executors. Weights are
learnt by follow-the-regularised-leader with an elastic net from a sample: the least
hashed ids of every language, about its share of ``TRAIN_DOCS`` or ``LEAST_DOCS`` (all,
where it has fewer). Languages are counted over all learning documents, so none is lost to the
bound; one sampled above its share has its bias shifted by the logarithm of the ratio. A
fifth of each language's sample is set aside to fit the temperature, weighted alike.
n-grams are computed once per distinct word of a chunk, so a text's score is a
weighted sum over its words; term frequencies are relative to the text's n-grams.

Defined cases: a null text or one without a letter is ``und`` with score 0; no learning
row makes every text ``und``; one learnt language is always predicted; ties go to the
language that sorts first; repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import ALNUM, FOLDED_NAMES, U64, Words, chunks, mix, text_buffer
from branchbook.llm.linear import Ftrl, class_quotas, class_sample, log_shift, remainder

BITS = 16
SIZE = 1 << BITS
TRAIN_DOCS = 2500
LEAST_DOCS = 100  # of a language
PASSES = 2
SLICES = 16
SCALE = 20.0


def word_ngrams(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word of every word, place of every n-gram of the distinct words, its word)."""
    if not len(w.name):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    _, first, of = np.unique(w.name, return_index=True, return_inverse=True)
    data = w.data.tobytes()
    text = " " + " ".join(data[a:b].decode("utf-8", "replace").lower() for a, b in zip(w.start[first].tolist(), w.end[first].tolist())) + " "
    point = np.frombuffer(text.replace("İ", "i").encode("utf-32-le"), dtype="<u4").astype(np.int64)
    gap = point == 32
    word = np.cumsum(gap) - 1
    seed = mix(point.astype(U64) + U64(977))
    places, owner = [], []
    name = np.zeros(len(point), dtype=U64)
    for n in range(1, 5):
        m = len(point) - n + 1
        if m <= 0:
            break
        name = mix(name[:m] * U64(31) + seed[n - 1 : n - 1 + m])
        inner = np.concatenate(([0], np.cumsum(gap)))
        ok = (inner[n - 1 : n - 1 + m] - inner[1 : 1 + m] == 0) if n > 1 else ~gap
        if n == 2:
            ok &= ~(gap[:m] & gap[1 : 1 + m])
        at = np.flatnonzero(ok)
        places.append((name[at] >> U64(64 - BITS)).astype(np.int64))
        owner.append(word[at])
    return of.reshape(-1), np.concatenate(places), np.concatenate(owner)


def _vectors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, count) of the n-grams of every text."""
    of, place, owner = word_ngrams(w)
    doc = w.doc_of()
    pair, count = np.unique(doc.astype(np.int64) * (len(of) + 1) + of, return_counts=True)
    d, u = pair // (len(of) + 1), pair % (len(of) + 1)
    order = np.argsort(owner, kind="stable")
    place, owner = place[order], owner[order]
    lo, hi = np.searchsorted(owner, u), np.searchsorted(owner, u, side="right")
    n = hi - lo
    at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key, back = np.unique(np.repeat(d, n) * SIZE + place[at], return_inverse=True)
    tf = np.bincount(back.reshape(-1), weights=np.repeat(count, n), minlength=len(key))
    return key // SIZE, key % SIZE, tf


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each place, over all texts, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            raw, offs = text_buffer(batch.column(0))
            n += batch.num_rows
            for lo, hi in chunks(offs):
                w = Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES)
                at = _vectors(w)[1] if len(w.name) else np.zeros(0, dtype=np.int64)
                df += np.bincount(at, minlength=SIZE)
        part = SIZE // SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([df[i * part : (i + 1) * part].tobytes() for i in range(SLICES)], pa.binary()), pa.array([n] * SLICES, pa.int64())],
            names=["slice", "df", "n"])

    def total(table: pa.Table) -> pa.Table:
        s = np.sum([np.frombuffer(b, dtype=np.int64) for b in table.column("df").to_pylist()], axis=0)
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "df": pa.array([s.tobytes()], pa.binary()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64())})

    schema = "slice int, df binary, n bigint"
    rows = texts.mapInArrow(count, schema).groupBy("slice").applyInArrow(total, schema).orderBy("slice").toArrow()  # SLICES rows
    if not rows.num_rows:
        return np.zeros(SIZE, dtype=np.int64), 0
    return np.concatenate([np.frombuffer(b, dtype=np.int64) for b in rows.column("df").to_pylist()]), rows.column("n")[0].as_py()


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.weights, self.bias, self.temperature = langs, weights.astype(np.float32), bias, temperature


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(docs: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    learn = docs.where(F.col("lang").isNotNull()).where(remainder("doc_id", 3) != 1)
    df, n_docs = document_frequencies(learn.select("text"))
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffer(batch.column(1))
            for lo, hi in chunks(offs):
                w = Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES)
                doc, place, tf = _vectors(w) if len(w.name) else (np.zeros(0, dtype=np.int64),) * 3
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array([place[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                     pa.array([tf[a:b].astype(np.float32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["doc_id", "lang", "place", "tf"])

    known = learn.select("doc_id", "lang").distinct()
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(counts)
    if len(langs) < 2:
        return Model(langs, np.zeros((SIZE, len(langs))), np.zeros(len(langs)), 1.0)
    picked = class_sample(known, "lang", counts, class_quotas(counts, limit, LEAST_DOCS))
    sample = learn.select("doc_id", "text", "lang").join(F.broadcast(picked), ["doc_id", "lang"])
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang")
    rows = sample.mapInArrow(sparse, "doc_id bigint, lang string, place binary, tf binary").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    place_of = {v: i for i, v in enumerate(langs)}
    y = [place_of[v] for v in rows.column("lang").to_pylist()]
    x = []
    for p, t in zip(rows.column("place").to_pylist(), rows.column("tf").to_pylist()):
        p, t = np.frombuffer(p, dtype=np.int32), np.frombuffer(t, dtype=np.float32)
        x.append((np.append(p, SIZE), np.append(SCALE * t / max(t.sum(), 1.0) * idf[p], 1.0)))
    order = np.random.Generator(np.random.PCG64(7)).permutation(len(x))
    seen, apart = [0] * len(langs), np.zeros(len(x), dtype=bool)
    for i in order:
        seen[y[i]] += 1
        apart[i] = seen[y[i]] % 5 == 0
    aside, rest = order[apart[order]], order[~apart[order]]
    share = np.array([counts[v] for v in langs]) / sum(counts.values())
    taken = np.maximum(np.bincount([y[i] for i in rest], minlength=len(langs)), 1)
    learner = Ftrl(SIZE + 1, len(langs), alpha=0.5, l1=0.05, l2=0.05)
    for _ in range(PASSES):
        for i in rest:
            idx, v = x[i]
            w = learner.weights(idx)
            p = _softmax(v @ w)
            p[y[i]] -= 1.0
            learner.step(idx, v, p, w)
    w = learner.weights()
    w[-1] += [log_shift(s, m / max(len(rest), 1)) for s, m in zip(share, taken)]
    temperature = 1.0
    if len(aside):
        z = np.array([x[i][1] @ w[x[i][0]] for i in aside])
        t_y = np.array([y[i] for i in aside])
        grid = np.exp(np.linspace(np.log(0.05), np.log(10), 60))
        weight = (share / np.maximum(np.bincount(t_y, minlength=len(langs)), 1))[t_y]
        loss = [-(weight * np.log(_softmax(z / t)[np.arange(len(t_y)), t_y] + 1e-12)).sum() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return Model(langs, SCALE * idf[:, None] * w[:-1], w[-1], temperature)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    ascii_letter = np.zeros(256, dtype=bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = given.value
        for batch in batches:
            raw, offs = text_buffer(batch.column(1))
            for lo, hi in chunks(offs):
                w = Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES)
                lang, score = ["und"] * (hi - lo), np.zeros(hi - lo)
                if len(w.name) and m.langs:
                    of, place, owner = word_ngrams(w)
                    n = int(owner.max()) + 1
                    k = len(m.langs)
                    size = np.bincount(owner, minlength=n)
                    doc = w.doc_of()
                    total = np.maximum(np.bincount(doc, weights=size[of], minlength=hi - lo), 1.0)
                    z = np.empty((hi - lo, k))
                    for c in range(k):
                        by_word = np.bincount(owner, weights=m.weights[place, c], minlength=n)
                        z[:, c] = np.bincount(doc, weights=by_word[of], minlength=hi - lo) / total + m.bias[c]
                    p = _softmax(z / m.temperature)
                    seen = np.concatenate(([0], np.cumsum(ascii_letter[w.data])))
                    letters = seen[w.doc_bytes[1:]] - seen[w.doc_bytes[:-1]]
                    for d in range(hi - lo):
                        if letters[d] or _has_letter(w.data[w.doc_bytes[d] : w.doc_bytes[d + 1]].tobytes()):
                            b = int(p[d].argmax())
                            lang[d], score[d] = m.langs[b], p[d, b]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document row."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    return predicted(src, train(src)).select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
