"""Hard-negative mining with exact integer scores from residue-number-system matrix products.

Vectors hold integers. Their components are taken modulo several small primes, and for
each prime the residues of a tile of anchors are multiplied with those of a tile of rows
in float32. Primes are small enough that every sum stays below 2**24, where float32 is
exact, and so many are taken that their product exceeds twice the largest score the table
allows. Chinese remaindering with balanced digits gives each score back exactly, sign
included.

Anchors are dealt into blocks of a bounded size; one block at a time is fetched and
broadcast, and all rows are scored against it, twice: the first pass finds each anchor's
positives, the second its negatives inside the window of scores that each positive opens.
A task keeps the best rows of each anchor (and positive) while it reads its partition and
emits them at the end; a window picks the final ones over all tasks. What a block found
is written before the next one starts. No task holds more than one block, one tile of
scores and the best rows so far, however many rows share a label or a vector.

Defined cases: rows without an id, label or vector, or with a null or non-finite
component, take no part; vectors of different lengths are filled up with zeros; equal
scores go by smaller id; an anchor's positives are rows of another id, and repeated rows
count as often as they occur, but an anchor that is repeated in full is one anchor; an
empty table gives no rows; further columns are ignored. A table whose scores could
reach 2**61 raises ValueError, as scores are 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import scratch, stored

BLOCK_BYTES = 16 << 20  # vectors of one block of anchors
ROWS, ANCHORS = 2048, 1024  # a tile of scores
INNER = 1024  # dimensions multiplied before residues are reduced
EXACT = 1 << 24  # whole numbers below are exact in float32
NONE = -(1 << 62)  # below every score
FOUND_SCHEMA = "at int, slot int, id bigint, score bigint"
_FOUND = pa.schema([("at", pa.int32()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def moduli(dims: int, bound: int) -> list[int]:
    """Primes, largest first, for scores up to ``bound`` of vectors of ``dims`` components."""
    n = min(max(dims, 1), INNER)
    p = min(2 * int(((EXACT - 1) / n) ** 0.5) + 1, 4093)
    found: list[int] = []
    while prod(found) <= 2 * bound + 1 or not found:
        if p < 3:
            raise ValueError("no primes left")
        if p % 2 and all(p % q for q in range(3, int(p**0.5) + 1, 2)) and n * (p // 2) ** 2 < EXACT:
            found.append(p)
        p -= 1
    return found


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues in -(p-1)/2 .. (p-1)/2; exact in float64 for whole numbers far below 2**50."""
    return x - p * np.rint(x * (1.0 / p))


@dataclass
class Residues:
    """Integer vectors as one float32 matrix per prime."""

    primes: list[int]
    parts: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray, primes: list[int]) -> Residues:
        return cls(primes, [((x + p // 2) % p - p // 2).astype(np.float32) for p in primes])

    def rows(self, lo: int, hi: int) -> Residues:
        return Residues(self.primes, [x[lo:hi] for x in self.parts])


def products(a: Residues, b: Residues) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, as 64-bit integers."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(a.primes):
        x, y = a.parts[k], b.parts[k]
        r = np.zeros((len(x), len(y)))
        for at in range(0, x.shape[1], INNER):
            r = _balanced(r + x[:, at : at + INNER] @ y[:, at : at + INNER].T, p)
        for q, d in zip(a.primes, digits):  # mixed radix: r = d1 + p1 (d2 + p2 (d3 ..)) modulo p
            inverse = pow(q, -1, p)
            r = _balanced((r - d) * (inverse if inverse <= p // 2 else inverse - p), p)
        digits.append(r)
    out = digits[-1].astype(np.int64)
    for d, p in zip(digits[-2::-1], a.primes[-2::-1]):
        out = out * p + d.astype(np.int64)
    return out


class Best:
    """The k best (score, id) of every anchor: greater scores first, equal ones by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, dtype=np.int64)
        self.id = np.zeros((n, k), dtype=np.int64)

    def add(self, lo: int, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray) -> None:
        """Offer a tile of scores of the anchors from ``lo`` on; ``ids`` ascend."""
        hi = lo + len(scores)
        ok = ok & (scores >= self.score[lo:hi, -1:])
        many = np.flatnonzero(ok.sum(axis=1) > 4 * self.k)
        if len(many):  # of many, only the k best of the tile: all above the k-th score, and its first ties
            s = np.where(ok[many], scores[many], NONE)
            kth = -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            above, tied = s > kth, s == kth
            ok[many] = above | (tied & (np.cumsum(tied, axis=1) <= self.k - above.sum(axis=1, keepdims=True)))
        row, col = np.nonzero(ok)
        if not len(row):
            return
        n = hi - lo
        row = np.concatenate([np.repeat(np.arange(n), self.k), row])
        score = np.concatenate([self.score[lo:hi].reshape(-1), scores[ok]])
        ident = np.concatenate([self.id[lo:hi].reshape(-1), ids[col]])
        order = np.lexsort((ident, -score, row))
        row, score, ident = row[order], score[order], ident[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k  # every anchor has k entries at least
        self.score[lo:hi], self.id[lo:hi] = score[best].reshape(n, self.k), ident[best].reshape(n, self.k)

    def found(self, slot: int) -> pa.RecordBatch:
        at, k = np.nonzero(self.score > NONE)
        arrays = [pa.array(at.astype(np.int32)), pa.array(np.full(len(at), slot, dtype=np.int32)), pa.array(self.id[at, k]), pa.array(self.score[at, k])]
        return pa.RecordBatch.from_arrays(arrays, schema=_FOUND)


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """A column of integer lists as one matrix, filled up with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(col), dims), dtype=np.int64)
    out[np.arange(dims) < n[:, None]] = flat
    return out


@dataclass
class Block:
    """A block of anchors, and the scores of their positives once these are known."""

    id: np.ndarray
    label: np.ndarray
    vectors: Residues
    positive: np.ndarray | None = None  # anchors x positives, NONE where there are fewer

    def best(self, batches: Iterator[pa.RecordBatch], dims: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
        """The best rows of this block's anchors among these batches: positives, or negatives by positive."""
        slots = 1 if self.positive is None else self.positive.shape[1]
        best = [Best(len(self.id), k) for _ in range(slots)]
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("id")  # equal scores: the smaller id first
            ids, label = table.column("id").to_numpy(), table.column("label").to_numpy()
            x = Residues.of(_matrix(table.column("vec"), dims), self.vectors.primes)
            for r in range(0, len(ids), ROWS):
                i, g, rows = ids[r : r + ROWS], label[r : r + ROWS], x.rows(r, r + ROWS)
                for a in range(0, len(self.id), ANCHORS):
                    scores = products(self.vectors.rows(a, a + ANCHORS), rows)
                    same = self.label[a : a + ANCHORS, None] == g
                    if self.positive is None:
                        best[0].add(a, scores, same & (self.id[a : a + ANCHORS, None] != i), i)
                        continue
                    for s in range(slots):
                        p = self.positive[a : a + ANCHORS, s : s + 1]
                        least, most = -((-low * p) // 100), (high * p) // 100
                        best[s].add(a, scores, ~same & (p > NONE) & (scores >= least) & (scores <= most), i)
        yield from (b.found(s) for s, b in enumerate(best))


def quantised(df: DataFrame, id: str, label: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, label, vec): rows that take part, components as floor(scale * x)."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).where(sound)
    vec = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    return rows.select(F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), vec.alias("vec"))


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("at", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of every anchor and positive, from ``quantised`` rows.

    Negatives are rows of another label whose score is at least ``low`` and at most
    ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = stored(rows, "vectors")
    top = rows.agg(F.max(F.size("vec")).alias("dims"), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("decimal(20,0)"))))).alias("largest")).first()
    dims, largest = int(top.dims or 0), int(top.largest or 0)
    if dims * largest**2 >= 1 << 61:
        raise ValueError("scores of these vectors don't fit in 64 bits")
    primes = moduli(dims, dims * largest**2)
    anchors = stored(rows.where(is_anchor).distinct(), "anchors")
    n_blocks = max(1, ceil(anchors.count() * max(dims, 1) * 8 / block_bytes))
    paths = []
    for b in range(n_blocks):
        t = anchors.where(F.pmod(F.xxhash64("id", "label", "vec"), F.lit(n_blocks)) == b).toArrow()  # about block_bytes
        if not t.num_rows:
            continue
        ids, label = t.column("id").to_numpy(), t.column("label").to_numpy()
        block = Block(ids, label, Residues.of(_matrix(t.column("vec"), dims), primes))

        def scored(block: Block, k: int) -> tuple[DataFrame, object]:
            sent = spark.sparkContext.broadcast(block)
            return _first(rows.mapInArrow(lambda it: sent.value.best(it, dims, k, low, high), FOUND_SCHEMA), k), sent

        found, sent = scored(block, positives)
        chosen = found.toArrow()  # at most ``positives`` rows for each anchor of the block
        sent.destroy()
        at, place = chosen.column("at").to_numpy(), chosen.column("rank").to_numpy() - 1
        block.positive = np.full((len(ids), positives), NONE, dtype=np.int64)
        block.positive[at, place] = chosen.column("score").to_numpy()
        named = spark.createDataFrame(pa.table({
            "at": pa.array(at), "slot": pa.array(place.astype(np.int32)), "anchor_id": pa.array(ids[at]),
            "positive_id": chosen.column("id"), "positive_score": chosen.column("score"),
        }))
        found, sent = scored(block, negatives)
        out = found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(named, ["at", "slot"])
        paths.append(scratch(spark, "negatives"))
        out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(paths[-1])
        sent.destroy()
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
