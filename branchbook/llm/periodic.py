"""Maximal periodic runs of words by internal pattern matching.

A run is a stretch of a text that repeats itself with a smallest period q over at least
max(12, 2q) words and can't be extended. Texts are independent, so Spark spreads them
over tasks; a task handles texts in chunks of a bounded number of words (one longer text
is a chunk of its own), with arrays over all words of the chunk:

1. prefix doubling names all stretches of 1, 2, 4, .. words, by their place in sorted
   order, until all names differ. The last names are the suffix array; the names of
   length l give any block's range in it. Words of different texts never have one name.
2. A run of period q holds an aligned (dyadic) block of l words whose copy follows at
   distance q, l being the largest power of two with 2l - 1 <= max(12 - q, q). Every block
   that occurs twice asks a wavelet matrix over the suffix array for the first, second
   and last occurrence in the neighbouring windows of these distances (range successor
   and predecessor). A window has at most l starts, so its occurrences are an arithmetic
   progression, and its members are the candidate periods.
3. Members that lie in the block's own run of the progression's difference are multiples
   of that run's period and are left out. Others are extended to both sides by comparing
   names; of equal stretches the smallest period counts.

Time and memory of a chunk grow with its words times their logarithm; names are compared,
not hashes, so results are exact.

Defined cases: null, empty and wordless texts have no words and no run; a null doc_id is
taken as it is (nothing is planted); repeated rows are rows of their own; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of the shortest run
CHUNK_WORDS = 1 << 18
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("collapsed", pa.string()), ("runs", _RUNS),
])
OUT_SCHEMA = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, collapsed string, runs array<struct<start: bigint, length: bigint, period: bigint>>"
)


class Names:
    """Names of all stretches of 1, 2, 4, .. words: the number of stretches of that length that sort before."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        order = np.argsort(seq, kind="stable")
        new = np.append(True, np.diff(seq[order]) != 0) if n else np.zeros(0, dtype=bool)
        name = np.empty(n, dtype=np.int32)
        name[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.levels = [name]
        while True:
            shared = np.flatnonzero(np.bincount(name, minlength=n)[name] > 1)
            if not len(shared):
                break
            size = 1 << (len(self.levels) - 1)
            then = np.full(len(shared), -1, dtype=np.int64)
            inside = shared + size < n
            then[inside] = name[shared[inside] + size]
            key = name[shared].astype(np.int64) * (n + 1) + then + 1
            order = np.argsort(key, kind="stable")
            key = key[order]
            at = np.arange(len(key))
            group = np.maximum.accumulate(np.where(np.append(True, np.diff(key // (n + 1)) != 0), at, 0))
            part = np.maximum.accumulate(np.where(np.append(True, np.diff(key) != 0), at, 0))
            name = name.copy()
            name[shared[order]] += (part - group).astype(np.int32)
            self.levels.append(name)

    def suffix_array(self) -> np.ndarray:
        out = np.empty(len(self.levels[-1]), dtype=np.int64)
        out[self.levels[-1]] = np.arange(len(out))
        return out

    def alike(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from positions i and j (i < j) on."""
        n, got = len(self.levels[0]), np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i + got, j + got
            end = b < n
            same = np.zeros(len(i), dtype=bool)
            same[end] = self.levels[k][a[end]] == self.levels[k][b[end]]
            got[same] += 1 << k
        return got

    def alike_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words right before positions i and j (i < j)."""
        got = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i - got - (1 << k), j - got - (1 << k)
            start = a >= 0
            same = np.zeros(len(i), dtype=bool)
            same[start] = self.levels[k][a[start]] == self.levels[k][b[start]]
            got[same] += 1 << k
        return got


class WaveletMatrix:
    """Range successor and predecessor over a permutation of 0 .. n-1, for many ranges at a time."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values)).bit_length(), 1)
        self.zeros_before: list[np.ndarray] = []
        v = values.astype(np.int32)
        for s in range(self.bits - 1, -1, -1):
            one = (v >> s & 1).astype(bool)
            before = np.zeros(len(v) + 1, dtype=np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros_before.append(before)
            v = np.concatenate([v[~one], v[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range are less than x (x < 2**bits)."""
        count = np.zeros(len(lo), dtype=np.int64)
        for s, before in zip(range(self.bits - 1, -1, -1), self.zeros_before):
            a, b = before[lo], before[hi]
            one = (x >> s & 1).astype(bool)
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, before[-1] + lo - a, a), np.where(one, before[-1] + hi - b, b)
        return count

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of each range."""
        out = np.zeros(len(lo), dtype=np.int64)
        for s, before in zip(range(self.bits - 1, -1, -1), self.zeros_before):
            a, b = before[lo], before[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            out |= one.astype(np.int64) << s
            lo, hi = np.where(one, before[-1] + lo - a, a), np.where(one, before[-1] + hi - b, b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Least value >= x of each range, or -1."""
        out = np.full(len(lo), -1, dtype=np.int64)
        k = np.where(x < 1 << self.bits, self.below(lo, hi, np.minimum(x, (1 << self.bits) - 1)), hi - lo)
        some = k < hi - lo
        out[some] = self.kth(lo[some], hi[some], k[some])
        return out

    def predecessor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Greatest value <= x of each range, or -1."""
        out = np.full(len(lo), -1, dtype=np.int64)
        k = np.where(x + 1 < 1 << self.bits, self.below(lo, hi, np.minimum(x + 1, (1 << self.bits) - 1)), hi - lo)
        some = k > 0
        out[some] = self.kth(lo[some], hi[some], k[some] - 1)
        return out


def windows(size: int, least: int = LEAST) -> list[tuple[int, int]]:
    """Distances [first, last] at which a block of ``size`` words looks for its copies, at most ``size`` at a time."""

    def in_charge(q: int) -> bool:
        room = max(least - q, q)  # words that a run of period q has a copy of, at least
        return 2 * size - 1 <= room < 4 * size - 1

    out: list[tuple[int, int]] = []
    for q in range(1, 4 * size):
        if in_charge(q):
            if out and out[-1][1] == q - 1 and q - out[-1][0] < size:
                out[-1] = (out[-1][0], q)
            else:
                out.append((q, q))
    return out


def find_runs(seq: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, stop, period) of all runs of a sequence of word numbers, by start and period."""
    names = Names(seq)
    order = WaveletMatrix(names.suffix_array())
    n = len(seq)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for k, name in enumerate(names.levels):
        size = 1 << k
        copies = np.bincount(name, minlength=n)
        block = np.arange(0, n - size + 1, size)
        block = block[copies[name[block]] > 1]
        if not len(block):
            continue
        lo = name[block].astype(np.int64)
        hi = lo + copies[lo]
        for near, far in windows(size, least):
            first = order.successor(lo, hi, block + near)
            some = (first >= 0) & (first <= block + far)
            b, a, z, one = block[some], lo[some], hi[some], first[some]
            two = order.successor(a, z, one + 1)
            single = (two < 0) | (two > b + far)
            last = order.predecessor(a, z, b + far)
            step = np.where(single, 1, two - one)
            count = (last - one) // step + 1
            skip = np.zeros(len(b), dtype=np.int64)
            periodic = ~single & (2 * step <= size)  # then the step is the block's own period
            own = np.zeros(len(b), dtype=np.int64)
            own[periodic] = names.alike(b[periodic], (b + step)[periodic]) + (b + step)[periodic]  # end of the block's run
            skip[periodic] = np.clip(-((one + size - own - 1) // step), 0, count)[periodic]
            itself = periodic & (b + step == one) & (skip > 0)
            left = count - skip
            at = np.repeat(np.arange(len(b)), left)
            place = np.arange(len(at)) - np.repeat(np.cumsum(left) - left, left)
            i = np.concatenate([b[at], b[itself]])
            j = np.concatenate([(one + skip * step)[at] + place * step[at], one[itself]])
            q = j - i
            start = i - names.alike_before(i, j)
            stop = j + names.alike(i, j)
            ok = stop - start >= np.maximum(least, 2 * q)
            found.append(np.stack([start[ok], stop[ok], q[ok]], axis=1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # the smallest period of each stretch
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def plant(words: list, doc_id: int | None) -> list:
    """The contract's change of every tenth document: from some word on, the text repeats itself."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _row(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
    """One document's result, runs as (start, stop, period) from its first word on."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    kept = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist()) if not d] if len(runs) else words
    text = b" ".join(kept)
    listed = [(s, e - s, q) for s, e, q in runs.tolist()]
    said = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest()
    top = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * top[1] // top[2] if listed else None
    return (doc_id, len(words), len(listed), *top, milli, said, hashlib.sha256(text).hexdigest(), text.decode(), [dict(zip(("start", "length", "period"), r)) for r in listed])


def _found(docs: list[tuple[int | None, list[bytes]]], least: int) -> pa.RecordBatch:
    """Results of one chunk of documents."""
    seq, size = [], 0
    for _, words in docs:
        numbers: dict[bytes, int] = {}
        seq.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)) + size)
        size += len(numbers)  # each text has numbers of its own
    runs = find_runs(np.concatenate(seq), least)
    first = np.cumsum([0, *(len(s) for s in seq)])
    cut = np.searchsorted(runs[:, 0], first)
    rows = [_row(d, words, runs[cut[i] : cut[i + 1]] - [first[i], first[i], 0]) for i, (d, words) in enumerate(docs)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)


def _chunks(batches: Iterator[pa.RecordBatch], planted: bool, least: int) -> Iterator[pa.RecordBatch]:
    docs: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for batch in batches:
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = t.as_buffer().to_pybytes().split() if t.is_valid else []  # bytes: at 0x20 and 0x09-0x0D only
            if planted:
                words = plant(words, d)
            if docs and size + len(words) > CHUNK_WORDS:
                yield _found(docs, least)
                docs, size = [], 0
            docs.append((d, words))
            size += len(words)
    if docs:
        yield _found(docs, least)


def periodic_runs(docs: DataFrame, least: int = LEAST, planted: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: its longest run, digests, all ``runs`` and the ``collapsed`` text (each run's first period kept).

    ``least`` is the length of the shortest run; ``planted`` first changes every tenth document as ``plant`` says.
    """
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(lambda it: _chunks(it, planted, least), OUT_SCHEMA)
