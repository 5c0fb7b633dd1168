"""Exact order statistics and quantiles of many columns by radix-histogram selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer;
for a whole-table quantile that is one task holding the column. Here each value's
64 bits, in an order that agrees with the numbers', are read as four digits of 16
bits. A pass counts, for every column and every wanted prefix, how many values have
each next digit (one array of 65,536 counts per prefix and task, added up by a map-side
combined aggregate); the driver walks the counts and extends each rank's prefix by one
digit. After four passes the digits of all wanted ranks of all columns are known. The
number of passes doesn't depend on the distribution, hot values or the number of ranks,
and no value is ever sorted, shuffled or fetched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16
DIGITS = 64 // DIGIT_BITS
_SIGN = np.uint64(1 << 63)
HIST_SCHEMA = "col int, prefix bigint, digit int, c bigint"


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned 64-bit numbers in the same order."""
    u = (x + 0.0).view(np.uint64)  # + 0.0: one zero
    return np.where(u >> np.uint64(63), ~u, u | _SIGN)


def from_ordered_bits(u: int) -> float:
    bits = u & ~(1 << 63) if u >> 63 else ~u & (1 << 64) - 1
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _digit_counts(batches: Iterator[pa.RecordBatch], wanted: list[list[int]], done: int) -> Iterator[pa.RecordBatch]:
    """One task's counts of the digit after ``done`` digits, for every column's wanted prefixes."""
    shift = np.uint64(64 - DIGIT_BITS * (done + 1))
    prefixes = [np.array(w, dtype=np.uint64) for w in wanted]
    counts = [np.zeros((len(w), 1 << DIGIT_BITS), dtype=np.int64) for w in wanted]
    for batch in batches:
        for c, (sought, count) in enumerate(zip(prefixes, counts)):
            x = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
            u = ordered_bits(x[~np.isnan(x)]) >> shift
            if done:
                top = u >> np.uint64(DIGIT_BITS)
                at = np.minimum(np.searchsorted(sought, top), len(sought) - 1)
                hit = sought[at] == top
                at, u = at[hit], u[hit]
            else:
                at = np.zeros(len(u), dtype=np.int64)
            digit = (u & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64)
            count += np.bincount(at * (1 << DIGIT_BITS) + digit, minlength=count.size).reshape(count.shape)
    for c, (sought, count) in enumerate(zip(prefixes, counts)):
        p, digit = np.nonzero(count)
        arrays = [pa.array(np.full(len(p), c, dtype=np.int32)), pa.array(sought[p].view(np.int64)), pa.array(digit.astype(np.int32)), pa.array(count[p, digit])]
        yield pa.RecordBatch.from_arrays(arrays, names=["col", "prefix", "digit", "c"])


def _histograms(x: DataFrame, wanted: list[list[int]], done: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(column, prefix) -> (digits, counts), digits ascending; at most 65,536 for each prefix."""
    h = x.mapInArrow(lambda it: _digit_counts(it, wanted, done), HIST_SCHEMA).groupBy("col", "prefix", "digit").agg(F.sum("c").alias("c"))
    t = h.toArrow().sort_by([("col", "ascending"), ("prefix", "ascending"), ("digit", "ascending")])
    col, prefix, digit, c = (t.column(k).to_numpy() for k in ("col", "prefix", "digit", "c"))
    cut = np.flatnonzero(np.append(True, (col[1:] != col[:-1]) | (prefix[1:] != prefix[:-1]))) if len(col) else []
    return {
        (int(col[a]), int(prefix[a]) & (1 << 64) - 1): (digit[a:b], c[a:b]) for a, b in zip(cut, [*cut[1:], len(col)])
    }


def _selected(x: DataFrame, ranks_of) -> list[dict[int, float]]:
    """Values at the 0-based ranks ``ranks_of(column, n)`` of every column's n values."""
    n_cols = len(x.columns)
    wanted: list[list[int]] = [[0] for _ in range(n_cols)]
    state: list[dict[int, tuple[int, int]]] = [{} for _ in range(n_cols)]  # rank -> (prefix, rank below the prefix)
    for done in range(DIGITS):
        hist = _histograms(x, wanted, done)
        for c in range(n_cols):
            if not done:
                n = int(hist[c, 0][1].sum()) if (c, 0) in hist else 0
                state[c] = {r: (0, r) for r in ranks_of(c, n)}
            for r, (prefix, rest) in state[c].items():
                digits, counts = hist[c, prefix]
                total = np.cumsum(counts)
                at = int(np.searchsorted(total, rest, side="right"))
                state[c][r] = (prefix << DIGIT_BITS | int(digits[at]), rest - int(total[at] - counts[at]))
            wanted[c] = sorted({p for p, _ in state[c].values()})
        if not any(wanted):
            break  # no column has a value
    return [{r: from_ordered_bits(p) for r, (p, _) in s.items()} for s in state]


def _doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])


def order_statistics(df: DataFrame, col: str, ranks: list[int]) -> dict[int, float]:
    """Values at 0-based ranks of a numeric column; nulls and NaN have no rank."""
    return _selected(_doubles(df, [col]), lambda c, n: [r for r in ranks if 0 <= r < n])[0]


def column_quantiles(df: DataFrame, probs: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles (pandas / ``quantile_cont``) of several numeric columns at once, in four passes.

    ``df`` is read once by each pass: give a stored or persisted frame if it is dear to compute.
    """
    cols = list(probs)
    place: list[list[tuple[int, int, float]]] = [[] for _ in cols]

    def ranks(c: int, n: int) -> list[int]:
        if n:
            for q in probs[cols[c]]:
                k = int(math.floor((n - 1) * q))
                place[c].append((k, min(k + 1, n - 1), (n - 1) * q - k))
        return sorted({r for k, k2, _ in place[c] for r in (k, k2)})

    stats = _selected(_doubles(df, cols), ranks)
    return {
        col: [s[k] + (s[k2] - s[k]) * frac if frac else s[k] for k, k2, frac in p] if p else [None for _ in probs[col]]
        for col, s, p in zip(cols, stats, place)
    }


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles of one numeric column."""
    return column_quantiles(df, {col: probs})[col]
