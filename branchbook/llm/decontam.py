"""Benchmark decontamination with suffix arrays over the training documents.

Each task turns a bounded chunk of whole documents into a shard: a word-level
suffix array, sorted by the first words of every suffix that starts with a word
the benchmark uses (other suffixes answer no query). Every test suffix (an item's
words from each of its positions) is binary-searched in every shard; the suffixes
between its two bounds are the verbatim occurrences of the first ``window`` words
(or of the whole item when it has fewer). Occurrences on one diagonal are joined
to the longest verbatim match, reported with its place.

The benchmark is the stated query set. It is cut into blocks of at most about
``block_bytes`` of text; one block at a time is fetched and broadcast, so its size
is bounded whatever the benchmark's is. With several blocks the documents and their
finds are written after each but the last, and its broadcast is dropped before the next
is fetched. Documents are never shuffled.

Defined cases: a null or wordless text has no words and is clean; a null or
wordless item is skipped; items without an id hit like others and count as one item,
but have no name in the list; repeated item rows count once, items sharing a window are all named; repeated document rows each give a row; an empty benchmark leaves
every document clean; further columns are ignored. ``decontaminate`` rejects texts, not
ids: a clean row stays whatever other rows of its doc_id, or other rows without one, hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import ALNUM, FOLDED_NAMES, Words, chunks, cover, released, runs, stored, text_buffer

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
MATCH = "array<struct<item_id:string,doc_word:bigint,item_word:bigint,n_words:bigint>>"
SCHEMA = f"doc_id bigint, n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>, matches {MATCH}"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPAN), ("items", pa.list_(pa.string())), ("matches", _MATCH)])


class TestSuffixes:
    """The distinct test suffixes of a block, as word ids (1.. in name order; 0 is any other word)."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        raw, offs = text_buffer(pa.array([t for _, t in items], pa.string()))
        w = Words(raw, offs, 0, len(items), ALNUM, FOLDED_NAMES)
        self.names = np.unique(w.name)
        ids = np.searchsorted(self.names, w.name) + 1
        self.window = window
        self.item_ids = [None if i is None else str(i) for i, _ in items]
        rows, lens, owner, at = [], [], [], []
        for k in range(len(items)):
            own = ids[w.first[k] : w.first[k + 1]]
            size = min(window, len(own))
            if size == 0:
                continue
            n = len(own) - size + 1
            m = np.zeros((n, window), dtype=np.int64)
            m[:, :size] = np.lib.stride_tricks.sliding_window_view(own, size)
            rows.append(m), lens.append(np.full(n, size)), owner.append(np.full(n, k)), at.append(np.arange(n))
        self.n = 0
        if not rows:
            return
        m, size = np.concatenate(rows), np.concatenate(lens)
        self.words, cls = np.unique(m, axis=0, return_inverse=True)
        cls = cls.reshape(-1)
        self.n = len(self.words)
        self.size = (self.words > 0).sum(axis=1)
        order = np.argsort(cls, kind="stable")
        self.owner, self.at = np.concatenate(owner)[order], np.concatenate(at)[order]
        self.cut = np.searchsorted(cls[order], np.arange(self.n + 1))


def suffix_array(ids: np.ndarray, window: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(array, padded ids): positions with a benchmark word, ordered by their first ``window`` words."""
    per = 63 // bits
    n_keys = -(-window // per)
    pad = np.concatenate([ids, np.zeros(n_keys * per, dtype=np.int64)])
    keys = []
    for k in range(n_keys):
        key = np.zeros(len(ids), dtype=np.int64)
        for j in range(per):
            key = (key << bits) | pad[k * per + j : k * per + j + len(ids)]
        keys.append(key)
    at = np.flatnonzero(ids)
    at = at[np.argsort(keys[0][at])]
    lead = keys[0][at]
    same = lead[1:] == lead[:-1]
    tied = np.zeros(len(at), dtype=bool)
    tied[1:] |= same
    tied[:-1] |= same
    if n_keys > 1 and tied.any():
        sub = at[tied]
        at[tied] = sub[np.lexsort([k[sub] for k in reversed(keys)])]
    return at, pad


def bounds(array: np.ndarray, pad: np.ndarray, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of all test suffixes at once: ranges of the array that start with their words."""
    out = []
    col = np.arange(words.shape[1])
    used = col[None, :] < size[:, None]
    for upper in (False, True):
        lo, hi = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(array), dtype=np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            have = pad[array[np.minimum(mid, len(array) - 1)][:, None] + col[None, :]]
            diff = (have != words) & used
            at = diff.argmax(axis=1)
            row = np.arange(len(words))
            h, q, any_ = have[row, at], words[row, at], diff.any(axis=1)
            right = np.where(any_, h < q, upper) & open_
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        out.append(lo)
    return out[0], out[1]


def _shard(w: Words, doc_ids: list, tests: TestSuffixes) -> Iterator[tuple]:
    n_docs = len(doc_ids)
    n_words = np.diff(w.first)
    found: dict[int, tuple] = {}
    if tests.n and len(w.name):
        k = np.minimum(np.searchsorted(tests.names, w.name), len(tests.names) - 1)
        ids = np.where(tests.names[k] == w.name, k + 1, 0)
        array, pad = suffix_array(ids, tests.window, max(1, int(len(tests.names)).bit_length()))
        if len(array):
            lo, hi = bounds(array, pad, tests.words, tests.size)
            n = hi - lo
            cls = np.repeat(np.arange(tests.n), n)
            at = array[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            fits = tests.size[cls] <= w.left()[at] if len(at) else np.zeros(0, dtype=bool)
            cls, at = cls[fits], at[fits]
            doc = np.searchsorted(w.first, at, side="right") - 1
            order = np.lexsort((at, doc))
            cls, at, doc = cls[order], at[order], doc[order]
            cut = np.searchsorted(doc, np.arange(n_docs + 1))
            for d in np.unique(doc):
                found[int(d)] = (cls[cut[d] : cut[d + 1]], at[cut[d] : cut[d + 1]] - w.first[d])
    for d in range(n_docs):
        if d not in found:
            yield doc_ids[d], int(n_words[d]), [], [], []
            continue
        cls, at = found[d]
        a, b = runs(cover(at, at + tests.size[cls], int(n_words[d])))
        spans = [{"start": int(x), "stop": int(y)} for x, y in zip(a, b)]
        n = tests.cut[cls + 1] - tests.cut[cls]
        take = np.repeat(tests.cut[cls], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, iw, dw, size = tests.owner[take], tests.at[take], np.repeat(at, n), np.repeat(tests.size[cls], n)
        # one diagonal of an item: consecutive test suffixes found at consecutive words
        order = np.lexsort((iw, dw - iw, item))
        item, iw, dw, size = item[order], iw[order], dw[order], size[order]
        new = np.ones(len(item), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | ((dw - iw)[1:] != (dw - iw)[:-1]) | (iw[1:] != iw[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(item)) - 1
        length = iw[last] + size[last] - iw[first]
        best = np.lexsort((dw[first], -length, item[first]))
        lead = np.ones(len(best), dtype=bool)
        lead[1:] = item[first][best][1:] != item[first][best][:-1]
        matches = [
            {"item_id": tests.item_ids[item[first[i]]], "doc_word": int(dw[first[i]]), "item_word": int(iw[first[i]]), "n_words": int(length[i])}
            for i in best[lead]
        ]
        yield doc_ids[d], int(n_words[d]), spans, _named({m["item_id"] for m in matches}), matches


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[tuple[bool, list[tuple]]]:
    """(whether it is the last, items) of every block."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).dropDuplicates()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for b in range(n):
        one = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        yield b == n - 1, sorted(((r["i"], r["t"]) for r in one.collect()), key=lambda r: (str(r[0]), str(r[1])))


def _named(items: set) -> list:
    """Item ids in order, a null one last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def _joined(old: tuple, new: tuple) -> tuple:
    """Spans, items and matches of two blocks for one document."""
    (spans, items, matches), (spans2, items2, matches2) = old, new
    if not spans or not spans2:
        return spans or spans2, _named({*items, *items2}), [*matches, *matches2]
    out: list[dict] = []
    for s in sorted([*spans, *spans2], key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], s["stop"])
        else:
            out.append(dict(s))
    return out, _named({*items, *items2}), [*matches, *matches2]


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, id_type: str = "bigint",
) -> DataFrame:
    """One row per document row: its words, the hit spans (in words), the items found and each item's longest match.

    Several benchmark blocks are searched one after the other; a document's finds are
    stored with its text from one block to the next.
    """
    spark = docs.sparkSession
    schema = SCHEMA.replace("doc_id bigint", f"doc_id {id_type}")
    out = docs.select(F.col(doc_id).cast(id_type).alias("doc_id"), F.col(text).alias("text"))
    before = None
    for last, items in _blocks(benchmark, item_id, item_text, block_bytes):
        tests = spark.sparkContext.broadcast(TestSuffixes(items, window))

        def search(batches: Iterator[pa.RecordBatch], tests=tests, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, offs = text_buffer(batch.column(1))
                ids = batch.column(0).to_pylist()
                for lo, hi in chunks(offs, SHARD_BYTES):
                    rows = list(_shard(Words(raw, offs, lo, hi, ALNUM, FOLDED_NAMES), ids[lo:hi], tests.value))
                    if batch.num_columns > 2:
                        old = zip(*(batch.column(c)[lo:hi].to_pylist() for c in (3, 4, 5)))
                        rows = [(*r[:2], *_joined(o, r[2:])) for o, r in zip(old, rows)]
                    cols = [batch.column(0)[lo:hi], *(pa.array(c, t) for c, t in zip(list(zip(*rows))[1:], _ARROW.types[1:]))]
                    if last:
                        yield pa.RecordBatch.from_arrays(cols, names=_ARROW.names)
                    else:
                        cols.insert(1, batch.column(1)[lo:hi])
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text", *_ARROW.names[1:]])

        out = out.mapInArrow(search, schema if last else schema.replace(",", ", text string,", 1))
        if not last:
            out = stored(out, "finds")
            tests.destroy()
            if before is not None:
                released(spark, before)
            before = out
    return out


def digest(matches: DataFrame) -> DataFrame:
    """The contract's columns from ``find_matches``."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return matches.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, their columns unchanged."""
    name = F.md5(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text"))))
    bad = find_matches(docs.select("text", name.alias("__name")), benchmark, window, doc_id="__name", id_type="string")
    bad = bad.where(F.size("items") > 0).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, name == F.col("__bad"), "left_anti")
