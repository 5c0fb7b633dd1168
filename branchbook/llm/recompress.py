"""Substring dedup by recompression.

Two rounds of pair compression name each document's words: a symbol's name falls on
a left or a right side, and a left symbol followed by a right one becomes one symbol
named after both. Names are functions of content, so every executor gives equal
stretches equal names and no round needs a shuffle to agree on them. Whether two
neighbours merge depends on them alone, hence inside two equal stretches of words all
symbol boundaries agree except near the ends; runs of one word have no pair to merge
and keep their boundaries. For a window of 13 words the second-round boundaries after
3 to 10 words are always the same, and at least two of those exist, as symbols
hold at most 4 words.

Each window is filed under the boundary with the least name of its neighbouring
symbols: equal windows are filed under equal symbols, whatever surrounds them. One
shuffle by symbol brings together the documents that share it ("reveals"); there the
windows themselves are compared ("verifies"): a window is removed if its words also
start in a document with a smaller id. Symbols travel packed, one row per batch and
bucket, so a symbol that a third of the corpus holds is a few bytes per occurrence.
Buckets are dealt by symbol only: a frequent passage is spread over buckets by its
many symbols, but all occurrences of one hot symbol lie in one group. The comparison
of windows decides what goes; the symbols only choose the bucket.

Windows are compared by 64 bits, mixed from their names and their place around the boundary.
Defined cases: a null or wordless text has no words and keeps the empty text; texts
under a window's length are kept whole; a document is not compared with itself nor
with rows of its own id; of rows that share a doc_id, or have none, each loses what is
found in itself (marks go by doc_id and, for such ids, a hash of the text); a null
doc_id counts as smallest; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import (
    BYTE_NAMES, KEY, MARK_SCHEMA, NO_ID, NOT_SPACE, U64, WORD_BASE, Rolling, Words, chunks, covered,
    from_low_bytes, low_bytes, mark_table, mix, packed_keys, parts, row_keys, text_buffer, unpacked_keys, with_marks, with_row_keys,
)

WINDOW = 13
NAME_BYTES = 6
ENTRY_SCHEMA = "bucket int, docs binary, idx binary, pos binary, lead binary, n binary, name binary, windows binary"
_ENTRY = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "idx", "pos", "lead", "n", "name", "windows"))])
OUT_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])


def compress(names: np.ndarray, at: np.ndarray, last: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round: (names, first word, ends-its-document) of the symbols after merging left-right pairs."""
    side = (mix(names ^ U64(salt)) >> U64(17)) & U64(1)
    pair = np.zeros(len(names), dtype=bool)
    pair[:-1] = (side[:-1] == 0) & (side[1:] == 1) & ~last[:-1]
    keep = np.ones(len(names), dtype=bool)
    keep[1:] = ~pair[:-1]
    follow = np.append(names[1:], U64(0))
    named = np.where(pair, mix(names * U64(0xA24BAED4963EE407) + mix(follow + U64(salt))), names)
    ends = np.where(pair, np.append(last[1:], True), last)
    return named[keep], at[keep], ends[keep]


def anchors(w: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, its boundary word) of every window, and the windows' names."""
    n = len(w.name)
    starts = np.flatnonzero(w.left() >= window) if n else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return starts, starts, np.zeros(0, dtype=U64)
    last = np.zeros(n, dtype=bool)
    ends = w.first[1:]
    last[ends[ends > 0] - 1] = True
    one, at1, last1 = compress(w.name, np.arange(n), last, 0x51ED27)
    prior = mix(one * U64(0x9FB21C651E98DF25) + np.concatenate(([U64(0)], one[:-1])))
    level1 = np.full(n, 0xFFFFFFFF, dtype=U64)
    level1[at1] = prior >> U64(33)  # 31 bits, below the value that stands for no boundary
    _, at2, _ = compress(one, at1, last1, 0x2C1B3C)
    rank = np.full(n + window, U64(0xFFFFFFFF) << U64(32), dtype=U64)
    rank[at2] = level1[at2] << U64(32)
    rank[:n] |= np.arange(n, dtype=U64)
    span = window - 5  # boundaries after 3 .. window - 3 words
    low, width = rank, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    at = (low[starts + 3] & U64(0xFFFFFFFF)).astype(np.int64)
    return starts, at, mix(Rolling(w.name, WORD_BASE).grams(window)[starts])


def _entries(raw: np.ndarray, offs: np.ndarray, keys: np.ndarray, window: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    got = []
    for lo, hi in chunks(offs):
        w = Words(raw, offs, lo, hi, NOT_SPACE, BYTE_NAMES)
        starts, at, names = anchors(w, window)
        if not len(starts):
            continue
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        head = np.flatnonzero(new)
        boundary = at[head]
        doc = np.searchsorted(w.first, boundary, side="right") - 1
        count = np.diff(np.append(head, len(at)))
        around = mix(Rolling(w.name, WORD_BASE).of(boundary - 3, boundary + 3))  # inside every window filed here
        got.append((doc + lo, starts[head] - w.first[doc], boundary - starts[head], count, around, names))
    if not got:
        return
    doc, pos, lead, count, name, windows = (np.concatenate(c) for c in zip(*got))
    bucket = (name % U64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    first = np.cumsum(count) - count
    out = []
    for b in range(n_buckets):
        e = order[cut[b] : cut[b + 1]]
        if not len(e):
            continue
        own, idx = np.unique(doc[e], return_inverse=True)
        c = count[e]
        take = np.repeat(first[e], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        out.append((
            b, packed_keys(keys[own]), idx.astype("<u2").tobytes(), pos[e].astype("<u4").tobytes(), lead[e].astype(np.uint8).tobytes(),
            c.astype(np.uint8).tobytes(), low_bytes(name[e], NAME_BYTES).tobytes(), low_bytes(windows[take], NAME_BYTES).tobytes(),
        ))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ENTRY.types)], schema=_ENTRY)


def _verified(table: pa.Table, n_parts: int) -> pa.Table:
    """Windows of a bucket that also start in a document with a smaller id, as spans by document."""
    col = {c: table.column(c).to_pylist() for c in table.column_names if c != "bucket"}
    held = [unpacked_keys(b) for b in col["docs"]]
    base, keys = np.cumsum([0, *map(len, held)]), np.concatenate(held)
    row, pos, lead, n, name, windows = [], [], [], [], [], []
    for r in range(table.num_rows):
        row.append(base[r] + np.frombuffer(col["idx"][r], dtype="<u2"))
        pos.append(np.frombuffer(col["pos"][r], dtype="<u4"))
        lead.append(np.frombuffer(col["lead"][r], dtype=np.uint8))
        n.append(np.frombuffer(col["n"][r], dtype=np.uint8))
        name.append(from_low_bytes(col["name"][r], NAME_BYTES))
        windows.append(from_low_bytes(col["windows"][r], NAME_BYTES))
    row, pos, lead, n, name, windows = (np.concatenate(c) for c in (row, pos, lead, n, name, windows))
    doc = keys[row, 0]
    # reveal: symbols that more than one document holds
    _, sym = np.unique(name, return_inverse=True)
    low, high = np.full(sym.max() + 1, 2**63 - 1), np.full(sym.max() + 1, NO_ID)
    np.minimum.at(low, sym, doc)
    np.maximum.at(high, sym, doc)
    shared = (low < high)[sym]
    n = n.astype(np.int64)
    windows = windows[np.repeat(shared, n)]
    row, doc, pos, lead, n, name = row[shared], doc[shared], pos[shared].astype(np.int64), lead[shared].astype(np.int64), n[shared], name[shared]
    if not len(doc):
        return mark_table(keys[row], pos, pos, n_parts)
    # verify: equal windows around the symbol
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(lead, n) - step
    key = mix(mix(np.repeat(name, n) * U64(16) + place.astype(U64)) + windows)
    order = np.argsort(key)
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[order][1:] != key[order][:-1]
    owner = np.repeat(doc, n)[order]
    least = np.minimum.reduceat(owner, np.flatnonzero(first))
    again = np.zeros(len(key), dtype=bool)
    again[order] = owner > least[np.cumsum(first) - 1]
    entry = np.repeat(np.arange(len(n)), n)
    a, b = _runs_within(again, entry)
    return mark_table(keys[row[entry[a]]], pos[entry[a]] + step[a], pos[entry[a]] + step[b - 1] + WINDOW, n_parts)


def _runs_within(mask: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that stay within one group."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (group[at[1:]] != group[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = text_buffer(batch.column(1))
        marks, ids = batch.column(2), batch.column(0)
        for lo, hi in chunks(offs, 4 << 20):
            w = Words(raw, offs, lo, hi, NOT_SPACE, BYTE_NAMES)
            own, data, rows = marks[lo:hi].to_pylist(), w.data.tobytes(), []
            for d in range(hi - lo):
                a, b = w.first[d], w.first[d + 1]
                gone = covered(own[d], int(b - a))
                if gone.any():
                    kept = b" ".join(data[s:e] for s, e in zip(w.start[a:b][~gone].tolist(), w.end[a:b][~gone].tolist()))
                else:
                    kept = b" ".join(data[w.doc_bytes[d] : w.doc_bytes[d + 1]].split())
                rows.append((int(b - a), int(gone.sum()), kept, hashlib.sha256(kept).hexdigest()))
            n, gone, kept, sha = zip(*rows)
            text = pa.array(kept, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([ids[lo:hi].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), text, pa.array(sha)], schema=_OUT)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of MARK_SCHEMA: the stretches of words of the keyed documents whose windows also start in a document with a smaller id."""
    docs = docs.select("text", *KEY)
    n_buckets = parts(docs.sparkSession)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffer(batch.column("text"))
            keys = row_keys(batch)
            for lo in range(0, len(keys), 1 << 15):
                yield from _entries(raw, offs[lo : lo + (1 << 15) + 1], keys[lo : lo + (1 << 15)], window, n_buckets)

    filed = docs.mapInArrow(entries, ENTRY_SCHEMA)
    return filed.groupBy("bucket").applyInArrow(lambda t: _verified(t, n_buckets), MARK_SCHEMA)


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: words, words removed, the kept text and its hash."""
    if window != WINDOW:
        raise ValueError("the symbol boundaries are proven for windows of 13 words")
    src = with_row_keys(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    return with_marks(src, repeated_spans(src, window)).mapInArrow(_kept, OUT_SCHEMA)
