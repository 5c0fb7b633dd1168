"""Sequence packing as a cutting-stock problem, solved by column generation.

A document is its token ids and one id 0. Full lengths of 1024 are sequences of their
own; what is left of each document, 1 to 1023 tokens, is an item. A histogram of item
lengths in steps of ``WIDTH`` (at most 128 counts leave the executors) is the demand. A linear program over patterns, each
a way to fill one sequence, covers the counts with the fewest sequences; an unbounded
knapsack by dynamic programming prices new patterns until none can lower the optimum by
more than ``GAP``. Whole multiples of the patterns are used, and the few items left by
rounding (no more than the patterns hold together once) are filled first-fit by size.

Documents get ranks within their step by hashed buckets of bounded size and bucket
offsets, so a step that a third of all documents share is many small groups. A
pattern takes consecutive ranks of a step; a search in the pattern table, of bounded
size, gives each document its sequence and slot, and the lengths before it in the
sequence its offset. Items are counted at the upper end of their step: that is where
the little padding comes from, under 8 tokens an item.

Token ids come from the vocabulary as a rank file, which holds the same ids as the
tokenizer's JSON file and is read several times faster. The rank file has no added
tokens: those are read from the JSON file and go whole to their ids, wherever a text
holds them. Without a JSON file there are none, and special strings are ordinary text.

Defined cases: a null or empty text is the id 0 alone; equal lengths are ranked by
doc_id, repeated rows are packed each; an empty table gives no pieces; further columns
are ignored. Each document is cut only at multiples of 1024.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import chunks, stored, text_buffer

LENGTH = 1024
WIDTH = 8
GAP = 0.0005
GROUP = 20_000  # documents of a bucket


class Encoder:
    """Token ids of whole texts from a rank file and the added tokens of its tokenizer's JSON file."""

    def __init__(self, path: str, added: str | None = None):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = []
        if added is not None:
            with open(added, encoding="utf-8") as file:
                tokens = json.load(file)["added_tokens"]
        special = {t["content"]: t["id"] for t in tokens}
        if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on the text around them are not supported")
        if any(a != b and a in b for a in special for b in special):
            raise ValueError("added tokens inside one another are not supported")
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> np.ndarray:
        """The text's ids and one id 0."""
        return np.array([*self.encoding.encode(text or "", allowed_special="all"), 0], dtype="<u4")


_encoders: dict[tuple[str, str | None], Encoder] = {}
DOC_SCHEMA = "doc_id bigint, n bigint, crcs array<bigint>"
_DOC = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("crcs", pa.list_(pa.int64()))])


def tokenized(docs: DataFrame, path: str, length: int, added: str | None = None) -> DataFrame:
    """(doc_id, n, crcs): number of ids of every document and the checksum of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, added) not in _encoders:
            _encoders[path, added] = Encoder(path, added)
        for batch in batches:
            _, offs = text_buffer(batch.column(1))
            encode = _encoders[path, added].encode
            for lo, hi in chunks(offs):
                n, crcs = [], []
                for t in batch.column(1)[lo:hi]:
                    ids = encode(t.as_py())
                    n.append(len(ids))
                    crcs.append([zlib.crc32(ids[i : i + length]) for i in range(0, len(ids), length)])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], schema=_DOC)

    return docs.mapInArrow(run, DOC_SCHEMA)


def price(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: (best worth, copies of each size)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c], pick[c] = best[c - 1], -1
        fit = int(np.searchsorted(sizes, c, side="right"))
        if fit:
            v = best[c - sizes[:fit]] + worth[:fit]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], pick[c] = v[i], i
    copies, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            copies[pick[c]] += 1
            c -= sizes[pick[c]]
    return float(best[capacity]), copies


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int = LENGTH, gap: float = GAP) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: copies}) that hold every item exactly once: rounded LP patterns, then first fit for the rest."""
    order = np.argsort(sizes)
    sizes, demand = sizes[order].astype(np.int64), demand[order].astype(np.int64)
    m = len(sizes)
    if not m:
        return []
    basis = np.diag((capacity // sizes).astype(float))
    inverse, x = np.diag(1.0 / basis.diagonal()), demand / basis.diagonal()
    for _ in range(40 * m + 100):
        worth = inverse.sum(axis=0)
        value, column = price(sizes, np.maximum(worth, 0.0), capacity)
        if value <= 1 + gap:
            break
        u = inverse @ column
        ok = u > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, u, 1.0), np.inf)
        r = int(ratio.argmin())
        step = max(float(ratio[r]), 0.0)
        x = np.maximum(x - step * u, 0.0)
        x[r] = step
        row = inverse[r] / u[r]
        inverse -= np.outer(u, row)
        inverse[r] = row
        basis[:, r] = column
    times = np.floor(x + 1e-6).astype(np.int64)
    left = demand.copy()
    out = []
    for j in np.argsort(-x, kind="stable"):
        copies = basis[:, j].astype(np.int64)
        used = copies > 0
        t = int(min(times[j], (left[used] // copies[used]).min())) if used.any() else 0
        if t > 0:
            out.append((t, {int(s): int(c) for s, c in zip(sizes[used], copies[used])}))
            left -= t * copies
    rooms: list[list] = []  # first fit by falling size
    for i in range(m - 1, -1, -1):
        s, k = int(sizes[i]), int(left[i])
        for room in rooms:
            if not k:
                break
            t = min(k, room[0] // s)
            if t:
                room[0] -= t * s
                room[1][s] = room[1].get(s, 0) + t
                k -= t
        while k:
            t = min(k, capacity // s)
            rooms.append([capacity - t * s, {s: t}])
            k -= t
    return out + [(1, room[1]) for room in rooms]


class Plan:
    """Per step: the first rank, copies, first sequence and first slot of every pattern that holds it."""

    def __init__(self, found: list[tuple[int, dict[int, int]]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        self.sequences = 0
        for times, copies in found:
            slot = 0
            for s in sorted(copies, reverse=True):
                rows.setdefault(s, []).append((taken.get(s, 0), copies[s], self.sequences, slot))
                taken[s] = taken.get(s, 0) + times * copies[s]
                slot += copies[s]
            self.sequences += times
        self.arrays = {s: np.array(v, dtype=np.int64).T for s, v in rows.items()}

    def place(self, step: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, slot = np.zeros(len(step), dtype=np.int64), np.zeros(len(step), dtype=np.int64)
        for s in np.unique(step):
            at = np.flatnonzero(step == s)
            first, copies, base, start = self.arrays[int(s)]
            p = np.searchsorted(first, rank[at], side="right") - 1
            k = rank[at] - first[p]
            seq[at], slot[at] = base[p] + k // copies[p], start[p] + k % copies[p]
        return seq, slot


PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, slot bigint"
_PIECE = pa.schema([(c.split()[0], pa.int64()) for c in PIECE_SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", added: str | None = None) -> DataFrame:
    """One row per piece: its place in the document and in its sequence.

    ``tokenizer`` is the rank file, ``added`` the JSON file that names the added tokens.
    """
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    lengths = stored(tokenized(src, tokenizer, length, added), "tokens")
    item = F.ceil((F.col("n") % length) / WIDTH)
    counts = lengths.groupBy(item.alias("r")).agg(F.count("*").alias("c")).collect()  # at most length / WIDTH + 1 rows
    items = sorted((r["r"], r["c"]) for r in counts if r["r"])
    plan = Plan(patterns(np.array([r for r, _ in items], dtype=np.int64), np.array([c for _, c in items], dtype=np.int64), length // WIDTH))
    n_buckets = max(1, -(-sum(r["c"] for r in counts) // GROUP))
    rows = lengths.withColumns({"r": item, "full": F.floor(F.col("n") / length), "b": F.pmod(F.xxhash64("doc_id", "n"), F.lit(n_buckets))})
    order = ["doc_id", "n", F.xxhash64("crcs")]
    rows = rows.withColumns({
        "in_bucket": F.sum("full").over(Window.partitionBy("b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"),
        "in_group": F.row_number().over(Window.partitionBy("b", "r").orderBy(*order)) - 1,
    })
    plain = lengths.withColumns({"r": item, "full": F.floor(F.col("n") / length), "b": F.pmod(F.xxhash64("doc_id", "n"), F.lit(n_buckets))})
    groups = plain.groupBy("b", "r").agg(F.count("*").alias("c"))
    before = Window.partitionBy("r").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("b", "r", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("group_base"))
    buckets = plain.groupBy("b").agg(F.sum("full").alias("f"))  # a row for each 20,000 documents
    buckets = buckets.select("b", F.coalesce(F.sum("f").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_base"))
    ranked = rows.join(groups, ["b", "r"]).join(buckets, "b").select(
        "doc_id", "n", "crcs", (F.col("group_base") + F.col("in_group")).cast("bigint").alias("rank"), (F.col("bucket_base") + F.col("in_bucket")).cast("bigint").alias("full_base"))
    given = docs.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = given.value
        for batch in batches:
            n, rank, base = (batch.column(c).to_numpy() for c in (1, 3, 4))
            crcs = batch.column(2).flatten().to_numpy()
            pieces = -(-n // length)
            doc = np.repeat(np.arange(len(n)), pieces)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(n[doc] - k * length, length)
            seq, slot = p.sequences + base[doc] + k, np.zeros(len(doc), dtype=np.int64)
            part = np.flatnonzero(size < length)
            seq[part], slot[part] = p.place(-(-size[part] // WIDTH), rank[doc[part]])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in (k * length, size, crcs, n[doc], seq, slot))], schema=_PIECE)

    placed = ranked.mapInArrow(place, PIECE_SCHEMA)
    so_far = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)  # at most ``length`` rows each
    return placed.withColumn("offset", F.sum("length").over(so_far) - F.col("length")).drop("slot")
