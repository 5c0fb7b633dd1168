"""Helpers shared by the corpus operators: scratch tables, Arrow text chunks, rolling and word hashes.

Texts reach Python through Arrow and are handled as UTF-8 bytes in chunks of a
bounded size (one longer text is a chunk of its own). Words and byte strings get
64-bit names from a polynomial hash over a fixed random byte table, taken from
one running sum per chunk, so no per-word Python code runs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
LONG_WORD = 64  # bytes; polynomials of longer words could be made to agree, so these are hashed one by one
U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
BYTE_NAMES = _RNG.integers(1, 2**64, 256, dtype=U64)
FOLDED_NAMES = BYTE_NAMES.copy()
FOLDED_NAMES[65:91] = FOLDED_NAMES[97:123]  # A-Z count as a-z
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INV = U64(pow(int(BASE), -1, 2**64))
WORD_BASE = U64(0xD1342543DE82EF95)
WORD_BASE_INV = U64(pow(int(WORD_BASE), -1, 2**64))
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, dtype=bool)  # digits, letters and every byte above ASCII
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: U64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        p = np.full(size, base, dtype=U64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class Rolling:
    """Names of any stretch of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray, base: U64 = BASE):
        n = len(values)
        self.sum = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * powers(base, n), out=self.sum[1:])
        self.inv = powers(U64(pow(int(base), -1, 2**64)), n + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sum[stop] - self.sum[start]) * self.inv[start]

    def grams(self, k: int) -> np.ndarray:
        """Names of all stretches of length k, by start."""
        n = len(self.sum) - 1 - k + 1
        return (self.sum[k:] - self.sum[: max(n, 0)]) * self.inv[: max(n, 0)] if n > 0 else np.zeros(0, dtype=U64)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, o


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) whose texts together stay within ``limit`` bytes, or hold one text."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """Words of a chunk of texts: start and end byte, 64-bit name, and each text's first word."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, lo: int, hi: int, word: np.ndarray, names: np.ndarray):
        a = int(offs[lo])
        data = raw[a : int(offs[hi])]
        self.data = data
        ds = offs[lo : hi + 1] - a
        inside = word[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        edges = ds[:-1][ds[:-1] < len(data)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.name = mix(Rolling(names[data]).of(self.start, self.end)) if len(data) else np.zeros(0, dtype=U64)
        fold = names[0x41] == names[0x61]
        for i in np.flatnonzero(self.end - self.start > LONG_WORD):
            word = data[self.start[i] : self.end[i]].tobytes()
            self.name[i] = int.from_bytes(hashlib.blake2b(word.lower() if fold else word, digest_size=8).digest(), "little")
        self.first = np.searchsorted(self.start, ds)  # first word of each text; last entry: number of words
        self.doc_bytes = ds

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """Words from here to the end of the text, this one included."""
        n = np.diff(self.first)
        return np.repeat(self.first[1:], n) - np.arange(len(self.start))


def parts(spark: SparkSession) -> int:
    """Buckets of a shuffle: the session's setting, which grows with the job."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch(spark: SparkSession, name: str) -> str:
    from branchbook.session import scratch_dir

    return f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables written by ``stored`` that nothing needs any more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/llm/" in f}:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cover(start: np.ndarray, stop: np.ndarray, n: int) -> np.ndarray:
    """Boolean cover of [0, n) by the stretches [start, stop)."""
    d = np.zeros(n + 1, dtype=np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, stop, -1)
    return np.cumsum(d[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs of True."""
    d = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


NO_ID = -(2**63)  # stands for a null document id inside blobs


def packed_ids(ids: np.ndarray) -> bytes:
    """Document ids in a blob: differences, compressed (ids of neighbours are close)."""
    import zlib

    return zlib.compress(np.diff(ids, prepend=0).tobytes(), 1)


def unpacked_ids(blob: bytes) -> np.ndarray:
    import zlib

    return np.cumsum(np.frombuffer(zlib.decompress(blob), dtype=np.int64))


def low_bytes(x: np.ndarray, n: int) -> np.ndarray:
    """The n low bytes of 64-bit values, as rows of bytes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n])


def from_low_bytes(blob: bytes, n: int) -> np.ndarray:
    rows = np.frombuffer(blob, dtype=np.uint8).reshape(-1, n)
    out = np.zeros((len(rows), 8), dtype=np.uint8)
    out[:, :n] = rows
    return out.view("<u8").reshape(-1)


KEY = ("__doc", "__h1", "__h2")
KEY_SCHEMA = ", ".join(f"{c} bigint" for c in KEY)
KEY_ARROW = [(c, pa.int64()) for c in KEY]


def with_row_keys(docs: DataFrame) -> DataFrame:
    """The documents with the columns ``KEY``, which tell rows of different texts apart.

    An id that only one row has is a key by itself. Rows of a null id, or of an id that
    several rows share, have a 128-bit hash of the text besides; of the same id and the
    same text they are copies and share a key. Only ids are counted, texts are not read.
    """
    doc = F.col("doc_id").cast("bigint")
    counts = docs.select(doc.alias("__shared")).where("__shared is not null").groupBy("__shared").count()
    shared = stored(counts.where("count > 1").select("__shared"), "shared-ids")
    alone = doc.isNotNull()
    out = docs
    if not shared.isEmpty():
        out = docs.join(shared, doc == F.col("__shared"), "left")
        alone = alone & F.col("__shared").isNull()
    hashes = [F.when(alone, F.lit(0)).otherwise(h).cast("bigint") for h in (F.xxhash64("text"), F.xxhash64(F.lit(977), "text"))]
    return out.select(*(docs[c] for c in docs.columns), *(c.alias(k) for c, k in zip((F.coalesce(doc, F.lit(NO_ID)), *hashes), KEY)))


def row_keys(batch: pa.RecordBatch) -> np.ndarray:
    """The key columns of a batch, a row of three values each."""
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY], axis=1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Row keys in a blob: packed ids, and the hashes where any row has one."""
    import zlib

    ids = packed_ids(keys[:, 0])
    return len(ids).to_bytes(4, "little") + ids + (zlib.compress(keys[:, 1:].tobytes(), 1) if keys[:, 1:].any() else b"")


def unpacked_keys(blob: bytes) -> np.ndarray:
    import zlib

    n = 4 + int.from_bytes(blob[:4], "little")
    ids = unpacked_ids(blob[4:n])
    keys = np.zeros((len(ids), len(KEY)), dtype=np.int64)
    keys[:, 0] = ids
    if len(blob) > n:
        keys[:, 1:] = np.frombuffer(zlib.decompress(blob[n:]), dtype=np.int64).reshape(-1, 2)
    return keys


def parts_of(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """The part of the documents each row key belongs to."""
    k = keys.view(U64)
    return (mix(k[:, 0] ^ k[:, 1]) % U64(n_parts)).astype(np.int64)


def grouped_keys(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bounds of equal keys in that order, the distinct keys) of row keys in blobs."""
    keys = np.concatenate([unpacked_keys(b) for b in blobs])
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return order, np.append(np.flatnonzero(new), len(keys)), keys[new]


MARK_SCHEMA = "part int, docs binary, spans binary"
_MARK = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("spans", pa.binary())])
_PER_DOC = pa.schema([*KEY_ARROW, ("spans", pa.binary())])


def mark_table(keys: np.ndarray, start: np.ndarray, stop: np.ndarray, n_parts: int) -> pa.Table:
    """Marked stretches of documents, by row key, packed: one row for each part of the documents."""
    part = parts_of(keys, n_parts)
    order = np.lexsort((start, *keys.T[::-1], part))
    part, keys = part[order], keys[order]
    pairs = np.stack([start[order], stop[order]], axis=1).astype("<u4")
    cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)) if len(part) else np.zeros(1, dtype=np.int64)
    rows = [(int(part[a]), packed_keys(keys[a:b]), pairs[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_MARK.types)], schema=_MARK)


def _marks_by_doc(table: pa.Table) -> pa.Table:
    order, cut, keys = grouped_keys(table.column("docs").to_pylist())
    pairs = np.frombuffer(b"".join(table.column("spans").to_pylist()), dtype="<u4").reshape(-1, 2)[order]
    return pa.table([*(pa.array(k) for k in keys.T), pa.array([pairs[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], schema=_PER_DOC)


def marks_by_document(marks: DataFrame) -> DataFrame:
    """(``KEY``, spans): one row per marked row key, from rows of MARK_SCHEMA."""
    return marks.groupBy("part").applyInArrow(_marks_by_doc, f"{KEY_SCHEMA}, spans binary")


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, text, marks): every document with the stretches marked in it, from keyed documents and rows of MARK_SCHEMA."""
    return docs.join(marks_by_document(marks), list(KEY), "left").select("doc_id", "text", "spans")


def covered(blob: bytes | None, n: int) -> np.ndarray:
    """Boolean cover of a document's n units by its marks."""
    if not blob or not n:
        return np.zeros(n, dtype=bool)
    pairs = np.minimum(np.frombuffer(blob, dtype="<u4").reshape(-1, 2).astype(np.int64), n)
    return cover(pairs[:, 0], pairs[:, 1], n)
