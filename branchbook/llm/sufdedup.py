"""Suffix-array dedup with a logarithmic index family.

Every byte string of ``length`` bytes is filed under one suffix: the one, of those
that start in it, whose first 32 bytes have the least name (the first on a tie).
Equal strings pick equal suffixes, so a sparse suffix array over the picked suffixes,
about 1 in 85, answers for all strings. A suffix is kept as the name of its first 32
bytes and the name of the whole stretch of strings filed under it.

``SuffixFamily`` keeps the index as tables in the shared folder. A batch of documents
gets its suffix arrays, sorted by name, and becomes the newest level. Before that, levels
of equal size merge, as carries do in a binary counter, so a suffix is merged about
log2(batches) times; a merged level keeps one suffix for each distinct stretch and whether
it was found more than once. The new level is then scanned against all others: names
are dealt over buckets by range, and each bucket's sorted arrays are merged in one task.
Documents may be added at any time; the marks of all batches together are those of one.

A suffix whose whole stretch occurs twice settles all its strings at once, copies and
common passages thus need no further work. Suffixes that share 32 bytes but not the
stretch go back to their texts once, one per distinct stretch: the names of the single
strings decide there. Names have 64 bits, of a stretch as of a string and its
suffix together; bytes are not compared after them.

Hot names and stretches, those with more than a quarter of a mean bucket, are counted
first: each task reports what holds such a share of its own suffixes, so none can be
missed (but for tasks of few suffixes, where one must occur twice to be reported), and at most four times the number of buckets are kept and sent to the tasks. A
hot stretch is settled where it stands and only one suffix for each array goes on; a hot
name is dealt by its stretches, and its strings one by one, over all buckets.

Defined cases: a null text is empty; texts under ``length`` bytes are kept; matches
never cross documents; repeated rows are copies of each other; every row is a
document of its own, whether its doc_id is null or shared with other rows (marks go by
doc_id and, for such ids, a hash of the text); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.llm.common import (
    BYTE_NAMES, KEY, KEY_ARROW, KEY_SCHEMA, MARK_SCHEMA, U64, Rolling, chunks, covered, from_low_bytes, grouped_keys, low_bytes, mark_table,
    marks_by_document, mix, packed_keys, parts, parts_of, released, row_keys, runs, stored, text_buffer, unpacked_keys, with_marks, with_row_keys,
)

LENGTH = 200
LEAD = 32
STRING_BYTES = 6
BATCHES = 3  # batches a whole table is added in
PIECE = 1 << 16  # suffixes in one row of a level
_PLACE = np.dtype([("start", "<u4"), ("lead", "<u2"), ("n", "<u2"), ("sure", "u1")])
_COLUMNS = ("docs", "idx", "name", "stretch", "place")
LEVEL_SCHEMA = ", ".join(f"{c} binary" for c in _COLUMNS)
_LEVEL = pa.schema([(c, pa.binary()) for c in _COLUMNS])
DEALT_SCHEMA = f"bucket int, fresh boolean, {LEVEL_SCHEMA}"
_DEALT = pa.schema([("bucket", pa.int32()), ("fresh", pa.bool_()), *_LEVEL])
_ASK = pa.schema([*KEY_ARROW, ("asked", pa.binary())])
FOUND_SCHEMA = "settled boolean, part int, docs binary, spans binary, asked binary"
_FOUND = pa.schema([("settled", pa.bool_()), ("part", pa.int32()), ("docs", pa.binary()), ("spans", pa.binary()), ("asked", pa.binary())])
OUT_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def picked_suffixes(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first string start, number of strings, suffix start, suffix name, stretch name) of every picked suffix.

    ``ends`` are the texts' bounds in ``data``; strings do not cross them.
    """
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none.astype(U64), none.astype(U64)
    roll = Rolling(BYTE_NAMES[data])
    gram = mix(roll.grams(LEAD))
    rank = (gram & (U64(0xFFFFFFFF) << U64(32))) | np.arange(len(gram), dtype=U64)
    span, width = length - LEAD + 1, 1
    while 2 * width <= span:
        rank = np.minimum(rank[:-width], rank[width:])
        width *= 2
    if width < span:
        rank = np.minimum(rank[: len(rank) - (span - width)], rank[span - width :])
    at = (rank & U64(0xFFFFFFFF)).astype(np.int64)  # suffix of the string that starts here
    ok = np.ones(len(at), dtype=bool)
    for e in ends[1:-1]:
        ok[max(int(e) - length + 1, 0) : int(e)] = False
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
    stop = np.ones(len(at), dtype=bool)
    stop[:-1] = (at[1:] != at[:-1]) | ~ok[1:]
    first = np.flatnonzero(new & ok)
    count = np.flatnonzero(stop & ok) + 1 - first
    suffix = at[first]
    stretch = mix(roll.of(first, first + count + length - 1) + mix(((suffix - first) * 256 + count).astype(U64)))
    return first, count, suffix, gram[suffix], stretch


def _level_row(keys: np.ndarray, name: np.ndarray, stretch: np.ndarray, place: np.ndarray) -> tuple[bytes, ...]:
    """Suffixes, each with its document's row key, as the binary columns of one row."""
    order = np.lexsort(keys.T[::-1])
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
    idx = np.empty(len(keys), dtype="<u2")
    idx[order] = np.cumsum(new) - 1
    return packed_keys(keys[order][new]), idx.tobytes(), name.tobytes(), stretch.tobytes(), place.tobytes()


def _level_cols(docs: bytes, idx: bytes, name: bytes, stretch: bytes, place: bytes) -> tuple[np.ndarray, ...]:
    """The inverse: (row keys, names, stretches, places)."""
    keys = unpacked_keys(docs)[np.frombuffer(idx, dtype="<u2")]
    return keys, np.frombuffer(name, dtype=U64), np.frombuffer(stretch, dtype=U64), np.frombuffer(place, dtype=_PLACE)


def _binary(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)


def _suffix_arrays(raw: np.ndarray, offs: np.ndarray, keys: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """The sorted suffix array of some documents, in pieces of consecutive names."""
    got = []
    for lo, hi in chunks(offs):
        a = int(offs[lo])
        ends = offs[lo : hi + 1] - a
        first, count, suffix, name, stretch = picked_suffixes(raw[a : int(offs[hi])], ends, length)
        if len(first):
            doc = np.searchsorted(ends, first, side="right") - 1
            place = np.zeros(len(first), dtype=_PLACE)
            place["start"], place["lead"], place["n"] = first - ends[doc], suffix - first, count
            got.append((doc + lo, mix(name), stretch, place))  # least names are small: mixed again, they spread evenly
    if not got:
        return
    doc, name, stretch, place = (np.concatenate(c) for c in zip(*got))
    order = np.lexsort((stretch, name))
    for lo in range(0, len(order), PIECE):
        e = order[lo : lo + PIECE]
        yield _binary([_level_row(keys[doc[e]], name[e], stretch[e], place[e])], _LEVEL)


def _counts(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Names (0) and stretches (1) that hold 1/share of a task's suffixes in blocks of a million, and the number of suffixes (2)."""
    held, n = [], 0

    def counted() -> pa.RecordBatch:
        kind, value, many = [np.array([2])], [np.zeros(1, dtype=np.int64)], [np.array([n])]
        for k, blobs in enumerate(zip(*held)):
            v, c = np.unique(np.frombuffer(b"".join(blobs), dtype=U64), return_counts=True)
            often = c >= max(2, n / share)
            kind.append(np.full(int(often.sum()), k))
            value.append(v[often].view(np.int64))
            many.append(c[often])
        cols = [pa.array(np.concatenate(c), t) for c, t in ((kind, pa.int32()), (value, pa.int64()), (many, pa.int64()))]
        return pa.RecordBatch.from_arrays(cols, names=["kind", "value", "n"])

    for batch in batches:
        for name, stretch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.append((name, stretch))
            n += len(name) // 8
            if n >= 1 << 20:
                yield counted()
                held, n = [], 0
    if n:
        yield counted()


def hot_names(level: DataFrame, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and stretches that hold at least 1/share of a level's suffixes, at most ``share`` of either.

    What holds 2/share of all suffixes holds 1/share of some blocks and is reported there; what
    is left out of a block makes up less than 1/share in all.
    """
    counts = level.select("name", "stretch").mapInArrow(lambda it: _counts(it, share), "kind int, value bigint, n bigint")
    counts = stored(counts.groupBy("kind", "value").agg(F.sum("n").alias("n")), "suffix-counts")
    total = counts.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    rows = counts.where((F.col("kind") < 2) & (F.col("n") * share >= total)).collect()
    released(level.sparkSession, counts)
    return tuple(np.sort(np.array([r.value for r in rows if r.kind == k], dtype=np.int64).view(U64)) for k in (0, 1))


def _held(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are among some sorted values."""
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _by_range(x: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((x >> U64(32)) * U64(n_buckets) >> U64(32)).astype(np.int64)


def _dealt(batches: Iterator[pa.RecordBatch], hot: tuple[np.ndarray, np.ndarray], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Suffixes by bucket: ranges of names, hot names by stretch, of a hot stretch one suffix for each array."""
    for batch in batches:
        fresh = batch.column(0).to_pylist()
        for r, blobs in enumerate(zip(*(batch.column(c).to_pylist() for c in _COLUMNS))):
            keys, name, stretch, place = _level_cols(*blobs)
            often = _held(hot[1], stretch)
            if often.any():  # sorted by name and stretch: equal ones are neighbours
                lead = np.ones(len(name), dtype=bool)
                lead[1:] = (stretch[1:] != stretch[:-1]) | (name[1:] != name[:-1])
                place = place.copy()
                place["sure"] |= often
                keep = lead | ~often
                keys, name, stretch, place = keys[keep], name[keep], stretch[keep], place[keep]
            bucket = np.where(_held(hot[0], name), _by_range(mix(name ^ mix(stretch)), n_buckets), _by_range(name, n_buckets))
            order = np.argsort(bucket, kind="stable")
            cut = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
            out = []
            for a, b in zip(cut[:-1], cut[1:]):
                e = order[a:b]
                out.append((int(bucket[e[0]]), fresh[r], *_level_row(keys[e], name[e], stretch[e], place[e])))
            if out:
                yield _binary(out, _DEALT)


def _bucket(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(row keys, names, stretches, places, of the new batch) of a bucket, merged by name and stretch."""
    rows = [_level_cols(*r) for r in zip(*(table.column(c).to_pylist() for c in _COLUMNS))]
    fresh = np.repeat(table.column("fresh").to_numpy(), [len(r[1]) for r in rows])
    keys, name, stretch, place = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((stretch, name))
    return keys[order], name[order], stretch[order], place[order], fresh[order]


def _twice(*cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: which are equal to a neighbour, and which are the first of their kind."""
    equal = np.logical_and.reduce([c[1:] == c[:-1] for c in cols])
    again, first = np.zeros(len(cols[0]), dtype=bool), np.ones(len(cols[0]), dtype=bool)
    again[1:] |= equal
    again[:-1] |= equal
    first[1:] = ~equal
    return again, first


def _merged(table: pa.Table) -> pa.Table:
    """One level of a bucket's levels: a suffix for each distinct stretch, and whether it is known to occur twice."""
    keys, name, stretch, place, _ = _bucket(table)
    again, first = _twice(name, stretch)
    sure = np.logical_or.reduceat(again | (place["sure"] > 0), np.flatnonzero(first))
    keys, name, stretch, place = keys[first], name[first], stretch[first], place[first]
    place["sure"] = sure
    rows = [_level_row(*(c[lo : lo + PIECE] for c in (keys, name, stretch, place))) for lo in range(0, len(name), PIECE)]
    return pa.Table.from_batches([_binary(rows, _LEVEL)])


def _scanned(table: pa.Table, hot: np.ndarray, length: int, n_parts: int) -> pa.Table:
    """Scan a bucket's levels with the new one: settled stretches, and what is asked of the texts."""
    keys, name, stretch, place, fresh = _bucket(table)
    near, first = _twice(name)
    group = np.cumsum(first) - 1
    split = _held(hot, name)  # its other stretches may lie in other buckets
    concerned = (near & np.logical_or.reduceat(fresh, np.flatnonzero(first))[group]) | split
    same, lead = _twice(name, stretch)
    of_stretch = np.cumsum(lead) - 1
    same |= np.logical_or.reduceat(place["sure"] > 0, np.flatnonzero(lead))[of_stretch]
    begin = place["start"].astype(np.int64)
    done = concerned & same
    marks = mark_table(keys[done], begin[done], begin[done] + place["n"][done].astype(np.int64) + length - 1, n_parts)
    # names with several stretches: one suffix for each
    several = (np.bincount(group, weights=lead) > 1)[group] | split
    e = np.flatnonzero(lead & concerned & several)
    asked = np.zeros(len(e), dtype=_ASKED)
    for c in ("start", "lead", "n"):
        asked[c] = place[c][e]
    asked["name"], asked["same"] = name[e], same[e]
    ask = _packed_by_part(keys[e], asked, n_parts)
    return pa.concat_tables([_settled(marks), pa.Table.from_batches([_binary([(False, a[0], a[1], None, a[2]) for a in ask], _FOUND)])])


def _settled(marks: pa.Table) -> pa.Table:
    n = marks.num_rows
    return pa.table([pa.array([True] * n, pa.bool_()), *(marks.column(c) for c in ("part", "docs", "spans")), pa.nulls(n, pa.binary())], schema=_FOUND)


def _hot_marks(batches: Iterator[pa.RecordBatch], hot: np.ndarray, length: int, n_parts: int) -> Iterator[pa.RecordBatch]:
    """Marks of hot stretches, which are known to occur more than once."""
    for batch in batches:
        for blobs in zip(*(batch.column(c).to_pylist() for c in _COLUMNS)):
            keys, _, stretch, place = _level_cols(*blobs)
            often = _held(hot, stretch)
            begin = place["start"][often].astype(np.int64)
            yield from _settled(mark_table(keys[often], begin, begin + place["n"][often].astype(np.int64) + length - 1, n_parts)).to_batches()


_ASKED = np.dtype([("start", "<u4"), ("lead", "<u2"), ("n", "<u2"), ("name", "<u8"), ("same", "u1")])


def _packed_by_part(keys: np.ndarray, rows: np.ndarray, n_parts: int) -> list[tuple[int, bytes, bytes]]:
    part = parts_of(keys, n_parts)
    order = np.lexsort((keys[:, 0], part))
    part, keys, rows = part[order], keys[order], rows[order]
    cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)) if len(part) else [0]
    return [(int(part[a]), packed_keys(keys[a:b]), rows[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]


def _asked_by_doc(table: pa.Table) -> pa.Table:
    order, cut, keys = grouped_keys(table.column("docs").to_pylist())
    rows = np.frombuffer(b"".join(table.column("asked").to_pylist()), dtype=_ASKED)[order]
    asked = [np.unique(rows[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]  # several batches may ask the same
    return pa.table([*(pa.array(k) for k in keys.T), pa.array(asked, pa.binary())], schema=_ASK)


STRING_SCHEMA = "bucket int, docs binary, idx binary, asked binary, strings binary"
_STRING = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "idx", "asked", "strings"))])


def _one_by_one(doc: np.ndarray, rows: np.ndarray, names: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """The asked suffixes with those of hot names taken apart into single strings, dealt by string."""
    n = rows["n"].astype(np.int64)
    deal = rows["name"]
    apart = _held(hot, rows["name"])
    if not apart.any():
        return doc, rows, names, deal
    string = np.repeat(apart, n)
    step = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))[string]
    single = np.repeat(rows, n)[string]
    single["start"] += step.astype(np.uint32)
    single["lead"] -= step.astype(np.uint16)
    single["n"] = 1
    by = mix(mix(single["name"] + single["lead"]) ^ names[string])
    return (np.concatenate([doc[~apart], np.repeat(doc, n)[string]]), np.concatenate([rows[~apart], single]),
            np.concatenate([names[~string], names[string]]), np.concatenate([deal[~apart], by]))


def _strings(batches: Iterator[pa.RecordBatch], hot: np.ndarray, length: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Names of the single strings of the asked suffixes, dealt by suffix name, of hot names by string."""
    for batch in batches:
        raw, offs = text_buffer(batch.column("text"))
        keys = row_keys(batch)
        asks = batch.column("asked")
        for lo in range(0, len(keys), 1 << 15):
            got = []
            for d in range(lo, min(lo + (1 << 15), len(keys))):
                rows = np.frombuffer(asks[d].as_py(), dtype=_ASKED)
                data = raw[int(offs[d]) : int(offs[d + 1])]
                rows = rows[rows["start"].astype(np.int64) + rows["n"] + length - 1 <= len(data)]
                if not len(rows):
                    continue
                names = mix(Rolling(BYTE_NAMES[data]).grams(length))
                n = rows["n"].astype(np.int64)
                at = np.repeat(rows["start"].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                got.append((np.full(len(rows), d), rows, names[at]))
            if not got:
                continue
            doc, rows, names, deal = _one_by_one(*(np.concatenate(c) for c in zip(*got)), hot)
            n = rows["n"].astype(np.int64)
            first = np.cumsum(n) - n
            bucket = (deal % U64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            out = []
            for b in range(n_buckets):
                e = order[cut[b] : cut[b + 1]]
                if len(e):
                    own, idx = np.unique(doc[e], return_inverse=True)
                    take = np.repeat(first[e], n[e]) + np.arange(n[e].sum()) - np.repeat(np.cumsum(n[e]) - n[e], n[e])
                    out.append((b, packed_keys(keys[own]), idx.astype("<u2").tobytes(), rows[e].tobytes(), low_bytes(names[take], STRING_BYTES).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _STRING.types)], schema=_STRING)


def _compared(table: pa.Table, length: int, n_parts: int) -> pa.Table:
    """Strings of a bucket's asked suffixes that occur under more than one of them."""
    col = {c: table.column(c).to_pylist() for c in table.column_names if c != "bucket"}
    keys = np.concatenate([unpacked_keys(a)[np.frombuffer(b, dtype="<u2")] for a, b in zip(col["docs"], col["idx"])])
    rows = np.frombuffer(b"".join(col["asked"]), dtype=_ASKED)
    names = from_low_bytes(b"".join(col["strings"]), STRING_BYTES)
    n = rows["n"].astype(np.int64)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(rows["lead"].astype(np.int64), n) - step
    key = mix(mix(np.repeat(rows["name"], n) * U64(1024) + place.astype(U64)) + names)
    order = np.argsort(key)
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:]] |= equal
    twice[order[:-1]] |= equal
    entry = np.repeat(np.arange(len(n)), n)
    at = np.flatnonzero(twice & (np.repeat(rows["same"], n) == 0))  # the others are settled
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (entry[at[1:]] != entry[at[:-1]])
    first = np.flatnonzero(new)
    a, b = at[first], (at[np.append(first[1:], len(at)) - 1] if len(at) else at)
    start = rows["start"].astype(np.int64)[entry[a]]
    return mark_table(keys[entry[a]], start + step[a], start + step[b] + length, n_parts)


class SuffixFamily:
    """Index of the picked suffixes of batches of documents: levels of geometric sizes in the shared folder."""

    def __init__(self, spark: SparkSession, length: int = LENGTH):
        self.length, self.n = length, parts(spark)
        self.levels: list[tuple[int, DataFrame]] = []  # (batches in it, table), largest first
        self.texts: list[DataFrame] = []
        self.found: list[DataFrame] = []
        self.hot = np.zeros(0, dtype=U64)

    def _grouped(self, levels: list[tuple[DataFrame, bool]], hot: tuple[np.ndarray, np.ndarray]):
        n = self.n
        rows = reduce(DataFrame.unionByName, [df.select(F.lit(new).alias("fresh"), *_COLUMNS) for df, new in levels])
        return rows.mapInArrow(lambda it: _dealt(it, hot, n), DEALT_SCHEMA).groupBy("bucket")

    def _carry(self) -> None:
        """Merge levels of equal size until all sizes differ."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            hot = hot_names(a.unionByName(b), 4 * self.n)
            merged = stored(self._grouped([(a, False), (b, False)], hot).applyInArrow(_merged, LEVEL_SCHEMA), "suffix-level")
            released(merged.sparkSession, a, b)
            self.levels.append((2 * size, merged))

    def add(self, docs: DataFrame) -> None:
        """Index the keyed documents and find what they share with each other and with earlier batches."""
        docs = docs.select("text", *KEY)
        length, n = self.length, self.n
        self._carry()

        def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, offs = text_buffer(batch.column("text"))
                keys = row_keys(batch)
                for lo in range(0, len(keys), 1 << 15):
                    yield from _suffix_arrays(raw, offs[lo : lo + (1 << 15) + 1], keys[lo : lo + (1 << 15)], length)

        new = stored(docs.mapInArrow(arrays, LEVEL_SCHEMA), "suffix-level")
        levels = [(new, True), *((df, False) for _, df in self.levels)]
        hot = hot_names(reduce(DataFrame.unionByName, [df for df, _ in levels]), 4 * n)
        found = self._grouped(levels, hot).applyInArrow(lambda t: _scanned(t, hot[0], length, n), FOUND_SCHEMA)
        if len(hot[1]):
            marks = reduce(DataFrame.unionByName, [df for df, _ in levels]).mapInArrow(lambda it: _hot_marks(it, hot[1], length, n), FOUND_SCHEMA)
            found = found.unionByName(marks)
        self.found.append(stored(found, "suffixes"))
        self.hot = np.union1d(self.hot, hot[0])
        self.levels.append((1, new))
        self.texts.append(docs)

    def repeated_spans(self) -> DataFrame:
        """Rows of MARK_SCHEMA: the bytes of every string that occurs more than once in all batches."""
        length, n, hot = self.length, self.n, self.hot
        found = reduce(DataFrame.unionByName, self.found)
        asked = found.where("not settled").groupBy("part").applyInArrow(_asked_by_doc, f"{KEY_SCHEMA}, asked binary")
        texts = reduce(DataFrame.unionByName, self.texts).join(asked, list(KEY)).select("text", *KEY, "asked")
        strings = texts.mapInArrow(lambda it: _strings(it, hot, length, n), STRING_SCHEMA)
        single = strings.groupBy("bucket").applyInArrow(lambda t: _compared(t, length, n), MARK_SCHEMA)
        return found.where("settled").select("part", "docs", "spans").unionByName(single)


def repeated_spans(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """Rows of MARK_SCHEMA: the bytes of every string of ``length`` bytes that occurs more than once in the keyed documents.

    The documents are added in batches, dealt by row key.
    """
    family = SuffixFamily(docs.sparkSession, length)
    for b in range(batches):
        family.add(docs.where(F.pmod(F.xxhash64(*KEY), F.lit(batches)) == b))
    released(docs.sparkSession, *(level for _, level in family.levels))  # no further batch comes
    return family.repeated_spans()


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = text_buffer(batch.column(1))
        marks, ids = batch.column(2), batch.column(0)
        for lo, hi in chunks(offs, 4 << 20):
            rows = []
            for d, blob in zip(range(lo, hi), marks[lo:hi].to_pylist()):
                data = raw[int(offs[d]) : int(offs[d + 1])]
                gone = covered(blob, len(data))
                kept = data[~gone].tobytes() if blob else data.tobytes()
                rows.append((len(data), int(gone.sum()), len(runs(gone)[0]), kept, hashlib.sha256(kept).hexdigest()))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types[1:])]
            yield pa.RecordBatch.from_arrays([ids[lo:hi].cast(pa.int64()), *cols], schema=_OUT)


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: bytes, bytes and runs removed, the kept bytes and their hash."""
    src = with_row_keys(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    return with_marks(src, repeated_spans(src, length)).mapInArrow(_kept, OUT_SCHEMA)


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings taken out of their texts, other columns unchanged.

    A removed run is narrowed to whole characters, so the text stays valid; ``n_chars``
    follows the text where the documents have it. Null texts stay null.
    """
    src = with_row_keys(docs)
    marks = marks_by_document(repeated_spans(src, length))
    names, schema = docs.columns, docs.schema
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffer(batch.column(at))
            old, blobs = batch.column(at), batch.column(batch.num_columns - 1).to_pylist()
            texts = []
            for d, blob in enumerate(blobs):
                if not blob:
                    texts.append(old[d].as_py())
                    continue
                data = raw[int(offs[d]) : int(offs[d + 1])]
                gone = covered(blob, len(data))
                head = np.flatnonzero((data & 0xC0) != 0x80)  # characters go whole or stay
                whole = np.logical_and.reduceat(gone, head) if len(head) else np.zeros(0, dtype=bool)
                kept = data[~np.repeat(whole, np.diff(np.append(head, len(data))))]
                texts.append(kept.tobytes().decode())
            cols = list(batch.columns[:-1])
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    joined = src.join(marks.withColumnRenamed("spans", "__marks"), list(KEY), "left").select(*names, "__marks")
    out = joined.mapInArrow(cut, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
