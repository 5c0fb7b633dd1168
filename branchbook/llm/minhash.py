"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds the names of its distinct word shingles. Signatures follow
circulant MinHash: one permutation spreads the shingles over [0, 2**32), a second one,
shifted by one place per coordinate, gives the coordinates; two permutations replace
128 hash functions. Coordinates are banded (32 bands of 4: two documents at the
threshold 0.8 share no band with probability 5e-8).

Equal sets are one node before any banding, so exact copies cost a hash aggregate.
Buckets are never expanded into all pairs. Round one links every member to the
bucket's centre (the least hashed id, mostly the same in all bands). Links are
verified on full shingle sets, and connected components are taken from what holds.
Buckets whose members then lie in different components go on: members outside the
bucket's largest component are compared with all others in blocks of a bounded size,
by signature first and, if 64 % of the coordinates agree (a pair at 0.8 stays below
with probability 3e-6), on full sets. A pair is compared in the first band it shares
and only while its ends are in different components; what comes out is a forest of
links, however large a bucket is.

Components are found with alternating large-star and small-star steps on tables in
the shared folder. Nodes are sets and documents are rows, told apart by their row keys,
so ids never join texts. Defined cases: null, empty and wordless texts have an empty set
and stay alone; texts with fewer words than a shingle are one shingle; repeated rows are
exact copies; rows that share a doc_id with different texts, and rows without an id, are
documents of their own; a component is named by its smallest id (null if no member has
one); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import (
    FOLDED_NAMES, KEY, KEY_ARROW, KEY_SCHEMA, NOT_SPACE, U64, WORD_BASE, Rolling, Words, chunks, mix, packed_ids, parts, stored, text_buffer,
    unpacked_ids, with_row_keys,
)

BANDS, ROWS = 32, 4
SALTS = 16  # places that the nodes of one component are spread over
BLOCK = 1024  # members of one side of a comparison
LIKELY = 0.64  # agreement of signatures below which no link is looked for
SIG_SCHEMA = f"doc_id bigint, {KEY_SCHEMA}, n bigint, d1 bigint, d2 bigint, sig binary"
_SIG = pa.schema([("doc_id", pa.int64()), *KEY_ARROW, ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sig", pa.binary())])


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(names, text index) of the distinct shingles of every text, by text and name."""
    n = np.diff(w.first)
    roll = Rolling(w.name, WORD_BASE)
    at = np.flatnonzero(w.left() >= k)
    doc = np.searchsorted(w.first, at, side="right") - 1
    name = roll.of(at, at + k)
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        name = np.concatenate([name, roll.of(w.first[few], w.first[few + 1]) + (n[few] * 7919).astype(U64)])
        doc = np.concatenate([doc, few])
    name = mix(name)
    order = np.lexsort((name, doc))
    name, doc = name[order], doc[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    return name[new], doc[new]


def _permuted(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def circulant_signatures(names: np.ndarray, first: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Signatures of the sets that start at ``first`` (none empty): least place under each shift of the second permutation."""
    spread = _permuted(mix(names ^ U64(0x5851F42D4C957F2D)).astype(np.uint32))  # first permutation
    sig = np.empty((len(first), size), dtype=np.uint32)
    for k in range(size):
        sig[:, k] = np.minimum.reduceat(_permuted(spread + np.uint32(k)), first)
    return sig


def _signed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = text_buffer(batch.column(batch.num_columns - 1))
        for lo, hi in chunks(offs):
            names, doc = shingle_sets(Words(raw, offs, lo, hi, NOT_SPACE, FOLDED_NAMES), k)
            n = np.bincount(doc, minlength=hi - lo)
            d1, d2 = np.zeros(hi - lo, dtype=U64), np.zeros(hi - lo, dtype=U64)
            sigs: list = [None] * (hi - lo)
            if len(names):
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                own = doc[first]
                d1[own] = np.add.reduceat(mix(names + U64(1)), first)
                d2[own] = np.add.reduceat(mix(names ^ U64(0xABCDEF1234567)), first)
                for d, s in zip(own, circulant_signatures(names, first)):
                    sigs[d] = s.tobytes()
            own = [c[lo:hi] for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(sigs, pa.binary())], schema=_SIG)


BAND_SCHEMA = "bucket int, ids binary, n binary, bands binary"
_BAND = pa.schema([("bucket", pa.int32()), ("ids", pa.binary()), ("n", pa.binary()), ("bands", pa.binary())])
MEMBER_SCHEMA = "band bigint, id bigint, n bigint"
_MEMBER = pa.schema([("band", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])


def _banded(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint32).reshape(len(ids), BANDS, ROWS)
        key = np.zeros((len(ids), BANDS), dtype=U64) + np.arange(1, BANDS + 1, dtype=U64)
        for r in range(ROWS):
            key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, :, r])
        key = ((key & ~U64(BANDS - 1)) | np.arange(BANDS, dtype=U64)).reshape(-1)  # the low bits say which band
        row = np.repeat(np.arange(len(ids)), BANDS)
        bucket = (key % U64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        out = []
        for b in range(n_buckets):
            e = order[cut[b] : cut[b + 1]]
            if len(e):
                out.append((b, packed_ids(ids[row[e]]), n[row[e]].astype("<u4").tobytes(), key[e].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _BAND.types)], schema=_BAND)


def _met(table: pa.Table) -> pa.Table:
    """Members of the bands that more than one document falls into."""
    ids = np.concatenate([unpacked_ids(b) for b in table.column("ids").to_pylist()])
    n = np.frombuffer(b"".join(table.column("n").to_pylist()), dtype="<u4").astype(np.int64)
    key = np.frombuffer(b"".join(table.column("bands").to_pylist()), dtype=U64)
    order = np.argsort(key)
    key, ids, n = key[order], ids[order], n[order]
    equal = key[1:] == key[:-1]
    both = np.zeros(len(key), dtype=bool)
    both[1:] |= equal
    both[:-1] |= equal
    return pa.table([pa.array(key[both].view(np.int64)), pa.array(ids[both]), pa.array(n[both])], schema=_MEMBER)


def _linked(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets hold 100 * both >= percent * either."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])
    for batch in batches:
        sides = [text_buffer(batch.column(c)) for c in (2, 3)]
        ok = np.zeros(batch.num_rows, dtype=bool)
        lo = 0
        while lo < batch.num_rows:
            hi = lo + 1
            while hi < batch.num_rows and sum(int(o[hi + 1] - o[lo]) for _, o in sides) <= 1 << 20:
                hi += 1
            names, owner = [], []
            for raw, offs in sides:
                x, d = shingle_sets(Words(raw, offs, lo, hi, NOT_SPACE, FOLDED_NAMES), k)
                names.append(x), owner.append(d)
            size = [np.bincount(d, minlength=hi - lo) for d in owner]
            x, d = np.concatenate(names), np.concatenate(owner)
            order = np.lexsort((x, d))
            x, d = x[order], d[order]
            twin = (x[1:] == x[:-1]) & (d[1:] == d[:-1])
            common = np.bincount(d[1:][twin], minlength=hi - lo)
            ok[lo:hi] = 100 * common >= percent * (size[0] + size[1] - common)
            lo = hi
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok)], schema=schema)


def _joined(table: pa.Table, k: int, percent: int) -> pa.Table:
    """Links of a block that join components: a spanning forest, each link verified on full sets.

    A pair that meets in several bands is compared in the first one only.
    """
    band = int(table.column("band")[0].as_py()) & (BANDS - 1)
    ids, n, comp, ask = (table.column(c).to_numpy() for c in ("id", "n", "comp", "ask"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint32).reshape(table.num_rows, BANDS, ROWS)
    raw, offs = text_buffer(table.column("text"))
    sets: dict[int, frozenset] = {}
    root: dict[int, int] = {}
    links: list[tuple[int, int]] = []

    def shingles(i: int) -> frozenset:
        if i not in sets:
            sets[i] = frozenset(shingle_sets(Words(raw, offs, i, i + 1, NOT_SPACE, FOLDED_NAMES), k)[0].tolist())
        return sets[i]

    def top(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    rest = np.flatnonzero(~ask)
    for q in np.flatnonzero(ask):
        m = rest[(comp[rest] != comp[q]) & (100 * np.minimum(n[rest], n[q]) >= percent * np.maximum(n[rest], n[q]))]
        if not len(m):
            continue
        equal = sig[m] == sig[q]
        agree = equal.mean(axis=(1, 2))
        m, agree = (x[(equal.all(axis=2).argmax(axis=1) == band) & (agree >= LIKELY)] for x in (m, agree))
        for j in m[np.argsort(-agree, kind="stable")]:
            a, b = top(int(comp[q])), top(int(comp[j]))
            if a == b:
                continue
            both = len(shingles(int(q)) & shingles(int(j)))
            if 100 * both >= percent * (len(sets[int(q)]) + len(sets[int(j)]) - both):
                root[max(a, b)] = min(a, b)
                links.append((int(ids[q]), int(ids[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(id, label): smallest id reachable over the edges (a, b), for every id on an edge."""
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # a forest of stars: no end of an edge is the start of another, and each start has one
        if e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty() and e.groupBy("u").count().where("count > 1").isEmpty():
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())


def over_components(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes (id, values) with each value's least over the node's component.

    Nodes of one component meet in SALTS places, so that a large one isn't one task's.
    """
    values = [F.min(c).alias(c) for c in nodes.columns if c != "id"]
    linked = nodes.join(labels, "id")
    least = linked.groupBy("label").agg(*values).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = linked.select("id", "label", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    found = spread.join(least, ["label", "salt"]).select(*nodes.columns)
    return found.unionByName(nodes.join(labels, "id", "left_anti"))


def grouped(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, ``KEY``, n, component_id and first (whether its row key is the component's least)."""
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    n_parts = parts(docs.sparkSession)
    src = with_row_keys(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", *KEY, "text")
    signed = stored(src.mapInArrow(lambda it: _signed(it, shingle), SIG_SCHEMA), "signatures")
    # of a set's rows the first is the one of the least id and key; rows without an id come last
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *KEY)
    sets = signed.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(order).alias("least"), F.min("doc_id").alias("component_id"), F.first("sig").alias("sig"))
    nodes = stored(sets.withColumn("id", F.monotonically_increasing_id()), "nodes")  # numbers as stored
    members = stored(
        nodes.select("id", "n", "sig").mapInArrow(lambda it: _banded(it, n_parts), BAND_SCHEMA).groupBy("bucket").applyInArrow(_met, MEMBER_SCHEMA), "members"
    )
    near = nodes.select(*(F.col(f"least.{c}").alias(c) for c in KEY), "id").join(members.select("id").distinct(), "id")
    # one row's text for each set that met another; copies of a row have one key
    texts = stored(src.join(near, list(KEY)).select("id", "text").dropDuplicates(["id"]), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        two = one.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
        return two.mapInArrow(lambda it: _linked(it, shingle, percent), "a bigint, b bigint, linked boolean").groupBy("a", "b").agg(F.max("linked").alias("linked"))

    centre = members.groupBy("band").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("c"))
    star = members.join(centre, "band").where("id != c.id and 100 * least(n, c.n) >= 80 * greatest(n, c.n)")
    tested = stored(verified(star.select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()), "links")
    known = tested.where("linked").select("a", "b")
    blocks = _open_blocks(members, nodes, texts, components(known))
    more = blocks.groupBy("band", "q", "r").applyInArrow(lambda t: _joined(t, shingle, percent), "a bigint, b bigint")
    labels = components(known.unionByName(more))
    named = over_components(nodes.select("id", "least", "component_id"), labels)
    of_set = nodes.select("n", "d1", "d2", "id").join(named, "id").drop("id")
    out = signed.join(of_set, ["n", "d1", "d2"], "left")
    alone = F.col("least").isNull()
    first = alone | (order == F.col("least"))
    return out.select("doc_id", *KEY, "n", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), first.alias("first"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest linked id) and kept."""
    g = grouped(docs, shingle, percent, doc_id, text)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("first"))
    return g.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def _open_blocks(members: DataFrame, nodes: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the bands whose members lie in different components, dealt into blocks: asking rows against all."""
    placed = members.join(labels, "id", "left").select("band", "id", "n", F.coalesce("label", "id").alias("comp"))
    sizes = placed.groupBy("band", "comp").agg(F.count("*").alias("size"))
    bands = sizes.groupBy("band").agg(F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("m"), F.count("*").alias("comps")).where("comps > 1 and m > 2")
    rows = placed.join(bands.select("band", F.col("main.comp").alias("main"), F.col("main.size").alias("main_size"), "m"), "band")
    rows = rows.join(nodes.select("id", "sig").dropDuplicates(["id"]), "id")
    ask_blocks = F.ceil((F.col("m") - F.col("main_size")) / BLOCK).cast("int")
    all_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    place = F.pmod(F.xxhash64("id"), F.lit(2**31 - 1))
    rows = rows.join(texts, "id")
    cols = ["band", "id", "n", "comp", "sig", "text"]
    ask = rows.where("comp != main").select(*cols, F.pmod(place, ask_blocks).alias("q"), F.explode(F.sequence(F.lit(0), all_blocks - 1)).alias("r"), F.lit(True).alias("ask"))
    rest = rows.select(*cols, F.explode(F.sequence(F.lit(0), ask_blocks - 1)).alias("q"), F.pmod(place, all_blocks).alias("r"), F.lit(False).alias("ask"))
    return ask.unionByName(rest).withColumns({"q": F.col("q").cast("int"), "r": F.col("r").cast("int")})


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents less every near copy, columns unchanged: of each group the row of the smallest doc_id stays.

    Rows go by their own text, never by an id that others share; of rows alike in
    id and text one stays.
    """
    gone = grouped(docs, shingle, percent).where("not first").select(*KEY).distinct()
    keyed = with_row_keys(docs).join(gone, list(KEY), "left_anti")
    own = (F.col(KEY[1]) == 0) & (F.col(KEY[2]) == 0)  # an id that one row has
    return keyed.where(own).unionByName(keyed.where(~own).dropDuplicates(list(KEY))).select(*docs.columns)
