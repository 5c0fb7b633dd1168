"""Near-duplicate documents by SimHash and the generalised pigeonhole principle.

A document's fingerprint has a bit set where over half of the 64-bit hashes of its word
shingles (repeats included) have it. Equal fingerprints are one node, so exact copies
cost a hash aggregate. Nodes that differ in at most two bits are linked:

1. the co-occurrence of all bit pairs is counted over all nodes, and correlated bits
   are grouped into 2, 3 or 4 partitions;
2. for every partition the nodes that share its bits are counted, and a dynamic program
   deals thresholds of -1 (never probed) to 2 to the partitions so that the estimated
   candidates and probes are least. Thresholds that add up to 2 - m + 1 over m
   partitions lose no link (generalised pigeonhole principle);
3. nodes are filed under their bits of each probed partition, every node probes all
   values within the partition's threshold, and each candidate's whole fingerprint is
   compared.

A value that more than ``BUCKET`` nodes share is never expanded into pairs: its nodes,
and those that probe it, are filed under every fingerprint within one bit of their own.
Two fingerprints are within two bits exactly if they meet there, at most 65 meet in one
place, and each place gives a star of links. So hot values stay exact and linear.

Defined cases: null, empty and wordless texts have the fingerprint zero and link like any
other; texts with fewer words than a shingle are one shingle; repeated rows and rows that
share a doc_id are documents of their own; a null doc_id never names a component (null if
no member has an id); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import stored
from branchbook.llm.minhash import components, over_components

BITS, RADIUS = 64, 2
SEED = 42  # of XXH64, part of the fingerprint's definition
PIECE = 1 << 16  # shingles hashed at a time
PARTITIONS = (2, 3, 4)  # numbers of partitions to choose from
BUCKET = 64  # nodes of one partition value up to which candidates are compared one by one
FP_SCHEMA = "doc_id bigint, fp bigint"


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one text's UTF-8 bytes, as an unsigned number."""
    import xxhash

    joined = b" ".join(text.lower().split())  # bytes: only A-Z change, words end at 0x20 and 0x09-0x0D
    if not joined:
        return 0
    stop = np.append(np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20), len(joined))
    start = np.append(0, stop[:-1] + 1)
    k = min(shingle, len(stop))
    first, last = start[: len(stop) - k + 1], stop[k - 1 :]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(first), PIECE):
        ends = zip(first[at : at + PIECE].tolist(), last[at : at + PIECE].tolist())
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in ends), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = (fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in batch.column(1))
        fp = np.fromiter(fps, dtype="<u8", count=batch.num_rows).view("<i8")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed 64-bit number."""
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(lambda it: _fingerprints(it, shingle), FP_SCHEMA)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of bits is set together, one row per pair and task."""
    both = np.zeros((BITS, BITS))
    for batch in batches:
        raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
        x = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
        both += x.T @ x  # float32 sums of up to 2**24 ones are exact, batches are smaller
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(both.reshape(-1).astype(np.int64))]
    yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "c"])


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """(number of nodes, co-occurrence of all bit pairs) over every node; 64 x 64 numbers reach the driver."""
    rows = nodes.select("fp").mapInArrow(_pair_counts, "i int, j int, c bigint").groupBy("i", "j").agg(F.sum("c").alias("c"))
    both = np.zeros((BITS, BITS))
    for i, j, c in rows.collect():
        both[i, j] = c
    return nodes.count(), both


def correlated_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of the bits: each starts at the strongest pair left and takes the bits closest to it."""
    f = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(f * (1 - f), 1e-12))
    r = np.abs((both / max(n, 1) - np.outer(f, f)) / np.outer(sd, sd))
    np.fill_diagonal(r, 0.0)
    left, groups = list(range(BITS)), []
    for k in range(m, 0, -1):
        width = round(len(left) / k)
        sub = r[np.ix_(left, left)]
        mine = [left[int(np.argmax(sub.max(axis=1)))]]
        while len(mine) < width:
            rest = [b for b in left if b not in mine]
            mine.append(rest[int(np.argmax(r[np.ix_(rest, mine)].mean(axis=1)))])
        groups.append(sorted(mine))
        left = [b for b in left if b not in mine]
    return groups


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _filed(nodes: DataFrame, groups: list[list[int]]) -> DataFrame:
    """(fp, part, value): every node under its bits of every group."""
    entries = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g)).cast("bigint")).alias("value")) for i, g in enumerate(groups)]
    return nodes.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.part", "e.value")


def candidate_counts(pairs: float, f: np.ndarray) -> list[float]:
    """Estimated pairs at 0, up to 1 and up to 2 differing bits of a group, from the counted pairs at 0.

    Bits differ with probability 2f(1-f); the ratio to distance 0 is taken as if they did so independently.
    """
    dist = np.zeros(RADIUS + 1)
    dist[0] = 1.0
    for p in 2 * f * (1 - f):
        dist[1:] = dist[1:] * (1 - p) + dist[:-1] * p
        dist[0] *= 1 - p
    return (max(pairs, 1.0) * np.cumsum(dist) / max(dist[0], 1e-300)).tolist()


def allocate(costs: list[list[float]]) -> tuple[float, list[int]]:
    """(cost, thresholds): least sum of costs[i][t + 1] over thresholds t = -1 .. RADIUS that add up to RADIUS - m + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, RADIUS + 1):
                c = cost + row[t + 1]
                if total + t not in step or c < step[total + t][0]:
                    step[total + t] = (c, [*chosen, t])
        best = step
    return best[RADIUS - len(costs) + 1]


def partition_plan(nodes: DataFrame, bucket: int = BUCKET) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every probed partition, for the cheapest number of partitions."""
    n, both = bit_statistics(nodes)
    f = np.diag(both) / max(n, 1)
    layouts = {m: correlated_groups(n, both, m) for m in PARTITIONS}
    flat = [g for m in PARTITIONS for g in layouts[m]]
    c = F.col("count")
    met = _filed(nodes, flat).groupBy("part", "value").count().groupBy("part")
    # hot values cost their nodes' neighbourhoods instead of pairs
    sums = {r.part: float(r.s) for r in met.agg(F.sum(F.when(c > bucket, c * (BITS + 1)).otherwise(c * (c - 1))).alias("s")).collect()}
    plans, at = [], 0
    for m in PARTITIONS:
        costs = []
        for g in layouts[m]:
            pairs = candidate_counts(sums.get(at, 0.0), f[g])
            probes = np.cumsum([comb(len(g), d) for d in range(RADIUS + 1)])
            costs.append([0.0, *(n * p + q for p, q in zip(probes.tolist(), pairs))])
            at += 1
        cost, chosen = allocate(costs)
        plans.append((cost, [(g, t) for g, t in zip(layouts[m], chosen) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


def _flips(bits: list[int], radius: int) -> list[int]:
    out = [0]
    if radius >= 1:
        out += [1 << b for b in bits]
    if radius >= 2:
        out += [1 << a | 1 << b for i, a in enumerate(bits) for b in bits[:i]]
    return out


def _within(value: Column, bits: list[int], radius: int) -> Column:
    """All values that differ from ``value`` in at most ``radius`` of the bits."""
    return F.transform(F.array(*(F.lit(_signed(x)).cast("bigint") for x in _flips(bits, radius))), lambda x: value.bitwiseXOR(x))


def links(nodes: DataFrame, plan: list[tuple[list[int], int]], bucket: int = BUCKET) -> DataFrame:
    """(a, b): fingerprints within two bits of each other, enough of them to connect all that are."""
    key = ["part", "value"]
    index = _filed(nodes, [g for g, _ in plan])
    hot = stored(index.groupBy(*key).count().where(F.col("count") > bucket).select(*key, F.lit(True).alias("hot")), "hot-values")

    def tagged(rows: DataFrame) -> DataFrame:
        return rows.join(hot, key, "left").withColumn("hot", F.col("hot").isNotNull())

    index = stored(tagged(index), "simhash-index")
    probes = index.where(F.col("part").isin([i for i, (_, t) in enumerate(plan) if t == 0]))
    for i, (g, t) in enumerate(plan):
        if t > 0:  # beyond the node's own value also those at up to t bits
            own = F.col("fp").bitwiseAND(F.lit(_mask(g)).cast("bigint"))
            probes = probes.unionByName(tagged(nodes.select("fp", F.lit(i).alias("part"), F.explode(_within(own, g, t)).alias("value"))))
    crowd = index.unionByName(probes).where("hot").select("fp").distinct()
    index, probes = (x.where("not hot").drop("hot") for x in (index, probes))
    pairs = index.withColumnRenamed("fp", "a").join(probes.withColumnRenamed("fp", "b"), key).where("a < b")
    close = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b")
    places = crowd.select("fp", F.explode(_within(F.col("fp"), list(range(BITS)), 1)).alias("z"))
    stars = places.groupBy("z").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("bs")).where("size(bs) > 1")  # at most 65
    return close.unionByName(stars.select("a", F.explode("bs").alias("b")).where("a != b"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bucket: int = BUCKET, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits) and component_id (smallest linked id)."""
    prints = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("component_id")), "simhash-nodes")
    labels = components(links(nodes, partition_plan(nodes, bucket), bucket))
    named = over_components(nodes.withColumnRenamed("fp", "id"), labels).withColumnRenamed("id", "fp")
    out = prints.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
