"""SimHash, hard negatives and periodic runs against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from branchbook.llm import hardneg, periodic, queries, simhash

DOCS = "doc_id bigint, text string, lang string, source string, fp string, part int, label string, count bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", None, "x", 1, "y", 2) for d, t in rows], DOCS)


def got_rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# ---------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    w = (text or "").translate(LOWER).encode().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Smallest id of each node's component, for (id, fingerprint) rows."""
    label = [d for d, _ in fps]
    best = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, (_, x) in enumerate(fps):
            for j, (_, y) in enumerate(fps):
                if (x ^ y).bit_count() <= 2 and best[j] < best[i]:
                    best[i], changed = best[j], True
    out = {}
    for i, b in enumerate(best):
        ids = [label[j] for j in range(len(fps)) if best[j] == b and label[j] is not None]
        out[i] = min(ids) if ids else None
    return [out[i] for i in range(len(fps))]


def near_texts():
    rng = random.Random(8)
    vocabulary = ["wört", "The", "rain", "A", "b", "été", "stone", "42"]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one two"), (5, "another text of the same id"), (None, "one"), (None, "nobody's text at all here")]
    for i in range(6):
        words = [rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(400)]
        for j in range(12):
            near = words.copy()
            for _ in range(j % 4):
                near[rng.randrange(400)] = f"n{j}"
            rows.append((100 * (6 - i) + j, " ".join(near)))
    rows += [rows[10], rows[10], (900, "x " * 9000), (901, "x\n" * 9000)]
    return rows


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2, 0])
def test_simhash(spark, bucket):
    """Buckets compared one by one, and all of them by neighbourhoods."""
    rows = near_texts()
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    want = sorted(((d, f"{x:016x}", c) for (d, x), c in zip(fps, plain_components(fps))), key=str)
    got = simhash.near_duplicates(documents(spark, rows), bucket=bucket)
    assert got_rows(got, ["doc_id", "fingerprint", "component_id"]) == want
    assert len({c for *_, c in want}) < len({x for _, x, _ in want})  # some links lie between different fingerprints


def test_simhash_links_of_any_plan(spark):
    """No link is lost under any allocation, also with constant and copied bits."""
    rng = random.Random(4)
    base = [rng.getrandbits(64) & ~0xFF for _ in range(60)]
    base += [x ^ 1 << rng.randrange(64) for x in base[:30]] + [x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for x in base[:30]]
    base += [7 << i for i in range(20)]
    fps = sorted({simhash._signed(x) for x in base})
    want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    nodes = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    n, both = simhash.bit_statistics(nodes)
    assert n == len(fps) and both[3, 5] == sum(x >> 3 & x >> 5 & 1 for x in fps)
    g2, g3, g4 = (simhash.correlated_groups(n, both, m) for m in (2, 3, 4))
    assert all(sorted(b for g in gs for b in g) == list(range(64)) for gs in (g2, g3, g4))
    plans = [simhash.partition_plan(nodes), list(zip(g2, (1, 0))), [(g2[0], 1), (g2[1], 0)][::-1], [(g2[1], 2)], list(zip(g3, (0, 0, 0))), [(g3[0], 1), (g3[2], 0)]]
    for plan in plans:
        found = {tuple(sorted(r)) for r in simhash.links(nodes, plan, bucket=1000).collect()}
        assert found == want


def test_allocation_is_the_cheapest():
    costs = [[0, 5, 60, 900], [0, 50, 60, 70], [0, 1, 2, 300]]
    every = [(sum(c[t + 1] for c, t in zip(costs, (x, y, 0 - x - y))), [x, y, -x - y]) for x in range(-1, 3) for y in range(-1, 3) if -1 <= -x - y <= 2]
    assert simhash.allocate(costs) == min(every)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int, id bigint, score double"


def vectors():
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 0.3, (4, 9))
    rows = []
    for i in range(900):
        v = (centre[i % 4] + rng.normal(0, 0.15, 9)).round(2 if i % 3 else 1)
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 10)) if i % 5 else 3, 7, 0.5))
    same = rows[40][1]
    rows += [(1000 + i, same, i % 2, 7, 0.5) for i in range(300)]  # one vector holds a large share: ties
    rows += [(2000, None, 1, 1, 0.1), (2100, same, None, 1, 0.1), (None, same, 1, 1, 0.1), (2200, [*same[:8], None], 1, 1, 0.1)]
    rows += [(2300, [*same[:8], math.inf], 1, 1, 0.1), (2400, [*same[:8], math.nan], 1, 1, 0.1), (2500, [0.0] * 9, 4, 1, 0.1)]
    return rows + [rows[100], rows[100], rows[17]]


def test_hard_negatives(spark, tmp_path, monkeypatch):
    rows = vectors()
    spark.createDataFrame(rows, VECTORS).write.parquet(str(tmp_path / "embeddings.parquet"))
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.sql(f"select {', '.join(cols)} from ({queries.ORACLE['op12_hard_negatives']})").fetchall(), key=str)
    assert len(want) > 50
    assert got_rows(queries.op12_hard_negatives(spark, str(tmp_path)), cols) == want
    # several blocks of anchors, small tiles
    monkeypatch.setattr(hardneg, "BLOCK_BYTES", 300)
    monkeypatch.setattr(hardneg.mine, "__defaults__", (5, 5, 80, 100, 300))
    assert got_rows(queries.op12_hard_negatives(spark, str(tmp_path)), cols) == want


def test_best_rows_by_score_and_id():
    """Against a full sort, with many ties, in several tiles and orders."""
    rng = np.random.default_rng(1)
    s = rng.integers(-3, 4, (40, 600))
    ok = rng.random((40, 600)) < 0.7
    ids = np.arange(600) * 3
    for order in (range(0, 600, 50), range(550, -1, -50)):
        best = hardneg.Best(40, 5)
        for at in order:
            best.add(0, s[:20, at : at + 50], ok[:20, at : at + 50], ids[at : at + 50])
            best.add(20, s[20:, at : at + 50], ok[20:, at : at + 50], ids[at : at + 50])
        for a in range(40):
            want = sorted((-s[a, j], ids[j]) for j in range(600) if ok[a, j])[:5]
            assert list(zip(-best.score[a], best.id[a])) == want


@pytest.mark.parametrize(("dims", "top"), [(1, 2**30), (64, 256), (64, 2**27), (1500, 2**20), (3, 1)])
def test_products_are_exact(dims, top):
    rng = np.random.default_rng(dims)
    a, b = rng.integers(-top, top + 1, (7, dims)), rng.integers(-top, top + 1, (9, dims))
    a[0], b[0], b[1] = top, top, -top
    primes = hardneg.moduli(dims, dims * top**2)
    assert math.prod(primes) > 2 * dims * top**2 and len(set(primes)) == len(primes)
    got = hardneg.products(hardneg.Residues.of(a, primes), hardneg.Residues.of(b, primes))
    assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_hard_negatives_of_odd_tables(spark):
    def mined(rows):
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
        return hardneg.mine(hardneg.quantised(df, "vec_id", "label", "embedding"), F.col("id") % 100 == 0)

    assert mined([]).collect() == []
    assert mined([(1, [1.0], 1)]).collect() == []  # no anchor
    short = mined([(0, [1.0, 1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [], 2)])  # filled up with zeros
    assert [tuple(r) for r in short.collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]
    with pytest.raises(ValueError):
        mined([(0, [1e300], 1)])


# ---------------------------------------------------------------- periodic runs


def plain_runs(words, least=12):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def plain_row(d, t):
    w = (t or "").encode().split()
    h, n = zlib.crc32(str(d).encode()), len(w)
    if d is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    text = b" ".join(x for i, x in enumerate(w) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    said = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (d, len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def test_periodic_runs(spark):
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, "\n \t"), (3, "a"), (None, "a b " * 30), (4, "same " * 11), (5, "same " * 12), (6, "é é " * 40), (7, "x y z " * 700)]
    for d in range(10, 130):
        words = []
        while len(words) < rng.choice([5, 60, 250]):
            piece = [rng.choice("abc") for _ in range(rng.randrange(1, 25))]
            words += piece * rng.choice([1, 1, 2, 3, 5])
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [rows[20], rows[20]]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = periodic.periodic_runs(documents(spark, rows), planted=True)
    assert got_rows(got, cols) == sorted((plain_row(*r) for r in rows), key=str)
    plain = {r.doc_id: r for r in periodic.periodic_runs(documents(spark, rows)).collect()}
    assert plain[7].collapsed == "x y z" and [tuple(r) for r in plain[7].runs] == [(0, 2100, 3)] and plain[7].exponent_milli == 700000
    assert plain[None].collapsed == "a b" and plain[4].n_runs == 0 and plain[5].collapsed == "same"
    assert periodic.periodic_runs(documents(spark, [])).collect() == []


def test_runs_of_hard_words():
    """Fibonacci words, abutting runs of one root, long periods and other shortest lengths."""
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(700))
    words = [fib[-1], "ab" * 40 + "ba" * 40, ("aab" * 9 + "ab" * 7) * 5, long * 2 + "z" + long, long[:300] * 3, "a" * 2000, ("a" * 50 + "b") * 30]
    for w in words:
        for least in (2, 5, 12, 40):
            got = [(s, e - s, q) for s, e, q in periodic.find_runs(np.frombuffer(w.encode(), dtype=np.uint8).astype(np.int64), least).tolist()]
            assert got == plain_runs(w, least)


def test_range_successor():
    rng = np.random.default_rng(5)
    v = rng.permutation(300)
    lo = rng.integers(0, 300, 400)
    hi = np.minimum(lo + rng.integers(0, 60, 400), 300)
    x = rng.integers(-1, 620, 400)
    tree = periodic.WaveletMatrix(v)
    for a, b, y, s, p in zip(lo, hi, x, tree.successor(lo, hi, np.maximum(x, 0)), tree.predecessor(lo, hi, x)):
        part = v[a:b]
        assert s == min(part[part >= max(y, 0)], default=-1) and p == max(part[part <= y], default=-1)
