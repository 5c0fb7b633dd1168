"""Rows, not ids, are documents; different words have different names; null ids everywhere."""

from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from branchbook.llm import decontam, langid, minhash, puquality, recompress, sufdedup, toxicity  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, first string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1, 2, "x", "y") for d, t in rows], DOCS)


def long_texts(n, seed=1, words=120):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(n)]


def thue_morse(n):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_rows_without_an_id_are_documents_of_their_own(spark):
    x, y = long_texts(2)
    rows = [(None, x), (None, x), (None, y), (5, x + " tail"), (9, y + " tail"), (11, x + " end")]
    got = minhash.near_duplicates(frame(spark, rows), shingle=4)
    seen = sorted(((r.doc_id, r.component_id, r.kept) for r in got.collect()), key=str)
    assert seen == sorted([(None, 5, False), (None, 5, False), (None, 9, False), (5, 5, True), (9, 9, True), (11, 5, False)], key=str)
    alone = minhash.near_duplicates(frame(spark, [(None, x), (None, x), (None, y), (None, None), (3, "")]), shingle=4)
    assert sorted(((r.n_shingles, r.component_id, r.kept) for r in alone.collect()), key=str) == sorted(
        [(117, None, True), (117, None, True), (117, None, True), (0, None, True), (0, 3, True)], key=str)


def test_deduplicate_loses_no_text(spark):
    """Rows sharing an id go by their own text; of rows alike one stays; columns are kept."""
    x, y, z = long_texts(3)
    rows = [(3, x), (7, x + " more"), (7, y), (None, z), (None, z), (8, z + " more"), (12, None), (12, None), (13, "")]
    df = frame(spark, rows)
    got = minhash.deduplicate(df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, x), (7, y), (8, z + " more"), (12, None), (13, "")], key=str)
    assert minhash.deduplicate(df.limit(0)).count() == 0
    copies = minhash.deduplicate(frame(spark, [(4, x)] * 5 + [(None, y)] * 4))
    assert sorted(((r.doc_id, r.text) for r in copies.collect()), key=str) == sorted([(4, x), (None, y)], key=str)


def test_words_made_to_agree_have_different_names(spark):
    """Thue-Morse words and their complements, which agree in any polynomial modulo a power of two."""
    for size in (1024, 4096):
        a, b = thue_morse(size)
        lead = [f"w{i}" for i in range(12)]
        docs = [(1, " ".join([*lead, a])), (2, " ".join([*lead, b])), (3, " ".join([*lead, a.upper()]))]
        got = recompress.remove_repeats(frame(spark, docs))
        assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == sorted(brute.word_repeats(docs))
        items = [(1, " ".join([*lead[:5], a])), (2, b), (3, "zz " + a)]
        docs = [(1, " ".join([*lead[:5], a])), (2, " ".join([*lead[:5], b])), (3, a.upper())]
        hit = decontam.digest(decontam.find_matches(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")))
        assert sorted(tuple(r) for r in hit.collect()) == sorted(brute.contamination(docs, items))
        docs = [(1, f"p q r {a}"), (2, f"p q r {b}"), (3, f"p q r {a.upper()}")]
        near = minhash.near_duplicates(frame(spark, docs), shingle=4)
        assert sorted(tuple(r) for r in near.collect()) == sorted(brute.near(docs))
        docs = [(1, a), (2, b), (3, a)]
        cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        assert sorted(tuple(r) for r in sufdedup.remove_repeats(frame(spark, docs)).select(cols).collect()) == sorted(brute.byte_repeats(docs))


def test_items_without_an_id(spark):
    items = [(None, "red stone bridge"), (4, "Red Stone"), (None, "blue lamp")]
    docs = [(1, "a red stone bridge"), (2, "blue lamp"), (3, "nothing")]
    for block in (decontam.BLOCK_BYTES, 12):
        got = decontam.digest(decontam.find_matches(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block))
        import hashlib

        sha = {k: hashlib.sha256(k.encode()).hexdigest() for k in ("4", "")}
        assert sorted(tuple(r) for r in got.collect()) == [(1, 4, 3, 2, sha["4"], True), (2, 2, 2, 1, sha[""], True), (3, 1, 0, 0, sha[""], False)]


def test_no_id_is_not_held_out(spark):
    """Rows without an id, repeated rows and long ones are scored; held_out is never null; repeats change nothing."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        words = rng.choices(["rain", "stone", "lamp", "river", "tree"], k=40) + (["idiot", "fool"] * 5 if bad else [])
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    odd = [(None, "rain and stone"), (None, None), (5, rows[5][1]), (5, "another text"), (500, "lamp " * 30000)]
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for run in (lambda d: toxicity.toxicity(d, lab), lambda d: puquality.quality(d, lab), lambda d: langid.languages(d)):
        one = run(frame(spark, rows + odd)).collect()
        assert len(one) == len(rows) + len(odd) and all(r.held_out is not None and 0 <= r.score <= 1 for r in one)
        assert not any(r.held_out for r in one if r.doc_id is None)
        again = run(frame(spark, (rows + odd)[::-1]).repartition(3)).collect()
        assert sorted(map(str, one)) == sorted(map(str, again))
        empty = run(frame(spark, rows).limit(0))
        assert empty.count() == 0
