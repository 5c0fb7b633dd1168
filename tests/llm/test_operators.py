"""The corpus operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from branchbook.llm import decontam, langid, mcdrules, minhash, packing, puquality, recompress, sufdedup, toxicity, warc  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, bucket int, spans string, score double"
LABELS = "doc_id bigint, quality int, toxic int"


def texts() -> list[tuple[int, str | None]]:
    rng = random.Random(5)
    vocabulary = ["wört", "the", "Of", "x", "rain", "idiot", "42", "été", "stone", "a", "river", "lamp|", "#"]
    base = [" ".join(rng.choices(vocabulary, k=n)) for n in (3, 12, 13, 60, 90, 120, 400, 3000)]
    passage = " ".join(rng.choices(vocabulary, k=70))
    out: list[str | None] = [None, "", "   \n\t", "one", "a b c", "...", *base, base[5], base[5].upper(), passage]
    out += [f"{b} {passage}\n{b[:50]}" for b in base[1:5]] + [passage + " tail"] + ["same " * 40, "same " * 55, "é" * 350, "é" * 351]
    near = base[6].split()
    for i in range(4):
        near = near.copy()
        near[50 * i + 7] = f"new{i}"
        out.append(" ".join(near))
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, ("en", "fr", None)[i % 3], None, 1, "x", 0.5) for i, (d, t) in enumerate(rows)], DOCS)


def rows_of(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    return texts()


def test_decontamination(spark, docs):
    long = docs[12][1].split()
    items = [(1, " ".join(long[5:25])), (2, "A b C"), (3, None), (4, "..."), (5, " ".join(long[8:30])), (5, " ".join(long[8:30])), (6, "idiot")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (decontam.BLOCK_BYTES, 60):
        got = decontam.digest(decontam.find_matches(frame(spark, docs), bench, block_bytes=block))
        assert rows_of(got, got.columns) == sorted(brute.contamination(docs, items), key=str)
    clean = decontam.decontaminate(frame(spark, docs), bench)
    assert clean.columns == frame(spark, docs).columns
    assert {r.doc_id for r in clean.collect()} == {d[0] for d in brute.contamination(docs, items) if not d[5]}
    assert decontam.find_matches(frame(spark, docs), bench.limit(0)).where("size(items) > 0").count() == 0


def test_one_benchmark_block_at_a_time(spark, docs, monkeypatch):
    """The broadcast of a block is gone before the next block is fetched."""
    alive, most = set(), []
    make = spark.sparkContext.broadcast

    def broadcast(value):
        made = make(value)
        if isinstance(value, decontam.TestSuffixes):
            drop = made.destroy
            made.destroy = lambda *a, **b: (alive.discard(id(value)), drop(*a, **b))
            alive.add(id(value))
            most.append(len(alive))
        return made

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    items = [(i, f"river stone {i} the rain") for i in range(12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.digest(decontam.find_matches(frame(spark, docs), bench, block_bytes=60))
    assert rows_of(got, got.columns) == sorted(brute.contamination(docs, items), key=str)
    assert len(most) > 2 and max(most) == 1


def test_near_duplicates(spark, docs):
    got = minhash.near_duplicates(frame(spark, docs), shingle=4)
    assert rows_of(got, ["doc_id", "n_shingles", "component_id", "kept"]) == sorted(brute.near(docs), key=str)
    repeated = minhash.near_duplicates(frame(spark, [*docs, docs[9], docs[9], (None, "one")]), shingle=4)
    assert repeated.count() == len(docs) + 3


def test_blocks_join_what_the_star_misses(spark):
    """A chain of near copies whose ends are far apart is one component."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(30):
        words = words.copy()
        for j in rng.sample(range(300), 5):
            words[j] = f"n{i}_{j}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(frame(spark, rows), shingle=4)
    assert rows_of(got, ["doc_id", "n_shingles", "component_id", "kept"]) == sorted(brute.near(rows), key=str)


def test_suffix_dedup(spark, docs):
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(sufdedup.remove_repeats(frame(spark, docs)), cols) == sorted(brute.byte_repeats(docs), key=str)
    cleaned = {r.doc_id: r for r in sufdedup.cleaned(frame(spark, docs)).collect()}
    assert cleaned[0].text is None and cleaned[0].bucket == 1 and cleaned[0].spans == "x"
    for d, n, gone, _, _ in brute.byte_repeats(docs):
        assert n - gone <= len((cleaned[d].text or "").encode()) <= n - gone + 6


def test_recompression(spark, docs):
    got = recompress.remove_repeats(frame(spark, docs))
    assert rows_of(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(brute.word_repeats(docs), key=str)


def test_recompression_of_runs(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randrange(10, 120)))) for i in range(60)] + [(99, "a " * 40), (100, "a " * 77)]
    got = recompress.remove_repeats(frame(spark, rows))
    assert rows_of(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(brute.word_repeats(rows), key=str)


def test_rows_that_share_an_id(spark):
    """What is found in one row leaves other rows of the same id, or other rows without an id, alone."""
    rng = random.Random(21)
    plain = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    passage, other = plain(), plain()
    rows = [(None, f"{passage} {plain()}"), (None, f"{plain()} {passage}"), (None, plain()), (None, None), (7, f"{other} x"), (7, plain()), (7, plain()),
            (9, f"y {passage} {other}"), (9, f"y {passage} {other}"), (9, plain()), (3, plain()), (8, f"{plain()} {other}")]
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = brute.byte_repeats(rows)
    assert rows_of(sufdedup.remove_repeats(frame(spark, rows)), cols) == sorted(expected, key=str)
    cleaned = sorted(len((r.text or "").encode()) for r in sufdedup.cleaned(frame(spark, rows)).collect())
    assert cleaned == sorted(n - gone for _, n, gone, _, _ in expected)
    least = [(-1 if d is None else d, t) for d, t in rows]
    expected = [(None if d == -1 else d, *rest) for d, *rest in brute.word_repeats(least)]
    got = recompress.remove_repeats(frame(spark, rows))
    assert rows_of(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(expected, key=str)
    bench = spark.createDataFrame([(1, " ".join(passage.split()[5:30]))], "item_id bigint, text string")
    clean = decontam.decontaminate(frame(spark, rows), bench)
    assert rows_of(clean, ["doc_id", "text"]) == sorted(((d, t) for d, t in rows if passage not in (t or "")), key=str)


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n é</p>"
    pages = [(3, "http://a", big), (1, "http://b\r\nX: y", big), (2, None, big), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "v", "short"), (8, "w", "y" * 100), (8, "w", "y" * 100)]
    got = warc.round_trip(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    have = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in got.collect()}
    n = len(big.encode())
    assert have == {1: (n, "response", None), 2: (n, "revisit", 1), 3: (n, "revisit", 1), 4: (0, "response", None), 5: (0, "response", None),
                    6: (5, "response", None), 7: (5, "response", None), 8: (100, "response", None)}
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_packing(spark, docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tok.encode_special_tokens = True
    rows = [*docs, (500, "a \n b\n\nc  d\t e it's  'S x\x1cy z\x85 q   "), (501, "<|endoftext|> hi"), (502, docs[13][1])]
    pieces = packing.pack(frame(spark, rows), path).toPandas()
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for p in pieces[pieces.doc_id == d].sort_values("start").itertuples():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    one = pieces.sort_values(["sequence_id", "offset"])
    assert (one.groupby("sequence_id").length.cumsum() - one.length == one.offset).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024
    assert packing.pack(frame(spark, []), path).count() == 0


def test_packing_ids_of_added_tokens(spark, tmp_path):
    """op5_packing against the unmodified tokenizer, on texts that hold its added token."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from branchbook.llm import queries

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    rows = list(enumerate(["a page <|endoftext|> next", end, f"{end}{end} \n{end}x", f"  {end}  ", f"<{end}>", "<|endoftext", "<|EndOfText|>", f"it's{end}'s é{end}é"]))
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = {r.doc_id: r for r in queries.op5_packing(spark, str(tmp_path)).collect()}
    for d, t in rows:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (pieces[d].doc_tokens, pieces[d].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_patterns_hold_every_item():
    import numpy as np

    rng = np.random.default_rng(2)
    sizes, counts = np.unique(rng.integers(1, 128, 3000), return_counts=True)
    found = packing.patterns(sizes, counts, 128)
    held: dict[int, int] = {}
    for times, copies in found:
        assert sum(s * c for s, c in copies.items()) <= 128
        for s, c in copies.items():
            held[s] = held.get(s, 0) + times * c
    assert held == dict(zip(sizes.tolist(), counts.tolist()))
    assert sum(t for t, _ in found) <= 1.02 * (sizes * counts).sum() / 128 + 1


def test_mcd_rules(spark, docs):
    got = mcdrules.judged(frame(spark, docs))
    assert rows_of(got, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]) == sorted(brute.base_statistics(docs), key=str)
    assert got.where("kept and base_failed or kept is null").count() == 0
    assert mcdrules.judged(frame(spark, [])).count() == 0


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.toPandas().set_index("doc_id")
    for got, label, least in ((toxicity.toxicity(docs, labels), "toxic", 0.95), (puquality.quality(docs, labels), "quality", 0.97)):
        held = got.where("held_out").toPandas().set_index("doc_id").join(known, how="inner")
        assert (held.predicted == held[label]).mean() > least
    held = langid.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_rare_languages_are_learnt(spark):
    """Languages far below the sample's resolution are in the model and predicted."""
    rng = random.Random(8)
    alphabets = {"xa": "abcdefg", "xb": "hijklmn", "xc": "opqrst", "xd": "uvwxyz", "xe": "éèàüöß"}
    text = lambda a: " ".join("".join(rng.choices(alphabets[a], k=5)) for _ in range(30))
    langs = ["xa"] * 3000 + ["xb", "xc", "xd", "xe"] * 9
    rows = spark.createDataFrame([(i, text(v), v) for i, v in enumerate(langs)], "doc_id bigint, text string, lang string")
    model = langid.train(rows, limit=50)
    assert model.langs == sorted(alphabets)
    got = {r.doc_id: r.lang_pred for r in langid.predicted(rows, model).collect()}
    assert sum(got[i] == v for i, v in enumerate(langs[3000:], 3000)) >= 34
    assert sum(got[i] == v for i, v in enumerate(langs[:3000])) >= 2990


def test_classifiers_on_odd_rows(spark, docs):
    rows = frame(spark, [*docs, (None, "no id")])
    labels = spark.createDataFrame([(3, 1, 0), (4, None, None), (4, 1, 1), (4, 0, 0), (9999, 1, 1)], LABELS)
    assert toxicity.toxicity(rows, labels).where("score is null or score < 0 or score > 1").count() == 0
    assert puquality.quality(rows, labels.limit(0)).where("score is null").count() == 0
    got = {r.doc_id: r.lang_pred for r in langid.languages(rows).collect()}
    assert got[0] == got[1] == got[2] == got[5] == "und" and got[9] in ("en", "fr")
    assert langid.languages(frame(spark, [])).count() == 0
