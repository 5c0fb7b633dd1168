"""The corpus pipeline's stages on small tables: nulls, empty and repeated rows, shared ids, clashing columns, empty tables."""

from __future__ import annotations

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean, spans string"


def tables():
    rng = random.Random(12)
    clean = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120]))) for _ in range(60)]
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    item = " ".join(f"b{i}" for i in range(30))
    toxic = [" ".join(["vile", "scum", "idiot"] * 8 + [f"t{rng.randrange(9999)}" for _ in range(20)]) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, t) for i, t in enumerate(toxic)]
    rows += [(200, clean[1]), (201, clean[1] + " tail"), (202, None), (203, ""), (None, "a text of nobody " + clean[2][:60]), (None, clean[3])]
    around = [" ".join(f"a{rng.randrange(10**6)}" for _ in range(90)) for _ in range(4)]
    rows += [(204, f"{around[0]} one {passage} two {around[1]}"), (205, f"{around[2]} three {passage} four {around[3]}"), (206, f"some {item} words"), (7, "another text of seven")]
    rows += [(207, "long " + " ".join(f"l{i}" for i in range(60_000))), (208, clean[5]), (208, clean[5])]
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 1) for i in range(30)]
    return rows, labels, [(1, item), (2, None), (None, "zzz zzz zzz")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "web", len(t or ""), 0.5, True, "s") for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = tables()
    at = tmp_path_factory.mktemp("corpus")
    frame(spark, rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_in_turn(spark, folder):
    """Each stage does its own work, keeps the columns and leaves clean documents alone."""
    rows, _, _ = tables()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            packed = {r.doc_id for r in out.collect()}
            break
        assert out.dtypes == docs.dtypes, name
        docs = corpus_pipeline.stored(out, "test-stage")
        ids[name] = sorted((r.doc_id for r in docs.collect()), key=str)
    assert not set(range(100, 130)) & set(ids["toxicity"]) and set(range(60)) <= set(ids["toxicity"])
    near = ids["near_duplicates"]
    assert not {200, 201} & set(near) and 208 not in near and near.count(7) == 2 and set(range(60)) <= set(near)
    assert near.count(None) == 1  # the copy of document 3 goes, the text of nobody stays
    assert ids["suffix_dedup"] == near
    cut = {r.doc_id: r.text for r in docs.collect()}
    assert ids["decontamination"] == [i for i in near if i != 206]
    before = dict(rows)
    for d in (204, 205):  # the passage goes, with the bytes next to it that both have; what is around it stays
        words = before[d].split()
        assert len(words) == 242 and len(cut[d].split()) in (181, 182)
        assert [w for w in cut[d].split() if w[0] == "a"] == [w for w in words if w[0] == "a"] and " p" not in cut[d]
    assert cut[202] is None and cut[203] == ""
    assert len(cut[207].split()) == 60_001
    assert {i for i in packed if i is not None} == {i for i in ids["decontamination"] if i is not None}


def test_pipeline_runs_whole_and_on_empty_tables(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    per = {}
    for r in out.collect():
        per.setdefault((r.doc_id, r.doc_tokens), 0)
        per[r.doc_id, r.doc_tokens] += r.length
        assert r.offset + r.length <= 1024
    # every token of a document is in one piece; two rows share the id 7
    assert all(n == tokens or d == 7 for (d, tokens), n in per.items())
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
