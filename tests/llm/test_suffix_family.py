"""The kept suffix index: batches in any number give the marks of one, levels merge geometrically, hot names are split."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("branchbook.llm")

import brute  # noqa: E402
from branchbook.llm import sufdedup  # noqa: E402
from branchbook.llm.common import covered, marks_by_document, with_row_keys  # noqa: E402


def texts(seed=5):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(50))
    phrase = "a phrase of more than thirty-two bytes that everyone uses all the time"
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(20)]
    rows += [(20 + i, " ".join([*(word() for _ in range(30)), passage, *(word() for _ in range(30))])) for i in range(12)]
    rows += [(40 + i, " ".join([*(word() for _ in range(40)), phrase, *(word() for _ in range(40))])) for i in range(40)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(9)]
    return [*rows, (200, "ab" * 2000), (201, "x" * 900), (202, None), (203, ""), (204, passage[:199])]


def removed(marks, docs):
    size = {d: len((t or "").encode()) for d, t in docs}
    return {r["__doc"]: int(covered(r.spans, size[r["__doc"]]).sum()) for r in marks_by_document(marks).collect()}


def frame(spark, rows):
    return with_row_keys(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_batches_equal_one(spark):
    rows = texts()
    expected = {d: gone for d, _, gone, _, _ in brute.byte_repeats(rows) if gone}
    docs = frame(spark, rows)
    for batches in (1, 5):
        assert removed(sufdedup.repeated_spans(docs, batches=batches), rows) == expected


def test_later_batches_and_geometric_levels(spark):
    """After each batch the index answers for all it holds; sizes go as a binary counter."""
    rows = texts(6)
    random.Random(1).shuffle(rows)
    family, held, sizes = sufdedup.SuffixFamily(spark), [], []
    for i in range(4):
        part = rows[i::4]
        held += part
        family.add(frame(spark, part))
        sizes.append([size for size, _ in family.levels])
        if i in (1, 3):
            assert removed(family.repeated_spans(), held) == {d: gone for d, _, gone, _, _ in brute.byte_repeats(held) if gone}
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1]]
    family.add(frame(spark, []))
    assert [size for size, _ in family.levels] == [4, 1]
    assert removed(family.repeated_spans(), held) == {d: gone for d, _, gone, _, _ in brute.byte_repeats(held) if gone}


def test_hot_names_are_found_and_split(spark):
    """Whatever holds 2/share of the suffixes is reported, at most share of each kind, and no bucket keeps a hot stretch."""
    rows = [(i, "z" * 400) for i in range(300)] + [(1000 + i, t) for i, t in texts(7)[:20]]
    docs = frame(spark, rows)
    family = sufdedup.SuffixFamily(spark)
    family.add(docs)
    level = family.levels[0][1]
    names, stretches = sufdedup.hot_names(level, 32)
    cols = [sufdedup._level_cols(*r) for r in level.collect()]
    for k, hot in ((1, names), (2, stretches)):
        v, c = np.unique(np.concatenate([x[k] for x in cols]), return_counts=True)
        assert set(v[c >= 2 * c.sum() / 32].tolist()) <= set(hot.tolist()) and 0 < len(hot) <= 32
    dealt = level.selectExpr("true as fresh", "*").mapInArrow(lambda it: sufdedup._dealt(it, (names, stretches), 8), sufdedup.DEALT_SCHEMA)
    held = [sufdedup._level_cols(*r[2:])[2] for r in dealt.collect()]
    assert max(np.isin(h, stretches).sum() for h in held) <= len(stretches) * len(cols)
    assert removed(family.repeated_spans(), rows) == {d: gone for d, _, gone, _, _ in brute.byte_repeats(rows) if gone}
