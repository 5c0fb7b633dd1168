"""Plain Python versions of the contracts, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        for j in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[j : j + 10])].add(str(i))
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for x, ids in windows.items():
            for j in range(len(w) - len(x) + 1):
                if tuple(w[j : j + len(x)]) == x:
                    hit.update(range(j, j + len(x)))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def near(docs, k=4):
    sets = {}
    for d, t in docs:
        w = (t or "").translate(LOWER).encode().split()
        sets[d] = {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()
    label = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return [(d, len(sets[d]), label[d], label[d] == d) for d, _ in docs]


def byte_repeats(docs, k=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = collections.Counter(b[i : i + k] for b in texts for i in range(len(b) - k + 1))
    out = []
    for (d, _), b in zip(docs, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if seen[b[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((d, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def word_repeats(docs, k=13):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least: dict = {}
    for d, w in words:
        for i in range(len(w) - k + 1):
            x = tuple(w[i : i + k])
            least[x] = min(least.get(x, d), d)
    out = []
    for d, w in words:
        gone = bytearray(len(w))
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < d:
                gone[i : i + k] = b"\1" * k
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, y in zip(w, gone) if not y)).hexdigest()))
    return out


def base_statistics(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        out.append((d, len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    return out
