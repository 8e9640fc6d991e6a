"""Lexical search against a plain version, whole and in small blocks, and on the awkward tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewell.llm import lexical_search as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    counts = [(d, Counter(words(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        found = []
        for d, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(words(text)) if c[t])
            if score > 0:
                found.append((-score, d is not None, d or 0))
        out += [(item, r + 1, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, k=5, schema=DOCS):
    frame = ls.search(spark.createDataFrame(docs, schema), spark.createDataFrame(items, ITEMS), k)
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdeé1日", k=rng.randint(1, 3))) for _ in range(120)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weights, k=n))

    docs = [(i, text(rng.choice([1, 5, 5, 5, 30, 30, 400]))) for i in range(300)]
    docs += [(300 + i, docs[3][1]) for i in range(150)] + [(1, docs[1][1]), (None, docs[4][1]), (None, docs[4][1])]
    docs += [(900, None), (901, ""), (902, "... --"), (903, "zzz")]
    items = [(i, text(rng.randint(1, 40))) for i in range(30)] + [(3, "b c"), (3, "b c"), (None, "a b"), (50, None), (51, ""), (52, "qqq")]
    return docs, items


def test_equals_plain_version(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items) == plain(docs, items, 5)


def test_groups_of_items(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ls, "PAIRS", 60)
    assert got(spark, docs, items, 3) == plain(docs, items, 3)


@pytest.mark.parametrize("cells,run,exact", [(2_000_000, 10**6, 1 << 53), (300, 500, 1 << 53), (40, 50, 1)])
def test_blocks_strata_and_bounds(corpus, monkeypatch, cells, run, exact):
    """One task's search, with blocks of any size and whole numbers in place of doubles."""
    docs, items = corpus
    for name, value in (("CELLS", cells), ("RUN", run), ("EXACT", exact)):
        monkeypatch.setattr(ls, name, value)
    items = sorted({(i, t) for i, t in items if i is not None and words(t)})
    rows = []
    for number, (_, text) in enumerate(items):
        data = np.frombuffer(text.encode(), np.uint8)
        rows.append({"item": number, "terms": np.unique(ls.terms(data, np.array([0, len(data)]))[0]).view(np.int64)})
    group = ls._group(rows)
    counts = [(d, t, Counter(words(t))) for d, t in docs if words(t)]
    n, total = len(counts), sum(c.total() for *_, c in counts)
    import pyarrow as pa

    found = []
    for d, text, c in counts:
        data = np.frombuffer(text.encode(), np.uint8)
        place, tf = np.unique(ls.terms(data, np.array([0, len(data)]))[0], return_counts=True)
        at = np.minimum(np.searchsorted(group.vocabulary, place), len(group.vocabulary) - 1)
        hit = group.vocabulary[at] == place
        found.append((50 + 50 * c.total() * n // total, d, at[hit].tolist(), tf[hit].tolist()))
    found = sorted((f for f in found if f[2]), key=lambda f: f[0])
    df = np.zeros(len(group.vocabulary), int)
    for f in found:
        df[f[2]] += 1
    weights = np.array([ls.weight(n, x) for x in df])
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([f[1] for f in part], pa.int64()), pa.array([f[0] for f in part], pa.int64()),
             pa.array([f[2] for f in part], pa.list_(pa.int32())), pa.array([f[3] for f in part], pa.list_(pa.int32()))],
            ["doc_id", "m", "terms", "tfs"])
        for part in (found[i : i + 7] for i in range(0, len(found), 7))
    ]
    best = {}
    for item, score, ids, there in ls.best_of(ls._strata(batches, weights), group, weights, 5):
        for i, s, d, is_there in zip(item.tolist(), score.tolist(), ids.tolist(), there.tolist()):
            best.setdefault(i, []).append((-s, is_there, d))
    out = [(items[i][0], r + 1, d if there else None, -s) for i, x in best.items() for r, (s, there, d) in enumerate(sorted(x))]
    assert sorted(out, key=repr) == plain(docs, items, 5)


def test_odd_tables(spark, corpus):
    docs, items = corpus
    assert got(spark, [], items) == [] and got(spark, docs, []) == [] and got(spark, [(1, None)], items) == []
    assert got(spark, docs, [(1, None), (2, "--")]) == []
    clash = "doc_id long, text string, item long, m int, n int, terms int, tfs int, score int, item_id int, rank int, df int"
    assert got(spark, [(d, t, *[0] * 9) for d, t in docs], items, 5, clash) == plain(docs, items, 5)


def test_long_text(spark):
    docs = [(1, "a b " * 300_000), (2, "a c"), (3, "c")]
    items = [(1, "A"), (2, "b c " * 1000)]
    assert got(spark, docs, items) == plain(docs, items, 5)
