"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from mercato.llm import lexical_search as ls

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return [t.translate(LOWER) for t in TERMS.findall(text or "")]


def by_hand(rows, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in rows]
    found = [(i, c) for i, c in found if c]
    N, L = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 25 + (75 * sum(c.values()) * N) // L
            s = 0
            for t in terms(text):
                if t in c:
                    s += math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = "item_id bigint, text string, doc_id string, rank int"


@pytest.fixture(scope="module")
def items(corpus, some_text):
    pick = random.Random(8)
    texts = [r[1] for r in corpus if r[1] and len(r[1]) > 200]
    cut = [pick.choice(texts).split() for _ in range(12)]
    rows = [(k, " ".join(w[a : a + 25])) for k, w in enumerate(cut) for a in [pick.randrange(len(w))]]
    rows += [(50, None), (51, ""), (52, "zzzz qqqq"), (53, "na na na"), (54, "one"), (None, "the same line here"), (54, some_text(4, 40))]
    return rows


@pytest.mark.parametrize("k, at_once, size", [(10, 2_000, 1 << 22), (1, 5, 1 << 22), (3, 2_000, 200)])
def test_search_equals_scoring_all(spark, documents, corpus, items, k, at_once, size):
    asked = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    got = ls.ranked_search(documents, asked, k, at_once, size)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand([r[:2] for r in corpus], items, k)


def test_limited_accumulators_keep_the_best():
    """Random postings: the rows found are the best by full scores, ties included."""
    pick = np.random.default_rng(3)
    for trial in range(60):
        n, m, k = 200, 12, int(pick.integers(1, 12))
        df = np.sort(pick.integers(1, n, m))
        rows = [np.sort(pick.choice(n, d, replace=False)) for d in df]
        gains = [pick.integers(1, 4 if trial % 2 else 1000, len(r)) for r in rows]
        cuts = np.concatenate(([0], np.cumsum(df)))
        item = ls.Item(np.arange(m), pick.integers(0, 50, m))
        full = np.zeros(n, np.int64)
        for r, g, w in zip(rows, gains, item.weights):
            full[r] += w * g
        score = np.zeros(n, np.int64)
        most = np.array([g.max() for g in gains])
        floor = int(np.sort(full)[-5]) if trial % 3 == 0 else 1
        good = ls.best_in_batch(item, cuts, np.concatenate(rows), np.concatenate(gains), most, score, k, max(1, floor))
        assert (score[good] == full[good]).all() and not np.delete(score, good).any()
        want = np.sort(full[full >= max(1, floor)])[::-1][:k]
        assert np.sort(score[good])[::-1][:k].tolist() == want.tolist()
        if len(want) == k:
            assert set(np.flatnonzero(full >= want[-1])) == set(good.tolist())


def test_accumulators_stop():
    """A common last term opens no accumulators once rare ones have filled the list."""
    item = ls.Item(np.array([0, 1]), np.array([1000, 1]))
    row, impact = np.concatenate([np.arange(5), np.arange(1000)]), np.ones(1005, np.int64)
    score = np.zeros(1000, np.int64)
    good = ls.best_in_batch(item, np.array([0, 5, 1005]), row, impact, np.array([1, 1]), score, 5, 1)
    assert sorted(good.tolist()) == [0, 1, 2, 3, 4] and np.count_nonzero(score) == 5 and score[0] == 1001


def test_equal_hashes_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ls.tb, "span_hash", lambda prefix, starts, ends: (ends - starts).astype(np.uint64))
    found, items = ls.asked_terms(pa.array(["ab cd ef ghi"]))
    data = np.frombuffer(b"xx ef ab abc", np.uint8)
    starts, ends = np.array([0, 3, 6, 9]), np.array([2, 5, 8, 12])
    words = [found.data[s : s + n].tobytes() for s, n in zip(found.starts, found.lengths)]
    assert [words[k] if k >= 0 else None for k in ls._numbers(found, data, starts, ends)] == [None, b"ef", b"ab", None]


def test_empty_tables(spark, documents, no_documents, items):
    asked = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    assert ls.ranked_search(no_documents, asked).count() == 0
    assert ls.ranked_search(documents, asked.limit(0)).count() == 0
