from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from mercato.llm.exact_dedup import drop_exact_copies, exact_copies
from mercato.llm.mixing import mix, mixed_documents, source_targets

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def expected_copies(corpus):
    groups = defaultdict(list)
    for i, t, *_ in corpus:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = Counter()
    for text, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            out[(i, first, len(ids), k == 0, sha)] += 1
    return out


def test_copies_are_those_of_equal_normalised_texts(documents, corpus):
    got = exact_copies(documents)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == expected_copies(corpus)


def test_naming_is_exact_when_hashes_collide_and_texts_have_many_blocks(documents, corpus):
    got = exact_copies(documents, characters=64, place=lambda b: F.xxhash64(b) % 5)
    assert Counter(tuple(r) for r in got.collect()) == expected_copies(corpus)


def test_one_row_of_each_group_stays_with_all_columns(documents, corpus):
    kept = drop_exact_copies(documents)
    assert kept.columns == documents.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(k[0] for k in expected_copies(corpus).elements() if k[3])


def test_no_documents(no_documents):
    assert exact_copies(no_documents).count() == 0
    assert drop_exact_copies(no_documents).count() == 0
    assert mix(no_documents).count() == 0
    assert mixed_documents(no_documents).count() == 0


def expected_targets(totals: dict) -> dict:
    """Share by weight, hold sources at three times their size, share the rest again."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = sum(totals.values()) - sum(target.values())
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / whole >= 3 * totals[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in over:
            target[s] = 3 * totals[s]
            open_.discard(s)
    return target


def test_targets_follow_repeated_sharing(spark):
    totals = {"a": 10_000, "b": 10, "c": 500, "é": 0, "d": 7_000, None: 20}
    rows = spark.createDataFrame(list(totals.items()), "source string, size bigint")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = expected_targets(totals)
    assert set(got) == set(want)
    assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_a_mix_spends_each_budget_exactly(documents, corpus):
    rows = mix(documents, rows_per_range=10).collect()
    sizes = Counter()
    for _, t, _, s, *_ in corpus:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = expected_targets(dict(sizes))
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.times >= (r.taken > 0)
    assert len(rows) == len(corpus)
    assert all(abs(taken[s] - want[s]) <= 0.5001 for s in want)
    same = lambda rs: sorted((str(r.doc_id), r.size, r.taken) for r in rs)
    assert same(rows) == same(mix(documents, rows_per_range=1_000).collect())


def test_mixed_documents_repeat_rows(documents):
    mixed = mixed_documents(documents)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r.times for r in mix(documents).collect())
