"""Importance resampling against counting and sorting by hand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import importance
from mercato.llm import textbytes as tb

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
KEY = ("doc_id", "n_features", "weight", "score", "rank")


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def by_hand(rows, target, percent=25):
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out, can = [], []
    for k, (i, text) in enumerate(rows):
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
        if len(words) >= 20:
            can.append(k)
    can.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0]))
    for rank, k in enumerate(can[: percent * len(can) // 100], 1):
        out[k][4] = rank
    return out


def shown(df):
    return sorted((tuple(r) for r in df.select(*KEY).collect()), key=repr)


def same(rows):
    """Repeated rows may stand in for one another."""
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def target(spark, some_text):
    return spark.createDataFrame([(k, some_text(500 + k, 40)) for k in range(6)] + [(7, None), (8, "")], "item_id bigint, text string")


@pytest.mark.parametrize("percent, last_keys", [(25, 10_000), (60, 1), (100, 3)])
def test_draw_equals_a_full_sort(documents, corpus, target, percent, last_keys):
    rows = [r[:2] for r in corpus]
    texts = [r["text"] for r in target.collect()]
    got = importance.resampled(documents, target, percent=percent, last_keys=last_keys)
    assert shown(got) == same(by_hand(rows, texts, percent))


def test_checksums_of_words_of_any_length(some_text):
    pick = random.Random(4)
    words = ["".join(pick.choice("abc0é漢") for _ in range(n)) for n in [1, 2, 63, 64, 65, 66, 200, 3, 64, 1, 500, 2]]
    raw = " ".join(words).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends = tb.runs(importance.WORD[data], np.array([0, len(data)]))
    one, two = importance._crcs(data, starts, ends)
    assert one.tolist() == [zlib.crc32(w.encode()) for w in words]
    assert two.tolist() == [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])]


def test_many_words_are_worked_on_in_groups(monkeypatch, documents, corpus, target):
    monkeypatch.setattr(importance, "WORDS_AT_ONCE", 7)
    rows = [(k, (r[1] or "").encode()) for k, r in enumerate(corpus)]
    offsets = np.cumsum([0] + [len(x) for _, x in rows])
    piece = tb.Slice(0, offsets, np.frombuffer(b"".join(x for _, x in rows), np.uint8))
    one, two, first = importance.word_buckets(piece)
    inside = importance._in_rows(first, len(two))
    found = [features(r[1]) for r in corpus]
    assert one.tolist() == [bucket(w) for words, _ in found for w in words]
    assert two[inside].tolist() == [bucket(p) for words, every in found for p in every[len(words) :]]


@pytest.mark.parametrize("block", [1, 5, 1000])
def test_pivots_find_each_place(spark, monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK_KEYS", block)
    pick = random.Random(block)
    rows = [(pick.choice([None, 1, 2, 3]), pick.randrange(4), pick.randrange(2), k) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, score bigint, text_hash bigint, uid bigint")
    frame = frame.withColumn("unnamed", F.col("doc_id").isNull().cast("int")).repartition(3)
    order = sorted((-s, int(d is None), d or 0, h, u) for d, s, h, u in rows)
    for place in (1, 2, 17, 40):
        assert importance.cutoff(frame, place, last_keys=1) == order[place - 1]


def test_empty_tables(spark, documents, no_documents, target):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resampled(no_documents, target).count() == 0
    assert importance.resampled(no_documents, none).count() == 0
    got = importance.resampled(documents, none)
    assert got.count() == documents.count() and got.where("rank is not null").count() > 0
    few = spark.createDataFrame([(1, "too few words"), (2, None)], "doc_id bigint, text string")
    assert [r["rank"] for r in importance.resampled(few, target).collect()] == [None, None]
