from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from mercato.llm import ngram_join
from mercato.llm.ngram_join import drop_similar, similar_groups
from mercato.llm.packing import best_fit, default_vocabulary, local_search, pack, pack_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def expected_groups(corpus) -> list[tuple]:
    sets = [shingles(r[1]) for r in corpus]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(sets)):
        members[root(i)].append(corpus[i][0])
    smallest = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return [(corpus[i][0], len(sets[i]), smallest[root(i)]) for i in range(len(sets))]


@pytest.mark.parametrize("common, tile_rows", [(0.001, 2_000), (0.5, 3)])
def test_components_equal_brute_force(documents, corpus, monkeypatch, common, tile_rows):
    monkeypatch.setattr(ngram_join, "COMMON_SHARE", common)
    rows = similar_groups(documents, tile_rows=tile_rows).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == Counter(expected_groups(corpus))
    kept = [r for r in rows if r.kept]
    assert all(r.doc_id == r.component_id for r in kept)


@pytest.mark.parametrize("tile_rows, block, stripe", [(2_000, 4_000_000, 256), (3, 700, 2)])
def test_links_of_classes_equal_brute_force(documents, corpus, monkeypatch, tile_rows, block, stripe):
    monkeypatch.setattr(ngram_join, "STRIPE_SETS", stripe)
    sets = [shingles(r[1]) for r in corpus]
    classes = [s for s in set(sets) if s]
    links = {a: sum(a != b and 100 * len(a & b) >= 80 * len(a | b) for b in classes) for a in classes}
    first = {a: min((r[0] for r, s in zip(corpus, sets) if s == a and r[0] is not None), default=None) for a in classes}
    want = [(r[0], first.get(s, r[0]), links.get(s, 0), c) for r, s, (_, _, c) in zip(corpus, sets, expected_groups(corpus))]
    assert max(links.values()) > 2
    got = similar_groups(documents, tile_rows=tile_rows, with_links=True, block_shingles=block).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links, r.component_id) for r in got) == Counter(want)


def test_links_at_the_threshold(text_of):
    words = [f"w{i}" for i in range(104)]
    a = " ".join(words)
    # Of 100 shingles 5 go with the last word's change, so 95 of 105 stay shared.
    docs = [(1, a), (2, " ".join([*words[:-1], "x"])), (3, " ".join([*words[:93], *[f"y{i}" for i in range(11)]]))]
    docs += [(4, " ".join([*words[:92], *[f"z{i}" for i in range(12)]]))]
    got = {r.doc_id: r.component_id for r in similar_groups(text_of(*docs)).collect()}
    want = {i: c for i, _, c in expected_groups(docs)}
    assert got == want


def test_one_document_of_each_group_stays(documents, corpus):
    kept = drop_similar(documents)
    assert kept.columns == documents.columns
    groups = expected_groups(corpus)
    want = Counter()
    for i, n, c in groups:
        if n == 0:
            want[i] += 1
    want.update({c for _, n, c in groups if n})
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_no_documents(no_documents):
    assert similar_groups(no_documents).count() == 0
    assert drop_similar(no_documents).count() == 0
    assert pack_documents(no_documents).count() == 0


def test_pieces_hold_all_ids_and_fill_sequences(documents, corpus):
    rows = pack_documents(documents, block=20).collect()
    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = Counter()
    for i, t, *_ in corpus:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            blob = np.array(ids[k : k + 2048], "<u4").tobytes()
            want[(i, k // 2048, k, len(blob) // 4, zlib.crc32(blob), blob)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(places) <= -(-total // 2048) + 1


def test_words_are_cut_as_the_tokenizer_cuts_whole_texts():
    from mercato.llm.packing import WordIds

    texts = ["á b", "x̣́ ́y", "<|endoftext|> <|x", "tab\tand\x1cfs\x85nel em", "it's I'LL '' ''s !'s 12a3 ﬁ ½ ²", "ΣΑΣ İI ẞ"]
    tokenizer = Tokenizer.from_file(default_vocabulary())
    ids, at = WordIds(default_vocabulary()).encode([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0]


def test_local_search_raises_squared_fill_and_empties_bins():
    lengths = np.array([6, 5, 4, 3, 7, 2, 3])
    poor = [[0], [1, 2], [3, 5], [4], [6]]
    better = local_search(poor, lengths, 10)
    fill = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert sorted(i for b in better for i in b) == list(range(7))
    assert all(sum(lengths[i] for i in b) <= 10 for b in better)
    assert fill(better) > fill(poor) and len(better) < len(poor)
    assert len(best_fit(lengths, 10)) <= 4


@pytest.mark.parametrize("low, high, spare", [(400, 700, 20), (600, 800, 115), (300, 1100, 25), (1, 2047, 30)])
def test_search_goes_on_until_no_step_is_left(low, high, spare):
    """`spare`: sequences above the bound; bins are exchanged until nothing fits better."""
    lengths = np.random.default_rng(low).integers(low, high + 1, 3000)
    bins = pack(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(3000)) and all(sum(lengths[b]) <= 2048 for b in bins)
    assert len(bins) <= -(-int(lengths.sum()) // 2048) + spare
    fills = sorted((sum(lengths[b]), k) for k, b in enumerate(bins))
    rank = {k: r for r, (f, k) in enumerate(fills)}
    for _, b in fills[:3]:
        for c in (c for c in rank if rank[c] > rank[b]):
            rest = 2048 - sum(lengths[bins[c]])
            for need in lengths[bins[b]].tolist():
                assert not any(back < need <= rest + back for back in [0, *lengths[bins[c]].tolist()])


def test_equal_short_pieces_need_little_memory():
    import tracemalloc

    tracemalloc.start()
    assert len(pack(np.full(20_000, 3), 2048)) == 30
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_long_texts_and_a_full_memory_of_words(monkeypatch, some_text):
    from mercato.llm import packing

    texts = [some_text(1, 400), some_text(2, 900), "", some_text(3, 50)]
    ids, at = packing.WordIds(default_vocabulary()).encode([t.encode() for t in texts])
    monkeypatch.setattr(packing, "TEXT_BYTES", 100)
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 1_000)
    words = packing.WordIds(default_vocabulary())
    for _ in range(2):
        again, places = words.encode([t.encode() for t in texts])
        assert again.tolist() == ids.tolist() and places.tolist() == at.tolist()


def test_signatures_bound_the_difference_of_sets_of_any_size():
    pick = np.random.default_rng(5)
    sets = []
    for n in (1, 50, 2048, 2049, 3000, 4096, 4097, 20_000):
        base = pick.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate([base[n // 8 :], pick.integers(0, 1 << 63, n // 8, dtype=np.int64).astype(np.uint64)]))]
    x, y = (a.ravel() for a in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    found = ngram_join.differences([ngram_join._signature(s).tobytes() for s in sets], x, y)
    for a, b, bits in zip(x.tolist(), y.tolist(), found.tolist()):
        apart = len(np.setxor1d(sets[a], sets[b]))
        assert bits <= apart and (bits - apart) % 2 == 0 and (a != b or bits == 0)
        n1, n2 = len(sets[a]), len(sets[b])
        if n1 > 2000 and 5 * n1 >= 4 * n2 and 5 * n2 >= 4 * n1 and apart == n1 + n2:
            # Sets without a common member are told apart by their signatures alone.
            assert (n1 + n2 - bits) // 2 < ngram_join._required(n1, n2, 80)


def test_shingles_of_the_same_sets_are_compared_once(spark):
    """A set that stands twice under one shingle is no other set left out."""
    met = {1: [1, 2], 2: [1, 2], 3: [1, 2, 3], 4: [1, 1, 2], 5: [7], 6: [8, 8], 7: [3, 4, 5, 9], 8: [9, 5, 4, 3]}
    rows = spark.createDataFrame([(h, u) for h, us in met.items() for u in us], "h bigint, uid bigint")
    assert sorted(r.h for r in ngram_join._telling(rows).collect()) == [1, 3, 4, 7]


def test_groups_of_one_tile_are_told_apart(spark):
    met = [(1, 1, 0), (1, 2, 0), (1, 3, 5), (2, 1, 0), (2, 2, 0), (2, 4, 5), (3, 3, 5), (3, 4, 5), (4, 4, 5), (4, 3, 5)]
    rows = spark.createDataFrame(met, "h bigint, uid bigint, within bigint")
    assert sorted(map(tuple, ngram_join._telling(rows, "within").collect())) == [(1, 0), (3, 5)]


def tile_of(spark, sets: list[np.ndarray]):
    """Sets that all meet in three shingles, each a group of its own."""
    rows = [(h, u, len(x), u, 0) for u, x in enumerate(sets) for h in (7, 8, 9)]
    members = spark.createDataFrame(rows, "h bigint, uid bigint, n int, root bigint, within bigint")
    described = [(u, bytearray(ngram_join._signature(x).tobytes()), bytearray(x.tobytes())) for u, x in enumerate(sets)]
    return members, spark.createDataFrame(described, "uid bigint, bits binary, hashes binary")


def roots_of(pairs, size: int) -> list[int]:
    root = list(range(size))
    for a, b in pairs:
        root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    return root


@pytest.mark.parametrize("tile_rows, block, chunk", [(2_000, 4_000_000, 500_000), (2_000, 4_000_000, 70), (7, 900, 70)])
@pytest.mark.parametrize("hashes", [False, True])
def test_a_tile_gives_no_more_pairs_than_rows(spark, monkeypatch, tile_rows, block, chunk, hashes):
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", chunk)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    made, plain = [], ngram_join.map_arrow

    def kept(df, run, schema):
        made.append(plain(df, run, schema))
        return made[-1]

    monkeypatch.setattr(ngram_join, "map_arrow", kept)
    pick = np.random.default_rng(3)
    base = np.arange(1, 101, dtype=np.uint64) << np.uint64(20) | pick.integers(0, 1 << 20, 100, dtype=np.uint64)
    sets = []
    for k in range(60):
        # Some are near to most others, some at the threshold, some to none.
        changed = pick.choice(100, (2, 8, 30)[k % 3], replace=False)
        sets.append(np.unique(np.where(np.isin(np.arange(100), changed), base + np.uint64(k + 1) * np.uint64(1 << 40), base)))
    members, described = tile_of(spark, sets)
    pairs = ngram_join._tile_pairs(members, described if hashes else described.drop("hashes"), 80, tile_rows)
    pairs = [tuple(r) for r in pairs.collect()]
    signatures = [ngram_join._signature(x).tobytes() for x in sets]
    x, y = np.triu_indices(len(sets), 1)
    possible = (200 - ngram_join.differences(signatures, x, y)) // 2 >= ngram_join._required(100, 100, 80)
    linked = [len(np.intersect1d(sets[a], sets[b])) * 100 >= 80 * len(np.union1d(sets[a], sets[b])) for a, b in zip(x, y)]
    wanted = np.array(linked) if hashes else possible
    every = list(zip(x[wanted].tolist(), y[wanted].tolist()))
    assert len(every) > 4 * len(sets)
    assert set(pairs) <= set(every) and roots_of(pairs, len(sets)) == roots_of(every, len(sets))
    rows = ngram_join._tile_pairs(members, described.drop("hashes"), 80, tile_rows, only_rows=True).collect()
    assert sorted(r.uid for r in rows) == np.unique(np.concatenate([x[possible], y[possible]])).tolist()
    # All pairs of the three shingles would be many times as many as there are rows.
    blocks = 1 if tile_rows > len(sets) else 10
    assert made[0].count() < 3 * len(sets) * blocks and (blocks > 1 or len(pairs) < len(sets))


@pytest.mark.parametrize("tile_rows", [2_000, 20])
def test_a_group_around_the_threshold_equals_brute_force(text_of, some_text, tile_rows):
    """Hubs and pairs that seem near are often no links here."""
    pick = random.Random(11)
    docs = []
    for g in range(3):
        words = some_text(900 + g, 120 + 60 * g).split()
        for k in range(40):
            edited = list(words)
            for at in pick.sample(range(len(words)), pick.choice((1, 2, 3, 4, 5))):
                edited[at] = f"new{k}at{at}"
            docs.append((100 * g + k, " ".join(edited)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_groups(text_of(*docs), tile_rows=tile_rows).collect()]
    assert sorted(got) == sorted(expected_groups(docs))


def test_sets_are_made_again_only_where_they_are_asked_for(spark, documents, monkeypatch):
    rows = ngram_join._hashed(documents).where("doc_id in (10, 12, 41)")
    active = rows.selectExpr("doc_id * 2 as uid", "doc_id", "text_hash")
    made = ngram_join.set_contents(documents, active, 5)
    sets = {r.uid: np.frombuffer(r.hashes, np.uint64) for r in made.collect()}
    words = {r.doc_id: r.text.lower().split() for r in rows.collect()}
    assert {u: len(x) for u, x in sets.items()} == {
        2 * i: len({tuple(w[k : k + 5]) for k in range(len(w) - 4)}) for i, w in words.items()
    }
    assert sets[20].tolist() == sets[24].tolist()
    assert ngram_join.set_contents(documents, active.limit(0), 5).count() == 0
    # Of all texts only those that are asked for, and their copies, leave the worker.
    sent = []
    monkeypatch.setattr(ngram_join, "map_arrow", lambda df, run, schema: sent.append((df, run)) or documents.sparkSession.createDataFrame([], schema))
    ngram_join.set_contents(documents, active, 5)
    ((df, run),) = sent
    out = [i for b in run(iter(df.toArrow().to_batches())) for i in b.column(0).to_pylist()]
    assert {10, 11, 12, 41} <= set(out) and len(out) < documents.count() // 4


class Counted:
    """A tokenizer whose calls of the normaliser are counted."""

    def __init__(self, tokenizer):
        self.tokenizer, self.normalizer, self.calls = tokenizer, self, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def normalize_str(self, text):
        self.calls += 1
        return self.tokenizer.normalizer.normalize_str(text)


def test_new_words_are_cut_together():
    from mercato.llm.packing import WordIds

    texts = [" ".join(f"é{k}ß'll x{k}-{k}y" for k in range(1000)), "one\x00two <|endoftext|> a\u0308 \u0308b ñ<|x \xa0 plain"]
    tokenizer = Tokenizer.from_file(default_vocabulary())
    words = WordIds(default_vocabulary())
    words.tokenizer = Counted(words.tokenizer)
    for _ in range(2):
        ids, at = words.encode([t.encode() for t in texts])
        for k, t in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
    assert words.tokenizer.calls < 100


def test_a_worker_keeps_no_words_and_no_free_memory(monkeypatch, documents):
    import pyarrow as pa

    from mercato.llm import packing, shipping

    given = []
    monkeypatch.setattr(shipping, "give_back", lambda: given.append(1))
    monkeypatch.setattr(packing, "map_arrow", lambda df, function, schema: shipping.tidy(function))
    run = packing.tokenised_pieces(documents, default_vocabulary())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", "and more"]})
    assert sum(b.num_rows for b in run(iter([batch]))) == 2
    assert not packing.word_ids(default_vocabulary()).words and given == [1]
