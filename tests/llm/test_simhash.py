"""Fingerprints and their links against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash

from mercato.llm import simhash
from mercato.llm.components import connected_components
from mercato.llm.scratch import Scratch

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprint(text):
    words = "".join(" " if c in "\t\n\v\f\r" else c for c in (text or "").translate(LOWER)).split(" ")
    words = [w for w in words if w]
    parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(codes, distance):
    label = list(range(len(codes)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                label[top(i)] = top(j)
    return [top(i) for i in range(len(codes))]


def expected(rows):
    codes = [fingerprint(t) for _, t in rows]
    roots = components(codes, 2)
    smallest = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            smallest[root] = min(i, smallest.get(root, i))
    return sorted(((i, f"{c:016x}", smallest.get(r)) for (i, _), c, r in zip(rows, codes, roots)), key=repr)


@pytest.mark.parametrize("part_codes", [1, 4, 100_000])
def test_documents_equal_all_pairs(documents, corpus, part_codes):
    got = simhash.near_duplicates(documents, part_codes=part_codes).select("doc_id", "fingerprint", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected([r[:2] for r in corpus])


def _codes(seed, n):
    """Some at random, some around a few centres, so that links and near links abound."""
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        code = pick.choice(centres) if pick.random() < 0.7 else pick.getrandbits(64)
        for _ in range(pick.randrange(6)):
            code ^= 1 << pick.randrange(64)
        out.add(code)
    return sorted(out, key=lambda c: pick.random())


@pytest.mark.parametrize("n, distance, node_pairs", [(1, 2, 10), (2, 64, 10), (300, 2, 7), (300, 0, 100_000), (257, 3, 100_000)])
def test_trees_find_all_close_pairs(n, distance, node_pairs):
    codes = np.array(_codes(n, n), np.uint64)
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    codes = codes[np.argsort(ranks)]
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    tree = simhash.GrayTree(codes)
    own = sorted((int(a), int(b)) for x, y in simhash.close_pairs(tree, tree, distance, node_pairs) for a, b in zip(x, y))
    assert own == sorted(zip(*(x.tolist() for x in np.nonzero(np.triu(apart <= distance, 1)))))
    left, right = simhash.GrayTree(codes[: n // 3]), simhash.GrayTree(codes[n // 3 :])
    across = sorted((int(a), int(b)) for x, y in simhash.close_pairs(left, right, distance, node_pairs) for a, b in zip(x, y))
    assert across == sorted(zip(*(x.tolist() for x in np.nonzero(apart[: n // 3, n // 3 :] <= distance))))


def test_parts_lose_no_link(spark):
    codes = _codes(9, 400)
    signed = np.array(codes, np.uint64).view(np.int64)
    frame = spark.createDataFrame([(int(c),) for c in signed], "code bigint")
    vertex = dict(zip(simhash.tb.mixed(np.array(codes, np.uint64)).view(np.int64).tolist(), range(len(codes))))
    assert len(vertex) == len(codes)
    scratch = Scratch(spark, "test")
    edges = scratch.write(simhash.close_codes(frame, scratch, 2, part_codes=20), "edges")
    for r in edges.collect():
        assert (codes[vertex[r["a"]]] ^ codes[vertex[r["b"]]]).bit_count() <= 64
    root = {vertex[r["v"]]: vertex[r["root"]] for r in connected_components(edges, scratch).collect()}
    got = [root.get(k, k) for k in range(len(codes))]
    want = components(codes, 2)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_empty_and_single(no_documents, text_of):
    assert simhash.near_duplicates(no_documents).count() == 0
    one = simhash.near_duplicates(text_of((5, None))).collect()
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in one] == [(5, "0" * 16, 5)]
    assert simhash.near_duplicates(text_of((None, "a b c d"))).first()["component_id"] is None
