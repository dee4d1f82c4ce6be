from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mercato.llm.line_runs import repeated_lines
from mercato.llm.repeated_passages import repeated_starts, suffix_ranks, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_removal(texts: list[str | None], span: int) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + span] for b in data for k in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - span + 1):
            if seen[b[k : k + span]] > 1:
                gone[k : k + span] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = int(gone[:1].sum() + (~gone[:-1] & gone[1:]).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("at_once", [4_000, 2])
def test_repeated_strings_go(documents, corpus, at_once):
    got = without_repeats(documents, span=200, at_once=at_once).collect()
    want = expected_removal([r[1] for r in corpus], 200)
    assert Counter((g.doc_id, *g[1:]) for g in got) == Counter((r[0], *w) for r, w in zip(corpus, want))


def test_spans_and_kept_bytes_belong_together(text_of):
    passage = "a passage that is long enough to be found in two places of the corpus"
    docs = text_of((1, "left " + passage + " right"), (2, passage + "é" + passage[:40]), (3, None))
    rows = {r.doc_id: r for r in without_repeats(docs, span=40, with_text=True).collect()}
    for i, text in ((1, "left " + passage + " right"), (2, passage + "é" + passage[:40])):
        data = text.encode()
        for s in reversed(rows[i].spans):
            data = data[: s.start] + data[s.end :]
        assert data == bytes(rows[i].kept)
    assert rows[3].n_bytes == 0 and rows[3].spans == []


def test_no_documents(no_documents):
    assert without_repeats(no_documents).count() == 0
    assert repeated_lines(no_documents).count() == 0


def test_suffix_ranks_follow_byte_order():
    phrases = [b"banana", b"nana", b"", b"ba", b"\xff\x00a"]
    ranks, begin = suffix_ranks(phrases)
    suffixes = [p[i:] for p in phrases for i in range(len(p))]
    place = {s: i for i, s in enumerate(sorted(set(suffixes)))}
    order = np.argsort(np.unique(ranks, return_inverse=True)[1], kind="stable")
    assert [suffixes[i] for i in order] == sorted(suffixes, key=lambda s: place[s])
    assert len({(r, s) for r, s in zip(ranks.tolist(), suffixes)}) == len(place) == len(set(ranks.tolist()))
    assert begin.tolist() == [0, 6, 10, 10, 12, 15]


def test_corpus_order_finds_strings_of_several_phrases():
    contents = [b"xxabcdefgh", b"yyabcdefgh", b"zzabcdefgQ"]
    number, start, twice = repeated_starts(contents, np.array([2, 2, 2]), 8)
    assert [(n, s) for n, s, t in zip(number.tolist(), start.tolist(), twice) if t] == [(0, 2), (1, 2)]


def expected_lines(corpus, min_lines: int, min_words: int) -> dict:
    """By row: what `repeated_lines` adds, from all runs of lines."""
    docs = {}
    for i, t, *_ in corpus:
        docs.setdefault((i is None, i or 0, t is None, t or ""), (t or "").split("\n"))
    order = sorted(docs)
    seq = {d: [(k, x) for k, x in enumerate(docs[d]) if WORD.search(x)] for d in order}
    first, starts = {}, defaultdict(list)
    for d in order:
        for p, (_, x) in enumerate(seq[d]):
            starts[x].append((d, p))
            for w in (1, min_lines):
                run = tuple(y for _, y in seq[d][p : p + w])
                if len(run) == w:
                    first.setdefault((w, run), (d, p))
    out = {}
    for d in order:
        s, gone, longest = seq[d], set(), 0
        for p, (_, x) in enumerate(s):
            run = tuple(y for _, y in s[p : p + min_lines])
            if len(run) == min_lines and first[(min_lines, run)] < (d, p):
                gone |= set(range(p, p + min_lines))
            if len(WORD.findall(x)) >= min_words and first[(1, (x,))] < (d, p):
                gone.add(p)
            for e, q in starts[x][:200]:
                if (e, q) != (d, p):
                    n = 0
                    while p + n < len(s) and q + n < len(seq[e]) and s[p + n][1] == seq[e][q + n][1]:
                        n += 1
                    longest = max(longest, n)
        cut = {s[p][0] for p in gone}
        kept = "\n".join(x for k, x in enumerate(docs[d]) if k not in cut)
        runs = sum(p - 1 not in gone for p in gone)
        out[d] = (len(docs[d]), len(gone), runs, longest, kept)
    return out


@pytest.mark.parametrize("min_lines", [2, 3])
def test_later_copies_of_line_runs_go(documents, corpus, min_lines):
    want = expected_lines(corpus, min_lines, 8)
    rows = repeated_lines(documents, min_lines, 8).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        key = (r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "")
        got = (r.n_lines, r.n_removed, r.n_runs, r.longest_run, r.kept_text)
        assert got == want[key], r.doc_id


def test_lines_have_places_in_the_order_of_documents(spark, text_of):
    """One integer orders all lines; no run goes on into the next document."""
    from mercato.llm.line_runs import line_rows
    from mercato.llm.scratch import Scratch

    rows = text_of((7, "a b\n\n" + "w " * 50), (None, "last"), (-2, "x\ny\nx"), (7, "a b\n\n" + "w " * 50), (3, None), (5, " "), (9, "a b"))
    lines = line_rows(rows, Scratch(spark, "places"), 50).orderBy("at").collect()
    ids = {r.k1: r.doc_id for r in rows.selectExpr("doc_id", "xxhash64(doc_id) k1").collect()}
    assert [(ids[r.k1], r.line, r.long) for r in lines] == [
        (-2, 0, False), (-2, 1, False), (-2, 2, False), (7, 0, False), (7, 2, True), (9, 0, False), (None, 0, False)
    ]
    for x, y in zip(lines, lines[1:]):
        assert (y.at - x.at == 1) == (x.k1 == y.k1)
