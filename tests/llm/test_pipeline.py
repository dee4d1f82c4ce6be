from __future__ import annotations

import itertools
import re
from collections import Counter

import pytest

import corpus_pipeline
from mercato.llm import mixing, ordinal_quality, packing
from mercato.llm.queries import QUERIES, SQL


def test_every_operator_is_registered():
    import __spark_entry__

    names = [k for k in __spark_entry__.queries() if k.startswith("op")]
    assert {int(k[2:].split("_")[0]) for k in names} == set(range(1, 14))
    assert "pipeline" in QUERIES and set(SQL) <= set(QUERIES)


def test_stages_hand_on_documents(spark, data):
    docs = corpus_pipeline.table(spark, data, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Scratch(spark, "t").write(stage(spark, docs, data), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name != "mix":
            assert 0 < docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def _near(a, b):
    return 100 * len(a & b) >= 80 * len(a | b) if a and b else False


def _shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.lower()) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


@pytest.fixture(scope="module")
def planted(spark, some_text, tmp_path_factory):
    """Clean documents, some with exact and near copies, toxic ones, junk, a null."""
    rows, labels, number = [], [], itertools.count()

    def add(text, source="a", quality=None, toxic=0):
        i = next(number)
        rows.append((i, text, "en", source, len(text or "")))
        if quality is not None:
            labels.append((i, quality, toxic))
        return i

    sources = ["a", "b", None, "c"]
    for k in range(120):
        text = some_text(k, 90)
        words = text.split(" ")
        if k % 4 == 1:
            for at in (3, 30, 60):
                words[at] = "scoundrel"
            add(" ".join(words), sources[k % 3], 1 if k < 100 else None, 1)
            continue
        add(text, sources[k % 4], 1 if k < 100 else None)
        if k % 12 == 0:
            add(text.replace(" ", "  "), sources[(k + 1) % 4])
            add(text, sources[k % 4])
        if k % 12 == 2:
            words[40] = "changed"
            add(" ".join(words), sources[k % 4])
            words[70] = "again"
            add(" ".join(words), "b")
    add(some_text(900, 3_000), "c")
    add(None, "a")
    for k in range(30):
        add("buy now $$$ " * (3 + k), "b", 0 if k < 25 else None)
    folder = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, labels


def test_run_equals_each_stage_by_hand(spark, planted):
    import duckdb
    from tokenizers import Tokenizer

    folder, rows, labels = planted
    documents, rated = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    verdicts = ordinal_quality.graded(documents, rated).where("kept").select("doc_id").collect()
    good = {r[0] for r in verdicts}
    # Toxic documents and junk, without a rating too, are turned away, clean ones stay.
    toxic = [i for i, t, *_ in rows if t and "scoundrel" in t]
    junk = [i for i, t, *_ in rows if t and "$$$" in t]
    clean = [i for i, t, *_ in rows if t and i not in toxic and i not in junk]
    assert not good & set(junk) and len(good & set(toxic)) <= 0.1 * len(toxic)
    assert len(good & set(clean)) >= 0.95 * len(clean)

    first = {}
    for i, text, *_ in rows:
        if i in good:
            first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), i)
    kept = {i: t for i, t, *_ in rows if i in set(first.values())}
    sets, root = {i: _shingles(t or "") for i, t in kept.items()}, {i: i for i in kept}
    for a, b in itertools.combinations(sorted(kept), 2):
        if _near(sets[a], sets[b]):
            x, y = root[a], root[b]
            root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    stay = {i for i in kept if root[i] == i}
    assert len(stay) < len(kept) < len(good)

    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s, _ in rows if i in stay])
    mixed = connection.execute(f"SELECT doc_id, size, taken FROM ({mixing.OP9_SQL})").fetchall()
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    want = Counter()
    for i, size, taken in mixed:
        tokens = len(tokenizer.encode(kept[i] or "", add_special_tokens=False).ids) + 1
        for piece in range(-(-tokens // 2048)):
            want[(i, piece, min(2048, tokens - 2048 * piece))] += -(-taken // size) if size else 0
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in found) == +want
    fill = Counter()
    for r in found:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048


def test_stages_on_odd_tables(spark, planted, documents, no_documents):
    """No rows give no rows; nulls, ties, repeated rows and other columns pass through."""
    folder, _, _ = planted
    for table in (no_documents, documents):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, folder)
            assert after.columns == docs.columns, name
            docs = after
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert (packed.count() == 0) == (table is no_documents)
