"""Ranked lexical search: accumulator-limited evaluation, one term at a time.

Documents are turned once into postings of the terms asked for. Then each batch of them
is searched for all items. The terms of an item are taken rarest first. A document
gets an accumulator when a term first meets it; once the terms still to come cannot
lift a new document to the best k so far, no more are created, and those that exist are
brought to their exact score. The best of a task go on to the next batch as the
score to beat, and only they leave the task."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow

TOP = 10
# Hundredths of the length normalisation.
LENGTH_SHARE = 75
# Items searched for in one pass, and bytes of their texts: what goes to the workers.
ITEMS_AT_ONCE = 2_000
BYTES_AT_ONCE = 4 << 20

# Bytes of a term: ASCII digits and letters and all beyond ASCII.
TERM = np.zeros(256, bool)
TERM[ord("0") : ord("9") + 1] = TERM[ord("A") : ord("Z") + 1] = TERM[ord("a") : ord("z") + 1] = True
TERM[128:] = True


class Terms(NamedTuple):
    """Distinct terms, sorted by hash: their bytes one after the other, and the most
    terms that share a hash."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    data: np.ndarray
    alike: int


class Item(NamedTuple):
    """The distinct terms of an item, rarest first, and weight times occurrences."""

    terms: np.ndarray
    weights: np.ndarray


def _term_spans(piece: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of all terms, by row the first one."""
    starts, ends = tb.runs(TERM[piece.data], piece.offsets)
    return tb.LOWER[piece.data], starts, ends, np.searchsorted(starts, piece.offsets)


def asked_terms(texts: pa.Array) -> tuple[Terms, list[np.ndarray]]:
    """All distinct terms of the items, and the terms of each item with repeats."""
    number: dict[bytes, int] = {}
    items = []
    for piece in tb.slices(texts):
        data, starts, ends, first = _term_spans(piece)
        raw = data.tobytes()
        found = [number.setdefault(raw[a:b], len(number)) for a, b in zip(starts.tolist(), ends.tolist())]
        items += [np.array(found[a:b], np.int64) for a, b in zip(first[:-1], first[1:])]
    words = list(number)
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(words), np.uint8)
    hashes = tb.span_hash(tb.prefix_hash(data), starts, starts + lengths)
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    alike = int(np.unique(hashes, return_counts=True)[1].max()) if len(hashes) else 0
    return Terms(hashes[order], starts[order], lengths[order], data, alike), [place[i] for i in items]


def _numbers(terms: Terms, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of each span among `terms`, -1 if it is none. Equal hashes only
    make a term possible; its bytes are compared."""
    out = np.full(len(starts), -1, np.int64)
    if not len(terms.hashes) or not len(starts):
        return out
    hashes = tb.span_hash(tb.prefix_hash(data), starts, ends)
    at = np.searchsorted(terms.hashes, hashes)
    for further in range(terms.alike):
        k = np.minimum(at + further, len(terms.hashes) - 1)
        maybe = np.flatnonzero((terms.hashes[k] == hashes) & (terms.lengths[k] == ends - starts) & (out < 0))
        k, length = k[maybe], terms.lengths[k[maybe]]
        begin = np.cumsum(length) - length
        inner = np.arange(int(length.sum())) - np.repeat(begin, length)
        same = data[np.repeat(starts[maybe], length) + inner] == terms.data[np.repeat(terms.starts[k], length) + inner]
        equal = np.logical_and.reduceat(same, begin) if len(begin) else np.zeros(0, bool)
        out[maybe[equal]] = k[equal]
    return out


def postings(documents: DataFrame, terms: Terms) -> DataFrame:
    """`doc_id`, `n` (terms with repeats) and, of the terms asked for, `terms` and `times`
    (little-endian 32-bit) of each document that has a term at all."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            for piece in tb.slices(batch.column(1)):
                data, starts, ends, first = _term_spans(piece)
                n = np.diff(first)
                number = _numbers(asked, data, starts, ends)
                row = np.repeat(np.arange(len(piece)), n)
                known = number >= 0
                key, times = np.unique(row[known] * max(1, len(asked.hashes)) + number[known], return_counts=True)
                row, number = key // max(1, len(asked.hashes)), key % max(1, len(asked.hashes))
                cuts = np.searchsorted(row, np.arange(len(piece) + 1))
                raw = [x.astype("<u4").tobytes() for x in (number, times)]
                some = np.flatnonzero(n)
                columns = [batch.column(0).take(pa.array(piece.first + some)), pa.array(n[some])]
                columns += [pa.array([x[4 * a : 4 * b] for a, b in zip(cuts[some], cuts[some + 1])], pa.binary()) for x in raw]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    return map_arrow(documents.select("doc_id", "text"), run, f"doc_id {id_type}, n bigint, terms binary, times binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of packed rows, and how many each row has."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int64)
    return flat, np.array([len(x.as_buffer()) // 4 for x in column], np.int64)


def frequencies(indexed: DataFrame, terms: int) -> np.ndarray:
    """Number of documents with each term. A task sends a row for each term; one row
    for each term asked for comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    got = map_arrow(indexed.select("terms"), run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(terms, np.int64)
    out[got["term"].to_numpy()] = got["df"].to_numpy()
    return out


def _planned(found: np.ndarray, df: np.ndarray, documents: int) -> Item:
    """Terms of an item that some document has, rarest first."""
    terms, times = np.unique(found, return_counts=True)
    times, terms = times[df[terms] > 0], terms[df[terms] > 0]
    order = np.lexsort((terms, df[terms]))
    terms, times = terms[order], times[order]
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df[terms]]
    return Item(terms, np.array(weight, np.int64) * times)


def best_in_batch(item: Item, cuts: np.ndarray, row: np.ndarray, impact: np.ndarray, most: np.ndarray, score: np.ndarray, k: int, floor: int) -> np.ndarray:
    """Rows that reach at least `floor` and can be among the best `k`; their exact
    scores are left in `score`, which comes and must be left as zeros elsewhere.
    `cuts` are where each term's postings (`row`, `impact`) begin, `most` its greatest
    impact."""
    bounds = item.weights * most[item.terms]
    # rest[t]: what a document without an accumulator can still get from term t on.
    rest = np.concatenate((np.cumsum(bounds[::-1])[::-1], [0]))
    seen = np.zeros(len(score), bool)
    creating = True
    for t, (term, weight) in enumerate(zip(item.terms.tolist(), item.weights.tolist())):
        rows, gain = row[cuts[term] : cuts[term + 1]], impact[cuts[term] : cuts[term + 1]]
        # A partial score is at most the sum of the bounds so far.
        if creating and rest[t] < max(floor, rest[0] - rest[t]):
            held = np.flatnonzero(seen)
            reach = floor
            if len(held) >= k:
                reach = max(floor, int(np.partition(score[held], len(held) - k)[len(held) - k]))
            creating = bool(rest[t] >= reach)
        if not creating:
            mine = seen[rows]
            rows, gain = rows[mine], gain[mine]
        else:
            seen[rows] = True
        score[rows] += weight * gain
    held = np.flatnonzero(seen)
    good = held[score[held] >= floor]
    if len(good) > k:
        reach = np.partition(score[good], len(good) - k)[len(good) - k]
        good = good[score[good] >= reach]
    drop = np.ones(len(held), bool)
    drop[np.searchsorted(held, good)] = False
    score[held[drop]] = 0
    return good


def _searched(indexed: DataFrame, plan: list[Item], item_ids: pa.Array, id_type: str, documents: int, all_terms: int, terms: int, k: int) -> DataFrame:
    """`item`, `item_id`, `doc_id`, `score`: the best k of each task for each item."""
    shared = indexed.sparkSession.sparkContext.broadcast((plan, item_ids))
    doc_type = indexed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ids = shared.value
        # Of each item the best so far, ordered: (-score, id is null, id).
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_ids, n = batch.column(0), batch.column(1).to_numpy()
            term, each = _flat(batch.column(2))
            times, _ = _flat(batch.column(3))
            row = np.repeat(np.arange(batch.num_rows), each)
            m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // all_terms
            order = np.argsort(term, kind="stable")
            term, row, times = term[order], row[order], times[order]
            impact = 1_000_000_000 * times // (1000 * times + 8 * m[row])
            cuts = np.searchsorted(term, np.arange(terms + 1))
            most = np.zeros(terms, np.int64)
            some = np.flatnonzero(np.diff(cuts))
            if len(some):
                most[some] = np.maximum.reduceat(impact, cuts[:-1][some])
            score = np.zeros(batch.num_rows, np.int64)
            for q, item in enumerate(items):
                floor = -best[q][-1][0] if len(best[q]) == k else 1
                good = best_in_batch(item, cuts, row, impact, most, score, k, floor)
                if len(good):
                    got = doc_ids.take(pa.array(good)).to_pylist()
                    rows = [(-s, d is None, 0 if d is None else d) for s, d in zip(score[good].tolist(), got)]
                    best[q] = sorted(best[q] + rows)[:k]
                    score[good] = 0
        rows = [(q, *x) for q, found in enumerate(best) for x in found]
        names = ["item", "item_id", "doc_id", "score"]
        numbers = pa.array([r[0] for r in rows], pa.int64())
        kind = target_type
        columns = [numbers, ids.take(numbers), pa.array([None if r[2] else r[3] for r in rows], kind), pa.array([-r[1] for r in rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    from pyspark.sql.pandas.types import to_arrow_type

    target_type = to_arrow_type(indexed.schema["doc_id"].dataType)
    return map_arrow(indexed, run, f"item bigint, item_id {id_type}, doc_id {doc_type}, score bigint")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = TOP, items_at_once: int = ITEMS_AT_ONCE, bytes_at_once: int = BYTES_AT_ONCE) -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id`, `score`: for each row of `items` (`item_id`,
    `text`) the `k` rows of `documents` (`doc_id`, `text`) with the highest scores above 0,
    equal scores by ascending doc_id, rows without one last.

    The score adds up, over the item's terms with repeats, a weight that falls with the
    documents holding the term, times a share that rises with its occurrences in the
    document and falls with the document's length; all whole numbers but the logarithm.
    A null or empty text, and one without terms, is found by nothing and finds
    nothing. Repeated documents are ranked each for itself, and repeated items or
    item_ids have a result each. Whole texts are read, whatever their length. An empty
    table on either side gives an empty result; other columns are not read.

    Items are searched for in blocks of about `items_at_once` rows and `bytes_at_once`
    bytes of text, all documents for each block; a block, its terms and their counts
    are what comes to the driver and goes to the workers."""
    scratch = Scratch(documents.sparkSession, "search")
    asked = items.select("item_id", "text").withColumn("_uid", F.monotonically_increasing_id())
    asked = scratch.write(asked, "items")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    blocks = max(1, math.ceil(size["n"] / items_at_once), math.ceil(size["b"] / bytes_at_once))
    item_type = items.schema["item_id"].dataType.simpleString()
    found = None
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("_uid"), F.lit(blocks)) == number).select("item_id", "text").toArrow()
        terms, wanted = asked_terms(block["text"].combine_chunks())
        indexed = scratch.write(postings(documents, terms), f"postings{number}")
        totals = indexed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = frequencies(indexed, len(terms.hashes))
        plan = [_planned(i, df, totals["n"]) for i in wanted]
        ids = block["item_id"].combine_chunks()
        part = _searched(indexed, plan, ids, item_type, totals["n"], totals["terms"], len(terms.hashes), k)
        part = part.withColumn("block", F.lit(number))
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("item_id", "rank", "doc_id", "score")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
l AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l),
p AS (SELECT r, unnest(terms) AS term FROM d WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM p GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
qt AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM q) GROUP BY q, item_id, term),
w AS (SELECT q, item_id, qt.term, times,
    CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM qt JOIN df USING (term), g),
s AS (SELECT q, item_id, l.r, l.doc_id, CAST(sum(times * weight *
      ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM w JOIN tf USING (term) JOIN l USING (r), g GROUP BY q, item_id, l.r, l.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""


@register("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
