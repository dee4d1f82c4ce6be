"""Suffix-array dedup of repeated passages by prefix-free parsing.

Rolling hashes of 16 bytes choose triggers: the smallest in each window of starts. A
phrase is the run of positions that share a trigger; equal strings of `span` bytes
have equal triggers at equal places, so a repeated string meets its copies at one
trigger. The parse is written as phrases with two hashes: of the bytes right of the
trigger that every string of the phrase contains, and of all bytes that its strings
contain. A phrase whose right side is unique has no repeated string; one whose whole
content is found twice has nothing else.

What is between, the edges of repeated regions, is put into corpus order: suffixes of
the distinct phrases (the dictionary) are ranked by prefix doubling, the strings that
follow the trigger (the parse) are sorted with their common prefix lengths, and
(phrase suffix, parse) orders all strings. Neighbours that share `span` bytes are
repeated."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow

SPAN = 200
TRIGGER_BYTES = 16
# Phrases that one task puts in order at once; a right side with more is spread.
ORDERED_AT_ONCE = 4_000
PARSE_SCHEMA = "k1 bigint, k2 bigint, lo array<int>, hi array<int>, at array<int>, h array<bigint>, c array<bigint>"
RUNS = "array<struct<lo:int,hi:int>>"


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows are known by hashes of id and text: equal rows have equal results."""
    return documents.select(
        "doc_id", "text", F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2")
    )


def window_width(span: int) -> int:
    """Starts of which one is a trigger; a power of two, so that a string keeps at
    least a third of its bytes to the right of its trigger."""
    return 1 << int(math.log2(span * 2 / 3))


def phrases(piece: tb.Slice, span: int) -> tuple[np.ndarray, ...]:
    """`first` (by row, one more), and by phrase `lo`, `hi`, `trigger` in the slice and the
    two hashes `h`, `c`."""
    n = len(piece.data)
    none = np.zeros(0, np.int64)
    width = window_width(span)
    if n < span:
        return np.zeros(len(piece) + 1, np.int64), none, none, none, none.astype(tb.U64), none.astype(tb.U64)
    prefix = tb.prefix_hash(piece.data)
    starts = np.arange(n - TRIGGER_BYTES + 1)
    hashes = tb.mixed((prefix[TRIGGER_BYTES:] - prefix[:-TRIGGER_BYTES]) * tb.inverses(n + 1)[starts])
    # The rightmost of equal hashes is the least.
    least = (hashes & tb.U64(0xFFFFFFFF00000000)) | (tb.U64(0xFFFFFFFF) - starts.astype(tb.U64))
    step = 1
    while step < width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    trigger = np.int64(0xFFFFFFFF) - (least & tb.U64(0xFFFFFFFF)).astype(np.int64)
    # Starts whose string lies within its row.
    open_ = np.zeros(n + 1, np.int64)
    begin, end = piece.offsets[:-1], piece.offsets[1:]
    long_enough = end - begin >= span
    open_[begin[long_enough]] += 1
    open_[end[long_enough] - span + 1] -= 1
    inside = np.cumsum(open_[:n]).astype(bool)[: len(trigger)]
    new = inside.copy()
    same = (trigger[1:] == trigger[:-1]) & inside[:-1]
    new[1:] &= ~same
    edge = begin[long_enough]
    new[edge] = True
    lo = np.flatnonzero(new)
    last = inside.copy()
    last[:-1] &= ~(inside[1:] & ~new[1:])
    hi = np.flatnonzero(last)
    t = trigger[lo]
    h = tb.span_hash(prefix, t, t + span - width + 1)
    c = tb.mixed(tb.span_hash(prefix, lo, hi + span) + (t - lo).astype(tb.U64) * tb.SEQUENCE)
    return np.searchsorted(lo, piece.offsets), lo, hi, t, h, c


def parse(documents: DataFrame, span: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tb.slices(batch.column(2)):
                first, lo, hi, t, h, c = phrases(piece, span)
                base = np.repeat(piece.offsets[:-1], np.diff(first))
                ends = pa.array(first, pa.int32())
                listed = lambda x, kind: pa.ListArray.from_arrays(ends, pa.array(x, kind))
                here = slice(piece.first, piece.first + len(piece))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[here],
                        batch.column(1)[here],
                        listed(lo - base, pa.int32()),
                        listed(hi - base, pa.int32()),
                        listed(t - lo, pa.int32()),
                        listed(h.view(np.int64), pa.int64()),
                        listed(c.view(np.int64), pa.int64()),
                    ],
                    ["k1", "k2", "lo", "hi", "at", "h", "c"],
                )

    return map_arrow(_keyed(documents).select("k1", "k2", "text"), run, PARSE_SCHEMA)


def suffix_ranks(phrases_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes of the phrases in byte order, equal ones alike, by prefix
    doubling; and where each phrase begins (one entry more)."""
    sizes = np.array([len(p) for p in phrases_], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    rank = np.frombuffer(b"".join(phrases_), np.uint8).astype(np.int64) + 1
    left = np.repeat(begin[1:], sizes) - np.arange(len(rank))
    step = 1
    while len(sizes) and step < sizes.max():
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:]
        after[left <= step] = 0
        key = rank * (len(rank) + 258) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = 1 + np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        step *= 2
    return rank, begin


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Shared leading bytes of each row of a byte matrix and the one before."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])))


def _range_minimum(values: np.ndarray):
    tables = [values]
    while (1 << len(tables)) <= len(values):
        x, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(x[:-half], x[half:]))
    padded = np.stack([np.concatenate([t, np.zeros(len(values) - len(t), values.dtype)]) for t in tables])

    def ask(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of values[a..b], for a <= b."""
        level = np.log2(b - a + 1).astype(np.int64)
        return np.minimum(padded[level, a], padded[level, b - (1 << level) + 1])

    return ask


def repeated_starts(contents: list[bytes], at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For phrases given by all bytes their strings contain and by the place of the
    trigger: phrase number, start, and whether the string there stands twice among
    them. All strings of the phrases are put in corpus order for that."""
    at = np.asarray(at, np.int64)
    starts = np.array([len(c) - span + 1 for c in contents], np.int64)
    lefts = [c[:a] for c, a in zip(contents, at)]
    dictionary, phrase = np.unique(np.array(lefts, object), return_inverse=True)
    rank, begin = suffix_ranks(list(dictionary))
    follows = np.zeros((len(contents), span), np.uint8)
    for i, (c, a) in enumerate(zip(contents, at)):
        row = np.frombuffer(c, np.uint8)[a:][:span]
        follows[i, : len(row)] = row
    order = np.lexsort(follows.T[::-1]) if len(contents) < 64 else np.argsort(follows.view(f"V{span}").ravel(), kind="stable")
    parse_rank = np.empty(len(contents), np.int64)
    parse_rank[order] = np.arange(len(contents))
    least = _range_minimum(common_prefixes(follows[order]))
    number = np.repeat(np.arange(len(contents)), starts)
    start = np.arange(len(number)) - np.repeat(np.cumsum(starts) - starts, starts)
    length = at[number] - start
    suffix = np.zeros(len(number), np.int64)
    some = length > 0
    suffix[some] = rank[begin[phrase[number[some]]] + start[some]]
    corpus = np.lexsort((parse_rank[number], suffix))
    here = parse_rank[number[corpus]]
    alike = suffix[corpus][1:] == suffix[corpus][:-1]
    shared = np.zeros(len(corpus), bool)
    if len(corpus) > 1:
        k = np.flatnonzero(alike)
        common = least(here[k] + 1, here[k + 1])
        equal = common >= span - length[corpus][k + 1]
        shared[k[equal]] = True
        shared[k[equal] + 1] = True
    twice = np.zeros(len(number), bool)
    twice[corpus] = shared
    return number, start, twice


def _runs(mask: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[list[dict]]:
    starts, ends = tb.runs(mask, np.concatenate([begin, [len(mask)]]))
    first = np.searchsorted(starts, begin)
    last = np.searchsorted(starts, end)
    return [[{"lo": int(x - b), "hi": int(y - 1 - b)} for x, y in zip(starts[f:l], ends[f:l])] for f, l, b in zip(first, last, begin)]


EDGE_SCHEMA = f"k1 bigint, k2 bigint, lo int, n bigint, h bigint, spread boolean, runs {RUNS}, strings array<bigint>, places array<int>"


def _ordered_edges(edges: DataFrame, span: int) -> DataFrame:
    """Runs of repeated starts among the phrases that share a part (`h`, `salt`). Of a
    spread right side also the hashes of the distinct strings, and, where one is found
    once in this part, its place."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        contents = t.column("content").to_pylist()
        number, start, twice = repeated_starts(contents, t.column("at").to_numpy(), span)
        sizes = np.bincount(number, minlength=len(contents))
        end = np.cumsum(sizes)
        begin = end - sizes
        runs = _runs(twice, begin, end)
        strings, places = [[] for _ in contents], [[] for _ in contents]
        spread = t.column("spread").to_pylist()
        if any(spread):
            data = np.frombuffer(b"".join(contents), np.uint8)
            base = np.concatenate(([0], np.cumsum([len(c) for c in contents])))[:-1]
            prefix = tb.prefix_hash(data)
            first = base[number] + start
            hashes = tb.span_hash(prefix, first, first + span)
            _, one = np.unique(hashes, return_index=True)
            for i in one.tolist():
                k = int(number[i])
                if spread[k]:
                    strings[k].append(int(hashes[i].view(np.int64)))
                    places[k].append(-1 if twice[i] else int(start[i]))
        columns = [t.column(c).combine_chunks() for c in ("k1", "k2", "lo", "n", "h", "spread")]
        columns += [
            pa.array(runs, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
            pa.array(strings, pa.list_(pa.int64())),
            pa.array(places, pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "lo", "n", "h", "spread", "runs", "strings", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, key = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            change = np.concatenate(([False], (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])))
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            from_ = 0
            for a, b in zip(cuts[:-1], cuts[1:]):
                this = (int(h[a]), int(salt[a]))
                if this != key and rows + (a - from_) >= ORDERED_AT_ONCE:
                    held.append(batch.slice(from_, a - from_))
                    yield solve([x for x in held if x.num_rows])
                    held, rows, from_ = [], 0, a
                key = this
            held.append(batch.slice(from_))
            rows += batch.num_rows - from_
        if rows:
            yield solve([x for x in held if x.num_rows])

    salted = edges.withColumn("spread", F.col("parts") > 1).withColumn(
        "salt", F.pmod(F.xxhash64("k1", "k2", "lo"), F.col("parts"))
    )
    ordered = salted.select("h", "salt", "k1", "k2", "lo", "n", "at", "content", "spread")
    ordered = ordered.repartition("h", "salt").sortWithinPartitions("h", "salt")
    return map_arrow(ordered, run, EDGE_SCHEMA)


def _contents(edges: DataFrame, documents: DataFrame, span: int) -> DataFrame:
    """`edges` with the bytes of their phrases."""
    wanted = edges.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "at", "h", "n", "parts")).alias("phrases"))
    texts = _keyed(documents).select("k1", "k2", F.col("text").cast("binary").alias("bytes"))
    found = texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "bytes", F.explode("phrases").alias("p"))
    content = F.substring(F.col("bytes"), F.col("p.lo") + 1, F.col("p.hi") - F.col("p.lo") + span)
    return found.select("k1", "k2", "p.lo", "p.hi", "p.at", "p.h", "p.n", "p.parts", content.alias("content"))


def repeated_runs(documents: DataFrame, scratch: Scratch, span: int = SPAN, at_once: int = ORDERED_AT_ONCE) -> DataFrame:
    """`k1`, `k2`, `runs` of repeated starts, for rows that have any."""
    parsed = scratch.write(parse(documents, span), "parse")
    right = parsed.select(F.explode("h").alias("h")).groupBy("h").count().where("count > 1").select("h")
    right = scratch.write(right, "right")
    scratch.release()
    each = parsed.select("k1", "k2", F.explode(F.arrays_zip("lo", "hi", "at", "h", "c")).alias("p")).select("k1", "k2", "p.*")
    found = scratch.write(each.join(right, "h"), "found")
    scratch.drop(parsed, right)
    scratch.release()
    whole = found.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "lo", "hi", "at")).alias("p")
    )
    whole = scratch.write(whole.select("h", "c", "n", "p.*"), "whole")
    several = whole.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") / at_once).cast("int")
    edges = whole.join(several, "h").withColumn("parts", parts).drop("m", "c")
    contents = scratch.write(_contents(edges, documents, span), "contents")
    scratch.release()
    solved = scratch.write(_ordered_edges(contents, span), "solved")
    scratch.drop(contents)
    once = solved.where("n = 1")
    runs = once.where(F.size("runs") > 0).select("k1", "k2", "lo", F.explode("runs").alias("r"))
    parted = [runs.select("k1", "k2", (F.col("lo") + F.col("r.lo")).alias("lo"), (F.col("lo") + F.col("r.hi")).alias("hi"))]
    # Strings of spread right sides: those that stand in several parts.
    strings = solved.where("spread").select(
        "k1", "k2", "lo", "n", F.explode(F.arrays_zip("strings", "places")).alias("s")
    )
    across = strings.groupBy("s.strings").count().where("count > 1").select(F.col("strings").alias("string"))
    strings = strings.where("n = 1 and s.places >= 0").withColumn("string", F.col("s.strings"))
    start = (F.col("lo") + F.col("s.places")).alias("lo")
    parted.append(strings.join(across, "string").select("k1", "k2", start, start.alias("hi")))
    twice = found.join(whole.where("n > 1").select("h", "c"), ["h", "c"]).select("k1", "k2", "lo", "hi")
    every = twice.unionAll(parted[0]).unionAll(parted[1])
    return scratch.write(
        every.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")), "runs"
    )


def without_repeats(documents: DataFrame, span: int = SPAN, with_text: bool = False, at_once: int = ORDERED_AT_ONCE) -> DataFrame:
    """One row for each row of `documents`: `doc_id`, `n_bytes`, `n_removed`, `n_spans`,
    `kept_sha256`, and with `with_text` also `kept` (binary: a cut may fall inside a
    character) and `spans` (start and end of what was removed).

    A byte goes if a string of `span` bytes that covers it also starts anywhere else,
    in this text or another; strings are judged on the input. Null counts as empty;
    a text shorter than `span` is left as it is. A row repeated with its doc_id and
    text is another document, so its text goes whole. An empty table gives an empty
    result; other columns are not read."""
    scratch = Scratch(documents.sparkSession, "repeats")
    runs = repeated_runs(documents, scratch, span, at_once)
    scratch.release()
    joined = _keyed(documents).join(runs, ["k1", "k2"], "left").select("doc_id", "text", "runs")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += ", kept binary, spans array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for piece in tb.slices(batch.column(1)):
                out = []
                for k in range(len(piece)):
                    data = piece.data[piece.offsets[k] : piece.offsets[k + 1]]
                    found = lists[piece.first + k]
                    cover = np.zeros(len(data) + 1, np.int64)
                    if found.is_valid:
                        lo, hi = (found.values.field(x).to_numpy() for x in ("lo", "hi"))
                        np.add.at(cover, lo, 1)
                        np.add.at(cover, hi + span, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    starts, ends = tb.runs(gone, np.array([0, len(data)]))
                    kept = data[~gone].tobytes()
                    row = (len(data), int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest())
                    if with_text:
                        row += (kept, [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)])
                    out.append(row)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    kinds += [pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
                    names += ["kept", "spans"]
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[piece.first : piece.first + len(piece)], *columns], names)

    return map_arrow(joined, run, schema)


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"))
