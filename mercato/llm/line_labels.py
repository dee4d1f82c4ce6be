"""Quality rules with line sequence labelling: a linear-chain conditional random field.

Each line of a text is described by binned shares and marked content or boilerplate
by Viterbi decoding; the share of words in content lines decides whether a text
stays, after plain base rules. Weights are trained by maximum likelihood on a bounded
sample of rated documents: lines of good ones count as content, of poor ones as
boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.shipping import map_arrow

MIN_WORDS = 50
REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
TRAINING_ROWS = 4_000
STEPS = 150
BINS = 8
# Training sequences longer than this are cut into several.
TRAINING_LINES = 64
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
LOUD = np.zeros(256, bool)
LOUD[[ord(c) for c in "!?"]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;\"'"]] = True
SEED = tb.U64(0x8CB92BA72F3D8DD7)
BASE_SCHEMA = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long")]


class Lines(NamedTuple):
    """Lines of the rows of a slice: `first` by row (one entry more), `words` of each
    line and its features, one bin for each."""

    first: np.ndarray
    words: np.ndarray
    bins: np.ndarray


FEATURES = 9


def _sums(mask: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[end] - total[begin]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By key: whether it is found twice, and whether it stood earlier."""
    order = np.argsort(keys, kind="stable")
    same = np.concatenate(([False], keys[order][1:] == keys[order][:-1]))
    earlier, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order] = same
    twice[order] = same | np.concatenate((same[1:], [False]))
    return twice, earlier


def measured(piece: tb.Slice) -> tuple[dict[str, np.ndarray], Lines]:
    """Base counts by row, and the lines."""
    data, offsets = piece.data, piece.offsets
    rows = len(piece)
    starts, ends, first_word = tb.words(piece)
    prefix = tb.prefix_hash(data)
    word_hash = tb.span_hash(prefix, starts, ends)
    word_row = np.repeat(np.arange(rows), np.diff(first_word))
    n_words = np.diff(first_word)

    triple = tb.shingles(word_hash, 3)
    whole = word_row[2:] == word_row[:-2] if len(word_row) > 2 else np.zeros(0, bool)
    keys = tb.mixed(triple[whole] + word_row[:-2][whole].astype(tb.U64) * SEED)
    twice, _ = _repeated(keys)
    marked = np.zeros(len(starts), bool)
    at = np.flatnonzero(whole)[twice]
    for k in range(3):
        marked[at + k] = True

    feeds = data == 10
    line_start = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(feeds) + 1]))
    # A feed at the end of a row starts a line there, which is empty.
    line_start = line_start[line_start <= len(data)]
    breaks = np.unique(np.concatenate([np.flatnonzero(feeds), offsets[1:]]))
    word_line = np.searchsorted(line_start, starts, "right") - 1
    has_word = np.bincount(word_line, minlength=len(line_start)) > 0
    begin = line_start[has_word]
    row = np.searchsorted(offsets, begin, "right") - 1
    # Empty rows begin where the next one does; the line belongs to the one with bytes.
    end = np.minimum(breaks[np.searchsorted(breaks, begin, "right")], offsets[1:][row])
    line_hash = tb.mixed(tb.span_hash(prefix, begin, end) + row.astype(tb.U64) * SEED)
    _, earlier = _repeated(line_hash)

    space = tb.SPACE[data]
    lead = (data & 0xC0) != 0x80
    base = {
        "n_words": n_words,
        "word_chars": _sums(lead & ~space, offsets[:-1], offsets[1:]),
        "n_symbols": _sums(SYMBOL[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": np.bincount(row[earlier], minlength=rows),
        "n_repeat_words": np.bincount(word_row[marked], minlength=rows),
    }
    words = np.bincount(word_line, minlength=len(line_start))[has_word]
    letters = _sums(tb.LETTER[data] & lead, begin, end)
    chars = np.maximum(_sums(~space & lead, begin, end), 1)
    first_in, last_in = np.searchsorted(starts, begin), np.searchsorted(starts, end)
    again = _sums(marked, first_in, last_in)
    share = lambda part, of: np.minimum(BINS - 1, np.sqrt(part / np.maximum(of, 1)) * BINS).astype(np.int64)
    final = data[ends[last_in - 1] - 1] if len(begin) else np.zeros(0, np.uint8)
    bins = np.stack(
        [
            np.minimum(BINS - 1, np.log2(words + 1)).astype(np.int64),
            np.minimum(BINS - 1, chars // np.maximum(words, 1) // 2),
            share(_sums(UPPER[data], begin, end), letters),
            share(_sums(SYMBOL[data], begin, end), chars),
            share(_sums(LOUD[data], begin, end), chars),
            share(_sums(DIGIT[data], begin, end), chars),
            share(again, words),
            STOP[final].astype(np.int64),
            earlier.astype(np.int64),
        ],
        axis=1,
    )
    return base, Lines(np.searchsorted(row, np.arange(rows + 1)), words, bins)


class ChainModel(NamedTuple):
    """Weights by feature, bin and label (0 boilerplate, 1 content), and of label pairs."""

    emission: np.ndarray
    transition: np.ndarray

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return self.emission[np.arange(FEATURES)[None, :], bins].sum(axis=1)


def viterbi(scores: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Most probable labels of all sequences, which begin at `first` (one entry more).
    Longer sequences come first, so each step works on a leading part."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    labels = np.zeros(len(scores), np.int64)
    if not len(scores):
        return labels
    back = np.zeros((len(scores), 2), np.int8)
    best = scores.copy()
    still = len(sizes)
    for t in range(1, int(sizes[0])):
        still = int(np.searchsorted(-sizes[:still], -t, "left"))
        at = begin[:still] + t
        paths = best[at - 1][:, :, None] + transition[None]
        back[at] = paths.argmax(axis=1)
        best[at] = paths.max(axis=1) + scores[at]
    last = begin + sizes - 1
    some = sizes > 0
    labels[last[some]] = best[last[some]].argmax(axis=1)
    still = int(some.sum())
    for t in range(int(sizes[0]) - 1, 0, -1):
        still = int(np.searchsorted(-sizes, -t, "left"))
        at = begin[:still] + t
        labels[at - 1] = back[at, labels[at]]
    return labels


def fit(sequences: list[tuple[int, np.ndarray]], steps: int = STEPS) -> ChainModel:
    """Maximum likelihood by forward-backward and adaptive gradient steps, from (label,
    bins by line). Without sequences of both labels all weights are 0."""
    model = ChainModel(np.zeros((FEATURES, BINS, 2)), np.zeros((2, 2)))
    pieces = [(y, b[k : k + TRAINING_LINES]) for y, b in sequences for k in range(0, len(b), TRAINING_LINES)]
    if len({y for y, _ in pieces}) < 2:
        return model
    pieces.sort(key=lambda p: -len(p[1]))
    y = np.array([p[0] for p in pieces])
    sizes = np.array([len(p[1]) for p in pieces])
    longest = int(sizes[0])
    bins = np.zeros((len(pieces), longest, FEATURES), np.int64)
    for i, (_, b) in enumerate(pieces):
        bins[i, : len(b)] = b
    real = np.arange(longest)[None, :] < sizes[:, None]
    # Both labels weigh the same, however many documents they have.
    weight = np.where(y == 1, 0.5 / (sizes * (y == 1)).sum(), 0.5 / (sizes * (y == 0)).sum())
    flat = (np.arange(FEATURES)[None, None, :] * BINS + bins)[real]
    line_weight = np.repeat(weight, sizes)
    truth = np.zeros((len(pieces), longest, 2))
    truth[np.arange(len(pieces)), :, y] = 1
    emission, transition = model
    squares, pair_squares = np.full(emission.shape, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(steps):
        s = emission[np.arange(FEATURES)[None, None, :], bins].sum(axis=2)
        forward, backward = np.zeros_like(s), np.zeros_like(s)
        forward[:, 0] = s[:, 0]
        for t in range(1, longest):
            m = forward[:, t - 1][:, :, None] + transition[None]
            forward[:, t] = np.where(real[:, t, None], np.logaddexp(m[:, 0], m[:, 1]) + s[:, t], forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            m = transition[None] + (s[:, t + 1] + backward[:, t + 1])[:, None, :]
            backward[:, t] = np.where(real[:, t + 1, None], np.logaddexp(m[:, :, 0], m[:, :, 1]), 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])[:, None, None]
        marginal = np.exp(forward + backward - total)
        gap = ((truth - marginal)[real] * line_weight[:, None])
        grad = np.stack(
            [np.bincount(flat.ravel(), np.repeat(gap[:, k], FEATURES), FEATURES * BINS) for k in (0, 1)], axis=1
        ).reshape(emission.shape)
        grad -= 1e-5 * emission
        pairs = np.zeros((2, 2))
        if longest > 1:
            joint = forward[:, :-1, :, None] + transition + (s + backward)[:, 1:, None, :] - total[..., None]
            both = (np.exp(joint) * (real[:, 1:] * weight[:, None])[..., None, None]).sum(axis=(0, 1))
            seen = np.zeros((2, 2))
            for k in (0, 1):
                seen[k, k] = ((sizes - 1) * weight)[y == k].sum()
            pairs = seen - both - 1e-4 * transition
        squares += grad**2
        pair_squares += pairs**2
        emission = emission + 0.3 * grad / np.sqrt(squares)
        transition = transition + 0.1 * pairs / np.sqrt(pair_squares)
    return ChainModel(emission, transition)


def training_sequences(rated: DataFrame, rows: int = TRAINING_ROWS) -> list[tuple[int, np.ndarray]]:
    """Line features of at most `rows` documents of `doc_id`, `text`, `label`, half of
    each label where there are enough, chosen by a hash of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tb.slices(batch.column(1)):
                _, lines = measured(piece)
                here = slice(piece.first, piece.first + len(piece))
                blobs = [lines.bins[a:b].astype(np.int8).tobytes() for a, b in zip(lines.first[:-1], lines.first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[here], pa.array(blobs, pa.binary())], ["label", "bins"])

    out = []
    hashed = rated.withColumn("_h", F.xxhash64("doc_id"))
    totals = {r["label"]: r["count"] for r in hashed.groupBy("label").count().collect()}
    for label, total in sorted(totals.items()):
        one = hashed.where(F.col("label") == label)
        if total > rows // 2:
            edge = int(rows * 0.55 / total * 2**64) - 2**63
            one = one.where(F.col("_h") <= F.lit(min(edge, 2**63 - 1))).limit(rows // 2)
        got = map_arrow(one.select("label", "text"), run, "label int, bins binary").toArrow()
        for blob in got["bins"]:
            b = np.frombuffer(blob.as_buffer(), np.int8).reshape(-1, FEATURES).astype(np.int64)
            if len(b):
                out.append((label, b))
    return out


def fit_on_labels(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> ChainModel:
    rated = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    return fit(training_sequences(documents.select("doc_id", "text").join(rated, "doc_id"), rows))


def judged(documents: DataFrame, model: ChainModel, content_share: float = CONTENT_SHARE) -> DataFrame:
    """`documents` with the base counts, `base_failed`, `content_share` (of words),
    `content_lines` (places among the lines with a word) and `kept`.

    A null text counts as empty; it has no word, so it fails the base rules. Repeated
    rows are judged alike. With untrained weights every line is boilerplate of equal
    score, so nothing is kept. An empty table gives an empty result; columns named
    like the new ones are replaced."""
    new = [n for n, _ in BASE_SCHEMA] + ["base_failed", "content_share", "content_lines", "kept"]
    docs = documents.drop(*new)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(list(docs.schema))
    for name, kind in BASE_SCHEMA:
        schema = schema.add(name, kind)
    schema = schema.add("base_failed", "boolean").add("content_share", "double")
    schema = schema.add("content_lines", T.ArrayType(T.IntegerType())).add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found: list[dict[str, np.ndarray]] = []
            shares, content = [], []
            for piece in tb.slices(batch.column(batch.schema.get_field_index("text"))):
                base, lines = measured(piece)
                labels = viterbi(m.scores(lines.bins), lines.first, m.transition)
                inside = _sums(labels * lines.words, lines.first[:-1], lines.first[1:])
                shares.append(inside / np.maximum(base["n_words"], 1))
                content += [np.flatnonzero(labels[a:b]) for a, b in zip(lines.first[:-1], lines.first[1:])]
                found.append(base)
            if not found:
                continue
            base = {n: np.concatenate([f[n] for f in found]) for n, _ in BASE_SCHEMA}
            share = np.concatenate(shares)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * base["n_words"])
            columns = [*batch.columns, *[pa.array(base[n], pa.int64()) for n, _ in BASE_SCHEMA]]
            columns += [pa.array(failed), pa.array(share), pa.array(content, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(~failed & (share >= content_share))], names=schema.names)

    return map_arrow(docs, run, schema)


@register("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = judged(documents.select("doc_id", "text"), fit_on_labels(documents, labels))
    return found.drop("text", "content_lines")
