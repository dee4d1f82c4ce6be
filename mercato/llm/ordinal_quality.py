"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight for each hashed feature is shared by all grades; ordered thresholds cut
the score s into P(grade <= j) = logistic(threshold_j - s). The expected grade and
the tail probability of the highest grade follow from them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.shipping import map_arrow

# Bounded sample of rated rows that the model is fitted on.
TRAINING_ROWS = 6_000
FEATURE_BITS = 18
MIN_DOCUMENTS = 5
# Features whose share differs less between grades, in standard errors, are left out; 0: none.
MIN_DEVIATIONS = 0.0
# Weight of the sum of absolute weights against the summed loss of all examples.
PENALTY = 1.0
EPOCHS = 60
# Few examples are gone through more often, until there are so many steps.
MIN_STEPS = 1_200
BATCH = 128
TAIL_PROBABILITY = 0.75
SHAPE_BINS = 16
# Lengths in bytes of the word beginnings that are features besides whole words.
STEMS = (4, 5, 6)
SYMBOL = np.zeros(256, bool)
SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"-"]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True


class OrdinalModel(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for each score and threshold."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def _share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.minimum(SHAPE_BINS - 1, np.sqrt(part / np.maximum(whole, 1)) * SHAPE_BINS).astype(np.int64)


def row_features(piece: tb.Slice, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row number and feature of every distinct (row, feature), sorted by row. Features
    are hashes of lower-cased letter runs and of their beginnings, and binned shares of capitals, symbols,
    repeated words and letters in the whole text."""
    rows = len(piece)
    data, offsets = piece.data, piece.offsets
    size = 1 << bits
    starts, ends = tb.runs(tb.LETTER[data], offsets)
    prefix = tb.prefix_hash(tb.LOWER[data])
    row = np.searchsorted(offsets, starts, "right") - 1
    keyed = lambda r, h: tb.unique(r * size + (h >> tb.U64(64 - bits)).astype(np.int64))
    keys = [keyed(row, tb.span_hash(prefix, starts, ends))]
    found = np.bincount(keys[0] // size, minlength=rows)
    for n in STEMS:
        longer = ends - starts > n
        hashes = tb.span_hash(prefix, starts[longer], starts[longer] + n)
        keys.append(keyed(row[longer], hashes * tb.SEQUENCE))
    count = np.bincount(row, minlength=rows)

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    length = np.diff(offsets)
    letters = per_row(tb.LETTER[data])
    shape = [
        _share_bin(per_row(UPPER[data]), letters),
        _share_bin(per_row(SYMBOL[data]), length),
        _share_bin(count - found, count),
        _share_bin(letters, length),
    ]
    every = np.arange(rows)
    extra = [every * size + size - 1 - (k * SHAPE_BINS + s) for k, s in enumerate(shape)]
    keys = tb.unique(np.concatenate([*keys, *extra]))
    return keys // size, keys % size


def fit(examples: list[tuple[int, np.ndarray]], grades: int, bits: int = FEATURE_BITS, epochs: int = EPOCHS) -> OrdinalModel:
    """Adaptive gradient steps on minibatches with an L1 penalty. All features of at least
    MIN_DOCUMENTS take part; the penalty leaves those at 0 that explain too little. It
    stands against the summed loss, so it gives way as examples are added. Without examples, or with one grade only, the thresholds
    follow the grades seen and all weights are 0."""
    size = 1 << bits
    y = np.array([g for g, _ in examples], np.int64)
    seen = np.array([np.sum(y <= j) for j in range(grades - 1)], float)
    share = (seen + 0.5) / (len(y) + 1.0)
    thresholds = np.log(share / (1 - share))
    full = np.zeros(size, np.float32)
    if len(np.unique(y)) < 2:
        return OrdinalModel(full, thresholds)
    frequency = np.bincount(np.concatenate([f for _, f in examples]), minlength=size)
    sizes = [len(f) for _, f in examples]
    every = np.concatenate([f for _, f in examples])
    strength = np.zeros(size)
    for j in range(grades - 1):
        # How far the share of documents with a feature differs above and below a cut.
        above = np.bincount(every, np.repeat(y > j, sizes).astype(float), size)
        n1, n0, p = max(1, np.sum(y > j)), max(1, np.sum(y <= j)), frequency / len(y)
        spread = np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
        gap = np.abs(above / n1 - (frequency - above) / n0)
        strength = np.maximum(strength, gap / np.maximum(spread, 1e-9))
    useful = np.flatnonzero((frequency >= MIN_DOCUMENTS) & (strength >= MIN_DEVIATIONS))
    place = np.full(size, -1)
    place[useful] = np.arange(len(useful))
    parts = [place[f][place[f] >= 0] for _, f in examples]
    lengths = np.array([len(p) for p in parts])
    flat = np.concatenate(parts)
    begin = np.concatenate(([0], np.cumsum(lengths)))
    weights = np.zeros(len(useful))
    squares, threshold_squares = np.full(len(useful), 1e-3), np.full(grades - 1, 1e-3)
    order_of = np.random.default_rng(7)
    for _ in range(max(epochs, -(-MIN_STEPS // -(-len(y) // BATCH)))):
        order = order_of.permutation(len(y))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rows = np.repeat(np.arange(len(batch)), lengths[batch])
            cols = np.concatenate([flat[begin[i] : begin[i + 1]] for i in batch])
            score = np.bincount(rows, weights[cols], len(batch))
            below = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - score[:, None], -30, 30)))
            below = np.hstack([np.zeros((len(batch), 1)), below, np.ones((len(batch), 1))])
            here = np.arange(len(batch))
            low, high = below[here, y[batch]], below[here, y[batch] + 1]
            slope_low, slope_high = low * (1 - low), high * (1 - high)
            p = np.maximum(high - low, 1e-9)
            by_score = (slope_high - slope_low) / p / len(batch)
            grad = np.bincount(cols, by_score[rows], len(useful))
            squares += grad**2
            pace = 0.15 / np.sqrt(squares)
            weights -= pace * grad
            weights = np.sign(weights) * np.maximum(np.abs(weights) - pace * PENALTY / len(y), 0)
            by_threshold = np.zeros(grades + 1)
            np.add.at(by_threshold, y[batch] + 1, -slope_high / p / len(batch))
            np.add.at(by_threshold, y[batch], slope_low / p / len(batch))
            step = by_threshold[1:-1]
            threshold_squares += step**2
            thresholds = np.sort(thresholds - 0.15 * step / np.sqrt(threshold_squares))
    full[useful] = weights
    return OrdinalModel(full, thresholds)


def training_examples(rated: DataFrame, rows: int = TRAINING_ROWS) -> list[tuple[int, np.ndarray]]:
    """Features of at most `rows` rows of `doc_id`, `text`, `grade`, chosen by a hash
    of the id. They are bounded by `rows`, and come to the driver as feature numbers."""
    chosen = (
        rated.where(F.col("grade").isNotNull())
        .select("doc_id", "text", F.col("grade").cast("int").alias("grade"))
        .withColumn("_h", F.xxhash64("doc_id"))
    )
    total = chosen.count()
    if total > rows:
        # Hashes are even, so this threshold leaves about that many; the limit is exact.
        edge = int((rows * 1.1 / total) * 2**64) - 2**63
        chosen = chosen.where(F.col("_h") <= F.lit(min(edge, 2**63 - 1))).limit(rows)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grade = batch.column(batch.schema.get_field_index("grade")).to_numpy(zero_copy_only=False)
            for piece in tb.slices(batch.column(batch.schema.get_field_index("text"))):
                row, feature = row_features(piece)
                cuts = np.searchsorted(row, np.arange(len(piece) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grade[piece.first : piece.first + len(piece)], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(feature, pa.int32())),
                    ],
                    ["grade", "features"],
                )

    got = map_arrow(chosen.select("text", "grade"), featured, "grade int, features array<int>").toArrow()
    lists = got["features"].combine_chunks()
    flat, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [(g, flat[a:b]) for g, a, b in zip(got["grade"].to_pylist(), cuts[:-1], cuts[1:])]


def scored(documents: DataFrame, model: OrdinalModel, tail: float = TAIL_PROBABILITY) -> DataFrame:
    """`documents` with `expected_grade`, `tail_probability` and `kept`. The model
    goes to the executors as one array of 2^FEATURE_BITS weights."""
    own = [c for c in documents.columns if c not in ("expected_grade", "tail_probability", "kept")]
    docs = documents.select(*own)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = (
        T.StructType(list(docs.schema))
        .add("expected_grade", "double")
        .add("tail_probability", "double")
        .add("kept", "boolean")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for piece in tb.slices(batch.column(batch.schema.get_field_index("text"))):
                row, feature = row_features(piece)
                score[piece.first : piece.first + len(piece)] = np.bincount(row, m.weights[feature], len(piece))
            tails = m.tails(score)
            columns = [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= tail)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs, run, schema)


def grade(labels: DataFrame) -> Column:
    """0 poor, 1 toxic, 2 good."""
    return (
        F.when(labels["quality"].isNull(), F.lit(None))
        .when(labels["quality"] == 0, 0)
        .when(labels["toxic"] == 1, 1)
        .otherwise(2)
    )


def fit_on_labels(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> OrdinalModel:
    rated = labels.select("doc_id", grade(labels).alias("grade")).where(F.col("grade").isNotNull())
    one = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    return fit(training_examples(documents.select("doc_id", "text").join(one, "doc_id"), rows), 3)


def graded(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, tail: float = TAIL_PROBABILITY) -> DataFrame:
    """`documents` with `expected_grade` (0 to 2), `tail_probability` (of grade 2) and
    `kept` (tail probability at least `tail`).

    The model is fitted on at most `rows` of the rated documents; rows without a
    rating, or rated without a document, do not count, and a document rated twice
    has the lower grade. A null text counts as empty and is scored by its shape.
    Repeated rows get equal scores. Without any rating all scores are 0 and the
    tail probability is one half. An empty table gives an empty result; columns named
    like the new ones are replaced."""
    return scored(documents, fit_on_labels(documents, labels, rows), tail)


@register("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return graded(documents.select("doc_id", "text"), labels).drop("text")
