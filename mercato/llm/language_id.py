"""Language ID: interpolated Kneser-Ney character models, one for each language.

Texts are lower-cased; all that is no letter becomes one space. Counts of four
characters are summed over all training texts. Lower orders count the distinct
characters before them, as Kneser-Ney asks. A model is sorted arrays of n-gram codes
with log probabilities and back-off weights. The language with the lowest
cross-entropy per character wins; a score calibrated on training rows says how sure
that is, and a text below the accepted score can be turned away."""

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
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow
from mercato.operators.running import exact_quantiles

ORDER = 4
ACCEPTED_SHARE = 0.99
SHARPNESS = np.geomspace(0.5, 64, 29)
UNKNOWN = "und"
SLICE = 1 << 21
REMEMBERED_GRAMS = 1_500_000
U64 = np.uint64

_letter: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Which of the first 65,536 code points are letters."""
    global _letter
    if _letter is None:
        _letter = np.array([0 < c and chr(c).isalpha() for c in range(1 << 16)], bool)
    return _letter


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all four characters in a row of each text (spaces added around it),
    where each text's begin (one entry more), and its number of letters."""
    letter = letter_table()
    joined = "\n".join(texts).lower()
    # Lower-casing can lengthen a text, so lengths are taken afterwards.
    sizes = np.array([len(t.lower()) for t in texts], np.int64) + 1
    codes = np.frombuffer((joined + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    far = codes > 0xFFFF
    clipped = np.where(far, 0xFFFF, codes).astype(np.int64)
    is_letter = letter[clipped]
    if far.any():
        at = np.flatnonzero(far)
        is_letter[at] = [chr(c).isalpha() for c in codes[at]]
    symbols = np.where(is_letter, clipped, 0x20).astype(U64)
    ends = np.cumsum(sizes)
    count = np.concatenate(([0], np.cumsum(is_letter)))
    letters = count[ends] - count[ends - sizes]
    first = np.zeros(len(symbols), bool)
    first[ends - sizes] = True
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1] | first[1:]
    row = np.repeat(np.arange(len(texts)), sizes)[keep]
    symbols = symbols[keep]
    # What stands before a text counts as spaces.
    code = symbols.copy()
    begin = np.searchsorted(row, np.arange(len(texts) + 1))
    place = np.arange(len(symbols)) - begin[row]
    for back in range(1, ORDER):
        before = np.full(len(symbols), 0x20, U64)
        before[back:] = symbols[:-back]
        before[place < back] = 0x20
        code |= before << U64(16 * back)
    return code, begin, letters


class Table(NamedTuple):
    """Sorted codes with values."""

    codes: np.ndarray
    values: np.ndarray

    def of(self, codes: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), missing)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.values[at], missing)


def _suffix(codes: np.ndarray, n: int) -> np.ndarray:
    return codes & U64((1 << (16 * n)) - 1)


class KneserNey:
    """Of counted n-grams of one language: for each order the probabilities of seen
    n-grams and the weights with which contexts pass on to the order below."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order].astype(float)
        levels = [(codes, counts)]
        for n in range(ORDER - 1, 0, -1):
            short, found = np.unique(_suffix(levels[-1][0], n), return_counts=True)
            levels.append((short, found.astype(float)))
        self.levels: list[tuple[Table, Table]] = []  # from one character up
        self.unseen = 1.0 / (len(levels[-1][0]) + 1)
        lower = None
        for n, (grams_, found) in enumerate(reversed(levels), 1):
            once, twice = np.sum(found == 1), np.sum(found == 2)
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = grams_ >> U64(16)
            heads, at = np.unique(context, return_inverse=True)
            total = np.bincount(at, found)
            passed = discount * np.bincount(at) / total
            below = np.full(len(grams_), self.unseen) if lower is None else lower
            p = np.maximum(found - discount, 0) / total[at] + passed[at] * below
            self.levels.append((Table(grams_, p), Table(heads, passed)))
            if n < ORDER:
                longer = levels[ORDER - n - 1][0]
                lower = self._probability(_suffix(longer, n), n)

    def _probability(self, codes: np.ndarray, order: int) -> np.ndarray:
        p = np.full(len(codes), self.unseen)
        for n in range(1, order + 1):
            seen, heads = self.levels[n - 1]
            part = _suffix(codes, n)
            found = seen.of(part, -1.0)
            p = np.where(found >= 0, found, heads.of(part >> U64(16), 1.0) * p)
        return p

    def log(self, codes: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(self._probability(codes, ORDER), 1e-12))


class LanguageModel(NamedTuple):
    names: list[str]
    models: list[KneserNey]
    sharpness: float
    accepted: float


class Scorer:
    """Log probabilities by n-gram and language, each n-gram looked up once."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.codes, self.values = np.zeros(0, U64), np.zeros((0, len(models)))

    def entropies(self, code: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Cross-entropy per character, by text and language."""
        distinct = tb.unique(code)
        at = np.searchsorted(self.codes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == distinct[inside]
        new = distinct[~known]
        if len(new):
            if len(self.codes) > REMEMBERED_GRAMS:
                self.codes, self.values, new = np.zeros(0, U64), np.zeros((0, len(self.models))), distinct
            found = np.stack([m.log(new) for m in self.models], axis=1)
            codes = np.concatenate([self.codes, new])
            order = np.argsort(codes)
            self.codes, self.values = codes[order], np.concatenate([self.values, found])[order]
        logs = self.values[np.searchsorted(self.codes, code)]
        sums = np.add.reduceat(logs, begin[:-1], axis=0)
        return -sums / np.diff(begin)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def count_grams(training: DataFrame) -> DataFrame:
    """`lang`, `code`, `n` over all rows of `lang`, `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                values = np.sort(np.concatenate(parts))
                first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
                n = np.diff(np.concatenate([first, [len(values)]]))
                columns = [pa.array([lang] * len(first)), pa.array(values[first].view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for piece in tb.slices(texts, SLICE):
                here = slice(piece.first, piece.first + len(piece))
                code, begin, _ = grams(texts[here].to_pylist())
                for k, lang in enumerate(langs[here]):
                    held.setdefault(lang, []).append(code[begin[k] : begin[k + 1]])
                size += len(code)
                if size > 8_000_000:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    rows = training.where("lang is not null and text is not null").select("lang", "text")
    return map_arrow(rows, run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train(training: DataFrame) -> LanguageModel:
    """Models of all languages of `training` (`doc_id`, `lang`, `text`). Counts are summed
    by Spark; all of them come to the driver, one language at a time, so a model is as
    large as the distinct n-grams of its language and is that of the whole corpus."""
    scratch = Scratch(training.sparkSession, "language-id")
    counts = scratch.write(count_grams(training), "counts")
    names = sorted(r[0] for r in counts.select("lang").distinct().collect())
    models = []
    for name in names:
        own = counts.where(F.col("lang") == name).select("code", "n").toArrow()
        models.append(KneserNey(own["code"].to_numpy().view(U64), own["n"].to_numpy()))
    scratch.drop(counts)
    return LanguageModel(names, models, *_calibration(training, names, models, scratch))


def _calibration(training: DataFrame, names: list[str], models: list[KneserNey], scratch: Scratch) -> tuple[float, float]:
    """How sharply differences of cross-entropy are turned into scores, so that scores of
    all training rows fit their share of right answers; and the accepted score. Rows are
    scored once and written; losses are added up by Spark, and the accepted score is an
    exact quantile over all right answers."""
    if len(names) < 2:
        return 1.0, 0.0
    rows = training.where("lang is not null and text is not null").select("lang", "text")
    shared = training.sparkSession.sparkContext.broadcast(models)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        place = {name: k for k, name in enumerate(names)}
        for batch in batches:
            for piece in tb.slices(batch.column(1), SLICE):
                here = slice(piece.first, piece.first + len(piece))
                code, begin, _ = grams(batch.column(1)[here].to_pylist())
                truth = pa.array([place[x] for x in batch.column(0)[here].to_pylist()], pa.int32())
                found = pa.array(list(scorer.entropies(code, begin)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([truth, found], ["truth", "e"])

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(SHARPNESS))
        for truth, entropy in _rows(batches):
            for k, s in enumerate(SHARPNESS):
                p = _posterior(entropy, s)[np.arange(len(truth)), truth]
                sums[k] -= np.log(np.maximum(p, 1e-9)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(SHARPNESS)), pa.int32()), pa.array(sums)], ["k", "loss"])

    entropies = scratch.write(map_arrow(rows, measured, "truth int, e array<double>"), "entropies")
    if entropies.isEmpty():
        return 1.0, 0.0
    summed = map_arrow(entropies, losses, "k int, loss double").groupBy("k").agg(F.sum("loss").alias("loss"))
    sharpness = float(SHARPNESS[min(summed.collect(), key=lambda r: (r["loss"], r["k"]))["k"]])

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for truth, entropy in _rows(batches):
            p = _posterior(entropy, sharpness)
            yield pa.RecordBatch.from_arrays([pa.array(p.max(axis=1)[p.argmax(axis=1) == truth])], ["score"])

    scores = map_arrow(entropies, right, "score double")
    accepted = exact_quantiles(scores, "score", [1 - ACCEPTED_SHARE]).first()["q0"]
    scratch.drop(entropies)
    return sharpness, 0.0 if accepted is None else float(accepted)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The true language's number and the cross-entropies of each row."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)


def _posterior(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    x = -sharpness * (entropy - entropy.min(axis=1, keepdims=True))
    p = np.exp(x)
    return p / p.sum(axis=1, keepdims=True)


def predicted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """`documents` with `lang_pred`, `score` and `accepted`.

    A text that is null, empty or without letters is `und` with score 0 and not
    accepted, and so is every text if nothing was learned. Repeated rows get equal
    answers; an empty table gives an empty result; columns named like the new ones
    are replaced."""
    docs = documents.drop("lang_pred", "score", "accepted")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(list(docs.schema)).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m.models)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            for piece in tb.slices(texts, SLICE) if m.names else ():
                here = slice(piece.first, piece.first + len(piece))
                code, begin, letters = grams([t or "" for t in texts[here].to_pylist()])
                p = _posterior(scorer.entropies(code, begin), m.sharpness)
                best[here] = np.where(letters > 0, p.argmax(axis=1), -1)
                score[here] = np.where(letters > 0, p.max(axis=1), 0.0)
            names = [m.names[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array((score >= m.accepted) & (best >= 0))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs, run, schema)


@register("op7_language_id")
def op7_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    rows = documents.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = train(rows.where("not held_out"))
    return predicted(rows.select("doc_id", "text", "held_out"), model).drop("text")
