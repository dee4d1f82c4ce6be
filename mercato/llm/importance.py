"""Importance resampling towards a target text: documents are drawn by the gain of
their hashed words and word pairs under the target's distribution, plus a random share
that makes the draw one without replacement.

Both texts are counted into a fixed array of buckets, so the model is one array. The
drawn documents are those up to a cutoff key, which is found exactly without sorting
all: sorted blocks of keys send their medians, the median of these weighted by what
remains in each block is the next pivot, and at least a quarter of what remains falls
away in each round. Only the winners are sorted."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow
from mercato.operators.running import ranked

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
# Keys that one median stands for.
BLOCK_KEYS = 250_000
# So few remaining keys are looked at one by one.
LAST_KEYS = 10_000
WORDS_AT_ONCE = 50_000

# Bytes of a word after lower-casing: digits, letters and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = True
WORD[128:] = True

# Words up to so many bytes are hashed together, longer ones alone.
SHORT = 64
ONES = np.uint32(0xFFFFFFFF)


def _zero_byte(state: np.ndarray, of_byte: np.ndarray) -> np.ndarray:
    return of_byte[state & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The CRC-32 step of one byte; the state that each byte of a start state becomes
    after n zero bytes; the start state after n zero bytes. As the register is linear
    over xor, a word's state is the xor of what its bytes become."""
    of_byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        of_byte = np.where(of_byte & np.uint32(1), (of_byte >> np.uint32(1)) ^ np.uint32(0xEDB88320), of_byte >> np.uint32(1))
    moved = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for place in range(4):
        moved[0, place] = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
    start = np.full(SHORT + 1, ONES)
    for n in range(SHORT):
        moved[n + 1] = _zero_byte(moved[n], of_byte)
        start[n + 1] = _zero_byte(start[n : n + 1], of_byte)[0]
    return of_byte, moved, start


OF_BYTE, MOVED, START = _crc_tables()
OF_LAST = np.ascontiguousarray(MOVED[:, 0]).ravel()


def _crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each word, and of each word, a space and the word after it."""
    length = ends - starts
    within = np.minimum(length, SHORT)
    begin = np.cumsum(within) - within
    # Bytes still to come, the byte itself included; of longer words the last ones.
    left = np.repeat(begin + within, within) - np.arange(int(within.sum()))
    byte = data[np.repeat(ends, within) - left]
    own = np.bitwise_xor.reduceat(OF_LAST[left * 256 + byte], begin)
    state = own ^ START[within]
    long = np.flatnonzero(length > SHORT)
    for i in long.tolist():
        state[i] = np.uint32(zlib.crc32(data[starts[i] : ends[i]])) ^ ONES
    spaced = OF_BYTE[(state[:-1] ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state[:-1] >> np.uint32(8))
    after = within[1:]
    pair = own[1:].copy()
    for place in range(4):
        pair ^= MOVED[after, place, (spaced >> np.uint32(8 * place)) & np.uint32(0xFF)]
    for i in long[long > 0].tolist():
        pair[i - 1] = np.uint32(zlib.crc32(data[starts[i] : ends[i]], int(spaced[i - 1] ^ ONES))) ^ ONES
    return state ^ ONES, pair ^ ONES


def word_buckets(piece: tb.Slice, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, of all pairs of neighbours (a pair at its first word;
    those over the end of a row too), and by row the index of its first word."""
    data = tb.LOWER[piece.data]
    starts, ends = tb.runs(WORD[data], piece.offsets)
    first = np.searchsorted(starts, piece.offsets)
    one, two = np.zeros(len(starts), np.int32), np.zeros(max(0, len(starts) - 1), np.int32)
    for a in range(0, len(starts), WORDS_AT_ONCE):
        word, pair = _crcs(data, starts[a : a + WORDS_AT_ONCE + 1], ends[a : a + WORDS_AT_ONCE + 1])
        one[a : a + WORDS_AT_ONCE] = word[:WORDS_AT_ONCE] % np.uint32(buckets)
        two[a : a + len(pair)] = pair % np.uint32(buckets)
    return one, two, first


def _in_rows(first: np.ndarray, pairs: int) -> np.ndarray:
    """Which pairs lie within a row."""
    inside = np.ones(pairs, bool)
    over = first[1:-1] - 1
    inside[over[(over >= 0) & (over < pairs)]] = False
    return inside


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Words and pairs of all rows of `text` by bucket. A task sends one row for each
    bucket; `buckets` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in tb.slices(batch.column(0)):
                one, two, first = word_buckets(piece, buckets)
                total += np.bincount(one, minlength=buckets)
                total += np.bincount(two[_in_rows(first, len(two))], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    counted = map_arrow(texts.select("text"), run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, floored."""
    s, t = source.astype(float), target.astype(float)
    size = float(len(source))
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """`doc_id`, `text_hash`, `n_words`, `n_features` and `weight`, the floored mean of
    the gains of all words and pairs. The gains go along as one array."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = docs.drop("text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            for piece in tb.slices(batch.column(2)):
                one, two, first = word_buckets(piece, len(of))
                words = np.diff(first)
                ones = np.concatenate(([0], np.cumsum(of[one])))
                twos = np.concatenate(([0], np.cumsum(of[two])))
                total = ones[first[1:]] - ones[first[:-1]]
                some = words > 1
                total[some] += twos[first[1:][some] - 1] - twos[first[:-1][some]]
                features = np.maximum(2 * words - 1, 0)
                here = slice(piece.first, piece.first + len(piece))
                columns = [batch.column(0)[here], batch.column(1)[here], pa.array(words), pa.array(features)]
                columns.append(pa.array(total // np.maximum(features, 1)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs, run, schema)


def random_share(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate, floored, that depends on seed and id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


# The order of the draw: higher score, smaller id (without id last). Repeated rows
# are told apart by the number under which they were written.
ORDER = ("-score", "unnamed", "doc_id", "text_hash", "uid")
KEY = ("lower", "unnamed", "named", "text_hash", "uid")


def _keys(scored: DataFrame) -> DataFrame:
    """The order as five whole numbers that all ascend."""
    return scored.select(
        (-F.col("score")).alias("lower"),
        "unnamed",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("named"),
        "text_hash",
        "uid",
    )


def _upto(key: tuple[int, ...]) -> Column:
    """Rows whose key is at most `key`."""
    columns = (-F.col("score"), F.col("unnamed"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), F.col("text_hash"), F.col("uid"))
    out = columns[-1] <= key[-1]
    for column, value in zip(columns[-2::-1], key[-2::-1]):
        out = (column < value) | ((column == value) & out)
    return out


def _less(keys: np.ndarray, key: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(keys), bool)
    equal = np.ones(len(keys), bool)
    for k, value in enumerate(key):
        out |= equal & (keys[:, k] < value)
        equal &= keys[:, k] == value
    return out


def _medians(keys: DataFrame, pivot: tuple[int, ...] | None, low, high) -> tuple[list, list]:
    """Of each block of keys between `low` and `high` the number of keys and the median
    below the pivot, and the same above it. A block is at most BLOCK_KEYS keys of a
    task, so one row for so many keys comes to the driver."""

    def described(held: list[np.ndarray]) -> tuple[list, list]:
        block = np.concatenate(held)
        block = block[np.lexsort(block.T[::-1])]
        below = int(_less(block, pivot).sum()) if pivot else len(block)
        above = below + (below < len(block) and tuple(block[below].tolist()) == pivot)
        parts = [(0, block[:below]), (1, block[above:])]
        return [s for s, x in parts if len(x)], [[len(x), *x[len(x) // 2].tolist()] for _, x in parts if len(x)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            sides, rows = described(held)
            columns = [pa.array(sides, pa.int32())] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(6)]
            return pa.RecordBatch.from_arrays(columns, ["side", "n", *KEY])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], axis=1)
            if low is not None:
                keys = keys[~_less(keys, (*low[:-1], low[-1] + 1))]
            if high is not None:
                keys = keys[_less(keys, high)]
            if len(keys):
                held.append(keys)
                size += len(keys)
            if size >= BLOCK_KEYS:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    if low is not None:
        keys = keys.where(F.col("lower") >= low[0])
    if high is not None:
        keys = keys.where(F.col("lower") <= high[0])
    rows = map_arrow(keys, run, "side int, n bigint, " + ", ".join(f"{c} bigint" for c in KEY)).toArrow().to_pylist()
    both = [[(tuple(r[c] for c in KEY), r["n"]) for r in rows if r["side"] == side] for side in (0, 1)]
    return both[0], both[1]


def _weighted_median(medians: list) -> tuple[int, ...]:
    """At least half of all keys are in blocks whose median is not above it, and at
    least half in blocks whose median is not below it."""
    half = sum(n for _, n in medians) / 2
    upto = 0
    for key, n in sorted(medians):
        upto += n
        if upto >= half:
            return key
    raise ValueError("no keys")


def cutoff(scored: DataFrame, place: int, last_keys: int = LAST_KEYS) -> tuple[int, ...]:
    """The key at `place` (from 1) in the order of all rows, by pivots. A round reads
    only what remains: the table is sorted within its files, so others are skipped."""
    keys = _keys(scored)
    low = high = None
    medians, _ = _medians(keys, None, None, None)
    while sum(n for _, n in medians) > last_keys:
        pivot = _weighted_median(medians)
        below, above = _medians(keys, pivot, low, high)
        before = sum(n for _, n in below)
        if place == before + 1:
            return pivot
        if place <= before:
            high, medians = pivot, below
        else:
            place, low, medians = place - before - 1, pivot, above
    left = keys
    if low is not None:
        left = left.where(F.col("lower") >= low[0])
    if high is not None:
        left = left.where(F.col("lower") <= high[0])
    # Keys of one score can be many, so the whole key is compared before they are sent.
    order = F.struct(*KEY)
    literal = lambda key: F.struct(*[F.lit(v).cast(t).alias(c) for v, c, t in zip(key, KEY, ("bigint", "int", "bigint", "bigint", "bigint"))])
    if low is not None:
        left = left.where(order > literal(low))
    if high is not None:
        left = left.where(order < literal(high))
    found = sorted(tuple(r) for r in left.collect())
    return found[place - 1]


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    last_keys: int = LAST_KEYS,
) -> DataFrame:
    """One row for each row of `documents`: `doc_id`, `n_words`, `n_features`, `weight`,
    `score`, `text_hash` and `rank`: 1, 2, 3... by falling score for the drawn `percent` of
    the documents of at least `min_words` words, null for all others.

    Words are runs of ASCII digits, letters (lower-cased) and all characters beyond
    ASCII. A null or empty text, or one without words, has no features, weight 0 and is
    never drawn. Equal scores go to the smaller doc_id (a whole number; rows without
    one last), equal ids to the smaller hash of the text; rows equal in all of it stand
    in for one another. Texts of any length are counted whole. An empty table gives an
    empty result, an empty target the smoothed shares alone; only `doc_id` and `text`
    of the documents and `text` of the target are read."""
    scratch = Scratch(documents.sparkSession, "importance")
    gain = gains(bucket_counts(documents, buckets), bucket_counts(target, buckets))
    scores = weighed(documents, gain).select(
        "*",
        (F.col("weight") + random_share(F.col("doc_id"), seed)).cast("bigint").alias("score"),
        F.col("doc_id").isNull().cast("int").alias("unnamed"),
        F.monotonically_increasing_id().alias("uid"),
    )
    scored = scratch.write(scores.sortWithinPartitions(F.desc("score")), "scored")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = percent * eligible.count() // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "text_hash"]
    nothing = F.lit(None).cast("bigint").alias("rank")
    if not drawn:
        return scored.select(*columns, nothing)
    last = cutoff(eligible, drawn, last_keys)
    wins = (F.col("n_words") >= min_words) & _upto(last)
    winners = ranked(scored.where(wins), ORDER).select(*columns, "rank")
    return winners.unionAll(scored.where(~wins).select(*columns, nothing))


OP11_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT range AS i, range AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS of_byte FROM steps WHERE k = 8),
rows AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT side, r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM rows),
f AS (
  SELECT side, r, unnest(list_concat(words,
    list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature
  FROM w),
h AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(hex(feature)) // 2),
      lambda i: CAST('0x' || substr(hex(feature), 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(of_byte[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), crc),
c AS (
  SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t
  FROM f JOIN h USING (feature) GROUP BY bucket),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (all_s + 10000) / ((CAST(s AS DOUBLE) + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM c, (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM c)),
m AS (
  SELECT r, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN h USING (feature) JOIN g USING (bucket) WHERE side = 0 GROUP BY r),
d AS (
  SELECT r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM w LEFT JOIN m USING (r) WHERE side = 0),
e AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM d WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM d LEFT JOIN e USING (r)
"""


@register("op11_importance_resampling", OP11_SQL)
def op11_importance_resampling(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampled(documents, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
