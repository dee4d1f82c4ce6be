"""Line dedup, DataFrame functions only: a suffix array over sequences of line names.

Documents are put in order once and their lines numbered, with a number between two
documents left out, so one integer is a line's place. Lines found twice are named by the
first place that has them. Prefix doubling names runs of 2, 4, 8 ... lines, and pairs
found once drop out, so each round is smaller. Equal names are the intervals of the
suffix array with a common prefix of that length; between two powers, runs are extended
by ever smaller powers. The first copy of a run, by document and line, stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.mixing import WORD
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch

MIN_LINES = 2
MIN_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_rows(documents: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """One row for each line with a word: its document's hashes, its place `at`, `line`
    (among all of its document), `a` and `b` (128 bits of hash), `long` (has `min_words`)."""
    # So many words need that many characters.
    may_be_long = lambda x: F.length(x) >= 2 * min_words - 1
    is_long = lambda x: may_be_long(x) & (F.regexp_count(x, F.lit(WORD)) >= min_words)
    with_words = F.filter(F.transform("l", lambda x, i: F.struct(i.alias("line"), x.alias("x"))), lambda s: s["x"].rlike(WORD))
    hashed = F.transform(
        with_words,
        lambda s: F.struct(
            s["line"].alias("line"),
            F.xxhash64(s["x"]).alias("a"),
            F.xxhash64(F.lit(1), s["x"]).alias("b"),
            is_long(s["x"]).alias("long"),
        ),
    )
    keyed = documents.select(
        F.col("doc_id").isNull().alias("unnamed"),
        "doc_id",
        F.xxhash64("doc_id").alias("k1"),
        F.xxhash64("text").alias("k2"),
        _lines(F.col("text")).alias("l"),
    )
    order = ["unnamed", "doc_id", "k1", "k2"]
    rows = scratch.write(keyed.select(*order, hashed.alias("l"), F.monotonically_increasing_id().alias("row")), "documents")
    firsts = scratch.write(rows.groupBy(*order).agg(F.min("row").alias("row")).select("row"), "firsts")
    if firsts.count() < rows.count():
        rows = rows.join(firsts, "row", "left_semi")
    in_order = rows.drop("row").repartitionByRange(*order).sortWithinPartitions(*order)
    # The null behind the lines of a document takes the number that is left out.
    each = in_order.select("k1", "k2", F.explode(F.concat("l", F.array(F.lit(None)))).alias("s"))
    numbered = each.withColumn("at", F.monotonically_increasing_id()).where("s is not null")
    return scratch.write(numbered.select("k1", "k2", "at", "s.*"), "lines")


def _named(rows: DataFrame, keys: list[str], scratch: Scratch, keep: list[str]) -> DataFrame:
    """Rows whose `keys` are found in two places, with the first of these as `name` of
    the keys and `later` (not the first place)."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min("at").alias("name")).where("copies > 1")
    named = rows.join(groups.select(*keys, "name"), keys)
    return scratch.write(named.select("at", *keep, (F.col("at") > F.col("name")).alias("later"), "name"), "level")


def _followed(rows: DataFrame, by: DataFrame, distance: Column, how: str = "inner") -> DataFrame:
    """`rows` with `next`, the name in `by` of the run that starts `distance` lines on."""
    ahead = by.select(F.col("at").alias("goes_on"), F.col("name").alias("next"))
    return rows.withColumn("goes_on", F.col("at") + distance).join(ahead, "goes_on", how).drop("goes_on")


def doubled(lines: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Level j: the starts of all runs of 2^j lines found twice. The last is empty."""
    levels = [_named(lines, ["a", "b"], scratch, ["k1", "k2", "line", "long"])]
    while levels[-1].limit(1).count():
        last, reach = levels[-1], 1 << (len(levels) - 1)
        pairs = _followed(last.select("at", F.col("name").alias("head")), last, F.lit(reach))
        levels.append(_named(pairs, ["head", "next"], scratch, []))
    return levels


def _of_length(levels: list[DataFrame], lines: int, scratch: Scratch) -> DataFrame:
    """Starts of runs of exactly so many lines found twice, with `later`."""
    top = lines.bit_length() - 1
    if top >= len(levels):
        return levels[-1]
    rows, length = levels[top], 1 << top
    for j in reversed(range(top)):
        if lines >> j & 1:
            rows = _followed(rows.select("at", F.col("name").alias("head")), levels[j], F.lit(length))
            rows = _named(rows, ["head", "next"], scratch, [])
            length += 1 << j
    return rows


def longest_runs(levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """`at`, `length`: the longest run that starts there and is found elsewhere, for each
    line found twice.

    From the largest power of two down, a line comes in with the longest power that it
    begins, and the lines of a class (equal runs of `length` lines, known by `head`, its
    first place when it was made) go on to a longer class where their extension is found
    twice. A line that stays may match one that went on or came in before, so one line of
    each longer class also stays, without a `real` claim."""
    own = ["length", "head"]
    columns = ["at", *own, "real"]
    state = levels[0].limit(0).select("at", F.lit(0).alias("length"), F.col("name").alias("head"), F.lit(True).alias("real"))
    for j in reversed(range(len(levels) - 1)):
        longer = levels[j + 1]
        power = levels[j].select("at", F.lit(1 << j).alias("length"), F.col("name").alias("head"))
        coming = power.join(longer.select("at"), "at", "left_anti").withColumn("real", F.lit(True))
        beside = power.join(longer.where("not later").select("at"), "at", "left_semi").withColumn("real", F.lit(False))
        if j == len(levels) - 2:
            state = coming.select(*columns)
            continue
        ahead = scratch.write(_followed(state, levels[j], F.col("length"), "left"), "ahead")
        groups = (
            ahead.where("next is not null")
            .groupBy(*own, "next")
            .agg(F.count(F.lit(1)).alias("copies"), F.max("real").alias("any_real"), F.min("at").alias("grown"))
            .where("copies > 1 and any_real")
            .select(*own, "next", "grown")
        )
        groups = scratch.write(groups, "groups")
        moved = scratch.write(ahead.join(groups, [*own, "next"], "left").select(*columns, "grown"), "moved")
        staying = moved.where("grown is null or not real").select(*columns).unionByName(coming)
        went_on = moved.where("grown is not null").select(
            "at", (F.col("length") + (1 << j)).alias("length"), F.col("grown").alias("head"), "real"
        )
        kept_back = groups.select(F.col("grown").alias("at"), *own, F.lit(False).alias("real"))
        claimed = staying.where("real").select(*own).distinct()
        witnesses = staying.where("not real").unionByName(kept_back).unionByName(beside).distinct().join(claimed, own, "left_semi")
        state = scratch.write(staying.where("real").unionByName(witnesses).unionByName(went_on), "state")
    return state.where("real").select("at", "length")


def repeated_lines(
    documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """`documents` with `n_lines`, `n_removed`, `n_runs` (of removed lines), `longest_run`
    (lines of the longest run that starts in it and is found elsewhere) and
    `kept_text`.

    Lines end at a line feed and are compared as they are; lines without a word belong
    to no run and stay. A run of at least `min_lines` lines, or a line of at least
    `min_words` words, that stands earlier, by doc_id and line, goes. A null text
    counts as empty. A null doc_id counts as larger than any other. Rows repeated with
    doc_id and text are one document and have one result. An empty table gives an
    empty result; columns named like the new ones are replaced."""
    new = ["n_lines", "n_removed", "n_runs", "longest_run", "kept_text", "_k1", "_k2", "_gone", "_l"]
    docs = documents.drop(*new)
    scratch = Scratch(documents.sparkSession, "line-runs")
    lines = line_rows(documents.select("doc_id", "text"), scratch, min_words)
    levels = doubled(lines, scratch)
    windows = _of_length(levels, min_lines, scratch).where("later")
    covered = windows.select(F.explode(F.sequence(F.col("at"), F.col("at") + min_lines - 1)).alias("at"))
    covered = covered.unionAll(levels[0].where("later and long").select("at")).distinct().withColumn("gone", F.lit(True))
    each = levels[0].select("k1", "k2", "at", "line").join(longest_runs(levels, scratch), "at").join(covered, "at", "left")
    by_row = each.groupBy("k1", "k2").agg(
        F.max("length").alias("longest_run"),
        F.array_sort(F.collect_list(F.when(F.col("gone"), F.struct("at", "line")))).alias("g"),
    )
    # A removed run begins where the line with a word before it stays.
    starts = F.size(
        F.filter("g", lambda s, i: (i == 0) | (F.col("g")[F.greatest(i - 1, F.lit(0))]["at"] < s["at"] - 1))
    )
    found = by_row.select(
        F.col("k1").alias("_k1"),
        F.col("k2").alias("_k2"),
        "longest_run",
        F.when(F.size("g") > 0, F.col("g.line")).alias("_gone"),
        starts.cast("bigint").alias("n_runs"),
    )
    found = scratch.write(found, "found")
    joined = docs.withColumn("_k1", F.xxhash64("doc_id")).withColumn("_k2", F.xxhash64("text")).join(found, ["_k1", "_k2"], "left")
    split = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), F.col("_gone"))
    text = F.array_join(F.transform(kept, lambda i: F.col("_l")[i]), "\n")
    return (
        joined.withColumn("_l", split)
        .withColumn("n_lines", F.size("_l").cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("bigint")))
        .withColumn("n_runs", F.coalesce("n_runs", F.lit(0).cast("bigint")))
        .withColumn("longest_run", F.coalesce(F.col("longest_run"), F.lit(0)).cast("bigint"))
        .withColumn("kept_text", F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(text))
        .select(*docs.columns, "n_lines", "n_removed", "n_runs", "longest_run", "kept_text")
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS line FROM d),
w AS (SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS no,
    len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
  FROM e WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
n AS (SELECT *, lead(x) OVER (PARTITION BY doc_id ORDER BY no) AS y FROM w),
f AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, no) AS r1,
    CASE WHEN y IS NOT NULL THEN row_number() OVER (PARTITION BY x, y ORDER BY doc_id, no) ELSE 1 END AS r2 FROM n),
g AS (SELECT *, (r2 > 1 OR coalesce(lag(r2) OVER (PARTITION BY doc_id ORDER BY no), 1) > 1
    OR (words >= 50 AND r1 > 1)) AS gone FROM f),
s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY no), false) AS begins FROM g),
p AS (SELECT a.doc_id, b.doc_id AS other, a.no, b.no - a.no AS shift,
    a.no - row_number() OVER (PARTITION BY a.doc_id, b.doc_id, b.no - a.no ORDER BY a.no) AS island
  FROM w a JOIN w b ON a.x = b.x AND (a.doc_id <> b.doc_id OR a.no <> b.no)),
r AS (SELECT doc_id, max(c) AS longest FROM (SELECT doc_id, count(*) AS c FROM p GROUP BY doc_id, other, shift, island) GROUP BY doc_id),
k AS (SELECT e.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE coalesce(gone, false)) AS n_removed,
    count(*) FILTER (WHERE coalesce(begins, false)) AS n_runs,
    coalesce(string_agg(e.x, chr(10) ORDER BY e.line) FILTER (WHERE NOT coalesce(gone, false)), '') AS kept
  FROM e LEFT JOIN s ON e.doc_id = s.doc_id AND e.line = s.line GROUP BY e.doc_id)
SELECT k.doc_id, n_lines, n_removed, n_runs, coalesce(longest, 0) AS longest_run, sha256(kept) AS kept_sha256
FROM k LEFT JOIN r ON k.doc_id = r.doc_id
"""


@register("op10_line_dedup", OP10_SQL)
def op10_line_dedup(spark, sf_dir):
    found = repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2("kept_text", 256).alias("kept_sha256"))
