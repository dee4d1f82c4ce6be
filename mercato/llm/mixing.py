"""Mixing sources to target weights, DataFrame functions only.

Every row gets a hash-random key. Rows are sorted by (source, key); keys are
uniform, so their leading hex digits cut even a hot source into even ranges. Each
range sums its own sizes, the sums of earlier ranges are carried in, and a source
is cut where its budget ends."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.registry import register, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`source`, `source_size`, `target` from rows of `source`, `size`.

    Sources in the order of their names, null last, have the weights in turn. All
    words are shared by weight; a source takes at most `max_epochs` times its size
    and the rest is shared again among the others. That ends where every source has
    the smaller of its limit and one level times its weight, and the level follows
    from the sources in the order of limit by weight. One row for each source is
    all that meets here."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1)
    capped = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = capped.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_words"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    )
    # Sources before this one are at their limit; it is, too, if its share passes it.
    full = F.col("cap") * F.col("left_weight") <= F.col("left_words") * F.col("weight")
    open_words = F.max(F.when(~full, F.struct("left_weight", "left_words"))).over(everything)
    shared = (
        F.col("weight").cast("double")
        * open_words["left_words"].cast("double")
        / open_words["left_weight"].cast("double")
    )
    target = F.when(full, F.col("cap").cast("double")).otherwise(shared)
    return level.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """`documents` with `size`, `source_size`, `target`, `taken` (words taken,
    repeats counted) and `times` (copies that hold them, the last may be cut).

    The budget of a source is its target rounded to whole words. It is spent in
    whole rounds over the source and then along the keys until it is used up, the
    document there being taken in part. A null text has size 0, a null source is a
    source, sources without words take nothing. Rows repeated with one doc_id share
    their key and follow one another. An empty table gives an empty result. Columns
    named like the new ones are replaced."""
    new = ["size", "source_size", "target", "taken", "times", "_key", "_range", "_source"]
    docs = documents.drop(*new)
    sized = docs.select(
        "*",
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"),
    )
    rows = documents.count()
    digits = max(1, math.ceil(math.log(max(rows, 1) / rows_per_range, 16))) if rows > rows_per_range else 0
    sized = sized.withColumn("_range", F.substring("_key", 1, digits)).withColumn(
        "_source", F.struct(F.col("source").isNull().alias("n"), F.col("source").alias("v"))
    )
    targets = source_targets(sized.select("source", "size"), weights, max_epochs)
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        sized.groupBy("_source", "_range")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .join(
            targets.withColumn(
                "_source", F.struct(F.col("source").isNull().alias("n"), F.col("source").alias("v"))
            ).drop("source"),
            "_source",
        )
        .withColumn("_budget", budget)
        .withColumn("_rounds", rounds.cast("bigint"))
        .withColumn("_rest", F.col("_budget") - F.col("_rounds") * F.col("source_size"))
        .select("_source", "_range", "_before", "source_size", "target", "_rounds", "_rest")
    )
    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", F.asc_nulls_last("doc_id"), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = sized.withColumn("_upto", F.sum("size").over(inside)).join(ranges, ["_source", "_range"])
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_rest") - F.col("_before") - F.col("_upto") + F.col("size")))
    return (
        placed.withColumn("_part", part.cast("bigint"))
        .withColumn("taken", F.col("_rounds") * F.col("size") + F.col("_part"))
        .withColumn("times", (F.col("_rounds") + (F.col("_part") > 0).cast("bigint")).cast("int"))
        .select(*docs.columns, "size", "source_size", "target", "taken", "times")
    )


def mixed_documents(documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of the mix with the columns of `documents`: each as often as it is
    taken. Texts are not cut, so the last one of a source's budget is whole. Null texts,
    and those without words, are not taken; nulls in other columns and columns of any
    name pass through; no documents give none."""
    rows = documents.select("doc_id", "text", "source", F.struct("*").alias("whole"))
    mixed = mix(rows, weights, max_epochs).where("times > 0")
    return mixed.select("whole", F.explode(F.sequence(F.lit(1), F.col("times")))).select("whole.*")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 3 AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
l AS (SELECT *,
    (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER b, 0) AS left_words,
    (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0) AS left_weight
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT max(left_weight) AS ow, max_by(left_words, left_weight) AS owords
  FROM l WHERE cap * left_weight > left_words * weight),
t AS (SELECT source, source_size, CASE WHEN cap * left_weight <= left_words * weight THEN CAST(cap AS DOUBLE)
    ELSE CAST(weight AS DOUBLE) * CAST(owords AS DOUBLE) / CAST(ow AS DOUBLE) END AS target
  FROM l LEFT JOIN o ON true),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
    CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS rounds,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id NULLS LAST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(rounds * size + least(size, greatest(0, budget - rounds * source_size - before)) AS BIGINT) AS taken
FROM p
"""


@register("op9_mixing", OP9_SQL)
def op9_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
