"""Ordered computations over a whole table without putting it in one task:
running totals, ranks, exact quantiles and the exact area under the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import materialize

COUNT = "decimal(38,0)"


def _order(keys: Sequence[str]) -> list[Column]:
    """'-revenue' sorts descending, 'sku' ascending."""
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys]


def running_total(
    df: DataFrame,
    value: str,
    order_by: Sequence[str],
    into: str = "running",
    group_by: Sequence[str] = (),
    total_into: str | None = None,
) -> DataFrame:
    """Sum of `value` from the first row up to each row, per group if given; with
    `total_into` also the sum of all rows.

    `order_by` must name a unique order and `group_by` must not be NULL. Rows are
    range-partitioned by that order and written once with their slice number;
    then slice sums give each slice its offset and every slice adds up alone. The
    offsets are as many rows as there are slices (and groups), whatever the
    data. The written table keeps slices and offsets consistent: a second range
    partitioning would sample other bounds."""
    groups = list(group_by)
    placed = materialize(
        df.repartitionByRange(*[F.asc(g) for g in groups], *_order(order_by)).withColumn(
            "slice", F.spark_partition_id()
        ),
        "running",
    )
    slices = Window.partitionBy(*groups)
    earlier = slices.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("slice_sum").over(earlier), F.lit(0)).alias("before")]
    if total_into:
        carried.append(F.sum("slice_sum").over(slices).alias(total_into))
    offsets = (
        placed.groupBy(*groups, "slice")
        .agg(F.sum(value).alias("slice_sum"))
        .select(*groups, "slice", *carried)
    )
    inside = (
        Window.partitionBy(*groups, "slice")
        .orderBy(*_order(order_by))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(offsets, [*groups, "slice"])
        .withColumn(into, F.col("before") + F.sum(value).over(inside))
        .drop("slice", "before")
    )


def ranked(
    df: DataFrame, order_by: Sequence[str], into: str = "rank", group_by: Sequence[str] = ()
) -> DataFrame:
    """Dense row number 1..n in a unique order, per group if given."""
    ones = df.withColumn("one", F.lit(1).cast("bigint"))
    out = running_total(ones, "one", order_by, into, group_by)
    return out.withColumn(into, F.col(into).cast("bigint")).drop("one")


def exact_quantiles(df: DataFrame, value: str, points: Sequence[float]) -> DataFrame:
    """One row q0, q1, ... of linearly interpolated quantiles. Works on counts per
    distinct value, so no task ever holds all values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    placed = running_total(counts, "n", [value], "upto", total_into="rows")

    picks = []
    for i, p in enumerate(points):
        at = (F.col("rows") - 1) * F.lit(float(p))
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("upto") > position) & (F.col("upto") - F.col("n") <= position)
            picks.append(F.max(F.when(here, F.col(value))).alias(f"{side}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"part{i}"))
    return placed.agg(*picks).select(
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}")
            for i in range(len(points))
        ]
    )


def quartile_band(df: DataFrame, score: str, labels: Sequence[str], into: str = "band") -> DataFrame:
    """Label by quartile of the score, right-closed, the lowest value included.
    Equal edges leave the band between them empty."""
    edges = exact_quantiles(df, score, (0.25, 0.5, 0.75))
    edge = F.col("edges")
    with_edges = df.withColumn("edges", edges.select(F.struct("q0", "q1", "q2")).scalar())
    band = (
        F.when(F.col(score) <= edge["q0"], labels[0])
        .when(F.col(score) <= edge["q1"], labels[1])
        .when(F.col(score) <= edge["q2"], labels[2])
        .when(F.col(score).isNotNull(), labels[3])
    )
    return with_edges.withColumn(into, band).drop("edges")


def roc_auc(
    df: DataFrame, score: str, label: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve from mean ranks of tied scores, per group
    if given. NULL where only one class is present."""
    groups = list(group_by)
    counts = df.groupBy(*groups, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("hits")
    )
    run = running_total(counts, "n", [score], "upto", groups)
    # Twice the mean rank of a tied block stays a whole number.
    twice = (2 * F.col("upto") - F.col("n") + 1).cast(COUNT)
    sums = run.groupBy(*groups).agg(
        F.sum(F.col("hits").cast("decimal(18,0)") * twice.cast("decimal(20,0)")).alias("twice_ranks"),
        F.sum("hits").cast("double").alias("p"),
        F.sum("n").cast("double").alias("rows"),
    )
    p, q = F.col("p"), F.col("rows") - F.col("p")
    wins = F.col("twice_ranks").cast("double") / 2 - p * (p + 1) / 2
    return sums.select(*groups, F.when((p > 0) & (q > 0), wins / (p * q)).alias("auc"))
