"""Grouping helpers that never gather an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.skew import salted_join


def keep_first(df: DataFrame, key: Column | str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in order. Spark cuts every group to one row per
    map task before the shuffle (WindowGroupLimit), so a huge group is no issue."""
    place = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("place", F.row_number().over(place)).where("place = 1").drop("place")


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """Commonest value per key, the lowest one on a tie. Counts are combined on
    the map side; no map of all values is built per key."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(
        F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value)
    )


def group_size(df: DataFrame, key: str, spread_by: Sequence[str], into: str) -> DataFrame:
    """Adds the number of rows sharing the key; a NULL key forms one group."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias(into))
    named = sizes.where(F.col(key).isNotNull())
    nulls = df.where(F.col(key).isNull()).agg(F.count(F.lit(1))).scalar()
    joined = salted_join(df, named, key, spread_by, "left")
    return joined.withColumn(into, F.when(F.col(key).isNull(), nulls).otherwise(F.col(into)))


def distinct_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Several distinct counts per key: values are deduplicated column by column
    and then only counted, instead of expanding every row once per column."""
    counts = [
        df.select(key, col).where(F.col(col).isNotNull()).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(f"{col}s"))
        for col in columns
    ]
    joined = reduce(lambda a, b: a.join(b, key, "left"), counts, df.select(key).distinct())
    return joined.fillna(0)


def duplicates(column: str) -> Column:
    """How many rows repeat a value already present."""
    return F.count(F.lit(1)) - F.countDistinct(column)
