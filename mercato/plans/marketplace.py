"""Rules of the second source, a consumer marketplace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import clean_zip, parse_ts_lenient, total
from mercato.operators.checks import zero_result
from mercato.operators.groups import keep_first
from mercato.operators.skew import salted_join
from mercato.parameters import MARKETPLACE_PEAK_MONTHS
from mercato.plans.gold import date_spine
from mercato.plans.quality import _equal_sums, _orphan_rows, fact_volume, union_all


def reviews(raw: DataFrame) -> DataFrame:
    """One row per review id, the latest; unreadable times come last."""
    typed = raw.withColumn("reviewed_at", parse_ts_lenient(F.col("reviewed_at")))
    return keep_first(typed, "review_id", [F.desc_nulls_last("reviewed_at"), F.asc("order_id")])


def geo_by_zip(raw: DataFrame) -> DataFrame:
    """One point per zip prefix: the mean."""
    points = raw.withColumn("zip", clean_zip(F.col("zip_raw"))).groupBy("zip").agg(
        F.sum("lat").alias("lat"), F.sum("lng").alias("lng"), F.count(F.lit(1)).alias("points")
    )
    return points.select(
        "zip",
        F.round(F.col("lat").cast("double") / F.col("points"), 6).alias("lat"),
        F.round(F.col("lng").cast("double") / F.col("points"), 6).alias("lng"),
        "points",
    )


def dim_person(customers: DataFrame) -> DataFrame:
    """A customer id is made per order; the person id is who bought."""
    return customers.withColumn("zip", clean_zip(F.col("zip_raw"))).groupBy("person_id").agg(
        F.countDistinct("customer_id").alias("customer_ids"), F.min("zip").alias("zip")
    )


def order_reviews(deduplicated: DataFrame) -> DataFrame:
    """Mean rating per order, so that lines are not multiplied."""
    return deduplicated.groupBy("order_id").agg(
        F.sum("score").alias("points"), F.count(F.lit(1)).alias("reviews")
    ).select("order_id", (F.col("points").cast("double") / F.col("reviews")).alias("review_score"))


def order_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(total(F.col("amount")).alias("order_payment"))


def fact_lines(
    lines: DataFrame, payments: DataFrame, deduplicated: DataFrame, spread_by: Sequence[str] = ("line_id",)
) -> DataFrame:
    """Order-line grain. Payment and rating belong to the order and repeat on each
    of its lines: never add them up here, use order_level_total."""
    per_order = order_payments(payments).join(order_reviews(deduplicated), "order_id", "left")
    return salted_join(
        lines.select("line_id", "order_id", "sku", "quantity", "unit_price"),
        per_order, "order_id", spread_by, "left",
    ).withColumn("revenue", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"))


def order_level_total(fact: DataFrame) -> DataFrame:
    """Order values counted once per order."""
    once = fact.groupBy("order_id").agg(F.first("order_payment").alias("order_payment"))
    return once.agg(total(F.col("order_payment")).alias("payment_total"), F.count(F.lit(1)).alias("orders"))


def calendar(df: DataFrame, date: str, peak_months: Sequence[int] = MARKETPLACE_PEAK_MONTHS) -> DataFrame:
    return date_spine(df, date).select(
        "day", F.year("day").alias("year"), F.month("day").alias("month"),
        F.month("day").isin(*peak_months).alias("peak_month"),
    )


def quality(
    fact: DataFrame, lines: DataFrame, orders: DataFrame, deduplicated: DataFrame, mart: DataFrame,
    fact_rows: tuple[int, int],
) -> DataFrame:
    """Revenue across layers, orphans, rating range, volume, mart against fact."""
    value = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    ratings = deduplicated.agg(
        F.count_if(~F.coalesce(F.col("score").between(1, 5), F.lit(False))).alias("n")
    )
    return union_all([
        _equal_sums("mkt_revenue_match", fact, lines.select(value.alias("value")), "revenue", "value"),
        zero_result(_orphan_rows(fact, orders, "order_id"), "mkt_no_orphan_order", "n"),
        zero_result(ratings, "mkt_rating_range", "n"),
        fact_volume(fact, *fact_rows),
        _equal_sums("mkt_mart_equals_fact", mart, fact, "revenue", "revenue"),
    ])
