"""Point-in-time client features: nothing after the cutoff is read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import day, safe_ratio
from mercato.parameters import RECENT_DAYS
from mercato.session import materialize
from mercato.vocabulary import ENGLISH, Vocabulary

NUMERIC_FEATURES = (
    "recency_days", "order_count", "revenue_total", "mean_ticket", "cycle_days", "overdue_ratio",
    "days_since_first_order", "days_since_registration", "recent_orders", "recent_revenue",
    "recent_share_pct", "distinct_categories", "distinct_brands", "units", "return_rate_pct",
    "recent_visits", "days_since_visit", "open_opportunities",
)
FEATURE_COLUMNS = ("client_id", *NUMERIC_FEATURES, "segment", "multichannel")
LABEL = "buys_next"


def until(df: DataFrame, date: str, cutoff: str) -> DataFrame:
    """Rows up to and including the cutoff. On a table partitioned by year and
    month the same bound is stated on those columns, so later partitions are not
    read."""
    last = day(cutoff)
    out = df.where(F.col(date) <= last)
    if {"year", "month"} <= set(df.columns):
        months = F.col("year") * 12 + F.col("month")
        out = out.where((F.col("year") <= F.year(last)) & (months <= F.year(last) * 12 + F.month(last)))
    return out


def since(df: DataFrame, date: str, start: Column) -> DataFrame:
    """Rows from a day on, with the bound on the partition columns as well."""
    out = df.where(F.col(date) >= start)
    if {"year", "month"} <= set(df.columns):
        months = F.col("year") * 12 + F.col("month")
        out = out.where((F.col("year") >= F.year(start)) & (months >= F.year(start) * 12 + F.month(start)))
    return out


def before(df: DataFrame, date: str, end: Column) -> DataFrame:
    """Rows before a day, with the bound on the partition columns as well."""
    out = df.where(F.col(date) < end)
    if {"year", "month"} <= set(df.columns):
        months = F.col("year") * 12 + F.col("month")
        out = out.where((F.col("year") <= F.year(end)) & (months <= F.year(end) * 12 + F.month(end)))
    return out


def _recent(date: str, cutoff: str, days: int) -> Column:
    return F.col(date) > F.date_sub(day(cutoff), days)


def client_orders(fact: DataFrame) -> DataFrame:
    """The state from which features at any cutoff are answered: what each client bought
    in an order on a day. Sums add up and minima, maxima and `seen` (the few pairs of
    category and brand in an order) combine, so rows of new fact partitions are simply
    added. It is as large as there are orders and is made in one scan of the fact; a
    large client is spread over its orders."""
    sold = F.when(~F.col("is_return"), F.col("quantity")).otherwise(0)
    return fact.groupBy("client_id", "order_id", "ordered_on").agg(
        F.min("channel").alias("first_channel"),
        F.max("channel").alias("last_channel"),
        F.sum("revenue").alias("revenue"),
        F.sum(sold).alias("units"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if("is_return").alias("returned"),
        F.collect_set(F.struct("category", "brand")).alias("seen"),
    )


def _orders(fact_or_orders: DataFrame) -> DataFrame:
    """Fact lines become orders; orders stay what they are."""
    return fact_or_orders if "seen" in fact_or_orders.columns else client_orders(fact_or_orders)


def up_to_label(fact: DataFrame, cutoffs: Sequence[str], horizon_days: int) -> DataFrame:
    """The rows that features at the cutoffs, or a label after them, ask for."""
    last = max(date.fromisoformat(c) + timedelta(days=horizon_days) for c in cutoffs)
    return until(fact, "ordered_on", last.isoformat())


def order_features(fact: DataFrame, cutoff: str, recent_days: int = RECENT_DAYS) -> DataFrame:
    """Recency, frequency, value, cycle, recent activity, channels, units, returns, from
    fact lines or `client_orders`. An order that stands under several days counts once."""
    recent = _recent("ordered_on", cutoff, recent_days)
    orders = _orders(until(fact, "ordered_on", cutoff)).groupBy("client_id", "order_id").agg(
        F.min("ordered_on").alias("first_on"),
        F.max("ordered_on").alias("last_on"),
        F.min("first_channel").alias("first_channel"),
        F.max("last_channel").alias("last_channel"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(recent, F.col("revenue"))).alias("recent_revenue"),
        F.sum("units").alias("units"),
        F.sum("lines").alias("lines"),
        F.sum("returned").alias("returned"),
    )
    return orders.groupBy("client_id").agg(
        F.max("last_on").alias("last_order_on"),
        F.min("first_on").alias("first_order_on"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("revenue").alias("revenue_total"),
        F.count_if(_recent("last_on", cutoff, recent_days)).alias("recent_orders"),
        F.coalesce(F.sum("recent_revenue"), F.lit(0)).alias("recent_revenue"),
        F.min("first_channel").alias("first_channel"),
        F.max("last_channel").alias("last_channel"),
        F.sum("units").alias("units"),
        F.sum("lines").alias("lines"),
        F.sum("returned").alias("returned"),
    )


def variety_features(fact: DataFrame, cutoff: str) -> DataFrame:
    """Distinct categories and brands, from the few distinct pairs of a client; from fact
    lines or `client_orders`."""
    orders = _orders(until(fact, "ordered_on", cutoff))
    pairs = orders.select("client_id", F.explode("seen").alias("s")).select("client_id", "s.*").distinct()
    return pairs.groupBy("client_id").agg(
        F.countDistinct("category").alias("distinct_categories"),
        F.countDistinct("brand").alias("distinct_brands"),
    )


def visit_features(visits: DataFrame, cutoff: str, recent_days: int = RECENT_DAYS) -> DataFrame:
    return until(visits, "visited_on", cutoff).groupBy("client_id").agg(
        F.count_if(_recent("visited_on", cutoff, recent_days)).alias("recent_visits"),
        F.datediff(day(cutoff), F.max("visited_on")).alias("days_since_visit"),
    )


def opportunity_features(
    opportunities: DataFrame, cutoff: str, words: Vocabulary = ENGLISH, stage_as_of_cutoff: bool = True
) -> DataFrame:
    """Open opportunities. The stage is today's, so by default one that closed
    after the cutoff still counts as open; `stage_as_of_cutoff=False` goes by the
    stage alone."""
    is_open = ~F.col("stage").isin(*words.closed_stages)
    if stage_as_of_cutoff:
        is_open = is_open | (F.col("closed_on") > day(cutoff))
    return (
        until(opportunities, "opened_on", cutoff)
        .where(is_open)
        .groupBy("client_id")
        .agg(F.count(F.lit(1)).alias("open_opportunities"))
    )


def label_buys_next(
    fact: DataFrame, cutoff: str, horizon_days: int, includes_cutoff: bool = False
) -> DataFrame:
    """Clients who order within the horizon. By default the window starts the day
    after the cutoff, so that no day is both feature and label."""
    start = day(cutoff) if includes_cutoff else F.date_add(day(cutoff), 1)
    window = before(since(fact, "ordered_on", start), "ordered_on", F.date_add(start, horizon_days))
    return window.select("client_id").distinct().withColumn(LABEL, F.lit(1))


def client_features(
    fact: DataFrame, visits: DataFrame, opportunities: DataFrame, clients: DataFrame, cutoff: str,
    recent_days: int = RECENT_DAYS, words: Vocabulary = ENGLISH, stage_as_of_cutoff: bool = True,
) -> DataFrame:
    """One row per client with a sale up to the cutoff, from fact lines or
    `client_orders`. Orders and variety share one scan and shuffle of the fact."""
    profile = clients.select("client_id", "segment", "registered_on")
    joined = (
        order_features(fact, cutoff, recent_days)
        .join(variety_features(fact, cutoff), "client_id", "left")
        .join(visit_features(visits, cutoff, recent_days), "client_id", "left")
        .join(opportunity_features(opportunities, cutoff, words, stage_as_of_cutoff), "client_id", "left")
        .join(profile, "client_id", "left")
    )
    last = day(cutoff)
    cycle = F.when(
        F.col("order_count") > 1,
        F.datediff("last_order_on", "first_order_on").cast("double") / (F.col("order_count") - 1),
    )
    revenue = F.col("revenue_total").cast("double")
    recent_revenue = F.col("recent_revenue").cast("double")
    return (
        joined.withColumns({
            "recency_days": F.datediff(last, "last_order_on"),
            "cycle_days": cycle,
            "mean_ticket": safe_ratio(revenue, F.col("order_count")),
            "days_since_first_order": F.datediff(last, "first_order_on"),
            "days_since_registration": F.datediff(last, "registered_on"),
            "recent_share_pct": F.when(revenue > 0, 100 * recent_revenue / revenue),
            "return_rate_pct": safe_ratio(100 * F.col("returned").cast("double"), F.col("lines")),
            "recent_visits": F.coalesce("recent_visits", F.lit(0)),
            "open_opportunities": F.coalesce("open_opportunities", F.lit(0)),
            "multichannel": F.coalesce(F.col("first_channel") != F.col("last_channel"), F.lit(False)),
        })
        .withColumns({
            "overdue_ratio": F.when(F.col("cycle_days") > 0, F.col("recency_days") / F.col("cycle_days")),
            "revenue_total": revenue,
            "recent_revenue": recent_revenue,
            "units": F.col("units").cast("bigint"),
        })
        .select(*FEATURE_COLUMNS, last.alias("cutoff"))
    )


def features_train(
    fact: DataFrame, visits: DataFrame, opportunities: DataFrame, clients: DataFrame, cutoff: str,
    horizon_days: int, label_includes_cutoff: bool = False, **options,
) -> DataFrame:
    """Features and label, from fact lines or `client_orders`. Fact lines are made into
    orders, and written, first, so that the fact is read once."""
    orders = fact if "seen" in fact.columns else materialize(client_orders(up_to_label(fact, [cutoff], horizon_days)), "orders")
    features = client_features(orders, visits, opportunities, clients, cutoff, **options)
    label = label_buys_next(orders, cutoff, horizon_days, label_includes_cutoff)
    return features.join(label, "client_id", "left").withColumn(
        LABEL, F.coalesce(LABEL, F.lit(0)).cast("int")
    )


def base_rate(train: DataFrame) -> DataFrame:
    return train.agg(F.avg(LABEL).alias("base_rate"))
