"""Star schema and marts. Input: typed tables, never raw ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import MONEY, banded, day, pct_ratio, money_ratio, total
from mercato.operators.running import running_total
from mercato.operators.skew import hot_keys, salted_join
from mercato.parameters import ABC_LIMITS, PEAK_MONTHS
from mercato.session import materialize
from mercato.vocabulary import ENGLISH, Vocabulary

BUYER_COLUMNS = ("client_id", "legal_name", "segment", "city")


def id_map(clients: DataFrame, merges: DataFrame) -> DataFrame:
    """(source_id, client_id): every id ever used and the client it means now."""
    own = clients.select(F.col("client_id").alias("source_id"), "client_id")
    return own.unionByName(merges.select(F.col("merged_id").alias("source_id"), "client_id"))


def buyers(clients: DataFrame, merges: DataFrame) -> DataFrame:
    """Client attributes under every id ever used. Merged ids bring the attributes
    of their client along, so this is a union without a join."""
    own = clients.select(F.col("client_id").alias("source_id"), *BUYER_COLUMNS)
    return own.unionByName(merges.select(F.col("merged_id").alias("source_id"), *BUYER_COLUMNS))


def dim_client(clients: DataFrame, merges: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Orders are added up per source id before ids are resolved, so neither join
    nor shuffle sees more than one row per id and map task."""
    bought = F.when(~F.col("cancelled"), F.col("ordered_on"))
    per_source = orders.groupBy(F.col("client_id").alias("source_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("net_value").alias("value"),
        F.min(bought).alias("first"),
        F.max(bought).alias("last"),
    )
    per_client = (
        per_source.join(id_map(clients, merges), "source_id")
        .groupBy("client_id")
        .agg(
            F.sum("n").alias("total_orders"),
            total(F.col("value")).alias("net_revenue"),
            F.min("first").alias("first_order_on"),
            F.max("last").alias("last_order_on"),
        )
    )
    return clients.join(per_client, "client_id", "left").select(
        "client_id", "tax_id", "legal_name", "segment", "city", "state", "registered_on",
        "first_order_on", "last_order_on",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("net_revenue", F.lit(0).cast("decimal(38,2)")).alias("net_revenue"),
        F.datediff(day(as_of), "last_order_on").alias("days_since_order"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "sku", "title", "brand", "category", "note", "unit_cost", "list_price", "launched_on",
        (~F.col("active")).alias("discontinued"),
    )


def dim_rep(reps: DataFrame) -> DataFrame:
    return reps.select(
        "rep_id", "rep_name", "region", "monthly_target",
        F.col("terminated_on").isNull().alias("active"),
    )


def date_spine(df: DataFrame, date: str) -> DataFrame:
    """Every day from the first to the last date found."""
    ends = df.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))


def dim_calendar(orders: DataFrame, peak_months: Sequence[int] = PEAK_MONTHS) -> DataFrame:
    return date_spine(orders, "ordered_on").select(
        "day",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.date_format("day", "MMMM").alias("month_name"),
        F.quarter("day").alias("quarter"),
        F.date_format("day", "EEEE").alias("weekday"),
        F.month("day").isin(*peak_months).alias("peak_month"),
    )


def fact_sales(
    lines: DataFrame, orders: DataFrame, clients: DataFrame, merges: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per line of an order that stands. Returns stay in, negative.

    Orders get their client first, being the smaller side; lines are shuffled once
    per join. Spark splits the partitions of hot products and orders."""
    standing = orders.where(~F.col("cancelled")).select(
        "order_id", F.col("client_id").alias("source_id"), "rep_id", "ordered_on", "year", "month",
        "channel",
    )
    sold = standing.join(buyers(clients, merges), "source_id").drop("source_id")
    catalog = products.select("sku", "category", "brand", "note", "unit_cost")
    priced = lines.select("line_id", "order_id", "sku", "quantity", "unit_price", "is_return").join(catalog, "sku")
    joined = priced.join(sold, "order_id")
    quantity = F.col("quantity")
    return joined.withColumns({
        "revenue": (quantity * F.col("unit_price")).cast(MONEY),
        "cost": (quantity * F.col("unit_cost")).cast(MONEY),
    }).select(
        "line_id", "order_id", "ordered_on", "year", "month", "channel", "client_id", "legal_name",
        "segment", "city", "rep_id", "sku", "category", "brand", "note", "quantity", "unit_price",
        "revenue", "cost", (F.col("revenue") - F.col("cost")).cast(MONEY).alias("margin"),
        "is_return",
    )


def dropped_lines(lines: DataFrame, orders: DataFrame, fact: DataFrame) -> DataFrame:
    """How many lines of standing orders found no client or product."""
    wanted = orders.where(~F.col("cancelled")).select("order_id")
    expected = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).join(wanted, "order_id")
    kept = fact.agg(F.count(F.lit(1))).scalar()
    return expected.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("expected_lines")).select(
        "expected_lines", kept.alias("fact_lines"),
        (F.col("expected_lines") - kept).alias("dropped_lines"),
    )


def rep_months(fact: DataFrame) -> DataFrame:
    """Sums of each rep and month. Lines become one row per order first, then per client,
    so that both distinct counts are plain counts and no row of the fact is copied."""
    month = ["rep_id", "year", "month"]
    added = [total(F.col("revenue")).alias("revenue"), total(F.col("margin")).alias("margin")]
    orders = fact.groupBy(*month, "client_id", "order_id").agg(*added)
    clients = orders.groupBy(*month, "client_id").agg(*added, F.count("order_id").alias("orders"))
    return clients.groupBy(*month).agg(
        *added, F.count("client_id").alias("clients"), F.sum("orders").alias("orders")
    )


def rep_mart(months: DataFrame, reps: DataFrame) -> DataFrame:
    return months.join(reps.select("rep_id", "monthly_target"), "rep_id").select(
        "rep_id", "year", "month", "revenue", "margin", "monthly_target",
        money_ratio(F.col("revenue"), F.col("monthly_target"), 3).alias("attainment"),
        "clients",
        money_ratio(F.col("revenue"), F.col("orders"), 2).alias("ticket"),
    )


def mart_rep_month(fact: DataFrame, reps: DataFrame) -> DataFrame:
    return rep_mart(rep_months(fact), reps)


def product_months(fact: DataFrame, *carried: str) -> DataFrame:
    """Sums of each product and month. `carried` columns are equal in all rows of a product."""
    return fact.groupBy("sku", "year", "month", *carried).agg(
        total(F.col("revenue")).alias("revenue"),
        total(F.col("margin")).alias("margin"),
        F.sum("quantity").cast("bigint").alias("quantity"),
    )


def abc_class(sales: DataFrame, limits: Sequence[float] = ABC_LIMITS) -> DataFrame:
    """(sku, class) by running share of all revenue, largest first. `sales` is
    the fact or any frame with sku and revenue. The product that crosses a limit
    falls into the next class. Ties by sku."""
    per_sku = sales.groupBy("sku").agg(total(F.col("revenue")).alias("sku_revenue"))
    run = running_total(per_sku, "sku_revenue", ["-sku_revenue", "sku"], "upto", total_into="all")
    everything = F.col("all").cast("double")
    share = F.col("upto").cast("double") / F.when(everything != 0, everything)
    return run.select(
        "sku", banded([(share <= limits[0], "A"), (share <= limits[1], "B")], "C").alias("abc_class")
    )


def with_margin(months: DataFrame) -> DataFrame:
    return months.select(
        "sku", "year", "month", "revenue", "margin",
        pct_ratio(F.col("margin"), F.col("revenue")).alias("margin_pct"),
        "quantity", "abc_class",
    )


def product_mart(months: DataFrame, limits: Sequence[float] = ABC_LIMITS) -> DataFrame:
    return with_margin(months.join(abc_class(months, limits), "sku"))


def mart_product_month(fact: DataFrame, limits: Sequence[float] = ABC_LIMITS) -> DataFrame:
    """The mart straight from a fact, which is read a single time: the few columns that it
    needs are written once. Classes come from them first; then rows meet their class by
    product, and are added up where they lie, without a second shuffle. Rows of a hot
    product are spread."""
    rows = materialize(fact.select("sku", "year", "month", "quantity", "revenue", "margin"), "product-rows")
    hot = hot_keys(rows, "sku")["sku"]
    classed = salted_join(rows, abc_class(rows, limits), "sku", ["year", "month", "quantity", "revenue"], hot=hot)
    return with_margin(product_months(classed, "abc_class"))


def mart_receivables(payments: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    late = F.col("payment_status") == words.paid_late
    received = F.col("payment_status").isin(words.paid, words.paid_late)
    days = F.when(late, F.datediff("paid_on", "due_on"))
    return payments.groupBy(
        F.year("due_on").alias("year"), F.month("due_on").alias("month")
    ).agg(
        total(F.col("amount")).alias("amount_due"),
        total(F.when(received, F.col("amount"))).alias("received"),
        money_ratio(F.sum(days), F.count(days), 1).alias("mean_days_late"),
        total(F.col("amount") - F.col("net_amount")).alias("fee_cost"),
    )
