"""Raw ERP/CRM shapes derived by formula from the benchmark tables, with the
dirt the cleaning rules are there for. Every column is text, as if read from a
landing file."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Events lie in 2024-01; they are moved back to the last month of the orders.
EVENT_SHIFT_MONTHS = 270


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _text(c: Column) -> Column:
    return c.cast("string")


def _price(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _pick(c: Column, *choices: str) -> Column:
    """choices[c]; c is a small non-negative number."""
    return F.element_at(F.array(*[F.lit(x) for x in choices]), (c + 1).cast("int"))


def _slashed(date: Column) -> Column:
    return F.date_format(date, "dd/MM/yyyy")


def _reps(spark: SparkSession, folder: str) -> Column:
    return table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()


def _returned() -> Column:
    return (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)


def _signed_quantity(returned: Column) -> Column:
    return F.col("l_quantity").cast("int") * F.when(returned, -1).otherwise(1)


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), _price(F.col("p_retailprice")).alias("price"))


def product_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    share = F.element_at(
        F.array(*[F.lit(x).cast("decimal(3,2)") for x in ("0.40", "0.45", "0.50", "0.55", "0.60")]),
        (key % 5 + 1).cast("int"),
    )
    launch = F.date_add(F.lit("1999-01-01").cast("date"), (key % 700).cast("int"))
    return table(spark, folder, "part").select(
        _text(key).alias("sku"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        _text(F.col("p_size")).alias("note"),
        _text(_price(F.col("p_retailprice"))).alias("list_price"),
        _text((_price(F.col("p_retailprice")) * share).cast("decimal(18,2)")).alias("unit_cost"),
        _pick(F.col("p_size") % 6, "UN", "CX", "KIT", "FR", "PC", "DZ").alias("unit"),
        F.when(key % 10 == 7, "N").otherwise("S").alias("active"),
        F.when(key % 6 == 0, _text(launch)).alias("launched_on"),
    )


def line_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Lines get their price by the sku as text, so that a later join by sku finds them in
    place and does not shuffle them again."""
    prices = _prices(spark, folder).select(_text(F.col("l_partkey")).alias("sku"), "price")
    lines = table(spark, folder, "lineitem").withColumn("sku", _text(F.col("l_partkey")))
    quantity = _signed_quantity(_returned())
    return lines.join(prices, "sku").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "sku", "l_suppkey",
                    F.col("l_quantity").cast("int")).alias("line_id"),
        _text(F.col("l_orderkey")).alias("order_id"),
        "sku",
        _text(quantity).alias("quantity"),
        _text(F.col("price")).alias("unit_price"),
        _text(F.col("l_discount").cast("decimal(9,4)")).alias("discount_pct"),
        _text((quantity * F.col("price")).cast("decimal(18,2)")).alias("gross_value"),
    )


def order_raw(spark: SparkSession, folder: str) -> DataFrame:
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    # A flag goes through the shuffle, not what it is made from.
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", _returned().alias("returned"))
    totals = (
        lines.join(_prices(spark, folder), "l_partkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(_signed_quantity(F.col("returned")) * F.col("price")).cast("decimal(18,2)").alias("total"))
    )
    return table(spark, folder, "orders").join(totals, "o_orderkey", "left").select(
        _text(key).alias("order_id"),
        _text(F.col("o_custkey")).alias("client_id"),
        _text(F.col("o_custkey") % _reps(spark, folder)).alias("rep_id"),
        F.when(key % 2 == 0, _text(date)).otherwise(_slashed(date)).alias("ordered_on"),
        F.col("o_orderpriority").alias("channel"),
        F.when((F.col("o_orderstatus") == "P") & (key % 4 == 0), "Cancelled")
        .otherwise("Invoiced").alias("status"),
        _text(F.coalesce("total", F.lit(0).cast("decimal(18,2)"))).alias("total_value"),
    )


def client_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    number = key + 1 - F.when(key % 20 == 19, 1).otherwise(0)
    d = F.lpad(_text(number), 14, "0")
    masked = F.concat(
        d.substr(1, 2), F.lit("."), d.substr(3, 3), F.lit("."), d.substr(6, 3), F.lit("/"),
        d.substr(9, 4), F.lit("-"), d.substr(13, 2),
    )
    since = F.date_add(F.lit("1994-01-01").cast("date"), ((key * 7) % 365).cast("int"))
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .join(region, "n_regionkey")
        .select(
            _text(key).alias("client_id"),
            F.when(key % 3 == 0, F.concat(F.lit(" "), _text(number), F.lit(" ")))
            .when(key % 3 == 1, masked).otherwise(d).alias("tax_id"),
            F.concat(F.upper("c_mktsegment"), F.lit("  client "), _text(key)).alias("legal_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.concat(F.lit("District "), _text(key % 30)).alias("district"),
            F.when(key % 2 == 0, _text(since)).otherwise(_slashed(since)).alias("registered_on"),
            F.when(key % 11 == 5, "N").otherwise("S").alias("active"),
        )
    )


def rep_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    hired = F.date_add(F.lit("1994-01-01").cast("date"), (key % 300).cast("int"))
    return (
        table(spark, folder, "supplier")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .select(
            _text(key).alias("rep_id"),
            F.concat(F.lit("Rep "), _text(key - F.when(key % 10 == 9, 9).otherwise(0))).alias("rep_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("state"),
            _text(hired).alias("hired_on"),
            F.when(key % 7 == 3, "2001-05-01").alias("terminated_on"),
            _text((20000 + (key % 5) * 5000).cast("decimal(18,2)")).alias("monthly_target"),
        )
    )


def portfolio_raw(spark: SparkSession, folder: str) -> DataFrame:
    key, reps = F.col("c_custkey"), _reps(spark, folder)
    customer = table(spark, folder, "customer").select("c_custkey")
    first = customer.select(
        F.concat(F.lit("a"), _text(key)).alias("portfolio_id"),
        _text(key).alias("client_id"),
        _text(key % reps).alias("rep_id"),
        F.lit("2000-01-01").alias("started_on"),
        F.when(key % 12 == 5, "2001-01-01").alias("ended_on"),
    )
    second = customer.where((key % 12 == 5) | (key % 40 == 0)).select(
        F.concat(F.lit("b"), _text(key)).alias("portfolio_id"),
        _text(key).alias("client_id"),
        _text((key + 1) % reps).alias("rep_id"),
        F.lit("2001-01-02").alias("started_on"),
        F.lit(None).cast("string").alias("ended_on"),
    )
    return first.unionByName(second)


def _moved() -> Column:
    return F.add_months(F.col("ts").cast("date"), -EVENT_SHIFT_MONTHS)


def visit_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, folder, "events").where("event_type = 'view'").select(
        _text(key).alias("visit_id"),
        _text(F.col("user_id")).alias("client_id"),
        _text(F.col("user_id") % _reps(spark, folder)).alias("rep_id"),
        _text(_moved()).alias("visited_on"),
        _pick(key % 3, "Order", "No order", "Absent").alias("result"),
        F.when(key % 50 == 0, "n/a").otherwise(_text(key % 120)).alias("duration_min"),
    )


def opportunity_raw(spark: SparkSession, folder: str) -> DataFrame:
    key, date = F.col("event_id"), _moved()
    closed = key % 6 >= 4
    return table(spark, folder, "events").where("event_type = 'signup'").select(
        _text(key).alias("opportunity_id"),
        _text(F.col("user_id")).alias("client_id"),
        _text(F.col("user_id") % _reps(spark, folder)).alias("rep_id"),
        _pick(key % 4, "Referral", "Fair", "Site", "Cold call").alias("origin"),
        _text(date).alias("opened_on"),
        _pick(key % 6, "Prospecting", "Qualification", "Proposal", "Negotiation",
              "Closed won", "Closed lost").alias("stage"),
        F.when(key % 25 == 0, "?").otherwise(_text((key % 11) * 10)).alias("probability_pct"),
        _text(_price(F.col("value"))).alias("estimated_value"),
        F.when(closed, _text(F.date_add(date, (key % 20).cast("int")))).alias("closed_on"),
        F.when(closed, _text(key % 20)).alias("cycle_days"),
        F.when(key % 6 == 5, "Price").alias("loss_reason"),
    )


def payment_raw(spark: SparkSession, folder: str) -> DataFrame:
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    amount = _price(F.col("o_totalprice"))
    late = F.date_add(date, (31 + key % 14).cast("int"))
    paid = F.when(key % 5 == 0, late).when(key % 5 != 1, F.date_add(date, 30))
    return table(spark, folder, "orders").select(
        _text(key).alias("payment_id"),
        _text(key).alias("order_id"),
        _pick(key % 3, "Slip", "Card", "Transfer").alias("method"),
        F.when(key % 40 == 0, "x").otherwise(_text(1 + key % 6)).alias("installments"),
        _text(amount).alias("amount"),
        _text((key % 5).cast("decimal(9,4)")).alias("fee_pct"),
        _text((amount - ((key % 7) * 10).cast("decimal(18,2)")).cast("decimal(18,2)")).alias("net_amount"),
        _text(F.date_add(date, 30)).alias("due_on"),
        _text(paid).alias("paid_on"),
        F.when(key % 5 == 0, "Paid late").when(key % 5 == 1, "Open").otherwise("Paid").alias("payment_status"),
    )


def stock_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _text(F.col("l_shipdate").cast("date")).alias("snapshot_on"),
        _text(F.col("l_partkey")).alias("sku"),
        _text((F.col("l_orderkey") + F.col("l_partkey")) % 9).alias("balance"),
    )


def trip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("pickup_zip"), _price(F.col("value")).alias("fare_amount")
    )


def marketplace_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _text(F.col("o_orderkey")).alias("customer_id"),
        _text(F.col("o_custkey")).alias("person_id"),
        _text(F.col("o_custkey") % 97).alias("zip_raw"),
    )


def marketplace_review(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    first = key - F.when(key % 10 == 9, 1).otherwise(0)
    return table(spark, folder, "orders").select(
        F.concat(F.lit("r"), _text(first)).alias("review_id"),
        _text(key).alias("order_id"),
        (1 + key % 5).cast("int").alias("score"),
        F.when(key % 50 == 0, "bad").otherwise(_text(F.col("o_orderdate").cast("date"))).alias("reviewed_at"),
    )


def marketplace_geo(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        _text(F.col("event_id") % 97).alias("zip_raw"),
        _price(F.col("value")).alias("lat"),
        _price(F.col("user_id")).alias("lng"),
    )


RAW = {
    "product": product_raw,
    "order": order_raw,
    "line": line_raw,
    "payment": payment_raw,
    "stock": stock_raw,
    "client": client_raw,
    "rep": rep_raw,
    "portfolio": portfolio_raw,
    "opportunity": opportunity_raw,
    "visit": visit_raw,
}
