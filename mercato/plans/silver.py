"""Typed, cleaned and deduplicated tables. Input: raw frames, every column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import (
    MONEY, clean_name, clean_tax_id, flag_from_code, lenient, money, parse_date_iso,
    parse_date_multi, rate, stamped, whole,
)
from mercato.operators.skew import salted_join
from mercato.vocabulary import ENGLISH, Vocabulary

def typed_clients(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    """Cleaned, not yet deduplicated. `same_as` is what makes two rows one client:
    the tax id, or the row itself if it has none."""
    return raw.select(
        "client_id",
        clean_tax_id(F.col("tax_id")).alias("tax_id"),
        clean_name(F.col("legal_name")).alias("legal_name"),
        "segment", "city", "state", "district",
        parse_date_multi(F.col("registered_on")).alias("registered_on"),
        flag_from_code(F.col("active"), words.yes).alias("active"),
    ).withColumn("same_as", F.coalesce("tax_id", F.concat(F.lit("client "), "client_id")))


def client_groups(typed: DataFrame) -> DataFrame:
    """(same_as, kept, rows): the oldest registration of each client, unreadable
    dates last, and how many rows it stands for. Combined before the shuffle, so
    it does not matter how many rows share a tax id."""
    age = F.struct(F.col("registered_on").isNull(), "registered_on", "client_id")
    row = F.struct(*[c for c in typed.columns if c != "same_as"])
    return typed.groupBy("same_as").agg(
        F.min_by(row, age).alias("kept"), F.count(F.lit(1)).alias("rows")
    )


def survivors(typed: DataFrame, carried: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clients, merges) of typed rows. Clients: one row each, with the number of ids
    merged into it. Merges: one row per merged-away id, with what the sales table needs
    of the client. A group may have any number of ids, so they are rows and no array.
    `carried` columns, equal in all rows of a client, stay with both."""
    groups = client_groups(typed)
    kept = [F.col(f"kept.{c}") for c in ("client_id", "legal_name", "segment", "city", *carried)]
    merged = groups.where("rows > 1").select("same_as", *kept, F.col("rows").alias("merged_rows"))
    ids = typed.select("same_as", F.col("client_id").alias("merged_id"))
    merges = (
        salted_join(ids, merged, "same_as", ["merged_id"])
        .where("merged_id <> client_id")
        .select("merged_id", "client_id", "legal_name", "segment", "city", "merged_rows", *carried)
    )
    clients = groups.select("kept.*", "rows").select(
        "client_id", "tax_id", "legal_name", "segment", "city", "state", "district",
        "registered_on", "active", (F.col("rows") - 1).alias("merged_count"), *carried,
    )
    return clients, merges


def client_tables(raw: DataFrame, words: Vocabulary = ENGLISH) -> tuple[DataFrame, DataFrame]:
    """(clients, merges) of raw rows."""
    clients, merges = survivors(typed_clients(raw, words))
    return stamped(clients, raw), merges


def silver_clients(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    return client_tables(raw, words)[0]


def client_merges(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    return client_tables(raw, words)[1]


def silver_orders(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    typed = raw.withColumns({
        "ordered_on": parse_date_multi(F.col("ordered_on")),
        "total_value": money(F.col("total_value")),
        "cancelled": F.coalesce(F.col("status") == words.cancelled, F.lit(False)),
    })
    return stamped(
        typed.select(
            "order_id", "client_id", "rep_id", "ordered_on", "channel", "status", "total_value",
            "cancelled",
            F.when(F.col("cancelled"), F.lit(0).cast(MONEY)).otherwise(F.col("total_value")).alias("net_value"),
            F.year("ordered_on").alias("year"),
            F.month("ordered_on").alias("month"),
        ),
        raw,
    )


def silver_products(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    return stamped(
        raw.select(
            "sku", "title", "category", "brand", "note",
            money(F.col("list_price")).alias("list_price"),
            money(F.col("unit_cost")).alias("unit_cost"),
            "unit",
            flag_from_code(F.col("active"), words.yes).alias("active"),
            parse_date_iso(F.col("launched_on")).alias("launched_on"),
        ),
        raw,
    )


def typed_lines(raw: DataFrame) -> DataFrame:
    """Order lines without the product flag; a return keeps its negative sign."""
    quantity = whole(F.col("quantity"))
    return raw.select(
        "line_id", "order_id", "sku",
        quantity.alias("quantity"),
        F.abs(quantity).alias("abs_quantity"),
        (quantity < 0).alias("is_return"),
        money(F.col("unit_price")).alias("unit_price"),
        rate(F.col("discount_pct")).alias("discount_pct"),
        money(F.col("gross_value")).alias("gross_value"),
    )


def silver_lines(raw: DataFrame, products: DataFrame) -> DataFrame:
    status = products.select("sku", (~F.col("active")).alias("sku_discontinued"))
    flagged = salted_join(typed_lines(raw), status, "sku", ["line_id"], "left")
    columns = [c for c in typed_lines(raw).columns]
    return stamped(
        flagged.select(
            *columns, F.coalesce("sku_discontinued", F.lit(False)).alias("sku_discontinued")
        ),
        raw,
    )


def silver_reps(raw: DataFrame) -> DataFrame:
    return stamped(
        raw.select(
            "rep_id", "rep_name", "region", "state",
            parse_date_iso(F.col("hired_on")).alias("hired_on"),
            parse_date_iso(F.col("terminated_on")).alias("terminated_on"),
            money(F.col("monthly_target")).alias("monthly_target"),
        ),
        raw,
    )


def silver_visits(raw: DataFrame) -> DataFrame:
    return stamped(
        raw.select(
            "visit_id", "client_id", "rep_id",
            parse_date_iso(F.col("visited_on")).alias("visited_on"),
            "result",
            whole(F.col("duration_min")).alias("duration_min"),
        ),
        raw,
    )


def silver_payments(raw: DataFrame) -> DataFrame:
    return stamped(
        raw.select(
            "payment_id", "order_id", "method",
            whole(F.col("installments")).alias("installments"),
            money(F.col("amount")).alias("amount"),
            rate(F.col("fee_pct")).alias("fee_pct"),
            money(F.col("net_amount")).alias("net_amount"),
            parse_date_iso(F.col("due_on")).alias("due_on"),
            parse_date_iso(F.col("paid_on")).alias("paid_on"),
            "payment_status",
        ),
        raw,
    )


def silver_portfolio(raw: DataFrame, reps: DataFrame) -> DataFrame:
    """Open rows of a rep who left are marked, not repaired. Any end text closes a
    row, readable or not."""
    gone = reps.select("rep_id", F.col("terminated_on").isNotNull().alias("rep_gone"))
    joined = salted_join(raw, gone, "rep_id", ["portfolio_id"], "left")
    is_open = F.col("ended_on").isNull()
    rep_gone = F.coalesce("rep_gone", F.lit(False))
    return stamped(
        joined.select(
            "portfolio_id", "client_id", "rep_id",
            parse_date_iso(F.col("started_on")).alias("started_on"),
            parse_date_iso(F.col("ended_on")).alias("ended_on"),
            (is_open & ~rep_gone).alias("current"),
            (is_open & rep_gone).alias("orphaned"),
        ),
        raw,
    )


def silver_opportunities(raw: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    return stamped(
        raw.select(
            "opportunity_id", "client_id", "rep_id", "origin",
            parse_date_iso(F.col("opened_on")).alias("opened_on"),
            "stage",
            (F.col("stage") == words.stage_won).alias("won"),
            (F.col("stage") == words.stage_lost).alias("lost"),
            lenient(F.col("probability_pct"), "decimal(9,4)").alias("probability_pct"),
            money(F.col("estimated_value")).alias("estimated_value"),
            parse_date_iso(F.col("closed_on")).alias("closed_on"),
            whole(F.col("cycle_days")).alias("cycle_days"),
            "loss_reason",
        ),
        raw,
    )


def silver_stock(raw: DataFrame) -> DataFrame:
    balance = whole(F.col("balance"))
    return stamped(
        raw.select(
            parse_date_iso(F.col("snapshot_on")).alias("snapshot_on"),
            "sku",
            balance.alias("balance"),
            (balance == 0).alias("stock_out"),
        ),
        raw,
    )
