"""Quality tests between layers, each a one-row result."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import total
from mercato.operators.checks import result, zero_result
from mercato.operators.groups import duplicates
from mercato.parameters import REVENUE_TOLERANCE


def _equal_sums(test: str, found: DataFrame, wanted: DataFrame, column: str, other: str) -> DataFrame:
    sums = found.agg(F.coalesce(total(F.col(column)), F.lit(0).cast("decimal(38,2)")).alias("found"))
    expected = wanted.agg(F.coalesce(total(F.col(other)), F.lit(0).cast("decimal(38,2)"))).scalar()
    both = sums.withColumn("wanted", expected)
    near = F.abs(F.col("found") - F.col("wanted")) <= F.lit(REVENUE_TOLERANCE).cast("decimal(3,2)")
    return both.select(*result(test, F.col("found"), F.col("wanted"), near))


def revenue_match(fact: DataFrame, orders: DataFrame) -> DataFrame:
    return _equal_sums("revenue_match", fact, orders, "revenue", "net_value")


def mart_equals_fact(mart: DataFrame, fact: DataFrame) -> DataFrame:
    return _equal_sums("mart_equals_fact", mart, fact, "revenue", "revenue")


def tax_id_unique(clients: DataFrame) -> DataFrame:
    return zero_result(clients.agg(duplicates("tax_id").alias("n")), "tax_id_unique", "n")


def order_date_present(orders: DataFrame) -> DataFrame:
    counts = orders.agg(F.count_if(F.col("ordered_on").isNull()).alias("n"))
    return zero_result(counts, "order_date_present", "n")


def negative_only_returns(fact: DataFrame) -> DataFrame:
    counts = fact.agg(F.count_if((F.col("revenue") < 0) & ~F.col("is_return")).alias("n"))
    return zero_result(counts, "negative_only_returns", "n")


def fact_volume(fact: DataFrame, low: int, high: int) -> DataFrame:
    n = F.col("n")
    return fact.agg(F.count(F.lit(1)).alias("n")).select(
        *result("fact_volume", n, f"{low} to {high}", n.between(low, high))
    )


def _orphan_rows(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent. Rows are counted per key first, so a hot key
    is one row by the time it is joined."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(parents.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def no_orphan_order(fact: DataFrame, orders: DataFrame) -> DataFrame:
    return zero_result(_orphan_rows(fact, orders, "order_id"), "no_orphan_order", "n")


def no_orphan_client(fact: DataFrame, clients: DataFrame) -> DataFrame:
    return zero_result(_orphan_rows(fact, clients, "client_id"), "no_orphan_client", "n")


def tax_id_length(clients: DataFrame) -> DataFrame:
    counts = clients.agg(F.count_if(F.length("tax_id") != 14).alias("n"))
    return zero_result(counts, "tax_id_length", "n")


def suspect_tax_ids(raw_clients: DataFrame) -> DataFrame:
    """Ids with no digit or more than 14: padding and cutting hide both from the
    length test."""
    from mercato.functions.columns import tax_id_digits

    digits = tax_id_digits(F.col("tax_id"))
    counts = raw_clients.agg(F.count_if(~digits.between(1, 14)).alias("n"))
    return zero_result(counts, "suspect_tax_ids", "n")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def dq_report(
    fact: DataFrame, orders: DataFrame, silver_clients: DataFrame, client_dim: DataFrame,
    product_mart: DataFrame, fact_rows: tuple[int, int],
) -> DataFrame:
    tests = [
        revenue_match(fact, orders),
        tax_id_unique(silver_clients),
        order_date_present(orders),
        negative_only_returns(fact),
        fact_volume(fact, *fact_rows),
        no_orphan_order(fact, orders),
        no_orphan_client(fact, silver_clients),
        mart_equals_fact(product_mart, fact),
        tax_id_length(client_dim),
    ]
    return union_all(tests).orderBy("test")


# -- from what was measured while the tables were written -------------------------------

def _sum(column: str) -> Column:
    return F.coalesce(total(F.col(column)), F.lit(0).cast("decimal(38,2)"))


def fact_measures() -> dict[str, Column]:
    return {
        "revenue": _sum("revenue"),
        "rows": F.count(F.lit(1)),
        "negative_sales": F.count_if((F.col("revenue") < 0) & ~F.col("is_return")),
    }


def order_measures() -> dict[str, Column]:
    return {"net_value": _sum("net_value"), "without_date": F.count_if(F.col("ordered_on").isNull())}


def mart_measures() -> dict[str, Column]:
    return {"revenue": _sum("revenue")}


def client_measures() -> dict[str, Column]:
    return {"wrong_length": F.count_if(F.length("tax_id") != 14)}


def measured(table: DataFrame, noted: Mapping[str, str], measures: Mapping[str, Column]) -> dict[str, str]:
    """The noted measures; taken from the table where they were not noted."""
    if set(measures) <= set(noted):
        return {k: noted[k] for k in measures}
    row = table.agg(*[m.alias(k) for k, m in measures.items()]).first()
    return {k: str(row[k]) for k in measures}


def _orphans(keys: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    per_key = keys.groupBy(key).agg(F.sum("n").alias("n"))
    left = per_key.join(parents.select(key), key, "left_anti")
    return zero_result(left.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), f"no_orphan_{key.removesuffix('_id')}", "n")


def measured_report(
    noted: Mapping[str, Mapping[str, str]], fact: DataFrame, orders: DataFrame, silver_clients: DataFrame,
    client_dim: DataFrame, product_mart: DataFrame, fact_rows: tuple[int, int],
) -> DataFrame:
    """The rows of `dq_report`. Sums, counts and violations come from `noted`, the
    measures of `fact`, `orders`, `clients` and `mart` as taken while these were written.
    Only the keys of the fact are read, once, for both orphan tests."""
    known = {
        "fact": measured(fact, noted.get("fact", {}), fact_measures()),
        "orders": measured(orders, noted.get("orders", {}), order_measures()),
        "mart": measured(product_mart, noted.get("mart", {}), mart_measures()),
        "clients": measured(client_dim, noted.get("clients", {}), client_measures()),
    }
    one = fact.sparkSession.range(1)

    def money(table: str, name: str) -> Column:
        return F.lit(known[table][name]).cast("decimal(38,2)")

    def equal(test: str, found: Column, wanted: Column) -> DataFrame:
        near = F.abs(found - wanted) <= F.lit(REVENUE_TOLERANCE).cast("decimal(3,2)")
        return one.select(*result(test, found, wanted, near))

    def none(test: str, table: str, name: str) -> DataFrame:
        return zero_result(one.select(F.lit(known[table][name]).cast("bigint").alias("n")), test, "n")

    low, high = fact_rows
    rows = F.lit(known["fact"]["rows"]).cast("bigint")
    keys = fact.groupBy("order_id", "client_id").agg(F.count(F.lit(1)).alias("n"))
    tests = [
        equal("revenue_match", money("fact", "revenue"), money("orders", "net_value")),
        equal("mart_equals_fact", money("mart", "revenue"), money("fact", "revenue")),
        none("order_date_present", "orders", "without_date"),
        none("negative_only_returns", "fact", "negative_sales"),
        none("tax_id_length", "clients", "wrong_length"),
        one.select(*result("fact_volume", rows, f"{low} to {high}", rows.between(low, high))),
        tax_id_unique(silver_clients),
        _orphans(keys, orders, "order_id"),
        _orphans(keys, silver_clients, "client_id"),
    ]
    return union_all(tests).orderBy("test")
