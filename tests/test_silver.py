"""Cleaning and typing rules on small dirty frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.functions import columns as c
from mercato.operators import skew
from mercato.operators.checks import CheckFailed, enforce, row_rules, violations
from mercato.plans import gold, silver

CLIENT = "client_id tax_id legal_name segment city state district registered_on active"


def client(i, tax_id, since="2020-01-01", name="ACME  corp"):
    return (i, tax_id, name, "S", "C", "ST", "D", since, "S")


@pytest.fixture()
def dirty_clients(rows):
    return rows(
        CLIENT,
        client("1", "12.345.678/0001-95", "2021-05-01"),
        client("2", " 12345678000195 ", "03/02/2020"),
        client("3", "12345678000195", "not a date"),
        client("4", None), client("5", None),
        client("6", "77"),
        client("10", "88", "2020-01-01"), client("9", "88", "2020-01-01"),
    )


def test_oldest_readable_registration_survives_and_lists_the_rest(dirty_clients):
    clients, merges = silver.client_tables(dirty_clients)
    kept = {r["client_id"]: r for r in clients.collect()}
    # Ids are text, so '10' comes before '9'.
    assert set(kept) == {"2", "4", "5", "6", "10"}
    assert kept["2"]["merged_count"] == 2
    assert kept["2"]["registered_on"] == dt.date(2020, 2, 3)
    assert kept["2"]["legal_name"] == "Acme Corp"
    assert kept["6"]["tax_id"] == "00000000000077" and kept["6"]["merged_count"] == 0
    assert kept["4"]["source_rows"] == 8
    assert sorted((r["merged_id"], r["client_id"]) for r in merges.collect()) == [("1", "2"), ("3", "2"), ("9", "10")]


def test_a_shared_tax_id_keeps_every_id(rows):
    raw = rows(CLIENT, *[client(str(i), "5") for i in range(20_000)])
    clients, merges = silver.client_tables(raw)
    (kept,) = clients.collect()
    assert kept["merged_count"] == 19_999
    assert merges.select("merged_id").distinct().count() == 19_999
    assert merges.where(merges["client_id"] == kept["client_id"]).count() == 19_999


def test_a_hot_tax_id_is_seen_and_kept_whole(rows):
    raw = rows(CLIENT, *[client(str(i), "5" if i % 3 == 0 else str(100 + i)) for i in range(300)])
    assert list(skew.hot_keys(silver.typed_clients(raw), "same_as")["same_as"].shares) == ["00000000000005"]
    assert silver.client_merges(raw).count() == 99


def test_orders(rows):
    raw = rows(
        "order_id client_id rep_id ordered_on channel status total_value",
        ("1", "a", "r", "2024-02-29", "App", "Cancelled", "10.5"),
        ("2", "a", "r", "29/02/2024", "App", "Invoiced", "-3.10"),
        ("3", "a", "r", "31/02/2024", "App", None, "7"),
    )
    got = {r["order_id"]: r for r in silver.silver_orders(raw).collect()}
    assert got["1"]["cancelled"] and got["1"]["net_value"] == 0 and got["1"]["total_value"] == Decimal("10.50")
    assert got["2"]["ordered_on"] == dt.date(2024, 2, 29) and (got["2"]["year"], got["2"]["month"]) == (2024, 2)
    assert got["3"]["ordered_on"] is None and got["3"]["cancelled"] is False
    counts = violations(silver.silver_orders(raw), row_rules()["orders"]).first()
    assert counts["order_date"] == 1 and counts["cancelled_zero"] == 0
    with pytest.raises(CheckFailed, match=r"order_date \(1\)"):
        enforce(silver.silver_orders(raw), row_rules()["orders"])


def test_malformed_money_stops_the_run(rows):
    raw = rows("order_id client_id rep_id ordered_on channel status total_value",
               ("1", "a", "r", "2024-01-01", "App", "Invoiced", "ten"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.silver_orders(raw).collect()


def test_lines_mark_returns_and_discontinued_products(rows):
    products = silver.silver_products(rows(
        "sku title category brand note list_price unit_cost unit active launched_on",
        ("A", "t", "c", "b", "n", "1", "1", "u", "S", ""), ("B", "t", "c", "b", "n", "1", "1", "u", "N", "2024-01-05"),
    ))
    assert [r["launched_on"] for r in products.orderBy("sku").collect()] == [None, dt.date(2024, 1, 5)]
    raw = rows(
        "line_id order_id sku quantity unit_price discount_pct gross_value",
        ("1", "o", "A", "-2", "1", "0", "-2"), ("2", "o", "B", "3", "1", "0", "3"),
        ("3", "o", "Z", "x", "1", "0", "0"), ("4", "o", None, "0", "1", "0", "0"),
    )
    lines = silver.silver_lines(raw, products)
    got = {r["line_id"]: r for r in lines.collect()}
    assert (got["1"]["quantity"], got["1"]["abs_quantity"], got["1"]["is_return"]) == (-2, 2, True)
    assert got["2"]["sku_discontinued"] and not got["3"]["sku_discontinued"] and not got["4"]["sku_discontinued"]
    assert got["3"]["quantity"] is None and got["3"]["is_return"] is None
    # A missing quantity breaks the rule as zero does.
    assert violations(lines, row_rules()["lines"]).first()["quantity_positive"] == 2


def test_portfolio_of_a_rep_who_left_is_marked(rows):
    reps = silver.silver_reps(rows(
        "rep_id rep_name region state hired_on terminated_on monthly_target",
        ("1", "n", "r", "s", "2020-01-01", None, "1"), ("2", "n", "r", "s", "2020-01-01", "2021-01-01", "1"),
    ))
    raw = rows(
        "portfolio_id client_id rep_id started_on ended_on",
        ("a", "c", "1", "2020-01-01", None), ("b", "c", "2", "2020-01-01", None),
        ("c", "c", "1", "2020-01-01", "whenever"), ("d", "c", "9", "2020-01-01", None),
    )
    got = {r["portfolio_id"]: (r["current"], r["orphaned"], r["ended_on"]) for r in silver.silver_portfolio(raw, reps).collect()}
    assert got == {"a": (True, False, None), "b": (False, True, None), "c": (False, False, None), "d": (True, False, None)}


def test_expressions(rows):
    df = rows("t", ("  a  B ",), ("x_y",), (None,))
    out = df.select(
        c.clean_name(F.col("t")).alias("n"), c.contains_term([F.col("t")], "_Y").alias("hit"),
        c.tax_id_digits(F.lit("a1-2")).alias("d"), c.clean_zip(F.lit("12")).alias("z"),
    ).collect()
    assert [r["n"] for r in out] == [" A B ", "X_y", None]
    assert [r["hit"] for r in out] == [False, True, False]
    assert out[0]["d"] == 2 and out[0]["z"] == "00012"


def test_ratios_round_halves_up_and_survive_zero(spark):
    df = spark.sql("SELECT CAST(317250.60 AS DECIMAL(38,2)) a, 120 b, 0 z")
    got = df.select(
        c.money_ratio(F.col("a"), F.col("b"), 2).alias("r"), c.money_ratio(F.col("a"), F.col("z"), 2).alias("n"),
        c.pct_ratio(F.col("b"), F.col("z")).alias("p"),
    ).first()
    assert tuple(got) == (2643.76, None, None)


def test_fail_if(spark):
    one = spark.range(1)
    assert one.select(c.fail_if(F.col("id") > 0, "boom").alias("x")).first()["x"] == "ok"
    with pytest.raises(Exception, match="boom"):
        one.select(c.fail_if(F.col("id") == 0, "boom").alias("x")).collect()


def test_date_spine_over_nothing(rows, spark):
    empty = spark.createDataFrame([], "d date")
    assert gold.date_spine(empty, "d").count() == 0
