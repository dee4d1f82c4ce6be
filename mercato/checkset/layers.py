"""Queries for the typed tables, star schema, marts, views and quality tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checkset.ctes import AS_OF, pct, ratio
from mercato.checkset.registry import Frames, check
from mercato.operators.checks import enforce, row_rules, violations
from mercato.plans import gold, quality, silver, views

STAMP = "processed_at"


@check("silver_clients", "SELECT * FROM clients")
def _(x: Frames):
    return x.clients.drop(STAMP)


@check("client_merges", "SELECT * FROM merges")
def _(x: Frames):
    return x.merges


@check("silver_orders", "SELECT * FROM sales_orders")
def _(x: Frames):
    return x.orders.drop(STAMP)


@check("silver_products", "SELECT * FROM products")
def _(x: Frames):
    return x.products.drop(STAMP)


@check("silver_lines", "SELECT * FROM lines")
def _(x: Frames):
    return silver.silver_lines(x.raw("line"), x.products).drop(STAMP)


@check("silver_reps", "SELECT * FROM reps")
def _(x: Frames):
    return x.reps.drop(STAMP)


@check("silver_visits", "SELECT * FROM visits")
def _(x: Frames):
    return x.visits.drop(STAMP)


@check("silver_payments", "SELECT * FROM payments")
def _(x: Frames):
    return x.payments.drop(STAMP)


@check("silver_portfolio", "SELECT * FROM portfolio")
def _(x: Frames):
    return x.portfolio.drop(STAMP)


@check("silver_opportunities", "SELECT * FROM opportunities")
def _(x: Frames):
    return x.opportunities.drop(STAMP)


@check("silver_stock", "SELECT * FROM stock")
def _(x: Frames):
    return x.stock.drop(STAMP)


@check("process_stamp", "SELECT DISTINCT source_rows FROM visits")
def _(x: Frames):
    return x.visits.where(F.col(STAMP).isNotNull()).select("source_rows").distinct()


# -- row rules ----------------------------------------------------------------

def _one_rule(key: str, table: str, rule: str, frame, sql: str):
    @check(key, sql)
    def _(x: Frames):
        return violations(frame(x), {rule: row_rules()[table][rule]})


_one_rule("check_client_tax_id", "clients", "client_tax_id", lambda x: x.clients,
          "SELECT COUNT(*) FILTER (WHERE NOT COALESCE(length(tax_id) = 14, false)) AS client_tax_id FROM clients")
_one_rule("check_client_date", "clients", "client_date", lambda x: x.clients,
          "SELECT COUNT(*) FILTER (WHERE registered_on IS NULL) AS client_date FROM clients")
_one_rule("check_order_date", "orders", "order_date", lambda x: x.orders,
          "SELECT COUNT(*) FILTER (WHERE ordered_on IS NULL) AS order_date FROM sales_orders")
_one_rule("check_cancelled_zero", "orders", "cancelled_zero", lambda x: x.orders,
          "SELECT COUNT(*) FILTER (WHERE NOT COALESCE(NOT cancelled OR net_value = 0, false)) AS cancelled_zero FROM sales_orders")
_one_rule("check_quantity_positive", "lines", "quantity_positive", lambda x: x.lines,
          "SELECT COUNT(*) FILTER (WHERE NOT COALESCE(abs_quantity > 0, false)) AS quantity_positive FROM lines")


@check("row_rules_broken", """
    SELECT 'client_tax_id' AS rule, COUNT(*) AS violations FROM clients WHERE segment = 'BUILDING' OR segment = 'MACHINERY' OR tax_id IS NULL
    UNION ALL SELECT 'client_date', COUNT(*) FROM clients WHERE segment = 'MACHINERY' OR registered_on IS NULL
    UNION ALL SELECT 'order_date', COUNT(*) FROM sales_orders WHERE month = 3 OR ordered_on IS NULL
    UNION ALL SELECT 'cancelled_zero', COUNT(*) FROM sales_orders WHERE cancelled AND total_value <> 0
    UNION ALL SELECT 'quantity_positive', COUNT(*) FROM lines WHERE abs_quantity IS NULL OR abs_quantity <= 10""")
def _(x: Frames):
    """Every row rule on tables that break it: tax ids too short or missing, dates
    missing, cancelled orders with their value, quantities reduced by ten."""
    segment = F.col("segment")
    clients = x.clients.withColumns({
        "tax_id": F.when(segment == "BUILDING", F.substring("tax_id", 1, 13)).when(segment != "MACHINERY", F.col("tax_id")),
        "registered_on": F.when(segment != "MACHINERY", F.col("registered_on")),
    })
    orders = x.orders.withColumns({"ordered_on": F.when(F.col("month") != 3, F.col("ordered_on")), "net_value": F.col("total_value")})
    lines = x.lines.withColumn("abs_quantity", F.col("abs_quantity") - 10)
    counted = []
    for table, df in (("clients", clients), ("orders", orders), ("lines", lines)):
        rules = row_rules()[table]
        counts = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules])
        counted.append(violations(df, rules).select(F.inline(counts)))
    return reduce(DataFrame.unionByName, counted)


@check("enforced_orders", "SELECT cancelled, COUNT(*) AS orders FROM sales_orders GROUP BY cancelled")
def _(x: Frames):
    return enforce(x.orders, row_rules()["orders"]).groupBy("cancelled").agg(
        F.count(F.lit(1)).alias("orders")
    )


# -- star schema ------------------------------------------------------------------

@check("dim_client", "SELECT * FROM dimclient")
def _(x: Frames):
    return x.dim_client


@check("dim_product", "SELECT * FROM dimproduct")
def _(x: Frames):
    return x.dim_product


@check("dim_rep", "SELECT * FROM dimrep")
def _(x: Frames):
    return x.dim_rep


@check("dim_calendar", "SELECT * FROM dimcalendar")
def _(x: Frames):
    return x.calendar


@check("fact_sales", "SELECT * FROM fact")
def _(x: Frames):
    return x.fact


@check("dropped_lines", """
    SELECT e AS expected_lines, f AS fact_lines, e - f AS dropped_lines FROM
      (SELECT (SELECT COUNT(*) FROM lines l JOIN sales_orders s ON s.order_id = l.order_id WHERE NOT s.cancelled) AS e,
              (SELECT COUNT(*) FROM fact) AS f)""")
def _(x: Frames):
    return gold.dropped_lines(x.lines, x.orders, x.fact)


@check("mart_rep_month", "SELECT * FROM rep_months")
def _(x: Frames):
    return gold.mart_rep_month(x.fact, x.dim_rep)


@check("abc_class", "SELECT * FROM abc")
def _(x: Frames):
    return gold.abc_class(x.fact)


@check("mart_product_month", "SELECT * FROM product_month")
def _(x: Frames):
    return gold.mart_product_month(x.fact)


@check("mart_receivables", f"""
    SELECT CAST(year(due_on) AS INT) AS year, CAST(month(due_on) AS INT) AS month,
      CAST(SUM(amount) AS DECIMAL(38,2)) AS amount_due,
      CAST(SUM(amount) FILTER (WHERE payment_status IN ('Paid', 'Paid late')) AS DECIMAL(38,2)) AS received,
      {ratio("SUM(paid_on - due_on) FILTER (WHERE payment_status = 'Paid late')",
             "COUNT(paid_on) FILTER (WHERE payment_status = 'Paid late')", 1)} AS mean_days_late,
      CAST(SUM(amount - net_amount) AS DECIMAL(38,2)) AS fee_cost
    FROM payments GROUP BY year(due_on), month(due_on)""")
def _(x: Frames):
    return gold.mart_receivables(x.payments)


# -- views --------------------------------------------------------------------------

@check("monthly_revenue", "SELECT * FROM month_view")
def _(x: Frames):
    return views.monthly_revenue(x.fact, x.calendar)


BRAND_SQL = f"""
    SELECT brand, CAST(r AS DECIMAL(38,2)) AS revenue, {pct('m', 'r')} AS margin_pct,
      {pct('r', 'SUM(r) OVER ()')} AS share_pct
    FROM (SELECT brand, SUM(revenue) AS r, SUM(margin) AS m FROM fact GROUP BY brand)"""


@check("brand_ranking", BRAND_SQL)
def _(x: Frames):
    return views.brand_ranking(x.fact)


@check("category_margin", "SELECT * FROM category_view")
def _(x: Frames):
    return views.category_margin(x.fact)


@check("clients_at_risk", "SELECT * FROM risk_view")
def _(x: Frames):
    return views.clients_at_risk(x.dim_client, AS_OF)


@check("launch_effect", "SELECT * FROM launch_view")
def _(x: Frames):
    return views.launch_effect(x.fact, x.dim_product, AS_OF)


@check("stockout_by_brand", "SELECT * FROM stockout_view")
def _(x: Frames):
    return views.stockout_by_brand(x.stock, x.dim_product)


# -- quality --------------------------------------------------------------------------

LOW, HIGH = 1000, 100_000_000_000


def _test_sql(test: str, value: str, expected: str, passed: str) -> str:
    return (
        f"SELECT '{test}' AS test, CAST({value} AS STRING) AS value,"
        f" CAST({expected} AS STRING) AS expected, {passed} AS passed"
    )


def _zero_sql(test: str, count: str) -> str:
    return _test_sql(test, f"({count})", "'0'", f"({count}) = 0")


def _sums_sql(test: str, found: str, wanted: str) -> str:
    f = f"(SELECT CAST(COALESCE({found}, 0) AS DECIMAL(38,2)))"
    w = f"(SELECT CAST(COALESCE({wanted}, 0) AS DECIMAL(38,2)))"
    return _test_sql(test, f, w, f"abs({f} - {w}) <= 0.01")


FACT_SUM = "(SELECT SUM(revenue) FROM fact)"
TESTS = {
    "revenue_match": _sums_sql("revenue_match", FACT_SUM, "(SELECT SUM(net_value) FROM sales_orders)"),
    "tax_id_unique": _zero_sql("tax_id_unique", "SELECT COUNT(*) - COUNT(DISTINCT tax_id) FROM clients"),
    "order_date_present": _zero_sql("order_date_present", "SELECT COUNT(*) FROM sales_orders WHERE ordered_on IS NULL"),
    "negative_only_returns": _zero_sql("negative_only_returns", "SELECT COUNT(*) FROM fact WHERE revenue < 0 AND NOT is_return"),
    "fact_volume": _test_sql("fact_volume", "(SELECT COUNT(*) FROM fact)", f"'{LOW} to {HIGH}'",
                             f"(SELECT COUNT(*) FROM fact) BETWEEN {LOW} AND {HIGH}"),
    "no_orphan_order": _zero_sql("no_orphan_order", "SELECT COUNT(*) FROM fact f ANTI JOIN sales_orders s ON s.order_id = f.order_id"),
    "no_orphan_client": _zero_sql("no_orphan_client", "SELECT COUNT(*) FROM fact f ANTI JOIN clients c ON c.client_id = f.client_id"),
    "mart_equals_fact": _sums_sql("mart_equals_fact", "(SELECT SUM(revenue) FROM product_month)", FACT_SUM),
    "tax_id_length": _zero_sql("tax_id_length", "SELECT COUNT(*) FROM dimclient WHERE length(tax_id) <> 14"),
}


@check("dq_revenue_match", TESTS["revenue_match"])
def _(x: Frames):
    return quality.revenue_match(x.fact, x.orders)


@check("dq_tax_id_unique", TESTS["tax_id_unique"])
def _(x: Frames):
    return quality.tax_id_unique(x.clients)


@check("dq_order_date_present", TESTS["order_date_present"])
def _(x: Frames):
    return quality.order_date_present(x.orders)


@check("dq_negative_only_returns", TESTS["negative_only_returns"])
def _(x: Frames):
    return quality.negative_only_returns(x.fact)


@check("dq_fact_volume", TESTS["fact_volume"])
def _(x: Frames):
    return quality.fact_volume(x.fact, LOW, HIGH)


@check("dq_no_orphan_order", TESTS["no_orphan_order"])
def _(x: Frames):
    return quality.no_orphan_order(x.fact, x.orders)


@check("dq_no_orphan_client", TESTS["no_orphan_client"])
def _(x: Frames):
    return quality.no_orphan_client(x.fact, x.clients)


@check("dq_mart_equals_fact", TESTS["mart_equals_fact"])
def _(x: Frames):
    return quality.mart_equals_fact(gold.mart_product_month(x.stored_fact), x.stored_fact)


@check("dq_tax_id_length", TESTS["tax_id_length"])
def _(x: Frames):
    return quality.tax_id_length(x.dim_client)


@check("dq_suspect_tax_ids", _zero_sql(
    "suspect_tax_ids",
    "SELECT COUNT(*) FROM client_raw WHERE NOT length(regexp_replace(tax_id, '[^0-9]', '', 'g')) BETWEEN 1 AND 14"))
def _(x: Frames):
    return quality.suspect_tax_ids(x.raw("client"))


def _report(x: Frames):
    from mercato.session import materialize

    # The report reads fact, orders and clients many times, so they are written once,
    # as in a run over published tables.
    fact = x.stored_fact
    orders, clients = (materialize(d, "dq") for d in (x.orders, x.clients))
    dim = gold.dim_client(clients, x.merges, orders, AS_OF)
    return quality.dq_report(fact, orders, clients, dim, gold.mart_product_month(fact), (LOW, HIGH))


@check("dq_report", "\nUNION ALL ".join(TESTS.values()))
def _(x: Frames):
    return _report(x)


# The given tables break no test. Here each of them is broken: dates of March orders are
# unknown and May orders missing, July revenue is negative, one segment of clients is
# missing and tax ids are cut to three digits.
_FACT = "(SELECT * REPLACE (CASE WHEN month = 7 AND NOT is_return THEN -revenue ELSE revenue END AS revenue) FROM fact)"
_ORDERS = "(SELECT * REPLACE (CASE WHEN month = 3 THEN NULL ELSE ordered_on END AS ordered_on) FROM sales_orders WHERE month <> 5)"
_CLIENTS = "(SELECT * REPLACE (substr(tax_id, 12, 3) AS tax_id) FROM clients WHERE segment <> 'BUILDING')"
_BROKEN_SUM = f"(SELECT SUM(revenue) FROM {_FACT})"
BROKEN = (
    _sums_sql("revenue_match", _BROKEN_SUM, f"(SELECT SUM(net_value) FROM {_ORDERS})"),
    _sums_sql("mart_equals_fact", "(SELECT SUM(revenue) FROM product_month)", _BROKEN_SUM),
    _zero_sql("tax_id_unique", f"SELECT COUNT(*) - COUNT(DISTINCT tax_id) FROM {_CLIENTS}"),
    _zero_sql("tax_id_length", f"SELECT COUNT(*) FROM {_CLIENTS} WHERE length(tax_id) <> 14"),
    _zero_sql("order_date_present", f"SELECT COUNT(*) FROM {_ORDERS} WHERE ordered_on IS NULL"),
    _zero_sql("negative_only_returns", f"SELECT COUNT(*) FROM {_FACT} WHERE revenue < 0 AND NOT is_return"),
    _test_sql("fact_volume", "(SELECT COUNT(*) FROM fact)", "'0 to 10'", "(SELECT COUNT(*) FROM fact) BETWEEN 0 AND 10"),
    _zero_sql("no_orphan_order", f"SELECT COUNT(*) FROM fact f ANTI JOIN {_ORDERS} s ON s.order_id = f.order_id"),
    _zero_sql("no_orphan_client", f"SELECT COUNT(*) FROM fact f ANTI JOIN {_CLIENTS} c ON c.client_id = f.client_id"),
)


@check("dq_report_broken", "\nUNION ALL ".join(BROKEN))
def _(x: Frames):
    """Every test on tables that break it."""
    in_july = (F.col("month") == 7) & ~F.col("is_return")
    fact = x.stored_fact.withColumn("revenue", F.when(in_july, -F.col("revenue")).otherwise(F.col("revenue")))
    orders = x.orders.where("month <> 5").withColumn("ordered_on", F.when(F.col("month") != 3, F.col("ordered_on")))
    clients = x.clients.where("segment <> 'BUILDING'").withColumn("tax_id", F.substring("tax_id", 12, 3))
    results = [
        quality.revenue_match(fact, orders), quality.mart_equals_fact(gold.product_months(x.stored_fact), fact),
        quality.tax_id_unique(clients), quality.tax_id_length(clients), quality.order_date_present(orders),
        quality.negative_only_returns(fact), quality.fact_volume(fact, 0, 10),
        quality.no_orphan_order(fact, orders), quality.no_orphan_client(fact, clients),
    ]
    return reduce(DataFrame.unionByName, results)


@check("dq_gate", "SELECT '9 tests passed' AS outcome")
def _(x: Frames):
    from mercato.operators.checks import gate_text

    return gate_text(_report(x))
