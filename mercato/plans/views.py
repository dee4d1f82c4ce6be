"""Business views, each answering one question over gold tables. Every view is one
SQL text: `{name}` stands for an input, filled in with a table name to make a
stored view or with a DataFrame to run it directly."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mercato.parameters import AT_RISK_DAYS, LAUNCH_DAYS


def _ratio(numerator: str, denominator: str, places: int) -> str:
    """Divided and rounded as decimals, then a double; NULL for a zero denominator."""
    bottom = f"NULLIF(CAST({denominator} AS DECIMAL(28,2)), 0)"
    return f"CAST(ROUND(CAST({numerator} AS DECIMAL(28,2)) / {bottom}, {places}) AS DOUBLE)"


def _pct(numerator: str, denominator: str) -> str:
    return _ratio(f"100 * {numerator}", denominator, 1)


def _total(column: str, condition: str = "") -> str:
    only = f" FILTER (WHERE {condition})" if condition else ""
    return f"CAST(SUM({column}){only} AS DECIMAL(38,2))"


MONTHLY_REVENUE = f"""
    SELECT s.year, s.month, s.revenue, s.margin, s.orders, c.peak_month
    FROM (SELECT year, month, {_total('revenue')} AS revenue, {_total('margin')} AS margin,
            COUNT(DISTINCT order_id) AS orders
          FROM {{fact}} GROUP BY year, month) s
    JOIN (SELECT DISTINCT year, month, peak_month FROM {{calendar}}) c
      ON c.year = s.year AND c.month = s.month"""

# The grand total adds up the same brand sums. It takes both of their columns, so
# that Spark sees one and the same shuffle and runs it once.
BRAND_RANKING = f"""
    WITH brands AS (
      SELECT brand, {_total('revenue')} AS revenue, {_total('margin')} AS margin
      FROM {{fact}} GROUP BY brand)
    SELECT brand, revenue, {_pct('margin', 'revenue')} AS margin_pct,
      {_pct('revenue', '(SELECT STRUCT(SUM(revenue) AS revenue, SUM(margin) AS margin) FROM brands).revenue')} AS share_pct
    FROM brands"""

CATEGORY_MARGIN = f"""
    SELECT category, revenue, margin, {_pct('margin', 'revenue')} AS margin_pct
    FROM (SELECT category, {_total('revenue')} AS revenue, {_total('margin')} AS margin
          FROM {{fact}} GROUP BY category)"""

# Quiet time is counted from as_of, not taken from when the dimension was built.
CLIENTS_AT_RISK = """
    SELECT client_id, legal_name, segment, city,
      DATEDIFF(DATE '{as_of}', last_order_on) AS days_since_order,
      ROUND(CAST(net_revenue AS DOUBLE)
            / GREATEST(1.0D, MONTHS_BETWEEN(last_order_on, first_order_on)), 2) AS monthly_revenue
    FROM {clients}
    WHERE DATEDIFF(DATE '{as_of}', last_order_on) > {days}"""

# The fact is added up per product and day before the join.
LAUNCH_EFFECT = f"""
    SELECT sku, title, launched_on, launch_revenue, rest_revenue,
      {_ratio('launch_revenue', "DATEDIFF(LEAST(DATE '{as_of}', DATE_ADD(launched_on, {days})), launched_on)", 2)} AS launch_per_day,
      {_ratio('rest_revenue', "DATEDIFF(DATE '{as_of}', DATE_ADD(launched_on, {days}))", 2)} AS rest_per_day
    FROM (SELECT p.sku, p.title, p.launched_on,
            {_total('d.revenue', 'd.ordered_on < DATE_ADD(p.launched_on, {days}){lower}')} AS launch_revenue,
            {_total('d.revenue', 'd.ordered_on >= DATE_ADD(p.launched_on, {days})')} AS rest_revenue
          FROM (SELECT sku, ordered_on, SUM(revenue) AS revenue FROM {{fact}} GROUP BY sku, ordered_on) d
          JOIN {{products}} p ON p.sku = d.sku
          WHERE p.launched_on IS NOT NULL
          GROUP BY p.sku, p.title, p.launched_on)"""

STOCKOUT_BY_BRAND = f"""
    SELECT brand, snapshots, stock_outs, {_pct('stock_outs', 'snapshots')} AS stock_out_pct
    FROM (SELECT p.brand, SUM(s.n) AS snapshots, SUM(s.outs) AS stock_outs
          FROM (SELECT sku, COUNT(*) AS n, COUNT_IF(stock_out) AS outs FROM {{stock}} GROUP BY sku) s
          JOIN {{products}} p ON p.sku = s.sku
          GROUP BY p.brand)"""


def _run(text: str, **inputs) -> DataFrame:
    frame = next(v for v in inputs.values() if isinstance(v, DataFrame))
    fixed = {k: v for k, v in inputs.items() if not isinstance(v, DataFrame)}
    frames = {k: v for k, v in inputs.items() if isinstance(v, DataFrame)}
    # Plain values first; the names of frames stay for Spark to fill in.
    text = text.format(**fixed, **{k: f"{{{k}}}" for k in frames})
    return frame.sparkSession.sql(text, **frames)


def monthly_revenue(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return _run(MONTHLY_REVENUE, fact=fact, calendar=calendar)


def brand_ranking(fact: DataFrame) -> DataFrame:
    return _run(BRAND_RANKING, fact=fact)


def category_margin(fact: DataFrame) -> DataFrame:
    return _run(CATEGORY_MARGIN, fact=fact)


def clients_at_risk(clients: DataFrame, as_of: str, days: int = AT_RISK_DAYS) -> DataFrame:
    return _run(CLIENTS_AT_RISK, clients=clients, as_of=as_of, days=days)


def launch_effect(
    fact: DataFrame, products: DataFrame, as_of: str, days: int = LAUNCH_DAYS, from_launch: bool = False
) -> DataFrame:
    """Sales before the launch count as launch sales unless `from_launch`."""
    return _run(
        LAUNCH_EFFECT, fact=fact, products=products, as_of=as_of, days=days, lower=launch_bound(from_launch)
    )


def launch_bound(from_launch: bool) -> str:
    return " AND d.ordered_on >= p.launched_on" if from_launch else ""


def stockout_by_brand(stock: DataFrame, products: DataFrame) -> DataFrame:
    return _run(STOCKOUT_BY_BRAND, stock=stock, products=products)
