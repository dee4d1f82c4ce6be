"""Named SQL building blocks for the check queries, in an order in which each may
use those before it. `with_ctes` puts the ones a query names in front of it."""

from __future__ import annotations

import re

AS_OF = "2001-08-01"
TRAIN_CUTOFF = "2001-06-01"
SCORE_CUTOFF = "2001-07-15"
HORIZON = 30
QUEUE_N = 200


def dround(expr: str, places: int) -> str:
    """Half-up rounding of the decimal a double prints as."""
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {places}) AS DOUBLE)"


def ratio(num: str, den: str, places: int | None = None, factor: int = 1) -> str:
    """A double ratio; with places, exact half-up rounding in whole numbers."""
    if places is None:
        return f"({factor} * CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"
    n = f"CAST(CAST({num} AS DECIMAL(26,2)) * 100 AS HUGEINT)"
    d = f"NULLIF(CAST(CAST({den} AS DECIMAL(26,2)) * 100 AS HUGEINT), 0)"
    whole = f"((2 * abs({n}) * {factor * 10 ** places} + abs({d})) // (2 * abs({d})))"
    return f"(sign({n}) * sign({d}) * CAST({whole} AS DOUBLE) / {10 ** places}.0)"


def pct(num: str, den: str, places: int = 1) -> str:
    return ratio(num, den, places, 100)


SIGNED = "CAST(l_quantity AS INT) * CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END"
REPS = "(SELECT COUNT(*) FROM supplier)"


def iso(column: str) -> str:
    return f"TRY_CAST({column} AS DATE)"


def multi(column: str) -> str:
    return (
        f"COALESCE(CASE WHEN regexp_matches({column}, '^[0-9]{{4}}-') THEN TRY_CAST({column} AS DATE) END,"
        f" CAST(try_strptime({column}, '%d/%m/%Y') AS DATE))"
    )


def slashed(date: str) -> str:
    return f"strftime({date}, '%d/%m/%Y')"


def features_cte(cutoff: str) -> str:
    c = f"DATE '{cutoff}'"
    return f"""
      SELECT o.client_id, CAST({c} - o.last_on AS INT) AS recency_days, o.order_count,
        CAST(o.rev AS DOUBLE) AS revenue_total, {ratio('o.rev', 'o.order_count')} AS mean_ticket,
        o.cycle AS cycle_days,
        CASE WHEN o.cycle > 0 THEN ({c} - o.last_on) / o.cycle END AS overdue_ratio,
        CAST({c} - o.first_on AS INT) AS days_since_first_order,
        CAST({c} - cl.registered_on AS INT) AS days_since_registration,
        o.recent_orders, CAST(o.recent_rev AS DOUBLE) AS recent_revenue,
        CASE WHEN o.rev > 0 THEN 100 * CAST(o.recent_rev AS DOUBLE) / CAST(o.rev AS DOUBLE) END AS recent_share_pct,
        o.distinct_categories, o.distinct_brands, o.units,
        100 * CAST(o.returned AS DOUBLE) / o.line_count AS return_rate_pct,
        COALESCE(v.recent_visits, 0) AS recent_visits, v.days_since_visit,
        COALESCE(p.open_opportunities, 0) AS open_opportunities,
        cl.segment, o.channels > 1 AS multichannel, {c} AS cutoff
      FROM (SELECT *, CASE WHEN order_count > 1 THEN CAST(last_on - first_on AS DOUBLE) / (order_count - 1) END AS cycle
            FROM (SELECT client_id, MAX(ordered_on) AS last_on, MIN(ordered_on) AS first_on,
                    COUNT(DISTINCT order_id) AS order_count, SUM(revenue) AS rev,
                    COUNT(DISTINCT category) AS distinct_categories, COUNT(DISTINCT brand) AS distinct_brands,
                    COUNT(DISTINCT channel) AS channels,
                    CAST(SUM(CASE WHEN is_return THEN 0 ELSE quantity END) AS BIGINT) AS units,
                    COUNT(*) AS line_count, COUNT(*) FILTER (WHERE is_return) AS returned,
                    COUNT(DISTINCT order_id) FILTER (WHERE ordered_on > {c} - 90) AS recent_orders,
                    COALESCE(SUM(revenue) FILTER (WHERE ordered_on > {c} - 90), 0) AS recent_rev
                  FROM fact WHERE ordered_on <= {c} GROUP BY client_id)) o
      LEFT JOIN (SELECT client_id, COUNT(*) FILTER (WHERE visited_on > {c} - 90) AS recent_visits,
                   CAST({c} - MAX(visited_on) AS INT) AS days_since_visit
                 FROM visits WHERE visited_on <= {c} GROUP BY client_id) v ON v.client_id = o.client_id
      LEFT JOIN (SELECT client_id, COUNT(*) AS open_opportunities FROM opportunities
                 WHERE opened_on <= {c} AND (stage NOT IN ('Closed won', 'Closed lost') OR closed_on > {c})
                 GROUP BY client_id) p ON p.client_id = o.client_id
      LEFT JOIN clients cl ON cl.client_id = o.client_id"""


def banded_cte(source: str, columns: str) -> str:
    """Quartile bands of `score` in `source`."""
    return f"""
      SELECT {columns}, CASE WHEN score <= q1 THEN 'Cold' WHEN score <= q2 THEN 'Warm'
                             WHEN score <= q3 THEN 'Hot' ELSE 'Very hot' END AS band
      FROM {source} CROSS JOIN (SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2,
                                  quantile_cont(score, 0.75) AS q3 FROM {source})"""


CTES: dict[str, str] = {
    # -- raw shapes over the given tables ---------------------------------------
    "product_raw": """
      SELECT CAST(p_partkey AS STRING) AS sku, p_name AS title, p_type AS category, p_brand AS brand,
        CAST(p_size AS STRING) AS note,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS list_price,
        CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CASE p_partkey % 5 WHEN 0 THEN CAST(0.40 AS DECIMAL(3,2)) WHEN 1 THEN CAST(0.45 AS DECIMAL(3,2)) WHEN 2 THEN CAST(0.50 AS DECIMAL(3,2)) WHEN 3 THEN CAST(0.55 AS DECIMAL(3,2)) ELSE CAST(0.60 AS DECIMAL(3,2)) END AS DECIMAL(18,2)) AS STRING) AS unit_cost,
        CASE p_size % 6 WHEN 0 THEN 'UN' WHEN 1 THEN 'CX' WHEN 2 THEN 'KIT' WHEN 3 THEN 'FR' WHEN 4 THEN 'PC' ELSE 'DZ' END AS unit,
        CASE WHEN p_partkey % 10 = 7 THEN 'N' ELSE 'S' END AS active,
        CASE WHEN p_partkey % 6 = 0 THEN CAST(DATE '1999-01-01' + CAST(p_partkey % 700 AS INT) AS STRING) END AS launched_on
      FROM part""",
    "line_raw": f"""
      SELECT CONCAT_WS('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS line_id,
        CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS sku,
        CAST({SIGNED} AS STRING) AS quantity,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS unit_price,
        CAST(CAST(l_discount AS DECIMAL(9,4)) AS STRING) AS discount_pct,
        CAST(CAST({SIGNED} * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS STRING) AS gross_value
      FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "order_raw": f"""
      SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS client_id,
        CAST(o_custkey % {REPS} AS STRING) AS rep_id,
        CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
             ELSE {slashed('CAST(o_orderdate AS DATE)')} END AS ordered_on,
        o_orderpriority AS channel,
        CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'Cancelled' ELSE 'Invoiced' END AS status,
        CAST(COALESCE(t.total, CAST(0 AS DECIMAL(18,2))) AS STRING) AS total_value
      FROM orders LEFT JOIN (
        SELECT l_orderkey, CAST(SUM({SIGNED} * CAST(p_retailprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) t ON t.l_orderkey = o_orderkey""",
    "client_raw": f"""
      SELECT CAST(c_custkey AS STRING) AS client_id,
        CASE WHEN c_custkey % 3 = 0 THEN CONCAT(' ', CAST(k AS STRING), ' ')
             WHEN c_custkey % 3 = 1 THEN CONCAT(SUBSTR(d, 1, 2), '.', SUBSTR(d, 3, 3), '.', SUBSTR(d, 6, 3), '/', SUBSTR(d, 9, 4), '-', SUBSTR(d, 13, 2))
             ELSE d END AS tax_id,
        CONCAT(UPPER(c_mktsegment), '  client ', CAST(c_custkey AS STRING)) AS legal_name,
        c_mktsegment AS segment, n_name AS city, r_name AS state,
        CONCAT('District ', CAST(c_custkey % 30 AS STRING)) AS district,
        CASE WHEN c_custkey % 2 = 0 THEN CAST(reg AS STRING) ELSE {slashed('reg')} END AS registered_on,
        CASE WHEN c_custkey % 11 = 5 THEN 'N' ELSE 'S' END AS active
      FROM (SELECT *, c_custkey + 1 - CASE WHEN c_custkey % 20 = 19 THEN 1 ELSE 0 END AS k,
              LPAD(CAST(c_custkey + 1 - CASE WHEN c_custkey % 20 = 19 THEN 1 ELSE 0 END AS STRING), 14, '0') AS d,
              DATE '1994-01-01' + CAST((c_custkey * 7) % 365 AS INT) AS reg
            FROM customer) c
      JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "rep_raw": """
      SELECT CAST(s_suppkey AS STRING) AS rep_id,
        CONCAT('Rep ', CAST(s_suppkey - CASE WHEN s_suppkey % 10 = 9 THEN 9 ELSE 0 END AS STRING)) AS rep_name,
        r_name AS region, n_name AS state,
        CAST(DATE '1994-01-01' + CAST(s_suppkey % 300 AS INT) AS STRING) AS hired_on,
        CASE WHEN s_suppkey % 7 = 3 THEN '2001-05-01' END AS terminated_on,
        CAST(CAST(20000 + (s_suppkey % 5) * 5000 AS DECIMAL(18,2)) AS STRING) AS monthly_target
      FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "portfolio_raw": f"""
      SELECT CONCAT('a', CAST(c_custkey AS STRING)) AS portfolio_id, CAST(c_custkey AS STRING) AS client_id,
        CAST(c_custkey % {REPS} AS STRING) AS rep_id, '2000-01-01' AS started_on,
        CASE WHEN c_custkey % 12 = 5 THEN '2001-01-01' END AS ended_on
      FROM customer
      UNION ALL
      SELECT CONCAT('b', CAST(c_custkey AS STRING)), CAST(c_custkey AS STRING),
        CAST((c_custkey + 1) % {REPS} AS STRING), '2001-01-02', CAST(NULL AS STRING)
      FROM customer WHERE c_custkey % 12 = 5 OR c_custkey % 40 = 0""",
    "visit_raw": f"""
      SELECT CAST(event_id AS STRING) AS visit_id, CAST(user_id AS STRING) AS client_id,
        CAST(user_id % {REPS} AS STRING) AS rep_id,
        CAST(CAST(CAST(ts AS DATE) - INTERVAL '270' MONTH AS DATE) AS STRING) AS visited_on,
        CASE event_id % 3 WHEN 0 THEN 'Order' WHEN 1 THEN 'No order' ELSE 'Absent' END AS result,
        CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE CAST(event_id % 120 AS STRING) END AS duration_min
      FROM events WHERE event_type = 'view'""",
    "opportunity_raw": f"""
      SELECT CAST(event_id AS STRING) AS opportunity_id, CAST(user_id AS STRING) AS client_id,
        CAST(user_id % {REPS} AS STRING) AS rep_id,
        CASE event_id % 4 WHEN 0 THEN 'Referral' WHEN 1 THEN 'Fair' WHEN 2 THEN 'Site' ELSE 'Cold call' END AS origin,
        CAST(CAST(CAST(ts AS DATE) - INTERVAL '270' MONTH AS DATE) AS STRING) AS opened_on,
        CASE event_id % 6 WHEN 0 THEN 'Prospecting' WHEN 1 THEN 'Qualification' WHEN 2 THEN 'Proposal' WHEN 3 THEN 'Negotiation' WHEN 4 THEN 'Closed won' ELSE 'Closed lost' END AS stage,
        CASE WHEN event_id % 25 = 0 THEN '?' ELSE CAST((event_id % 11) * 10 AS STRING) END AS probability_pct,
        CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS estimated_value,
        CASE WHEN event_id % 6 >= 4 THEN CAST(CAST(CAST(ts AS DATE) - INTERVAL '270' MONTH AS DATE) + CAST(event_id % 20 AS INT) AS STRING) END AS closed_on,
        CASE WHEN event_id % 6 >= 4 THEN CAST(event_id % 20 AS STRING) END AS cycle_days,
        CASE WHEN event_id % 6 = 5 THEN 'Price' END AS loss_reason
      FROM events WHERE event_type = 'signup'""",
    "payment_raw": """
      SELECT CAST(o_orderkey AS STRING) AS payment_id, CAST(o_orderkey AS STRING) AS order_id,
        CASE o_orderkey % 3 WHEN 0 THEN 'Slip' WHEN 1 THEN 'Card' ELSE 'Transfer' END AS method,
        CASE WHEN o_orderkey % 40 = 0 THEN 'x' ELSE CAST(1 + o_orderkey % 6 AS STRING) END AS installments,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amount,
        CAST(CAST(o_orderkey % 5 AS DECIMAL(9,4)) AS STRING) AS fee_pct,
        CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST((o_orderkey % 7) * 10 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS STRING) AS net_amount,
        CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) AS due_on,
        CASE WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 31 + CAST(o_orderkey % 14 AS INT) AS STRING)
             WHEN o_orderkey % 5 = 1 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) END AS paid_on,
        CASE WHEN o_orderkey % 5 = 0 THEN 'Paid late' WHEN o_orderkey % 5 = 1 THEN 'Open' ELSE 'Paid' END AS payment_status
      FROM orders""",
    "stock_raw": """
      SELECT CAST(CAST(l_shipdate AS DATE) AS STRING) AS snapshot_on, CAST(l_partkey AS STRING) AS sku,
        CAST((l_orderkey + l_partkey) % 9 AS STRING) AS balance
      FROM lineitem""",
    "trip": """
      SELECT user_id AS pickup_zip, CAST(value AS DECIMAL(18,2)) AS fare_amount
      FROM events WHERE event_type = 'purchase'""",
    "mkt_customer": """
      SELECT CAST(o_orderkey AS STRING) AS customer_id, CAST(o_custkey AS STRING) AS person_id,
        CAST(o_custkey % 97 AS STRING) AS zip_raw FROM orders""",
    "mkt_review": """
      SELECT CONCAT('r', CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS STRING)) AS review_id,
        CAST(o_orderkey AS STRING) AS order_id, CAST(1 + o_orderkey % 5 AS INT) AS score,
        CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS reviewed_at
      FROM orders""",
    "mkt_geo": """
      SELECT CAST(event_id % 97 AS STRING) AS zip_raw, CAST(value AS DECIMAL(18,2)) AS lat,
        CAST(user_id AS DECIMAL(18,2)) AS lng FROM events""",
    # -- typed tables ------------------------------------------------------------
    "clients_typed": f"""
      SELECT client_id, LPAD(regexp_replace(tax_id, '[^0-9]', '', 'g'), 14, '0') AS tax_id,
        regexp_replace(array_to_string([concat(upper(substr(w, 1, 1)), substr(w, 2)) FOR w IN string_split(lower(legal_name), ' ')], ' '), ' +', ' ', 'g') AS legal_name,
        segment, city, state, district, {multi('registered_on')} AS registered_on, active = 'S' AS active
      FROM client_raw""",
    "clients_ranked": """
      SELECT *, row_number() OVER (PARTITION BY tax_id ORDER BY registered_on ASC NULLS LAST, client_id) AS place,
        first_value(client_id) OVER (PARTITION BY tax_id ORDER BY registered_on ASC NULLS LAST, client_id) AS survivor,
        COUNT(*) OVER (PARTITION BY tax_id) AS group_rows
      FROM clients_typed""",
    "merges": """
      SELECT m.client_id AS merged_id, k.client_id, k.legal_name, k.segment, k.city, m.group_rows AS merged_rows
      FROM clients_ranked m JOIN clients_ranked k ON k.tax_id = m.tax_id AND k.place = 1
      WHERE m.client_id <> k.client_id""",
    "clients": """
      SELECT client_id, tax_id, legal_name, segment, city, state, district, registered_on, active,
        group_rows - 1 AS merged_count, (SELECT COUNT(*) FROM client_raw) AS source_rows
      FROM clients_ranked WHERE place = 1""",
    "sales_orders": f"""
      SELECT order_id, client_id, rep_id, d AS ordered_on, channel, status, v AS total_value,
        status = 'Cancelled' AS cancelled,
        CASE WHEN status = 'Cancelled' THEN CAST(0 AS DECIMAL(18,2)) ELSE v END AS net_value,
        CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
        (SELECT COUNT(*) FROM order_raw) AS source_rows
      FROM (SELECT *, {multi('ordered_on')} AS d, CAST(total_value AS DECIMAL(18,2)) AS v FROM order_raw)""",
    "products": f"""
      SELECT sku, title, category, brand, note, CAST(list_price AS DECIMAL(18,2)) AS list_price,
        CAST(unit_cost AS DECIMAL(18,2)) AS unit_cost, unit, active = 'S' AS active,
        {iso('launched_on')} AS launched_on, (SELECT COUNT(*) FROM product_raw) AS source_rows
      FROM product_raw""",
    "lines": """
      SELECT line_id, order_id, i.sku, TRY_CAST(quantity AS INT) AS quantity,
        CAST(abs(TRY_CAST(quantity AS INT)) AS INT) AS abs_quantity, TRY_CAST(quantity AS INT) < 0 AS is_return,
        CAST(unit_price AS DECIMAL(18,2)) AS unit_price, CAST(discount_pct AS DECIMAL(9,4)) AS discount_pct,
        CAST(gross_value AS DECIMAL(18,2)) AS gross_value,
        COALESCE(NOT p.active, false) AS sku_discontinued, (SELECT COUNT(*) FROM line_raw) AS source_rows
      FROM line_raw i LEFT JOIN products p ON p.sku = i.sku""",
    "reps": f"""
      SELECT rep_id, rep_name, region, state, {iso('hired_on')} AS hired_on, {iso('terminated_on')} AS terminated_on,
        CAST(monthly_target AS DECIMAL(18,2)) AS monthly_target, (SELECT COUNT(*) FROM rep_raw) AS source_rows
      FROM rep_raw""",
    "visits": f"""
      SELECT visit_id, client_id, rep_id, {iso('visited_on')} AS visited_on, result,
        TRY_CAST(duration_min AS INT) AS duration_min, (SELECT COUNT(*) FROM visit_raw) AS source_rows
      FROM visit_raw""",
    "payments": f"""
      SELECT payment_id, order_id, method, TRY_CAST(installments AS INT) AS installments,
        CAST(amount AS DECIMAL(18,2)) AS amount, CAST(fee_pct AS DECIMAL(9,4)) AS fee_pct,
        CAST(net_amount AS DECIMAL(18,2)) AS net_amount, {iso('due_on')} AS due_on, {iso('paid_on')} AS paid_on,
        payment_status, (SELECT COUNT(*) FROM payment_raw) AS source_rows
      FROM payment_raw""",
    "portfolio": f"""
      SELECT portfolio_id, p.client_id, p.rep_id, {iso('started_on')} AS started_on, {iso('ended_on')} AS ended_on,
        p.ended_on IS NULL AND r.terminated_on IS NULL AS current,
        p.ended_on IS NULL AND r.terminated_on IS NOT NULL AS orphaned,
        (SELECT COUNT(*) FROM portfolio_raw) AS source_rows
      FROM portfolio_raw p LEFT JOIN reps r ON r.rep_id = p.rep_id""",
    "opportunities": f"""
      SELECT opportunity_id, client_id, rep_id, origin, {iso('opened_on')} AS opened_on, stage,
        stage = 'Closed won' AS won, stage = 'Closed lost' AS lost,
        TRY_CAST(probability_pct AS DECIMAL(9,4)) AS probability_pct,
        CAST(estimated_value AS DECIMAL(18,2)) AS estimated_value, {iso('closed_on')} AS closed_on,
        TRY_CAST(cycle_days AS INT) AS cycle_days, loss_reason, (SELECT COUNT(*) FROM opportunity_raw) AS source_rows
      FROM opportunity_raw""",
    "stock": f"""
      SELECT {iso('snapshot_on')} AS snapshot_on, sku, TRY_CAST(balance AS INT) AS balance,
        TRY_CAST(balance AS INT) = 0 AS stock_out, (SELECT COUNT(*) FROM stock_raw) AS source_rows
      FROM stock_raw""",
    # -- star schema -------------------------------------------------------------
    "idmap": """
      SELECT client_id AS source_id, client_id FROM clients
      UNION ALL SELECT merged_id, client_id FROM merges""",
    "dimclient": f"""
      SELECT c.client_id, tax_id, legal_name, segment, city, state, registered_on,
        o.first_order_on, o.last_order_on, COALESCE(o.total_orders, 0) AS total_orders,
        CAST(COALESCE(o.net_revenue, 0) AS DECIMAL(38,2)) AS net_revenue,
        CAST(DATE '{AS_OF}' - o.last_order_on AS INT) AS days_since_order
      FROM clients c LEFT JOIN (
        SELECT m.client_id, COUNT(*) AS total_orders, SUM(net_value) AS net_revenue,
          MIN(ordered_on) FILTER (WHERE NOT cancelled) AS first_order_on,
          MAX(ordered_on) FILTER (WHERE NOT cancelled) AS last_order_on
        FROM sales_orders s JOIN idmap m ON m.source_id = s.client_id GROUP BY m.client_id) o
      ON o.client_id = c.client_id""",
    "dimproduct": """
      SELECT sku, title, brand, category, note, unit_cost, list_price, launched_on, NOT active AS discontinued
      FROM products""",
    "dimrep": """
      SELECT rep_id, rep_name, region, monthly_target, terminated_on IS NULL AS active FROM reps""",
    "dimcalendar": """
      SELECT CAST(d AS DATE) AS day, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
        monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, dayname(d) AS weekday,
        month(d) IN (4, 6, 10) AS peak_month
      FROM (SELECT unnest(generate_series(CAST(MIN(ordered_on) AS TIMESTAMP), CAST(MAX(ordered_on) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
            FROM sales_orders)""",
    "fact": """
      SELECT i.line_id, i.order_id, s.ordered_on, s.year, s.month, s.channel, c.client_id, c.legal_name,
        c.segment, c.city, s.rep_id, p.sku, p.category, p.brand, p.note, i.quantity, i.unit_price,
        CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS revenue,
        CAST(i.quantity * p.unit_cost AS DECIMAL(18,2)) AS cost,
        CAST(i.quantity * i.unit_price - i.quantity * p.unit_cost AS DECIMAL(18,2)) AS margin, i.is_return
      FROM lines i JOIN sales_orders s ON s.order_id = i.order_id
      JOIN idmap m ON m.source_id = s.client_id JOIN clients c ON c.client_id = m.client_id
      JOIN products p ON p.sku = i.sku
      WHERE NOT s.cancelled""",
    "rep_months": f"""
      SELECT a.rep_id, a.year, a.month, CAST(a.revenue AS DECIMAL(38,2)) AS revenue, CAST(a.margin AS DECIMAL(38,2)) AS margin,
        r.monthly_target, {ratio('a.revenue', 'r.monthly_target', 3)} AS attainment, a.clients,
        {ratio('a.revenue', 'a.orders', 2)} AS ticket
      FROM (SELECT rep_id, year, month, SUM(revenue) AS revenue, SUM(margin) AS margin,
              COUNT(DISTINCT client_id) AS clients, COUNT(DISTINCT order_id) AS orders
            FROM fact GROUP BY rep_id, year, month) a JOIN dimrep r ON r.rep_id = a.rep_id""",
    "abc": """
      SELECT sku, CASE WHEN share <= 0.80 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM (SELECT sku, CAST(SUM(r) OVER (ORDER BY r DESC, sku ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(SUM(r) OVER () AS DOUBLE) AS share
            FROM (SELECT sku, SUM(revenue) AS r FROM fact GROUP BY sku))""",
    "product_month": f"""
      SELECT m.sku, m.year, m.month, CAST(m.revenue AS DECIMAL(38,2)) AS revenue, CAST(m.margin AS DECIMAL(38,2)) AS margin,
        {pct('m.margin', 'm.revenue')} AS margin_pct, CAST(m.quantity AS BIGINT) AS quantity, a.abc_class
      FROM (SELECT sku, year, month, SUM(revenue) AS revenue, SUM(margin) AS margin, SUM(quantity) AS quantity
            FROM fact GROUP BY sku, year, month) m JOIN abc a ON a.sku = m.sku""",
    # -- views -------------------------------------------------------------------
    "month_view": """
      SELECT a.*, c.peak_month FROM (
        SELECT year, month, CAST(SUM(revenue) AS DECIMAL(38,2)) AS revenue, CAST(SUM(margin) AS DECIMAL(38,2)) AS margin,
          COUNT(DISTINCT order_id) AS orders FROM fact GROUP BY year, month) a
      JOIN (SELECT DISTINCT year, month, peak_month FROM dimcalendar) c ON c.year = a.year AND c.month = a.month""",
    "category_view": f"""
      SELECT category, CAST(SUM(revenue) AS DECIMAL(38,2)) AS revenue, CAST(SUM(margin) AS DECIMAL(38,2)) AS margin,
        {pct('SUM(margin)', 'SUM(revenue)')} AS margin_pct FROM fact GROUP BY category""",
    "risk_view": f"""
      SELECT client_id, legal_name, segment, city, days_since_order, {dround('CAST(net_revenue AS DOUBLE) / greatest(1.0, span)', 2)} AS monthly_revenue
      FROM (SELECT *, ROUND(CAST((year(l) - year(f)) * 12 + month(l) - month(f) AS DOUBLE)
                + CASE WHEN day(l) = day(f) OR (l = last_day(l) AND f = last_day(f)) THEN 0
                       ELSE (day(l) - day(f)) / 31.0 END, 8) AS span
            FROM (SELECT *, last_order_on AS l, first_order_on AS f FROM dimclient WHERE days_since_order > 90))""",
    "launch_view": f"""
      SELECT sku, title, launched_on, CAST(a AS DECIMAL(38,2)) AS launch_revenue, CAST(b AS DECIMAL(38,2)) AS rest_revenue,
        {ratio('a', f"(LEAST(DATE '{AS_OF}', launched_on + 120) - launched_on)", 2)} AS launch_per_day,
        {ratio('b', f"(DATE '{AS_OF}' - (launched_on + 120))", 2)} AS rest_per_day
      FROM (SELECT f.sku, p.title, p.launched_on, SUM(revenue) FILTER (WHERE ordered_on < launched_on + 120) AS a,
              SUM(revenue) FILTER (WHERE ordered_on >= launched_on + 120) AS b
            FROM fact f JOIN dimproduct p ON p.sku = f.sku WHERE launched_on IS NOT NULL GROUP BY f.sku, p.title, p.launched_on)""",
    "stockout_view": f"""
      SELECT p.brand, COUNT(*) AS snapshots, COUNT(*) FILTER (WHERE s.stock_out) AS stock_outs,
        {pct('COUNT(*) FILTER (WHERE s.stock_out)', 'COUNT(*)')} AS stock_out_pct
      FROM stock s JOIN dimproduct p ON p.sku = s.sku GROUP BY p.brand""",
    # -- features, stand-in score, queue -----------------------------------------
    "feat_train": features_cte(TRAIN_CUTOFF),
    "feat_score": features_cte(SCORE_CUTOFF),
    "labelled": f"""
      SELECT f.*, CASE WHEN b.client_id IS NULL THEN 0 ELSE 1 END AS buys_next
      FROM feat_train f LEFT JOIN (SELECT DISTINCT client_id FROM fact
        WHERE ordered_on >= DATE '{TRAIN_CUTOFF}' + 1 AND ordered_on < DATE '{TRAIN_CUTOFF}' + 1 + {HORIZON}) b
      ON b.client_id = f.client_id""",
    "held": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY buys_next ORDER BY md5(concat(client_id, '|42')), client_id) AS place,
                       COUNT(*) OVER (PARTITION BY buys_next) AS class_rows FROM labelled)""",
    "judged": f"""
      SELECT *, {dround('1.0 / (1 + recency_days)', 6)} AS score FROM labelled""",
    "scored": f"""
      SELECT client_id, {dround('1.0 / (1 + recency_days)', 6)} AS score FROM feat_score""",
    "scores": banded_cte("scored", "client_id, score"),
    "eligible": """
      SELECT s.client_id, s.score, s.band, p.rep_id FROM scores s
      JOIN (SELECT DISTINCT client_id, rep_id FROM portfolio WHERE current) p ON p.client_id = s.client_id""",
    "rep_names": """
      SELECT rep_id, CASE WHEN COUNT(*) OVER (PARTITION BY rep_name) > 1 THEN CONCAT(rep_name, ' (#', rep_id, ')') ELSE rep_name END AS rep
      FROM dimrep""",
    "reasons": f"""
      SELECT client_id,
        CASE WHEN recency_days > 90 THEN CONCAT('No purchase for ', CAST(recency_days AS STRING), ' days, client at risk')
             WHEN overdue_ratio > 1.5 THEN CONCAT('Late by ', CAST({dround('overdue_ratio', 1)} AS STRING), 'x against the usual buying cycle')
             WHEN recent_orders = 0 THEN 'Bought nothing in the last 90 days' ELSE 'High purchase propensity' END AS reason,
        CASE WHEN recency_days > 90 THEN 'Call to win back and learn why they left'
             WHEN overdue_ratio > 1.5 THEN 'Offer to refill the usual order'
             WHEN recent_orders = 0 THEN 'Show what is new and stay in touch' ELSE 'Use the moment to widen the order' END AS advice
      FROM feat_score""",
    "queue": f"""
      SELECT t.client_id, n.rep, CAST(row_number() OVER (PARTITION BY t.rep_id ORDER BY t.score DESC, t.client_id) AS INT) AS position,
        c.legal_name, c.city, t.score, t.band, r.reason, r.advice
      FROM (SELECT * FROM eligible ORDER BY score DESC, client_id, rep_id LIMIT {QUEUE_N}) t
      JOIN rep_names n ON n.rep_id = t.rep_id JOIN dimclient c ON c.client_id = t.client_id
      JOIN reasons r ON r.client_id = t.client_id""",
    # -- marketplace ---------------------------------------------------------------
    "mkt_reviews": """
      SELECT review_id, order_id, score, TRY_CAST(reviewed_at AS TIMESTAMP) AS reviewed_at FROM mkt_review
      QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY TRY_CAST(reviewed_at AS TIMESTAMP) DESC NULLS LAST, order_id) = 1""",
    "mkt_fact": """
      SELECT l.line_id, l.order_id, l.sku, l.quantity, l.unit_price, p.order_payment, r.review_score,
        CAST(l.quantity * l.unit_price AS DECIMAL(18,2)) AS revenue
      FROM lines l
      LEFT JOIN (SELECT order_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS order_payment FROM payments GROUP BY order_id) p ON p.order_id = l.order_id
      LEFT JOIN (SELECT order_id, CAST(SUM(score) AS DOUBLE) / COUNT(*) AS review_score FROM mkt_reviews GROUP BY order_id) r ON r.order_id = l.order_id""",
}


def with_ctes(sql: str) -> str:
    """The query with every block it names, directly or through another block."""
    words = {name: re.compile(rf"\b{name}\b") for name in CTES}
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, word in words.items():
            if name not in needed and word.search(text):
                needed.add(name)
                pending.append(CTES[name])
    if not needed:
        return sql
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {blocks}\n{sql}"
