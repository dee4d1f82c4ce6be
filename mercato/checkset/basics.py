"""Queries for single expressions, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.checkset.ctes import AS_OF, TRAIN_CUTOFF, dround, pct, ratio
from mercato.checkset.registry import Frames, check
from mercato.functions import columns as c
from mercato.operators import groups, running
from mercato.operators.skew import salted_join
from mercato.plans import gold, propensity, silver
from mercato.plans.call_queue import rank_in_group
from mercato.plans.features import until
from mercato.plans.measures import last_months
from mercato.sources import sample_tables

# -- expressions --------------------------------------------------------------


@check("clean_tax_id", "SELECT client_id, LPAD(regexp_replace(tax_id, '[^0-9]', '', 'g'), 14, '0') AS tax_id FROM client_raw")
def _(x: Frames):
    return x.raw("client").select("client_id", c.clean_tax_id(F.col("tax_id")).alias("tax_id"))


@check("clean_name", "SELECT client_id, legal_name FROM clients_typed")
def _(x: Frames):
    return x.raw("client").select("client_id", c.clean_name(F.col("legal_name")).alias("legal_name"))


@check("parse_date_multi", "SELECT order_id, ordered_on FROM sales_orders")
def _(x: Frames):
    return x.raw("order").select("order_id", c.parse_date_multi(F.col("ordered_on")).alias("ordered_on"))


@check("parse_date_iso", """
    SELECT order_id, CASE WHEN regexp_matches(ordered_on, '^[0-9]{4}-') THEN TRY_CAST(ordered_on AS DATE) END AS ordered_on
    FROM order_raw""")
def _(x: Frames):
    return x.raw("order").select("order_id", c.parse_date_iso(F.col("ordered_on")).alias("ordered_on"))


@check("flag_from_code", "SELECT sku, active = 'S' AS active FROM product_raw")
def _(x: Frames):
    return x.raw("product").select("sku", c.flag_from_code(F.col("active"), "S").alias("active"))


@check("cast_money", """
    SELECT line_id, CAST(unit_price AS DECIMAL(18,2)) AS unit_price, CAST(discount_pct AS DECIMAL(9,4)) AS discount_pct
    FROM line_raw""")
def _(x: Frames):
    return x.raw("line").select(
        "line_id", c.money(F.col("unit_price")).alias("unit_price"),
        c.rate(F.col("discount_pct")).alias("discount_pct"),
    )


@check("cast_lenient", """
    SELECT opportunity_id, TRY_CAST(probability_pct AS DECIMAL(9,4)) AS probability_pct,
      TRY_CAST(cycle_days AS INT) AS cycle_days FROM opportunity_raw""")
def _(x: Frames):
    return x.raw("opportunity").select(
        "opportunity_id", c.lenient(F.col("probability_pct"), "decimal(9,4)").alias("probability_pct"),
        c.whole(F.col("cycle_days")).alias("cycle_days"),
    )


@check("sign_split", "SELECT line_id, quantity, abs_quantity, is_return FROM lines")
def _(x: Frames):
    return x.lines.select("line_id", "quantity", "abs_quantity", "is_return")


@check("cancel_zeroing", "SELECT order_id, cancelled, net_value FROM sales_orders")
def _(x: Frames):
    return x.orders.select("order_id", "cancelled", "net_value")


@check("case_banding", """
    SELECT sku, CASE WHEN list_price <= 1000 THEN 'low' WHEN list_price <= 1500 THEN 'middle' ELSE 'high' END AS price_band
    FROM products""")
def _(x: Frames):
    price = F.col("list_price")
    return x.products.select("sku", c.banded([(price <= 1000, "low"), (price <= 1500, "middle")], "high").alias("price_band"))


@check("date_parts", """
    SELECT order_id, CAST(year(ordered_on) AS INT) AS year, CAST(month(ordered_on) AS INT) AS month,
      CAST(quarter(ordered_on) AS INT) AS quarter FROM sales_orders""")
def _(x: Frames):
    d = F.col("ordered_on")
    return x.orders.select("order_id", F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"))


@check("date_names", "SELECT order_id, monthname(ordered_on) AS month_name, dayname(ordered_on) AS weekday FROM sales_orders")
def _(x: Frames):
    d = F.col("ordered_on")
    return x.orders.select(
        "order_id", F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("weekday")
    )


@check("month_trunc", "SELECT order_id, CAST(date_trunc('month', ordered_on) AS DATE) AS month_start FROM sales_orders")
def _(x: Frames):
    return x.orders.select("order_id", F.trunc("ordered_on", "month").alias("month_start"))


@check("date_arith", f"""
    SELECT order_id, ordered_on + 120 AS later, ordered_on - 90 AS earlier, CAST(DATE '{AS_OF}' - ordered_on AS INT) AS days
    FROM sales_orders""")
def _(x: Frames):
    d = F.col("ordered_on")
    return x.orders.select(
        "order_id", F.date_add(d, 120).alias("later"), F.date_sub(d, 90).alias("earlier"),
        F.datediff(c.day(AS_OF), d).alias("days"),
    )


@check("months_between_ratio", "SELECT client_id, monthly_revenue FROM risk_view")
def _(x: Frames):
    from mercato.plans.views import clients_at_risk

    return clients_at_risk(x.dim_client, AS_OF).select("client_id", "monthly_revenue")


@check("add_months_filter", f"""
    SELECT order_id, ordered_on FROM sales_orders WHERE ordered_on >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE)""")
def _(x: Frames):
    return last_months(x.orders, "ordered_on", AS_OF).select("order_id", "ordered_on")


@check("least_date", f"SELECT sku, LEAST(DATE '{AS_OF}', launched_on + 120) AS ends_on FROM products WHERE launched_on IS NOT NULL")
def _(x: Frames):
    return x.products.where("launched_on is not null").select(
        "sku", F.least(c.day(AS_OF), F.date_add("launched_on", 120)).alias("ends_on")
    )


@check("safe_ratio", f"SELECT order_id, {ratio('net_value', 'total_value', 3)} AS kept_share FROM sales_orders")
def _(x: Frames):
    return x.orders.select("order_id", c.money_ratio(F.col("net_value"), F.col("total_value"), 3).alias("kept_share"))


@check("pct_ratio", f"SELECT payment_id, {pct('net_amount', 'amount')} AS net_pct FROM payments")
def _(x: Frames):
    return x.payments.select("payment_id", c.pct_ratio(F.col("net_amount"), F.col("amount")).alias("net_pct"))


@check("coalesce_default", "SELECT sku, COALESCE(launched_on, DATE '1900-01-01') AS launched_on FROM products")
def _(x: Frames):
    return x.products.select("sku", F.coalesce("launched_on", c.day("1900-01-01")).alias("launched_on"))


@check("null_predicate", "SELECT rep_id, terminated_on IS NULL AS active FROM reps")
def _(x: Frames):
    return x.reps.select("rep_id", F.col("terminated_on").isNull().alias("active"))


@check("in_list", "SELECT order_id, month IN (4, 6, 10) AS peak, channel NOT IN ('1-URGENT', '2-HIGH') AS calm FROM sales_orders")
def _(x: Frames):
    return x.orders.select(
        "order_id", F.col("month").isin(4, 6, 10).alias("peak"),
        (~F.col("channel").isin("1-URGENT", "2-HIGH")).alias("calm"),
    )


@check("between", "SELECT order_id, total_value BETWEEN 10000 AND 50000 AS usual FROM sales_orders")
def _(x: Frames):
    return x.orders.select("order_id", F.col("total_value").between(10000, 50000).alias("usual"))


@check("concat_text", "SELECT rep_id, CONCAT(rep_name, ' (#', rep_id, ')') AS label FROM reps")
def _(x: Frames):
    return x.reps.select("rep_id", F.concat("rep_name", F.lit(" (#"), "rep_id", F.lit(")")).alias("label"))


@check("join_text", "SELECT region, string_agg(DISTINCT state, ', ' ORDER BY state) AS states FROM reps GROUP BY region")
def _(x: Frames):
    # Distinct states are combined before the lists, which are as long as a region
    # has states.
    states = x.reps.select("region", "state").distinct()
    return states.groupBy("region").agg(F.concat_ws(", ", F.sort_array(F.collect_list("state"))).alias("states"))


@check("text_search", "SELECT client_id, legal_name, city FROM clients WHERE legal_name ILIKE '%client 1%' OR city ILIKE '%client 1%'")
def _(x: Frames):
    hit = c.contains_term([F.col("legal_name"), F.col("city")], "CLIENT 1")
    return x.clients.where(hit).select("client_id", "legal_name", "city")


@check("length_check", "SELECT client_id, CAST(length(tax_id) AS INT) AS n FROM clients")
def _(x: Frames):
    return x.clients.select("client_id", F.length("tax_id").alias("n"))


def _brands_of(products: DataFrame, key: str) -> DataFrame:
    """Brands are few by nature, however many products there are."""
    return products.groupBy(key).agg(F.sort_array(F.collect_set("brand")).alias("brands"))


BRANDS_SQL = "SELECT category, MIN(brand) AS first, list_sort(list(DISTINCT brand)) AS brands FROM products GROUP BY category"


@check("array_filter", f"SELECT category, [b FOR b IN brands IF b <> first] AS others FROM ({BRANDS_SQL})")
def _(x: Frames):
    listed = _brands_of(x.products, "category")
    return listed.select("category", F.filter("brands", lambda b: b != F.col("brands")[0]).alias("others"))


@check("explode_array", f"SELECT category, unnest(brands) AS brand FROM ({BRANDS_SQL})")
def _(x: Frames):
    return _brands_of(x.products, "category").select("category", F.explode("brands").alias("brand"))


@check("date_spine", """
    SELECT CAST(unnest(generate_series(CAST(MIN(ordered_on) AS TIMESTAMP), CAST(MAX(ordered_on) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
    FROM sales_orders""")
def _(x: Frames):
    return gold.date_spine(x.orders, "ordered_on")


@check("fail_if", "SELECT 'ok' AS outcome")
def _(x: Frames):
    counts = x.orders.agg(F.count_if(F.col("ordered_on").isNull()).alias("n"))
    return counts.select(c.fail_if(F.col("n") > 0, "orders without a date").alias("outcome"))


@check("round_abs", f"""
    SELECT order_id, abs(ROUND(total_value, 1) - total_value) <= 0.01 AS near FROM sales_orders""")
def _(x: Frames):
    v = F.col("total_value")
    return x.orders.select("order_id", (F.abs(F.round(v, 1) - v) <= F.lit("0.01").cast("decimal(3,2)")).alias("near"))


@check("to_text", "SELECT order_id, CAST(total_value AS STRING) AS total_text FROM sales_orders")
def _(x: Frames):
    return x.orders.select("order_id", F.col("total_value").cast("string").alias("total_text"))


@check("bool_logic", """
    SELECT o.opportunity_id, won OR lost AS closed, NOT won AND probability_pct > 50 AS promising,
      NOT (probability_pct > 50) OR lost AS doubtful FROM opportunities o""")
def _(x: Frames):
    won, lost, likely = F.col("won"), F.col("lost"), F.col("probability_pct") > 50
    return x.opportunities.select(
        "opportunity_id", (won | lost).alias("closed"), (~won & likely).alias("promising"),
        (~likely | lost).alias("doubtful"),
    )


@check("now_today", f"SELECT DATE '{AS_OF}' AS today, COUNT(*) AS past_orders FROM sales_orders WHERE ordered_on < DATE '{AS_OF}'")
def _(x: Frames):
    return x.orders.where(F.col("ordered_on") < c.day(AS_OF)).agg(F.count(F.lit(1)).alias("past_orders")).select(
        c.day(AS_OF).alias("today"), "past_orders"
    )


@check("cte_derived", """
    SELECT year, MAX(value) AS best_month FROM (
      SELECT year, month, CAST(SUM(net_value) AS DECIMAL(38,2)) AS value FROM sales_orders GROUP BY year, month) GROUP BY year""")
def _(x: Frames):
    monthly = x.orders.groupBy("year", "month").agg(c.total(F.col("net_value")).alias("value"))
    return monthly.groupBy("year").agg(F.max("value").alias("best_month"))


@check("parse_ts_lenient", "SELECT order_id, TRY_CAST(reviewed_at AS TIMESTAMP) IS NULL AS unreadable, CAST(TRY_CAST(reviewed_at AS TIMESTAMP) AS STRING) AS reviewed_at FROM mkt_review")
def _(x: Frames):
    raw = sample_tables.marketplace_review(x.spark, x.folder)
    ts = c.parse_ts_lenient(F.col("reviewed_at"))
    return raw.select("order_id", ts.isNull().alias("unreadable"), ts.cast("string").alias("reviewed_at"))


@check("clean_zip", "SELECT customer_id, LPAD(zip_raw, 5, '0') AS zip FROM mkt_customer")
def _(x: Frames):
    raw = sample_tables.marketplace_customer(x.spark, x.folder)
    return raw.select("customer_id", c.clean_zip(F.col("zip_raw")).alias("zip"))


# -- joins -----------------------------------------------------------------------


@check("join_inner", "SELECT o.order_id, p.amount FROM sales_orders o JOIN payments p ON p.order_id = o.order_id")
def _(x: Frames):
    return x.orders.select("order_id").join(x.payments, "order_id").select("order_id", "amount")


@check("join_star", "SELECT line_id, client_id, sku, rep_id, revenue FROM fact")
def _(x: Frames):
    return x.fact.select("line_id", "client_id", "sku", "rep_id", "revenue")


@check("join_left", "SELECT l.line_id, p.launched_on FROM lines l LEFT JOIN (SELECT * FROM products WHERE launched_on IS NOT NULL) p ON p.sku = l.sku")
def _(x: Frames):
    launched = x.products.where("launched_on is not null").select("sku", "launched_on")
    return salted_join(x.lines.select("line_id", "sku"), launched, "sku", ["line_id"], "left").select("line_id", "launched_on")


@check("join_anti", "SELECT COUNT(*) AS lines_without_launch FROM lines l ANTI JOIN (SELECT sku FROM products WHERE launched_on IS NOT NULL) p ON p.sku = l.sku")
def _(x: Frames):
    launched = x.products.where("launched_on is not null").select("sku")
    per_sku = x.lines.groupBy("sku").agg(F.count(F.lit(1)).alias("n"))
    return per_sku.join(launched, "sku", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines_without_launch"))


@check("join_multi_key", """
    SELECT o.year, o.month, o.orders, p.payments FROM
      (SELECT year, month, COUNT(*) AS orders FROM sales_orders GROUP BY year, month) o
    JOIN (SELECT CAST(year(due_on) AS INT) AS year, CAST(month(due_on) AS INT) AS month, COUNT(*) AS payments
          FROM payments GROUP BY 1, 2) p ON p.year = o.year AND p.month = o.month""")
def _(x: Frames):
    orders = x.orders.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))
    paid = x.payments.groupBy(F.year("due_on").alias("year"), F.month("due_on").alias("month")).agg(
        F.count(F.lit(1)).alias("payments")
    )
    return orders.join(paid, ["year", "month"])


@check("join_survivor_map", "SELECT source_id, client_id FROM idmap")
def _(x: Frames):
    return gold.id_map(x.clients, x.merges)


@check("join_distinct_side", """
    SELECT s.client_id, s.net_revenue, p.rep_id FROM dimclient s
    JOIN (SELECT DISTINCT client_id, rep_id FROM portfolio WHERE current) p ON p.client_id = s.client_id""")
def _(x: Frames):
    pairs = x.portfolio.where("current").select("client_id", "rep_id").distinct()
    return salted_join(pairs, x.dim_client.select("client_id", "net_revenue"), "client_id", ["rep_id"]).select(
        "client_id", "net_revenue", "rep_id"
    )


@check("scalar_subquery", """
    SELECT CAST((SELECT SUM(net_value) FROM sales_orders) AS DECIMAL(38,2)) AS order_value,
      CAST((SELECT SUM(amount) FROM payments) AS DECIMAL(38,2)) AS paid_value""")
def _(x: Frames):
    paid = x.payments.agg(c.total(F.col("amount"))).scalar()
    return x.orders.agg(c.total(F.col("net_value")).alias("order_value")).select("order_value", paid.alias("paid_value"))


@check("asof_filter", f"SELECT client_id, COUNT(DISTINCT order_id) AS orders FROM fact WHERE ordered_on <= DATE '{TRAIN_CUTOFF}' GROUP BY client_id")
def _(x: Frames):
    return until(x.fact, "ordered_on", TRAIN_CUTOFF).groupBy("client_id").agg(F.countDistinct("order_id").alias("orders"))


@check("date_band", """
    SELECT f.sku, COUNT(*) FILTER (WHERE f.ordered_on < p.launched_on + 120) AS early,
      COUNT(*) FILTER (WHERE f.ordered_on >= p.launched_on AND f.ordered_on < p.launched_on + 120) AS early_bounded
    FROM fact f JOIN products p ON p.sku = f.sku WHERE p.launched_on IS NOT NULL GROUP BY f.sku""")
def _(x: Frames):
    daily = x.fact.groupBy("sku", "ordered_on").agg(F.count(F.lit(1)).alias("n"))
    launched = x.products.where("launched_on is not null").select("sku", "launched_on")
    date, start = F.col("ordered_on"), F.col("launched_on")

    def rows(bounded: bool):
        return F.sum(F.when(c.in_band(date, start, 120, bounded), F.col("n")).otherwise(0))

    return daily.join(launched, "sku").groupBy("sku").agg(rows(False).alias("early"), rows(True).alias("early_bounded"))


# -- aggregates -------------------------------------------------------------------


@check("agg_group", f"""
    SELECT channel, COUNT(*) AS orders, CAST(SUM(net_value) AS DECIMAL(38,2)) AS value, MIN(ordered_on) AS first_on,
      MAX(ordered_on) AS last_on, {ratio('SUM(net_value)', 'COUNT(*)', 2)} AS mean_value
    FROM sales_orders GROUP BY channel""")
def _(x: Frames):
    value, n = c.total(F.col("net_value")), F.count(F.lit(1))
    return x.orders.groupBy("channel").agg(
        n.alias("orders"), value.alias("value"), F.min("ordered_on").alias("first_on"),
        F.max("ordered_on").alias("last_on"), c.money_ratio(value, n, 2).alias("mean_value"),
    )


@check("agg_global", "SELECT COUNT(*) AS orders, MIN(ordered_on) AS first_on, MAX(ordered_on) AS last_on FROM sales_orders")
def _(x: Frames):
    return x.orders.agg(
        F.count(F.lit(1)).alias("orders"), F.min("ordered_on").alias("first_on"), F.max("ordered_on").alias("last_on")
    )


@check("agg_filter", f"""
    SELECT payment_status, COUNT(*) FILTER (WHERE installments > 3) AS long_plans,
      CAST(SUM(amount) FILTER (WHERE method = 'Card') AS DECIMAL(38,2)) AS card,
      MIN(paid_on) FILTER (WHERE method = 'Slip') AS first_slip, MAX(paid_on) FILTER (WHERE method = 'Slip') AS last_slip,
      {ratio("SUM(installments) FILTER (WHERE method = 'Card')", "COUNT(installments) FILTER (WHERE method = 'Card')", 2)} AS mean_card_plan
    FROM payments GROUP BY payment_status""")
def _(x: Frames):
    return x.spark.sql("""
        SELECT payment_status, COUNT(*) FILTER (WHERE installments > 3) AS long_plans,
          CAST(SUM(amount) FILTER (WHERE method = 'Card') AS DECIMAL(38,2)) AS card,
          MIN(paid_on) FILTER (WHERE method = 'Slip') AS first_slip,
          MAX(paid_on) FILTER (WHERE method = 'Slip') AS last_slip,
          CAST(ROUND(AVG(CAST(installments AS DECIMAL(20,0))) FILTER (WHERE method = 'Card'), 2) AS DOUBLE) AS mean_card_plan
        FROM {payments} GROUP BY payment_status""", payments=x.payments)


@check("agg_conditional", """
    SELECT sku, CAST(SUM(CASE WHEN is_return THEN 0 ELSE quantity END) AS BIGINT) AS sold,
      COUNT(CASE WHEN is_return THEN 1 END) AS returns FROM lines GROUP BY sku""")
def _(x: Frames):
    return x.lines.groupBy("sku").agg(
        F.sum(F.when(~F.col("is_return"), F.col("quantity")).otherwise(0)).alias("sold"),
        F.count(F.when(F.col("is_return"), 1)).alias("returns"),
    )


@check("agg_count_distinct", "SELECT rep_id, COUNT(DISTINCT client_id) AS clients FROM sales_orders GROUP BY rep_id")
def _(x: Frames):
    return x.orders.groupBy("rep_id").agg(F.countDistinct("client_id").alias("clients"))


@check("agg_multi_distinct", """
    SELECT client_id, COUNT(DISTINCT order_id) AS order_ids, COUNT(DISTINCT category) AS categorys,
      COUNT(DISTINCT brand) AS brands, COUNT(DISTINCT channel) AS channels FROM fact GROUP BY client_id""")
def _(x: Frames):
    return groups.distinct_counts(x.stored_fact, "client_id", ["order_id", "category", "brand", "channel"])


@check("agg_by_expression", "SELECT CAST(year(snapshot_on) AS INT) AS year, COUNT(*) AS snapshots FROM stock GROUP BY year(snapshot_on)")
def _(x: Frames):
    return x.stock.groupBy(F.year("snapshot_on").alias("year")).agg(F.count(F.lit(1)).alias("snapshots"))


@check("agg_having", "SELECT tax_id, COUNT(*) AS n FROM clients_typed GROUP BY tax_id HAVING COUNT(*) > 1")
def _(x: Frames):
    return silver.typed_clients(x.raw("client")).groupBy("tax_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@check("agg_collect", f"SELECT category, brands FROM ({BRANDS_SQL})")
def _(x: Frames):
    return _brands_of(x.products, "category")


@check("agg_mode", """
    SELECT rep_id, channel FROM (SELECT rep_id, channel, row_number() OVER (PARTITION BY rep_id ORDER BY n DESC, channel) AS k
      FROM (SELECT rep_id, channel, COUNT(*) AS n FROM sales_orders GROUP BY rep_id, channel)) WHERE k = 1""")
def _(x: Frames):
    return groups.most_frequent(x.orders, "rep_id", "channel")


@check("agg_duplicates", "SELECT COUNT(*) - COUNT(DISTINCT tax_id) AS repeated FROM clients_typed")
def _(x: Frames):
    return silver.typed_clients(x.raw("client")).agg(groups.duplicates("tax_id").alias("repeated"))


@check("distinct_rows", "SELECT DISTINCT year, month, peak_month FROM dimcalendar")
def _(x: Frames):
    return x.calendar.select("year", "month", "peak_month").distinct()


@check("agg_quantile_bins", f"""
    SELECT client_id, CASE WHEN score <= q1 THEN 'Cold' WHEN score <= q2 THEN 'Warm' WHEN score <= q3 THEN 'Hot' ELSE 'Very hot' END AS band
    FROM (SELECT client_id, CAST(net_revenue AS DOUBLE) AS score FROM dimclient),
      (SELECT quantile_cont(CAST(net_revenue AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(net_revenue AS DOUBLE), 0.5) AS q2,
         quantile_cont(CAST(net_revenue AS DOUBLE), 0.75) AS q3 FROM dimclient)""")
def _(x: Frames):
    plain = x.dim_client.select("client_id", F.col("net_revenue").cast("double").alias("score"))
    return running.quartile_band(plain, "score", ("Cold", "Warm", "Hot", "Very hot")).select("client_id", "band")


# -- windows, sorts, limits, sets ------------------------------------------------


@check("win_dedup_oldest", "SELECT tax_id, client_id, registered_on FROM clients_ranked WHERE place = 1")
def _(x: Frames):
    typed = silver.typed_clients(x.raw("client")).select("same_as", "tax_id", "client_id", "registered_on")
    kept = groups.keep_first(typed, "same_as", [F.asc_nulls_last("registered_on"), F.asc("client_id")])
    return kept.drop("same_as")


@check("win_rank_in_group", """
    SELECT client_id, rep, row_number() OVER (PARTITION BY rep ORDER BY score DESC, client_id) AS position FROM queue""")
def _(x: Frames):
    return rank_in_group(x.queue.drop("position"), "rep", ["-score", "client_id"]).select(
        "client_id", "rep", "position"
    )


@check("win_running_sum", """
    SELECT sku, CAST(SUM(r) OVER (ORDER BY r DESC, sku ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS upto
    FROM (SELECT sku, SUM(quantity * unit_price) AS r FROM lines GROUP BY sku)""")
def _(x: Frames):
    value = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    per_sku = x.lines.groupBy("sku").agg(c.total(value).alias("r"))
    return running.running_total(per_sku, "r", ["-r", "sku"], "upto").select(
        "sku", F.col("upto").cast("decimal(38,2)").alias("upto")
    )


@check("win_share_of_total", f"""
    SELECT sku, {dround(ratio('r', 't'), 6)} AS share
    FROM (SELECT sku, r, SUM(r) OVER () AS t FROM (SELECT sku, SUM(quantity * unit_price) AS r FROM lines GROUP BY sku))""")
def _(x: Frames):
    value = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    per_sku = x.lines.groupBy("sku").agg(c.total(value).alias("r"))
    everything = per_sku.agg(F.sum("r")).scalar()
    return per_sku.select("sku", F.round(c.safe_ratio(F.col("r"), everything), 6).alias("share"))


@check("win_count_in_group", "SELECT rep_id, COUNT(*) OVER (PARTITION BY rep_name) AS namesakes FROM reps")
def _(x: Frames):
    return groups.group_size(x.reps.select("rep_id", "rep_name"), "rep_name", ["rep_id"], "namesakes").select(
        "rep_id", "namesakes"
    )


@check("sort_rows", "SELECT channel, year, COUNT(*) AS orders FROM sales_orders GROUP BY channel, year ORDER BY orders DESC, channel, year")
def _(x: Frames):
    counts = x.orders.groupBy("channel", "year").agg(F.count(F.lit(1)).alias("orders"))
    return counts.orderBy(F.desc("orders"), "channel", "year")


@check("top_n", "SELECT order_id, total_value FROM sales_orders ORDER BY total_value DESC, order_id LIMIT 20")
def _(x: Frames):
    return x.orders.select("order_id", "total_value").orderBy(F.desc("total_value"), "order_id").limit(20)


@check("limit_any", "SELECT client_id, legal_name FROM clients WHERE contains(legal_name, 'lient 1') ORDER BY client_id LIMIT 20")
def _(x: Frames):
    hits = x.clients.where(F.contains("legal_name", F.lit("lient 1"))).select("client_id", "legal_name")
    return hits.orderBy("client_id").limit(20)


@check("union_all", "SELECT client_id, rep_id FROM visits UNION ALL SELECT client_id, rep_id FROM opportunities")
def _(x: Frames):
    return x.visits.select("client_id", "rep_id").unionByName(x.opportunities.select("client_id", "rep_id"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@check("ml_one_hot", "SELECT client_id, " + ", ".join(
    f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in SEGMENTS
) + " FROM clients")
def _(x: Frames):
    return x.clients.select("client_id", *c.one_hot(F.col("segment"), SEGMENTS, "segment"))
