"""Queries for features, model, call queue, dashboard, questions, marketplace."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checkset.ctes import (
    AS_OF, HORIZON, QUEUE_N, SCORE_CUTOFF, TRAIN_CUTOFF, dround, ratio,
)
from mercato.checkset.registry import Frames, check
from mercato.operators.checks import CheckFailed
from mercato.operators.running import roc_auc
from mercato.parameters import AUC_CEILING, AUC_FLOOR
from mercato.plans import call_queue, features, marketplace, measures, propensity, trips, views
from mercato.plans.client_search import client_grams
from mercato.plans.table_functions import create_functions
from mercato.session import materialize
from mercato.sources import sample_tables

# -- features ------------------------------------------------------------------

DOUBLES = (
    "revenue_total", "mean_ticket", "cycle_days", "overdue_ratio", "recent_revenue",
    "recent_share_pct", "return_rate_pct",
)


def _feature(key: str, *names: str):
    """One or a few features per client at the scoring cutoff."""
    wanted = ", ".join(
        f"{dround(n, 6)} AS {n}" if n in DOUBLES else n for n in names
    )

    @check(key, f"SELECT client_id, {wanted} FROM feat_score")
    def _(x: Frames):
        return _rounded(x.score_features.select("client_id", *names))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in DOUBLES if n in df.columns})


_feature("feat_recency", "recency_days")
_feature("feat_frequency", "order_count")
_feature("feat_value", "revenue_total", "mean_ticket")
_feature("feat_cycle", "cycle_days")
_feature("feat_overdue", "overdue_ratio")
_feature("feat_tenure", "days_since_first_order", "days_since_registration")
_feature("feat_recent_90d", "recent_orders", "recent_revenue", "recent_share_pct")
_feature("feat_diversity", "distinct_categories", "distinct_brands", "multichannel")
_feature("feat_units", "units")
_feature("feat_return_rate", "return_rate_pct")
_feature("feat_visits", "recent_visits", "days_since_visit")
_feature("feat_open_opportunities", "open_opportunities")
_feature("feat_segment", "segment")

ALL_SQL = ", ".join(
    f"{dround(n, 6)} AS {n}" if n in DOUBLES else n
    for n in (*features.FEATURE_COLUMNS, "cutoff")
)


@check("features_score", f"SELECT {ALL_SQL} FROM feat_score")
def _(x: Frames):
    return _rounded(x.score_features)


@check("features_train", f"SELECT {ALL_SQL}, buys_next FROM labelled")
def _(x: Frames):
    return _rounded(x.train_features)


@check("label_buys_next", "SELECT client_id, buys_next FROM labelled")
def _(x: Frames):
    return x.train_features.select("client_id", "buys_next")


@check("base_rate", f"SELECT {dround('AVG(buys_next)', 9)} AS base_rate FROM labelled")
def _(x: Frames):
    return features.base_rate(x.train_features).select(F.round("base_rate", 9).alias("base_rate"))


# -- model -----------------------------------------------------------------------

AUC_SQL = """
    SELECT {name}(SUM(CASE WHEN y = 1 THEN place END) - SUM(y) * (SUM(y) + 1) / 2.0)
      / (CAST(SUM(y) AS DOUBLE) * (COUNT(*) - SUM(y))) AS auc
    FROM (SELECT {key} y, rank() OVER ({part} ORDER BY s) + (COUNT(*) OVER (PARTITION BY {key} s) - 1) / 2.0 AS place
          FROM ({source}))"""


def _auc_sql(source: str) -> str:
    inner = AUC_SQL.format(name="", key="", part="", source=source)
    return f"SELECT {dround('auc', 9)} AS auc FROM ({inner})"


@check("ml_stratified_split", "SELECT client_id, buys_next, place <= ROUND(class_rows * 0.3) AS holdout FROM held")
def _(x: Frames):
    return propensity.with_holdout(x.stored_train_features).select("client_id", "buys_next", "holdout")


@check("ml_auc", _auc_sql("SELECT buys_next AS y, score AS s FROM judged"))
def _(x: Frames):
    return roc_auc(x.judged, "score", "buys_next").select(F.round("auc", 9).alias("auc"))


_BASE = "\nUNION ALL ".join(
    f"SELECT '{name}' AS name, {dround('auc', 9)} AS auc FROM (" + AUC_SQL.format(
        name="", key="", part="",
        source=f"SELECT buys_next AS y, {expr} AS s FROM held WHERE place <= ROUND(class_rows * 0.3)",
    ) + ")"
    for name, expr in (
        ("recency", "-recency_days"), ("revenue", "revenue_total"),
        ("overdue", f"COALESCE(overdue_ratio, 0.0)"),
    )
)


@check("ml_baselines", _BASE)
def _(x: Frames):
    _, test = propensity.split(x.stored_train_features)
    return propensity.baselines(test).select("name", F.round("auc", 9).alias("auc"))


@check("ml_lift_at_k", f"""
    SELECT CAST(hits AS BIGINT) AS hits, {dround('rate', 9)} AS base_rate, {dround(f'CAST(hits AS DOUBLE) / {QUEUE_N} / rate', 6)} AS lift
    FROM (SELECT SUM(buys_next) AS hits, (SELECT AVG(buys_next) FROM judged) AS rate
          FROM (SELECT * FROM judged ORDER BY score DESC, client_id LIMIT {QUEUE_N}))""")
def _(x: Frames):
    return propensity.lift_at_k(x.judged, QUEUE_N).select(
        "hits", F.round("base_rate", 9).alias("base_rate"), F.round("lift", 6).alias("lift")
    )


@check("ml_calibration", f"""
    SELECT band, COUNT(*) AS clients, CAST(SUM(buys_next) AS BIGINT) AS buyers, {dround('AVG(score)', 6)} AS mean_score,
      {dround('AVG(buys_next)', 6)} AS buying_rate
    FROM (SELECT buys_next, score, CASE WHEN score <= q1 THEN 'Cold' WHEN score <= q2 THEN 'Warm' WHEN score <= q3 THEN 'Hot' ELSE 'Very hot' END AS band
          FROM judged CROSS JOIN (SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2, quantile_cont(score, 0.75) AS q3 FROM judged))
    GROUP BY band""")
def _(x: Frames):
    out = propensity.calibration(x.judged)
    return out.withColumns({n: F.round(n, 6) for n in ("mean_score", "buying_rate")})


@check("ml_score_bands", "SELECT client_id, score, band FROM scores")
def _(x: Frames):
    return x.scores


def _trained(x: Frames):
    train, test = propensity.split(x.stored_train_features)
    return propensity.train(train), train, test


_INPUTS = " UNION ALL ".join(
    f"SELECT '{c}_{part}' AS feature" for c in features.NUMERIC_FEATURES for part in ("in", "missing")
)


@check("ml_train", f"""
    SELECT feature, CAST(1 AS DOUBLE) AS total_gain FROM ({_INPUTS} UNION ALL SELECT 'multichannel_flag'
      UNION ALL SELECT DISTINCT 'segment=' || segment FROM held WHERE NOT place <= ROUND(class_rows * 0.3))""")
def _(x: Frames):
    """The inputs of the trained model; their gains are shares of one whole."""
    model, _, _ = _trained(x)
    gains = x.spark.createDataFrame(propensity.importance_by_gain(model), "feature string, gain double")
    return gains.select("feature", F.round(gains.agg(F.sum("gain")).scalar(), 9).alias("total_gain"))


@check("ml_score", "SELECT client_id, true AS is_probability FROM feat_score")
def _(x: Frames):
    model, _, _ = _trained(x)
    scored = propensity.score(model, x.stored_score_features)
    return scored.select("client_id", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("is_probability"))


@check("ml_permutation_importance", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, true AS is_drop" for c in propensity.SWAPPABLE
))
def _(x: Frames):
    model, _, test = _trained(x)
    drops = propensity.permutation_importance(model, test)
    return drops.select("feature", F.coalesce(F.abs("auc_drop") <= 1, F.lit(False)).alias("is_drop"))


# A score of two features that SQL can follow, and the distance of each repeat's donors.
REPEATS = 3
STEPS = ", ".join(f"({r}, {int(hashlib.md5(f'{propensity.SEED}|{r}'.encode()).hexdigest()[:12], 16)})" for r in range(1, REPEATS + 1))


def _two_features(days: str, multi: str) -> str:
    return f"{dround(f'1.0 / (1 + {days})', 6)} + CASE WHEN {multi} THEN 0.01 ELSE 0.0 END"


_DRAWN = f"""
    SELECT feature, repeat, a.buys_next AS y, {_two_features(
        "CASE WHEN feature = 'recency_days' THEN d.recency_days ELSE a.recency_days END",
        "CASE WHEN feature = 'multichannel' THEN d.multichannel ELSE a.multichannel END")} AS s
    FROM (SELECT *, row_number() OVER (ORDER BY md5(concat(client_id, '|42')), client_id) AS spot, COUNT(*) OVER () AS n FROM labelled) a
    CROSS JOIN (SELECT unnest([{', '.join(f"'{c}'" for c in propensity.SWAPPABLE)}]) AS feature)
    CROSS JOIN (VALUES {STEPS}) t(repeat, step)
    JOIN (SELECT recency_days, multichannel, row_number() OVER (ORDER BY md5(concat(client_id, '|42')), client_id) AS spot FROM labelled) d
      ON d.spot = (a.spot + step % greatest(1, n - 1)) % n + 1"""
_DROPS = AUC_SQL.format(name="feature, repeat, ", key="feature, repeat, ", part="PARTITION BY feature, repeat", source=_DRAWN)
_BEFORE = AUC_SQL.format(name="", key="", part="", source=f"SELECT buys_next AS y, {_two_features('recency_days', 'multichannel')} AS s FROM labelled")


@check("ml_permutation_drops", f"""
    SELECT feature, {dround('AVG(b.auc - a.auc)', 9)} AS auc_drop
    FROM ({_DROPS} GROUP BY feature, repeat) a CROSS JOIN ({_BEFORE}) b GROUP BY feature""")
def _(x: Frames):
    """The exact drop of every feature under the score that SQL can follow."""
    def scored(df: DataFrame) -> DataFrame:
        extra = F.when(F.col("multichannel"), F.lit(0.01)).otherwise(F.lit(0.0))
        return df.withColumn("score", F.round(1.0 / (1 + F.col("recency_days")), 6) + extra)

    drops = propensity.permutation_drops(scored, x.stored_train_features, REPEATS)
    return drops.select("feature", F.round("auc_drop", 9).alias("auc_drop"))


@check("ml_gate", f"""
    SELECT {dround('auc', 9)} AS auc, {dround('lift', 6)} AS lift,
      auc > {AUC_FLOOR} AND auc < {AUC_CEILING} AND lift > 1 AS passed
    FROM ({_auc_sql("SELECT buys_next AS y, score AS s FROM judged")}),
      (SELECT CAST(SUM(buys_next) AS DOUBLE) / {QUEUE_N} / (SELECT AVG(buys_next) FROM judged) AS lift
       FROM (SELECT * FROM judged ORDER BY score DESC, client_id LIMIT {QUEUE_N}))""")
def _(x: Frames):
    """The gate's verdict on scores that SQL can follow."""
    scored = materialize(x.judged.select("client_id", "buys_next", "score"), "scored")
    judged = roc_auc(scored, "score", "buys_next").crossJoin(propensity.lift_at_k(scored, QUEUE_N).select("lift"))
    (row,) = judged.collect()
    try:
        propensity.model_gate(row["auc"], row["lift"])
        passed = True
    except CheckFailed:
        passed = False
    return judged.select(F.round("auc", 9).alias("auc"), F.round("lift", 6).alias("lift"), F.lit(passed).alias("passed"))


# -- queue -------------------------------------------------------------------------


@check("queue_eligible", "SELECT client_id, score, band, rep_id FROM eligible")
def _(x: Frames):
    return call_queue.queue_eligible(x.scores, x.portfolio)


@check("rep_label", "SELECT rep_id, rep FROM rep_names")
def _(x: Frames):
    return call_queue.rep_label(x.dim_rep)


@check("queue_reason", "SELECT client_id, reason, advice FROM reasons")
def _(x: Frames):
    return call_queue.queue_reason(x.score_features)


@check("weekly_queue", "SELECT * FROM queue")
def _(x: Frames):
    return x.queue


FIRST_REP = "(SELECT MIN(rep) FROM queue)"


def _functions(x: Frames, *needed: str) -> str:
    """Temporary functions over this query's own views; returns their prefix."""
    tag = f"t{uuid.uuid4().hex[:12]}"
    frames = {
        "queue": x.queue, "scores": x.scores, "clients": x.dim_client, "features": x.stored_score_features,
        "grams": client_grams(x.dim_client),
    }
    names = {}
    for name, frame in frames.items():
        # A view used by the called function is written once: it is read in several places.
        names[name] = f"{tag}_{name}"
        (materialize(frame, name) if name in needed else frame).createOrReplaceTempView(names[name])
    create_functions(x.spark, names, prefix=f"{tag}_", temporary=True)
    return tag


@check("fn_prioritise", f"""
    SELECT position, legal_name, city, score, band, reason, advice FROM queue WHERE rep = {FIRST_REP} AND position <= 5""")
def _(x: Frames):
    t = _functions(x, "queue")
    return x.spark.sql(f"SELECT * FROM {t}_prioritise((SELECT MIN(rep) FROM {t}_queue), 5)")


EXPLAIN_SQL = f"""
    SELECT c.legal_name, s.score, s.band, q.reason, q.advice, f.recency_days, {dround('f.overdue_ratio', 6)} AS overdue_ratio
    FROM scores s JOIN dimclient c ON c.client_id = s.client_id JOIN feat_score f ON f.client_id = s.client_id
    LEFT JOIN queue q ON q.client_id = s.client_id WHERE s.client_id = """


@check("fn_explain", EXPLAIN_SQL + "'18'")
def _(x: Frames):
    t = _functions(x, "queue", "scores")
    return _rounded(x.spark.sql(f"SELECT * FROM {t}_explain_client('18')"))


@check("q_why_client", EXPLAIN_SQL + "(SELECT MIN(client_id) FROM queue)")
def _(x: Frames):
    t = _functions(x, "queue", "scores")
    return _rounded(x.spark.sql(f"SELECT * FROM {t}_explain_client((SELECT MIN(client_id) FROM {t}_queue))"))


@check("fn_rep_summary", f"""
    SELECT CAST(COUNT(*) AS BIGINT) AS contacts, {dround('AVG(score)', 2)} AS mean_score,
      (SELECT band FROM queue WHERE rep = {FIRST_REP} GROUP BY band ORDER BY COUNT(*) DESC, band LIMIT 1) AS common_band
    FROM queue WHERE rep = {FIRST_REP}""")
def _(x: Frames):
    t = _functions(x, "queue")
    return x.spark.sql(f"SELECT * FROM {t}_rep_summary((SELECT MIN(rep) FROM {t}_queue))")


@check("fn_find_client", """
    SELECT client_id, legal_name, city, segment FROM dimclient
    WHERE legal_name ILIKE '%client 1%' OR city ILIKE '%client 1%' ORDER BY client_id LIMIT 20""")
def _(x: Frames):
    t = _functions(x)
    return x.spark.sql(f"SELECT * FROM {t}_find_client('client 1')")


# -- dashboard -----------------------------------------------------------------------

MONEY_SUM = "CAST(SUM({0}) AS DECIMAL(38,2)) AS {0}"
REVENUE, MARGIN = MONEY_SUM.format("revenue"), MONEY_SUM.format("margin")


@check("measures", f"""
    SELECT year, segment, {REVENUE}, {MARGIN}, COUNT(DISTINCT order_id) AS orders,
      {dround(ratio('SUM(revenue)', 'COUNT(DISTINCT order_id)'), 6)} AS ticket,
      {dround(ratio('CAST(SUM(margin) AS DOUBLE) * 100', 'SUM(revenue)'), 6)} AS margin_pct
    FROM fact GROUP BY year, segment""")
def _(x: Frames):
    out = measures.measure_query(
        x.fact, ["year", "segment"], ["revenue", "margin", "orders", "ticket", "margin_pct"]
    )
    return out.withColumns({n: F.round(n, 6) for n in ("ticket", "margin_pct")})


@check("filter_multi", f"SELECT brand, {REVENUE} FROM fact WHERE year IN (1999, 2000) AND segment IN ('BUILDING') GROUP BY brand")
def _(x: Frames):
    chosen = {"year": [1999, 2000], "segment": ["BUILDING"], "city": None}
    return measures.measure_query(x.fact, ["brand"], ["revenue"], chosen)


@check("kpi_revenue", f"SELECT {REVENUE} FROM fact")
def _(x: Frames):
    return measures.kpi(x.fact, "revenue")


@check("kpi_margin", f"SELECT {MARGIN} FROM fact")
def _(x: Frames):
    return measures.kpi(x.fact, "margin")


@check("kpi_orders", "SELECT COUNT(DISTINCT order_id) AS orders FROM fact")
def _(x: Frames):
    return measures.kpi(x.fact, "orders")


@check("kpi_ticket", f"SELECT {dround(ratio('SUM(revenue)', 'COUNT(DISTINCT order_id)'), 6)} AS ticket FROM fact")
def _(x: Frames):
    return measures.kpi(x.fact, "ticket").select(F.round("ticket", 6).alias("ticket"))


@check("line_revenue_month", f"""
    SELECT CAST(date_trunc('month', ordered_on) AS DATE) AS month_start, {REVENUE} FROM fact GROUP BY 1 ORDER BY 1""")
def _(x: Frames):
    return measures.revenue_by_month(x.fact)


@check("bar_revenue_brand", f"SELECT brand, {REVENUE} FROM fact GROUP BY brand ORDER BY 2 DESC")
def _(x: Frames):
    return measures.revenue_by_brand(x.fact)


@check("bar_margin_category", f"""
    SELECT category, {dround(ratio('CAST(SUM(margin) AS DOUBLE) * 100', 'SUM(revenue)'), 6)} AS margin_pct FROM fact GROUP BY category""")
def _(x: Frames):
    return measures.margin_by_category(x.fact).withColumn("margin_pct", F.round("margin_pct", 6))


@check("bar_revenue_channel", f"SELECT channel, {REVENUE} FROM fact GROUP BY channel ORDER BY 2 DESC")
def _(x: Frames):
    return measures.revenue_by_channel(x.fact)


TOP_SQL = f"SELECT legal_name, segment, city, {REVENUE} FROM fact GROUP BY ALL ORDER BY revenue DESC, legal_name, segment, city LIMIT 20"


@check("table_top_clients", f"SELECT * FROM ({TOP_SQL}) WHERE segment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')")
def _(x: Frames):
    return measures.top_clients(x.fact, segments=["BUILDING", "MACHINERY", "AUTOMOBILE"])


@check("table_queue", "SELECT rep, position, legal_name, city, score, band, reason, advice FROM queue ORDER BY rep, position")
def _(x: Frames):
    return measures.queue_table(x.queue)


# -- questions -------------------------------------------------------------------------


@check("q_launch_top10", """
    SELECT sku, title, launch_per_day, rest_per_day FROM launch_view ORDER BY launch_per_day DESC NULLS LAST, sku LIMIT 10""")
def _(x: Frames):
    return measures.launch_top(views.launch_effect(x.fact, x.dim_product, AS_OF))


@check("q_brands_6_months", f"""
    SELECT brand, {dround('CAST(r AS DOUBLE) / 1e6', 1)} AS revenue_millions
    FROM (SELECT brand, SUM(revenue) AS r FROM fact WHERE ordered_on >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE)
          GROUP BY brand ORDER BY r DESC, brand LIMIT 5)""")
def _(x: Frames):
    return measures.top_brands(x.fact, AS_OF)


@check("q_lost_revenue", """
    SELECT COUNT(*) AS clients_at_risk, CAST(SUM(CAST(monthly_revenue AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS monthly_revenue_lost
    FROM risk_view""")
def _(x: Frames):
    return measures.lost_revenue(views.clients_at_risk(x.dim_client, AS_OF))


@check("q_stockout_top5", "SELECT brand, stock_out_pct FROM stockout_view ORDER BY stock_out_pct DESC, brand LIMIT 5")
def _(x: Frames):
    return measures.worst_stockouts(views.stockout_by_brand(x.stock, x.dim_product))


@check("q_category_margin", "SELECT category, revenue, margin, margin_pct FROM category_view ORDER BY margin_pct, category")
def _(x: Frames):
    return measures.categories_by_margin(views.category_margin(x.fact))


@check("q_season", "SELECT year, month, revenue, peak_month FROM month_view ORDER BY year, month")
def _(x: Frames):
    return measures.season(views.monthly_revenue(x.fact, x.calendar))


@check("q_call_list", f"""
    SELECT rep, position, legal_name, {dround('score', 2)} AS score, reason FROM queue WHERE rep = 'Rep 0 (#9)' ORDER BY position""")
def _(x: Frames):
    return measures.call_list(x.queue, "Rep 0 (#9)")


@check("gross_revenue", f"""
    SELECT CAST(SUM(revenue) FILTER (WHERE NOT is_return) AS DECIMAL(38,2)) AS gross_revenue,
      CAST(SUM(revenue) AS DECIMAL(38,2)) AS net_revenue FROM fact""")
def _(x: Frames):
    return measures.gross_revenue(x.fact)


# -- marketplace and sample project ---------------------------------------------------


@check("mkt_review_dedup", "SELECT review_id, order_id, score, CAST(reviewed_at AS STRING) AS reviewed_at FROM mkt_reviews")
def _(x: Frames):
    return x.market_reviews.withColumn("reviewed_at", F.col("reviewed_at").cast("string"))


@check("mkt_geo_by_zip", f"""
    SELECT LPAD(zip_raw, 5, '0') AS zip, {dround('CAST(SUM(lat) AS DOUBLE) / COUNT(*)', 6)} AS lat,
      {dround('CAST(SUM(lng) AS DOUBLE) / COUNT(*)', 6)} AS lng, COUNT(*) AS points FROM mkt_geo GROUP BY zip_raw""")
def _(x: Frames):
    return marketplace.geo_by_zip(sample_tables.marketplace_geo(x.spark, x.folder))


@check("mkt_dim_person", """
    SELECT person_id, COUNT(DISTINCT customer_id) AS customer_ids, MIN(LPAD(zip_raw, 5, '0')) AS zip
    FROM mkt_customer GROUP BY person_id""")
def _(x: Frames):
    return marketplace.dim_person(sample_tables.marketplace_customer(x.spark, x.folder))


@check("mkt_fact_lines", "SELECT * FROM mkt_fact")
def _(x: Frames):
    return x.market_fact


@check("mkt_order_level_total", """
    SELECT CAST(SUM(p) AS DECIMAL(38,2)) AS payment_total, COUNT(*) AS orders
    FROM (SELECT order_id, MAX(order_payment) AS p FROM mkt_fact GROUP BY order_id)""")
def _(x: Frames):
    return marketplace.order_level_total(x.market_fact)


@check("mkt_peak_months", """
    SELECT CAST(d AS DATE) AS day, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, month(d) IN (5, 8, 11, 12) AS peak_month
    FROM (SELECT unnest(generate_series(CAST(MIN(ordered_on) AS TIMESTAMP), CAST(MAX(ordered_on) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
          FROM sales_orders)""")
def _(x: Frames):
    return marketplace.calendar(x.orders, "ordered_on")


def _sums(test: str, found: str, wanted: str) -> str:
    return (
        f"SELECT '{test}' AS test, CAST(f AS STRING) AS value, CAST(w AS STRING) AS expected, abs(f - w) <= 0.01 AS passed"
        f" FROM (SELECT CAST(({found}) AS DECIMAL(38,2)) AS f, CAST(({wanted}) AS DECIMAL(38,2)) AS w)"
    )


def _zero(test: str, count: str) -> str:
    return f"SELECT '{test}' AS test, CAST(n AS STRING) AS value, '0' AS expected, n = 0 AS passed FROM (SELECT ({count}) AS n)"


@check("mkt_quality", "\nUNION ALL ".join([
    _sums("mkt_revenue_match", "SELECT SUM(revenue) FROM mkt_fact", "SELECT SUM(quantity * unit_price) FROM lines"),
    _zero("mkt_no_orphan_order", "SELECT COUNT(*) FROM mkt_fact f ANTI JOIN sales_orders s ON s.order_id = f.order_id"),
    _zero("mkt_rating_range", "SELECT COUNT(*) FROM mkt_reviews WHERE NOT COALESCE(score BETWEEN 1 AND 5, false)"),
    "SELECT 'fact_volume' AS test, CAST(n AS STRING) AS value, '1000 to 100000000000' AS expected,"
    " n BETWEEN 1000 AND 100000000000 AS passed FROM (SELECT COUNT(*) AS n FROM mkt_fact)",
    _sums("mkt_mart_equals_fact", "SELECT SUM(r) FROM (SELECT sku, SUM(revenue) AS r FROM mkt_fact GROUP BY sku)",
          "SELECT SUM(revenue) FROM mkt_fact"),
]))
def _(x: Frames):
    from mercato.functions.columns import total

    fact = materialize(x.market_fact, "market")
    mart = fact.groupBy("sku").agg(total(F.col("revenue")).alias("revenue"))
    return marketplace.quality(fact, x.lines, x.orders, x.market_reviews, mart, (1000, 100_000_000_000))


@check("sample_fares_by_zip", "SELECT pickup_zip, CAST(SUM(fare_amount) AS DECIMAL(38,2)) AS total_fare FROM trip GROUP BY pickup_zip")
def _(x: Frames):
    return trips.fares_by_zip(sample_tables.trip(x.spark, x.folder))
