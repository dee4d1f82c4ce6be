"""Star schema, marts, views, tests, features and queue on small frames."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators.checks import CheckFailed, gate, gate_text
from mercato.plans import call_queue, features, gold, marketplace, measures, propensity, quality, views
from mercato.vocabulary import PORTUGUESE

D = dt.date


@pytest.fixture()
def star(spark):
    clients = spark.createDataFrame(
        [("1", "00000000000001", "One", "S1", "City", "ST", D(2020, 1, 1)),
         ("2", "00000000000002", "Two", "S2", "Town", "ST", D(2020, 1, 1)),
         ("9", "00000000000009", "Quiet", "S2", "Town", "ST", D(2020, 1, 1))],
        "client_id string, tax_id string, legal_name string, segment string, city string, state string, registered_on date",
    )
    merges = spark.createDataFrame(
        [("1b", "1", "One", "S1", "City", 2)],
        "merged_id string, client_id string, legal_name string, segment string, city string, merged_rows int",
    )
    orders = spark.createDataFrame(
        [("o1", "1", "r", D(2024, 4, 1), "App", False, Decimal("30")), ("o2", "1b", "r", D(2024, 5, 1), "Web", False, Decimal("-10")),
         ("o3", "2", "r", D(2024, 5, 3), "App", True, Decimal("0")), ("o4", "?", "r", D(2024, 5, 4), "App", False, Decimal("10"))],
        "order_id string, client_id string, rep_id string, ordered_on date, channel string, cancelled boolean, net_value decimal(18,2)",
    ).withColumns({"year": F.year("ordered_on"), "month": F.month("ordered_on")})
    lines = spark.createDataFrame(
        [("l1", "o1", "A", 3, Decimal("10"), False), ("l2", "o2", "B", -1, Decimal("10"), True),
         ("l3", "o3", "A", 1, Decimal("10"), False), ("l4", "o4", "A", 1, Decimal("10"), False)],
        "line_id string, order_id string, sku string, quantity int, unit_price decimal(18,2), is_return boolean",
    )
    products = spark.createDataFrame(
        [("A", "ta", "c", "x", "n", Decimal("4"), Decimal("12"), D(2024, 3, 1), True), ("B", "tb", "c", "y", "n", Decimal("5"), Decimal("12"), None, False)],
        "sku string, title string, category string, brand string, note string, unit_cost decimal(18,2), list_price decimal(18,2), launched_on date, active boolean",
    )
    return clients, merges, orders, lines, products


@pytest.fixture()
def fact(star):
    clients, merges, orders, lines, products = star
    return gold.fact_sales(lines, orders, clients, merges, products)


def test_fact(fact, star):
    got = {r["line_id"]: r for r in fact.collect()}
    # l3 is cancelled; l4's client is unknown.
    assert set(got) == {"l1", "l2"}
    assert got["l2"]["client_id"] == "1" and got["l2"]["revenue"] == -10 and got["l2"]["margin"] == -5
    dropped = gold.dropped_lines(star[3], star[2], fact).first()
    assert tuple(dropped) == (3, 2, 1)


def test_building_the_fact_runs_nothing(star, spark):
    clients, merges, orders, lines, products = star
    spark.sparkContext.setJobGroup("plan-only", "no job may start")
    try:
        gold.fact_sales(lines, orders, clients, merges, products)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_partitions_outside_the_window_are_not_read(fact, folder, spark):
    path = f"{folder}/fact"
    fact.write.partitionBy("year", "month").parquet(path)
    stored = spark.read.parquet(path)
    for plan, bounds in (
        (features.label_buys_next(stored, "2024-01-10", 30), 4),
        (measures.last_months(stored, "ordered_on", "2024-06-01", 3), 2),
    ):
        # Spark names the partitions it reads in the metrics of the scan.
        plan.collect()
        read = {r["year"] * 12 + r["month"] for r in plan.select("year", "month").distinct().collect()} if bounds == 2 else set()
        assert all(m >= 2024 * 12 + 3 for m in read)
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("year#") >= bounds and text.count("month#") >= bounds / 2, text


def test_rep_months_copy_no_row(fact, star, spark):
    reps = spark.createDataFrame([("r", Decimal(1))], "rep_id string, monthly_target decimal(18,2)")
    assert "Expand" not in gold.mart_rep_month(fact, reps)._jdf.queryExecution().executedPlan().toString()


def test_dim_client(star):
    clients, merges, orders, _, _ = star
    got = {r["client_id"]: r for r in gold.dim_client(clients, merges, orders, "2024-06-01").collect()}
    assert (got["1"]["total_orders"], got["1"]["net_revenue"], got["1"]["days_since_order"]) == (2, 20, 31)
    assert (got["2"]["total_orders"], got["2"]["last_order_on"], got["2"]["days_since_order"]) == (1, None, None)
    assert (got["9"]["total_orders"], got["9"]["net_revenue"]) == (0, 0)


def test_abc_line_crosser_falls_to_the_next_class(spark):
    sales = spark.createDataFrame(
        [("a", Decimal(50)), ("b", Decimal(30)), ("c", Decimal(15)), ("d", Decimal(5))], "sku string, revenue decimal(18,2)"
    )
    assert {r["sku"]: r["abc_class"] for r in gold.abc_class(sales).collect()} == {"a": "A", "b": "A", "c": "B", "d": "C"}
    nothing = sales.withColumn("revenue", F.lit(0).cast("decimal(18,2)"))
    assert {r["abc_class"] for r in gold.abc_class(nothing).collect()} == {"C"}


@pytest.mark.parametrize("products", [3, 400])
def test_product_mart_shuffles_rows_once_by_product(spark, products):
    """Few products are all hot, many are not."""
    sales = spark.range(4 * products).select(
        (F.col("id") % products).cast("string").alias("sku"), F.lit(2000).alias("year"), (F.col("id") % 3).cast("int").alias("month"),
        F.lit(1).alias("quantity"), F.col("id").cast("decimal(18,2)").alias("revenue"), F.lit(1).cast("decimal(18,2)").alias("margin"),
    )
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = gold.mart_product_month(sales)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "product-rows" in plan and "sum(quantity" in plan
        assert ("hashpartitioning(sku" in plan) and (products == 3 or not re.search(r"hashpartitioning\(sku#\d+, year", plan))
        wanted = gold.product_mart(gold.product_months(sales))
        assert mart.dtypes == wanted.dtypes
        assert sorted(map(tuple, mart.collect())) == sorted(map(tuple, wanted.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_views_survive_zero_revenue(fact, spark):
    zero = fact.withColumn("revenue", F.lit(0).cast("decimal(18,2)"))
    assert {r["share_pct"] for r in views.brand_ranking(zero).collect()} == {None}
    assert views.category_margin(zero).first()["margin_pct"] is None


def test_launch_window(star, fact):
    products = gold.dim_product(star[4])
    row = views.launch_effect(fact, products, "2024-06-01").collect()
    assert len(row) == 1 and row[0]["launch_revenue"] == 30 and row[0]["rest_revenue"] is None
    early = products.withColumn("launched_on", F.when(F.col("sku") == "A", F.lit("2024-04-02").cast("date")))
    assert views.launch_effect(fact, early, "2024-06-01").first()["launch_revenue"] == 30
    assert views.launch_effect(fact, early, "2024-06-01", from_launch=True).first()["launch_revenue"] is None


def test_at_risk_counts_from_as_of(star):
    clients, merges, orders, _, _ = star
    dim = gold.dim_client(clients, merges, orders, "2024-05-02")
    assert views.clients_at_risk(dim, "2024-05-02").count() == 0
    assert [tuple(r)[-2:] for r in views.clients_at_risk(dim, "2024-09-01").collect()] == [(123, 20.0)]


def test_quality_both_ways(star, fact, spark):
    clients, merges, orders, _, _ = star
    known = orders.where("client_id <> '?'")
    dim = gold.dim_client(clients, merges, known, "2024-06-01")
    mart = gold.mart_product_month(fact)
    good = quality.dq_report(fact, known, clients, dim, mart, (1, 10))
    assert good.count() == 9 and gate_text(good).first()["outcome"] == "9 tests passed"
    bad = quality.dq_report(fact, orders, clients.where("client_id <> '1'").unionByName(clients.where("client_id = '2'")), dim, mart, (5, 10))
    with pytest.raises(CheckFailed, match="fact_volume, no_orphan_client, revenue_match, tax_id_unique"):
        gate(bad)
    with pytest.raises(Exception, match="no_orphan_client"):
        gate_text(bad).collect()
    negative = fact.withColumn("is_return", F.lit(False))
    assert not quality.negative_only_returns(negative).first()["passed"]
    assert not quality.mart_equals_fact(mart.limit(1), fact).first()["passed"]
    raw = spark.createDataFrame([("none",), ("123456789012345",), ("1",)], "tax_id string")
    assert quality.suspect_tax_ids(raw).first()["value"] == "2"


def _features(spark, fact, cutoff="2024-05-01", **options):
    visits = spark.createDataFrame([("1", D(2024, 4, 20)), ("1", D(2024, 6, 1))], "client_id string, visited_on date")
    opportunities = spark.createDataFrame(
        [("1", D(2024, 4, 1), "Proposal", None), ("1", D(2024, 4, 1), "Closed won", D(2024, 6, 1)), ("1", D(2024, 4, 1), "Closed lost", D(2024, 4, 9))],
        "client_id string, opened_on date, stage string, closed_on date",
    )
    clients = spark.createDataFrame([("1", "S1", D(2020, 1, 1))], "client_id string, segment string, registered_on date")
    return features.client_features(fact, visits, opportunities, clients, cutoff, **options)


def test_features(spark, fact):
    row = _features(spark, fact).first()
    assert (row["recency_days"], row["order_count"], row["cycle_days"], row["overdue_ratio"]) == (0, 2, 30.0, 0.0)
    assert (row["revenue_total"], row["mean_ticket"], row["units"], row["return_rate_pct"]) == (20.0, 10.0, 3, 50.0)
    assert (row["recent_visits"], row["days_since_visit"], row["open_opportunities"], row["multichannel"]) == (1, 11, 2, True)
    assert _features(spark, fact, stage_as_of_cutoff=False).first()["open_opportunities"] == 1
    single = _features(spark, fact, "2024-04-15").first()
    assert single["cycle_days"] is None and single["overdue_ratio"] is None


def test_later_rows_do_not_change_features(spark, fact):
    later = fact.withColumn("ordered_on", F.lit("2024-07-01").cast("date")).withColumn("order_id", F.lit("late"))
    assert _features(spark, fact.unionByName(later)).collect() == _features(spark, fact).collect()


def test_label_window(fact):
    assert features.label_buys_next(fact, "2024-05-01", 7).count() == 0
    assert features.label_buys_next(fact, "2024-05-01", 7, includes_cutoff=True).count() == 1
    assert features.label_buys_next(fact, "2024-04-30", 1).count() == 1


def test_model_finds_a_planted_signal_and_the_gate_judges(spark):
    base = spark.range(600).select(
        F.col("id").cast("string").alias("client_id"),
        *[((F.col("id") * (7 + i)) % 101).cast("double").alias(n) for i, n in enumerate(features.NUMERIC_FEATURES)],
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("segment"), (F.col("id") % 5 == 0).alias("multichannel"),
    )
    # All missing, as for visits before the first recorded one.
    base = base.withColumn("days_since_visit", F.lit(None).cast("double"))
    data = base.withColumn("buys_next", (F.col("overdue_ratio") + F.col("client_id").cast("int") % 13 > 60).cast("int"))
    train, test = propensity.split(data)
    share = data.agg(F.sum("buys_next")).first()[0]
    assert test.agg(F.sum("buys_next")).first()[0] == round(share * 0.3 + 1e-9)
    assert train.count() + test.count() == 600
    model = propensity.train(train, max_iter=5)
    scored = propensity.score(model, test)
    from mercato.operators.running import roc_auc

    auc = roc_auc(scored, "score", "buys_next").first()["auc"]
    lift = propensity.lift_at_k(scored, 20).first()["lift"]
    assert auc > 0.9 and lift > 1.5
    propensity.model_gate(0.8, lift)
    for bad in ((0.995, 2.0), (0.55, 2.0), (0.8, 1.0)):
        with pytest.raises(CheckFailed):
            propensity.model_gate(*bad)
    drops = propensity.permutation_importance(model, test, repeats=2)
    assert propensity.most_important(drops).first()["feature"] == "overdue_ratio"
    unseen = propensity.score(model, test.limit(3).withColumn("segment", F.lit("new")))
    assert unseen.where("score between 0 and 1").count() == 3


def test_queue_joins_before_the_cut(spark):
    scores = spark.createDataFrame([(str(i), 1.0 - i / 10, "Hot") for i in range(6)], "client_id string, score double, band string")
    portfolio = spark.createDataFrame(
        [("0", "r1", False), ("1", "r1", True), ("1", "r1", True), ("2", "r2", True), ("3", "r3", True), ("3", "r1", True)],
        "client_id string, rep_id string, current boolean",
    )
    reps = spark.createDataFrame([("r1", "Ana"), ("r2", "Bo"), ("r3", "Bo")], "rep_id string, rep_name string")
    clients = spark.createDataFrame([(str(i), f"C{i}", "City") for i in range(6)], "client_id string, legal_name string, city string")
    feats = spark.createDataFrame(
        [("1", 120, 2.0, 0), ("2", 10, 1.56, 1), ("3", 10, None, 0), ("4", 1, 1.0, 1)],
        "client_id string, recency_days int, overdue_ratio double, recent_orders int",
    )
    got = call_queue.weekly_queue(scores, portfolio, reps, clients, feats, 3, PORTUGUESE).orderBy("client_id", "rep").collect()
    assert [(r["client_id"], r["rep"], r["position"]) for r in got] == [("1", "Ana", 1), ("2", "Bo (#r2)", 1), ("3", "Ana", 2)]
    assert [r["reason"] for r in got] == [
        "Sem comprar há 120 dias — cliente em risco", "Atrasado 1.6x em relação ao próprio ciclo de compra",
        "Reduziu o ritmo de compra nos últimos 90 dias",
    ]
    likely = call_queue.queue_reason(feats.where("client_id = '4'")).first()
    assert likely["reason"] == "High purchase propensity"


def test_measures_and_filters(fact):
    both = measures.measure_query(fact, [], ["revenue", "orders", "ticket", "margin_pct"]).first()
    assert tuple(both) == (20, 2, 10.0, 65.0)
    none = measures.measure_query(fact, ["brand"], ["revenue"], {"segment": []}, ["-revenue"]).collect()
    assert [tuple(r) for r in none] == [("x", 30), ("y", -10)]
    assert measures.top_clients(fact, segments=["nope"]).count() == 0
    assert measures.gross_revenue(fact).first()["gross_revenue"] == 30


def test_marketplace(spark):
    reviews = spark.createDataFrame(
        [("r1", "o1", 5, "bad"), ("r1", "o2", 3, "2024-01-02 10:00:00"), ("r2", "o1", 1, "2024-01-01")],
        "review_id string, order_id string, score int, reviewed_at string",
    )
    kept = marketplace.reviews(reviews)
    assert {(r["review_id"], r["order_id"]) for r in kept.collect()} == {("r1", "o2"), ("r2", "o1")}
    lines = spark.createDataFrame(
        [("1", "o1", "s", 1, Decimal("5")), ("2", "o1", "s", 2, Decimal("5"))],
        "line_id string, order_id string, sku string, quantity int, unit_price decimal(18,2)",
    )
    payments = spark.createDataFrame([("o1", Decimal("9")), ("o1", Decimal("6"))], "order_id string, amount decimal(18,2)")
    fact = marketplace.fact_lines(lines, payments, kept)
    assert {(r["order_payment"], r["review_score"]) for r in fact.collect()} == {(Decimal("15.00"), 1.0)}
    assert tuple(marketplace.order_level_total(fact).first()) == (Decimal("15.00"), 1)
    mart = fact.groupBy("sku").agg(F.sum("revenue").alias("revenue"))
    result = marketplace.quality(fact, lines, lines.select("order_id"), kept.withColumn("score", F.lit(6)), mart, (1, 5))
    assert {r["test"] for r in result.where("not passed").collect()} == {"mkt_rating_range"}


def test_kept_up_sums_equal_a_full_rebuild(spark, folder):
    from mercato.plans import upkeep
    from mercato.sources import catalog, versions

    schema = f"u_{folder.rsplit('/', 1)[-1].replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}/db'")
    fact, sums = f"{schema}.fact_sales", f"{schema}.product_month_sums"
    money = "revenue decimal(18,2), margin decimal(18,2)"

    def sales(*rows):
        return spark.createDataFrame([(s, y, m, Decimal(r), Decimal(r) / 2, q) for s, y, m, r, q in rows], f"sku string, year int, month int, {money}, quantity int")

    def kept_up():
        found = upkeep.refresh(spark, fact, sums, gold.product_months)
        whole = gold.product_months(spark.table(fact))
        assert sorted(map(tuple, found.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
        return versions.current(spark, sums), versions.properties(spark, versions.current_table(spark, sums))

    catalog.publish_table(sales(("a", 2000, 1, 10, 1), ("a", 2000, 2, 20, 2), ("b", 2000, 2, 5, 1), ("b", 2000, 3, 7, 1)), fact, partition_by=("year", "month"))
    assert kept_up()[0] == 1
    # Nothing has changed: no version is made.
    assert kept_up()[0] == 1
    # A late order and a return in an old month, and a month that is new.
    catalog.replace_partitions(sales(("a", 2000, 1, 10, 1), ("a", 2000, 1, -4, -1), ("c", 2000, 1, 9, 3), ("a", 2000, 4, 1, 1)), fact)
    number, notes = kept_up()
    assert number == 2 and (notes["partitions_written"], notes["partitions_kept"]) == ("2", "2")
    # Two changes between refreshes, one of which takes a product out of a month.
    catalog.replace_partitions(sales(("a", 2000, 2, 20, 2)), fact)
    catalog.replace_partitions(sales(("b", 2000, 3, 8, 1)), fact)
    assert kept_up()[1]["partitions_written"] == "2"
    # A month that is gone.
    versions.replace_partitions(sales(("a", 2000, 2, 1, 1)), fact, without=["year=2000/month=1"])
    number, notes = kept_up()
    assert notes["partitions_kept"] == "2" and spark.table(sums).where("month = 1").count() == 0
    # The whole fact anew.
    catalog.publish_table(sales(("a", 2001, 1, 10, 1)), fact, partition_by=("year", "month"))
    kept_up()
    assert spark.table(sums).count() == 1
