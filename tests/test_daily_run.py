"""The whole run over landed files, with a buying pattern planted in them."""

from __future__ import annotations

import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mercato import daily_run
from mercato.daily_run import STEP_NAMES, Lake, run_all, run_log, run_step
from mercato.operators.checks import CheckFailed
from mercato.parameters import RunParameters
from mercato.plans import audit, model_versions
from mercato.session import materialize
from mercato.sources import catalog, landing, sample_tables, versions
from mercato.sources.landing_writer import write_landing

PARAMETERS = RunParameters(
    as_of="2001-08-01", train_cutoff="2001-06-01", score_cutoff="2001-07-15", horizon_days=30,
    queue_size=20, fact_rows=(1_000, 100_000),
)


def planted(spark, data):
    """Raw frames in which most clients of one segment buy within the horizon."""
    frames = {name: build(spark, data) for name, build in sample_tables.RAW.items()}
    # Events know few of the clients here; orders give them enough history.
    buying = frames["client"].where("segment = 'BUILDING' and cast(client_id as int) % 10 < 8")
    extra = frames["product"].agg(F.min("sku").alias("sku"), F.min_by("list_price", "sku").alias("price"))
    orders = buying.select(
        F.concat(F.lit("x"), "client_id").alias("order_id"), "client_id", F.lit("0").alias("rep_id"),
        F.lit("2001-06-10").alias("ordered_on"), F.lit("1-URGENT").alias("channel"),
        F.lit("Invoiced").alias("status"), extra.select("price").scalar().alias("total_value"),
    )
    lines = orders.select(
        F.concat("order_id", F.lit("-1")).alias("line_id"), "order_id", extra.select("sku").scalar().alias("sku"),
        F.lit("1").alias("quantity"), F.col("total_value").alias("unit_price"),
        F.lit("0").alias("discount_pct"), F.col("total_value").alias("gross_value"),
    )
    frames["order"] = frames["order"].unionByName(orders)
    frames["line"] = frames["line"].unionByName(lines)
    return frames


@pytest.fixture(scope="module")
def lake(spark, data):
    home = tempfile.mkdtemp(prefix="mercato-run-")
    write_landing(planted(spark, data), os.path.join(home, "landing"))
    lake = Lake(
        spark, os.path.join(home, "landing"), PARAMETERS, os.path.join(home, "models"),
        prefix="run_", location=os.path.join(home, "lake"),
    )
    return run_all(lake)


def test_every_step_ran_and_the_queue_is_ranked(lake):
    queue = lake.gold("weekly_queue")
    assert queue.count() == 20
    assert queue.groupBy("rep").agg(F.max("position").alias("m"), F.count("*").alias("n")).where("m <> n").count() == 0
    assert queue.where("reason is null or advice is null").count() == 0


def test_fact_reconciles_and_is_partitioned(lake):
    fact = lake.gold("fact_sales")
    found = fact.agg(F.sum("revenue")).first()[0]
    assert found == lake.silver("orders").agg(F.sum("net_value")).first()[0]
    table = versions.current_table(lake.spark, lake.name("gold", "fact_sales"))
    assert versions.partition_columns(lake.spark, table) == ["year", "month"]


def test_features_read_only_partitions_up_to_the_cutoff(lake):
    from mercato.plans.features import until

    plan = until(lake.gold("fact_sales"), "ordered_on", "1996-03-31").groupBy("client_id").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text


def test_metadata_is_complete_and_gaps_are_reported(lake):
    spark = lake.spark
    assert audit.audit_objects(spark, "run_gold").count() == 0
    assert audit.audit_coverage(spark, "run_gold").where("pct < 100").count() == 0
    spark.sql("CREATE TABLE run_gold.bare (mystery INT) USING parquet")
    try:
        with pytest.raises(CheckFailed, match=r"\[bare\].*bare.mystery"):
            audit.audit_gate(spark, "run_gold")
        audit_columns = audit.audit_columns(spark, "run_gold", ["fact_sales"])
        assert audit_columns.count() == 0
    finally:
        spark.sql("DROP TABLE run_gold.bare")


def test_views_and_table_functions_answer(lake):
    spark = lake.spark
    assert spark.table("run_gold.brand_ranking").count() == 25
    assert spark.table("run_gold.monthly_revenue").where("peak_month").count() > 0
    rep = spark.table("run_gold.weekly_queue").agg(F.min("rep")).first()[0]
    queue = spark.table("run_gold.weekly_queue").where(F.col("rep") == rep)
    # A table function is called by its bare name, from its own schema.
    catalog.set_namespace(spark, "run_gold")
    called = spark.sql(f"SELECT * FROM prioritise('{rep}', 2)")
    assert [r["position"] for r in called.collect()] == list(range(1, 1 + min(2, queue.count())))
    summary = spark.sql(f"SELECT * FROM rep_summary('{rep}')").first()
    assert summary["contacts"] == queue.count()
    nobody = spark.sql("SELECT * FROM rep_summary('nobody')").collect()
    assert [tuple(r) for r in nobody] == [(0, None, None)]
    client = queue.first()["client_id"]
    told = spark.sql(f"SELECT * FROM explain_client('{client}')").first()
    assert told["reason"] is not None
    assert spark.sql("SELECT * FROM find_client('BUILDING')").count() == 20
    catalog.set_namespace(spark, "default")


def test_rerun_replaces_tables_and_appends_logs(lake):
    before = lake.gold("fact_sales").count()
    logged = lake.spark.table("run_bronze.arrival_log").count()
    run_all(lake, ["arrival", "bronze", "fact", "model"])
    assert lake.gold("fact_sales").count() == before
    assert lake.spark.table("run_bronze.arrival_log").count() == 2 * logged
    assert lake.gold("model_metrics").count() == 2
    assert model_versions.load_alias(lake.spark, "run_gold", "propensity")[1] == 2


def test_model_gate_stops_the_run_before_saving(lake):
    strict = replace(lake, parameters=replace(PARAMETERS, auc_bounds=(0.9999, 1.0)))
    saved = lake.gold("model_versions").count()
    with pytest.raises(CheckFailed, match="AUC"):
        run_all(strict, ["model", "queue"])
    assert lake.gold("model_versions").count() == saved


def test_failed_test_stops_later_steps(lake):
    strict = replace(lake, parameters=replace(PARAMETERS, fact_rows=(0, 1)))
    with pytest.raises(CheckFailed, match="fact_volume"):
        run_all(strict, ["tests", "features"])


def test_missing_and_empty_files_are_all_named(lake, spark, folder):
    base = os.path.join(folder, "landing")
    file = landing.PLAIN[0]
    spark.createDataFrame([], "sku string").write.option("header", True).csv(file.path(base))
    with pytest.raises(CheckFailed, match="missing: .*crm/client.csv.*; empty: erp/product.csv"):
        landing.arrival_check(spark, base, landing.PLAIN)
    with pytest.raises(CheckFailed, match="missing"):
        landing.arrival_check(spark, os.path.join(folder, "nowhere"), landing.PLAIN)


def test_reconcile_uses_the_latest_check(lake, spark):
    log = spark.createDataFrame(
        [(f.system, f.file, 10, 1) for f in landing.PLAIN] + [(f.system, f.file, 999_999, 2) for f in landing.PLAIN],
        "system string, file string, rows bigint, checked_at int",
    )
    out = landing.row_count_reconcile(spark, "run_bronze", landing.PLAIN, log)
    assert out.where("raw <> 999999").count() == 0
    with pytest.raises(CheckFailed, match="row counts differ"):
        landing.reconcile_gate(out)


def test_single_steps(lake):
    run_step(lake, "marts")
    with pytest.raises(ValueError, match="no such step"):
        run_step(lake, "nonsense")


def test_ledger_names_versions_read_and_written(lake):
    run_all(lake, ["fact", "marts"])
    log = run_log(lake).where("status = 'done'")
    last = {r["step"]: r for r in log.orderBy("finished_at").collect()}
    assert set(STEP_NAMES) <= set(last)
    fact = f"v{versions.current(lake.spark, 'run_gold.fact_sales')}"
    assert last["fact"]["writes"] == {"run_gold.fact_sales": fact}
    assert set(last["fact"]["reads"]) == {f"run_silver.{t}" for t in ("lines", "orders", "clients", "client_merges", "products")}
    assert last["marts"]["reads"]["run_gold.fact_sales"] == fact
    assert last["silver_products"]["reads"].keys() == {"run_bronze.product", "run_bronze.line"}


def test_resume_goes_on_at_the_failed_step_and_skips_what_is_unchanged(lake, monkeypatch):
    upto = ["silver_clients", "silver_orders", "silver_products", "silver_crm", "dimensions", "fact", "marts", "tests", "views", "audit", "features"]
    run_all(lake, upto)

    def broken(lake):
        raise CheckFailed("broken on purpose")

    line = next(s for s in daily_run.STEPS if "marts" in s)
    # One table changes, and the step that makes the marts fails.
    lake.publish(lake.silver("orders"), "silver", "orders")
    with monkeypatch.context() as patch:
        patch.setitem(line, "marts", broken)
        with pytest.raises(CheckFailed, match="on purpose"):
            run_all(lake, upto, resume=True)
    assert lake.outcomes["silver_clients"] == lake.outcomes["silver_products"] == lake.outcomes["silver_crm"] == "unchanged"
    # Its own table was replaced by somebody else, so the step runs.
    assert lake.outcomes["silver_orders"] == lake.outcomes["dimensions"] == lake.outcomes["fact"] == "done"
    assert lake.outcomes["marts"] == "failed" and "tests" not in lake.outcomes
    failed = run_log(lake).where("status = 'failed' and step = 'marts'").first()
    assert "on purpose" in failed["error"]
    made = versions.current(lake.spark, "run_gold.fact_sales")
    run_all(lake, upto, resume=True)
    assert lake.outcomes["fact"] == lake.outcomes["dimensions"] == lake.outcomes["silver_orders"] == "unchanged"
    assert lake.outcomes["marts"] == lake.outcomes["tests"] == lake.outcomes["features"] == "done"
    assert versions.current(lake.spark, "run_gold.fact_sales") == made
    # Other parameters: what depends on them runs again.
    other = replace(lake, parameters=replace(PARAMETERS, as_of="2001-08-02"), outcomes={})
    run_all(other, ["dimensions"], resume=True)
    assert other.outcomes["dimensions"] == "done"
    run_all(lake, ["dimensions"])


def test_landing_files_are_told_apart(lake, folder):
    before = landing.fingerprint(lake.spark, lake.landing)
    assert before == landing.fingerprint(lake.spark, lake.landing) and before[0] > 0
    assert landing.fingerprint(lake.spark, os.path.join(folder, "nothing")) == (0, 0, 0)
    with open(os.path.join(folder, "more.csv"), "w") as out:
        out.write("a\n1\n")
    assert landing.fingerprint(lake.spark, folder)[:2] == (1, 4)


def scans(df, table):
    """Reads of a table that a plan carries out; reused results count once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(table in line for line in plan.splitlines() if "FileScan" in line and "ReusedExchange" not in line)


def test_report_reads_the_fact_once_and_equals_a_full_one(lake):
    from mercato.plans import quality

    name = {"fact": ("gold", "fact_sales"), "orders": ("silver", "orders"), "mart": ("gold", "mart_product_month"), "clients": ("gold", "dim_client")}
    noted = {k: catalog.measures_of(lake.spark, lake.name(*v)) for k, v in name.items()}
    assert set(noted["fact"]) == {"revenue", "rows", "negative_sales"}
    frames = (lake.gold("fact_sales"), lake.silver("orders"), lake.silver("clients"), lake.gold("dim_client"), lake.gold("mart_product_month"))
    report = quality.measured_report(noted, *frames, PARAMETERS.fact_rows)
    full = quality.dq_report(*frames, PARAMETERS.fact_rows)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, full.collect()))
    # What was not measured is taken from the table.
    assert sorted(map(tuple, quality.measured_report({}, *frames, PARAMETERS.fact_rows).collect())) == sorted(map(tuple, full.collect()))
    keys = frames[0].groupBy("order_id", "client_id").count()
    columns = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_id:string,client_id:string>" in columns
    bad = {**noted, "fact": {**noted["fact"], "revenue": "1.00", "negative_sales": "3"}}
    failed = {r["test"] for r in quality.measured_report(bad, *frames, PARAMETERS.fact_rows).where("not passed").collect()}
    assert failed == {"revenue_match", "mart_equals_fact", "negative_only_returns"}


def test_features_of_any_cutoff_come_from_one_state(lake):
    from mercato.plans import features

    fact = lake.gold("fact_sales")
    others = (lake.silver("visits"), lake.silver("opportunities"), lake.gold("dim_client"))
    # Two batches of the state, as after new partitions of the fact.
    state = features.client_orders(fact.where("year < 1997")).unionByName(features.client_orders(fact.where("year >= 1997")))
    state = materialize(state, "state")
    for cutoff in ("1996-05-17", "2001-06-01", "2001-07-15"):
        mine = features.client_features(state, *others, cutoff)
        assert scans(mine, "fact_sales") == 0
        assert mine.exceptAll(features.client_features(fact, *others, cutoff)).count() == 0
        assert mine.count() == features.until(fact, "ordered_on", cutoff).select("client_id").distinct().count()
    train = features.features_train(state, *others, "2001-06-01", 30)
    assert train.exceptAll(features.features_train(fact, *others, "2001-06-01", 30)).count() == 0
    assert scans(features.features_train(fact, *others, "2001-06-01", 30), "fact_sales") == 0
