"""The daily run: fifteen steps from landing files to the call queue. A step reads
and writes tables only, so any one of them can be run alone. A ledger holds the versions
that each step read and wrote; a resumed run leaves out what it shows as unchanged."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import ledger
from mercato.operators.checks import gate, row_rules
from mercato.operators.running import roc_auc
from mercato.parameters import AT_RISK_DAYS, LAUNCH_DAYS, RunParameters
from mercato.plans import (
    audit, call_queue, client_search, features, gold, model_versions, propensity, quality, silver, table_functions, upkeep, views,
)
from mercato.session import configure, materialize
from mercato.sources import catalog, landing

MODEL = "propensity"


@dataclass
class Lake:
    """Where a run reads and writes."""

    spark: SparkSession
    landing: str
    parameters: RunParameters
    model_folder: str
    files: tuple[landing.LandingFile, ...] = landing.PLAIN
    prefix: str = ""
    location: str | None = None
    timings: dict[str, float] = field(default_factory=dict)
    # What became of each step of the last run: done, unchanged or failed.
    outcomes: dict[str, str] = field(default_factory=dict)
    # Within a step, what it has read and written.
    record: ledger.StepRecord | None = None

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        name = self.name(layer, table)
        if self.record is not None:
            self.record.reads[name] = ledger.state(self.spark, name)
        return self.spark.table(name)

    def silver(self, table: str) -> DataFrame:
        return self.read("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self.read("gold", table)

    def raw(self, table: str) -> DataFrame:
        file = next(f for f in self.files if f.table == table)
        self.read("bronze", table)
        return landing.raw_frame(self.spark, f"{self.prefix}bronze", file)

    def wrote(self, layer: str, table: str) -> None:
        name = self.name(layer, table)
        if self.record is not None:
            # What a step makes itself is no input of it.
            self.record.reads.pop(name, None)
            self.record.writes[name] = ledger.state(self.spark, name)

    def publish(self, df: DataFrame, layer: str, table: str, **options) -> DataFrame:
        out = catalog.publish_table(df, self.name(layer, table), **options)
        self.wrote(layer, table)
        return out

    def measures(self, layer: str, table: str) -> dict[str, str]:
        """What was measured while a table was written."""
        self.read(layer, table)
        return catalog.measures_of(self.spark, self.name(layer, table))


def side_by_side(lake: Lake, *jobs: Callable[[], object]) -> list[object]:
    """Independent writes share the cluster instead of waiting for each other."""
    wrap = inheritable_thread_target(lake.spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(wrap(job)) for job in jobs]]


# -- steps -------------------------------------------------------------------------

def arrival_step(lake: Lake) -> None:
    catalog.create_schemas(lake.spark, lake.prefix, lake.location)
    checked = landing.arrival_check(lake.spark, lake.landing, lake.files)
    landing.arrival_log(checked, lake.name("bronze", "arrival_log"))
    lake.wrote("bronze", "arrival_log")


def bronze_step(lake: Lake) -> None:
    database = f"{lake.prefix}bronze"
    side_by_side(lake, *[partial(landing.bronze_ingest, lake.spark, lake.landing, f, database) for f in lake.files])
    log = lake.spark.table(lake.name("bronze", "arrival_log"))
    landing.reconcile_gate(landing.row_count_reconcile(lake.spark, database, lake.files, log))
    for file in lake.files:
        lake.wrote("bronze", file.table)


def silver_clients_step(lake: Lake) -> None:
    clients, merges = silver.client_tables(lake.raw("client"), lake.parameters.words)
    side_by_side(
        lake,
        lambda: lake.publish(clients, "silver", "clients", rules=row_rules()["clients"]),
        lambda: lake.publish(merges, "silver", "client_merges"),
    )


def silver_orders_step(lake: Lake) -> None:
    orders = silver.silver_orders(lake.raw("order"), lake.parameters.words)
    lake.publish(orders, "silver", "orders", rules=row_rules()["orders"], measures=quality.order_measures())


def silver_products_step(lake: Lake) -> None:
    products = lake.publish(
        silver.silver_products(lake.raw("product"), lake.parameters.words), "silver", "products"
    )
    lines = silver.silver_lines(lake.raw("line"), products)
    lake.publish(lines, "silver", "lines", rules=row_rules()["lines"])


def silver_crm_step(lake: Lake) -> None:
    words = lake.parameters.words

    def reps_and_portfolio() -> None:
        reps = lake.publish(silver.silver_reps(lake.raw("rep")), "silver", "reps")
        lake.publish(silver.silver_portfolio(lake.raw("portfolio"), reps), "silver", "portfolio")

    side_by_side(
        lake,
        reps_and_portfolio,
        lambda: lake.publish(silver.silver_visits(lake.raw("visit")), "silver", "visits"),
        lambda: lake.publish(silver.silver_payments(lake.raw("payment")), "silver", "payments"),
        lambda: lake.publish(
            silver.silver_opportunities(lake.raw("opportunity"), words), "silver", "opportunities"
        ),
        lambda: lake.publish(silver.silver_stock(lake.raw("stock")), "silver", "stock"),
    )


def dimensions_step(lake: Lake) -> None:
    clients, merges, orders = lake.silver("clients"), lake.silver("client_merges"), lake.silver("orders")
    products, reps = lake.silver("products"), lake.silver("reps")
    dim_client = gold.dim_client(clients, merges, orders, lake.parameters.as_of)

    def clients_and_index() -> None:
        known = lake.publish(dim_client, "gold", "dim_client", measures=quality.client_measures())
        lake.publish(client_search.client_grams(known), "gold", "client_grams", partition_by=("slot",))

    side_by_side(
        lake,
        clients_and_index,
        lambda: lake.publish(gold.dim_product(products), "gold", "dim_product"),
        lambda: lake.publish(gold.dim_rep(reps), "gold", "dim_rep"),
        lambda: lake.publish(gold.dim_calendar(orders), "gold", "dim_calendar"),
    )


def fact_step(lake: Lake) -> None:
    fact = gold.fact_sales(
        lake.silver("lines"), lake.silver("orders"), lake.silver("clients"),
        lake.silver("client_merges"), lake.silver("products"),
    )
    lake.publish(
        fact, "gold", "fact_sales", partition_by=("year", "month"), measures=quality.fact_measures(), by_files=True
    )


def marts_step(lake: Lake) -> None:
    """Sums of changed months are made anew, the marts from all sums."""
    reps, payments, words = lake.gold("dim_rep"), lake.silver("payments"), lake.parameters.words
    lake.gold("fact_sales")

    def summed(table: str, add_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
        out = upkeep.refresh(lake.spark, lake.name("gold", "fact_sales"), lake.name("silver", table), add_up)
        lake.wrote("silver", table)
        return out

    def products() -> None:
        mart = gold.product_mart(summed("product_month_sums", gold.product_months))
        lake.publish(mart, "gold", "mart_product_month", measures=quality.mart_measures())

    side_by_side(
        lake,
        lambda: lake.publish(gold.rep_mart(summed("rep_month_sums", gold.rep_months), reps), "gold", "mart_rep_month"),
        products,
        lambda: lake.publish(gold.mart_receivables(payments, words), "gold", "mart_receivables"),
    )


def tests_step(lake: Lake) -> None:
    measured = {
        "fact": lake.measures("gold", "fact_sales"), "orders": lake.measures("silver", "orders"),
        "mart": lake.measures("gold", "mart_product_month"), "clients": lake.measures("gold", "dim_client"),
    }
    report = quality.measured_report(
        measured, lake.gold("fact_sales"), lake.silver("orders"), lake.silver("clients"),
        lake.gold("dim_client"), lake.gold("mart_product_month"), lake.parameters.fact_rows,
    )
    gate(report)


def view_queries(lake: Lake) -> dict[str, str]:
    fact, as_of = lake.name("gold", "fact_sales"), lake.parameters.as_of
    products, clients = lake.name("gold", "dim_product"), lake.name("gold", "dim_client")
    return {
        "monthly_revenue": views.MONTHLY_REVENUE.format(fact=fact, calendar=lake.name("gold", "dim_calendar")),
        "brand_ranking": views.BRAND_RANKING.format(fact=fact),
        "category_margin": views.CATEGORY_MARGIN.format(fact=fact),
        "clients_at_risk": views.CLIENTS_AT_RISK.format(clients=clients, as_of=as_of, days=AT_RISK_DAYS),
        "launch_effect": views.LAUNCH_EFFECT.format(
            fact=fact, products=products, as_of=as_of, days=LAUNCH_DAYS, lower=views.launch_bound(False)
        ),
        "stockout_by_brand": views.STOCKOUT_BY_BRAND.format(stock=lake.name("silver", "stock"), products=products),
    }


def views_step(lake: Lake) -> None:
    for name, query in view_queries(lake).items():
        catalog.create_commented_view(lake.spark, lake.name("gold", name), query)
        lake.wrote("gold", name)


def audit_step(lake: Lake) -> None:
    audit.audit_gate(lake.spark, f"{lake.prefix}gold")


def features_step(lake: Lake) -> None:
    p = lake.parameters
    inputs = (
        lake.gold("fact_sales"), lake.silver("visits"), lake.silver("opportunities"), lake.gold("dim_client")
    )
    options = {"recent_days": p.recent_days, "words": p.words, "stage_as_of_cutoff": p.stage_as_of_cutoff}
    # The fact is read once, up to the last day that either cutoff or the label asks for.
    fact, *others = inputs
    wanted = features.up_to_label(fact, (p.train_cutoff, p.score_cutoff), p.horizon_days)
    orders = materialize(features.client_orders(wanted), "orders")
    train = features.features_train(
        orders, *others, p.train_cutoff, p.horizon_days, p.label_includes_cutoff, **options
    )
    current = features.client_features(orders, *others, p.score_cutoff, **options)
    side_by_side(
        lake,
        lambda: lake.publish(train, "gold", "features_train"),
        lambda: lake.publish(current, "gold", "features_score"),
    )


def model_step(lake: Lake) -> None:
    """Train on 70 percent, judge on the rest, and only then save, log and score."""
    spark, p, label = lake.spark, lake.parameters, features.LABEL
    train, test = propensity.split(lake.gold("features_train"))
    model = propensity.train(train, max_iter=lake.parameters.boosting_rounds)
    judged = materialize(propensity.score(model, test).select("client_id", label, "score"), "judged")
    auc = roc_auc(judged, "score", label).first()["auc"]
    lift = propensity.lift_at_k(judged, p.queue_size).first()
    propensity.model_gate(auc, lift["lift"], p.auc_bounds, p.lift_floor)

    by_hand = {r["name"]: r["auc"] for r in propensity.baselines(test).collect()}
    drops = propensity.permutation_importance(model, test)
    best = propensity.most_important(drops).first()["feature"]
    version = model_versions.save_version(spark, model, f"{lake.prefix}gold", MODEL, lake.model_folder)
    model_versions.set_alias(spark, f"{lake.prefix}gold", MODEL, "prod", version)
    metrics = spark.createDataFrame(
        [(auc, lift["lift"], lift["hits"], lift["base_rate"], by_hand["recency"], by_hand["revenue"],
          by_hand["overdue"], best, version)],
        "auc double, lift double, hits bigint, base_rate double, baseline_recency double,"
        " baseline_revenue double, baseline_overdue double, best_feature string, version int",
    ).withColumn("trained_at", F.current_timestamp())
    catalog.append_log(metrics, lake.name("gold", "model_metrics"))
    lake.publish(propensity.calibration(judged, p.words.bands), "gold", "holdout_calibration")

    in_use, _ = model_versions.load_alias(spark, f"{lake.prefix}gold", MODEL)
    scored = propensity.score(in_use, lake.gold("features_score")).select("client_id", "score", "cutoff")
    banded = propensity.score_bands(materialize(scored, "scored"), p.words.bands)
    lake.publish(banded.withColumn("scored_at", F.current_timestamp()), "gold", "propensity_scores")


def queue_step(lake: Lake) -> None:
    p = lake.parameters
    queue = call_queue.weekly_queue(
        lake.gold("propensity_scores"), lake.silver("portfolio"), lake.gold("dim_rep"),
        lake.gold("dim_client"), lake.gold("features_score"), p.queue_size, p.words,
    )
    lake.publish(queue, "gold", "weekly_queue")
    sources = {
        "queue": "weekly_queue", "scores": "propensity_scores", "clients": "dim_client", "features": "features_score",
        "grams": "client_grams",
    }
    table_functions.create_functions(
        lake.spark, {k: lake.name("gold", v) for k, v in sources.items()}, prefix=f"{lake.prefix}gold."
    )
    # Tables made after the audit step get the same check.
    audit.audit_gate(lake.spark, f"{lake.prefix}gold")


# Steps of one line run side by side; a line starts when the one before is done.
STEPS: tuple[dict[str, Callable[[Lake], None]], ...] = (
    {"arrival": arrival_step},
    {"bronze": bronze_step},
    {
        "silver_clients": silver_clients_step, "silver_orders": silver_orders_step,
        "silver_products": silver_products_step, "silver_crm": silver_crm_step,
    },
    {"dimensions": dimensions_step},
    {"fact": fact_step},
    {"marts": marts_step},
    {"tests": tests_step, "views": views_step},
    {"audit": audit_step},
    {"features": features_step},
    {"model": model_step},
    {"queue": queue_step},
)
STEP_NAMES = tuple(name for line in STEPS for name in line)


# Steps that depend on the landing files, not on tables alone.
FROM_LANDING = ("arrival", "bronze")


def _inputs(lake: Lake, name: str) -> str:
    """What a step depends on besides tables."""
    files = landing.fingerprint(lake.spark, lake.landing) if name in FROM_LANDING else None
    return ledger.digest(lake.parameters, lake.files, lake.landing, files)


def _run(lake: Lake, run_id: str, done: dict | None, name: str, step: Callable[[Lake], None]) -> None:
    """One step, timed and entered in the ledger; left out if `done` shows that it would
    repeat what is there."""
    spark, database = lake.spark, f"{lake.prefix}bronze"
    inputs = _inputs(lake, name)
    if done is not None and ledger.unchanged(spark, done.get(name), inputs):
        lake.outcomes[name] = "unchanged"
        return
    own = replace(lake, record=ledger.StepRecord())
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    start, outcome, error = time.monotonic(), "done", None
    try:
        step(own)
    except Exception as failure:
        outcome, error = "failed", str(failure)[:1000]
        raise
    finally:
        lake.timings[name] = time.monotonic() - start
        lake.outcomes[name] = outcome
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        ledger.note(spark, database, run_id, name, outcome, lake.timings[name], inputs, own.record, error)


def run_all(lake: Lake, only: Iterable[str] | None = None, resume: bool = False) -> Lake:
    """Run all steps, or the named ones over the tables already there. A failing step
    raises, and no later step runs.

    With `resume`, steps are left out whose parameters, landing files, and versions
    read and written are those of the last time they ended well: a run that failed goes
    on where it stopped, and after a change only what depends on it runs. Changes of
    the code are not seen; run without `resume` after them."""
    configure(lake.spark)
    wanted = set(only) if only is not None else set(STEP_NAMES)
    unknown = wanted - set(STEP_NAMES)
    if unknown:
        raise ValueError(f"no such step: {', '.join(sorted(unknown))}")
    catalog.create_schemas(lake.spark, lake.prefix, lake.location)
    lake.outcomes.clear()
    run_id = uuid.uuid4().hex
    done = ledger.last_done(lake.spark, f"{lake.prefix}bronze") if resume else None
    for line in STEPS:
        chosen = [(n, s) for n, s in line.items() if n in wanted]
        if len(chosen) == 1:
            _run(lake, run_id, done, *chosen[0])
        elif chosen:
            side_by_side(lake, *[partial(_run, lake, run_id, done, n, s) for n, s in chosen])
    return lake


def run_step(lake: Lake, name: str) -> Lake:
    return run_all(lake, [name])


def run_log(lake: Lake) -> DataFrame:
    """The ledger: `run_id`, `step`, `status`, `finished_at`, `seconds`, `reads`, `writes`, `error`."""
    return lake.spark.table(f"{lake.prefix}bronze.{ledger.TABLE}")


def model_home(lake_location: str) -> str:
    return os.path.join(lake_location, "models")
