"""Headline queries on the benchmark tables, one JSON line.

Gold and silver tables are published once from the landing files by the daily run,
as in use; its steps are timed, and then the queries over the published tables
(warm median of three). `from_raw` are whole plans from the given tables, run once
warm."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.checkset import QUERIES  # noqa: E402
from mercato.daily_run import Lake, STEP_NAMES, run_all  # noqa: E402
from mercato.operators.checks import CheckFailed  # noqa: E402
from mercato.operators.running import roc_auc  # noqa: E402
from mercato.parameters import RunParameters  # noqa: E402
from mercato.plans import features, gold, measures, quality  # noqa: E402
from mercato.session import local_session  # noqa: E402
from mercato.sources import sample_tables  # noqa: E402
from mercato.sources.landing_writer import write_landing  # noqa: E402

PARAMETERS = RunParameters(
    as_of="2001-08-01", train_cutoff="2001-06-01", score_cutoff="2001-07-15", horizon_days=30,
    fact_rows=(1_000, 100_000_000_000),
    # The test data has no buying pattern, which the gate on the model would rightly refuse.
    # Its bounds are open here, so that all fifteen steps are timed.
    auc_bounds=(-1.0, 2.0), lift_floor=-1.0,
)
FROM_RAW = ("fact_sales", "brand_ranking", "mart_product_month", "features_train", "mkt_fact_lines")



def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_of_three(build) -> float:
    times = []
    for _ in range(4):
        start = time.monotonic()
        consume(build())
        times.append(time.monotonic() - start)
    return statistics.median(times[1:])


def yardstick(spark) -> float:
    """A fixed plain query that none of our code takes part in: how fast the machine is."""
    numbers = spark.range(20_000_000).selectExpr("pmod(xxhash64(id), 1000000) AS k", "id")
    return median_of_three(lambda: numbers.groupBy("k").agg({"id": "sum"}))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, **{"spark.scheduler.mode": "FAIR"})
    home = tempfile.mkdtemp(prefix="mercato-bench-")
    raw = {name: build(spark, folder) for name, build in sample_tables.RAW.items()}
    write_landing(raw, os.path.join(home, "landing"))

    lake = Lake(
        spark, os.path.join(home, "landing"), PARAMETERS, os.path.join(home, "models"),
        prefix="bench_", location=os.path.join(home, "lake"),
    )
    start = time.monotonic()
    outcome = "complete"
    try:
        run_all(lake)
    except CheckFailed as refused:
        outcome = str(refused)
    daily = time.monotonic() - start

    fact = lake.gold("fact_sales")
    train = lake.gold("features_train")
    inputs = (fact, lake.silver("visits"), lake.silver("opportunities"), lake.gold("dim_client"))
    published = {
        "view_monthly_revenue": lambda: lake.gold("monthly_revenue"),
        "view_brand_ranking": lambda: lake.gold("brand_ranking"),
        "view_category_margin": lambda: lake.gold("category_margin"),
        "view_clients_at_risk": lambda: lake.gold("clients_at_risk"),
        "view_launch_effect": lambda: lake.gold("launch_effect"),
        "view_stockout_by_brand": lambda: lake.gold("stockout_by_brand"),
        "kpi_ticket": lambda: measures.kpi(fact, "ticket"),
        "line_revenue_month": lambda: measures.revenue_by_month(fact),
        "table_top_clients": lambda: measures.top_clients(fact),
        "q_brands_6_months": lambda: measures.top_brands(fact, PARAMETERS.as_of),
        "fact_from_silver": lambda: gold.fact_sales(
            lake.silver("lines"), lake.silver("orders"), lake.silver("clients"),
            lake.silver("client_merges"), lake.silver("products"),
        ),
        "mart_rep_month_from_fact": lambda: gold.mart_rep_month(fact, lake.gold("dim_rep")),
        "mart_product_month_from_fact": lambda: gold.mart_product_month(fact),
        "mart_product_month_from_sums": lambda: gold.product_mart(lake.silver("product_month_sums").drop("source")),
        "features_from_fact": lambda: features.client_features(*inputs, PARAMETERS.score_cutoff),
        "auc_from_features": lambda: roc_auc(train, "recency_days", "buys_next"),
        "dq_no_orphan_order": lambda: quality.no_orphan_order(fact, lake.silver("orders")),
    }
    queries = {name: round(median_of_three(build), 3) for name, build in published.items()}
    for name in FROM_RAW:
        for _ in range(2):
            start = time.monotonic()
            consume(QUERIES[name](spark, folder))
        queries[f"{name}_from_raw"] = round(time.monotonic() - start, 3)
    print(json.dumps({
        "metric": "total warm seconds of the headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "daily_run_sec": round(daily, 3),
        "daily_run_outcome": outcome,
        "yardstick_sec": round(yardstick(spark), 3),
        "steps": {n: round(lake.timings[n], 3) for n in STEP_NAMES if n in lake.timings},
        "fact_rows": fact.count(),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
