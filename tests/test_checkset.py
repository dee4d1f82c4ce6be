"""Registered queries against their SQL in another engine. A few by default; set
MERCATO_CHECK=all for every key, MERCATO_CHECK_DATA for another folder."""

from __future__ import annotations

import glob
import os
import threading

import pytest

import __spark_entry__ as entry
from mercato.checkset import QUERIES, SQL, registry
from mercato.plans import gold
from mercato.session import configure, materialize
from mercato.sources import catalog, landing

duckdb = pytest.importorskip("duckdb")

SAMPLE = (
    "silver_clients", "fact_sales", "dim_client", "mart_rep_month", "mart_product_month", "brand_ranking",
    "launch_effect", "features_train", "ml_baselines", "weekly_queue", "mkt_fact_lines", "row_count_reconcile",
)
KEYS = sorted(SQL) if os.environ.get("MERCATO_CHECK") == "all" else SAMPLE


@pytest.fixture(scope="module")
def folder(data):
    return os.environ.get("MERCATO_CHECK_DATA", data)


@pytest.fixture(scope="module")
def other(folder):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def text(value) -> str:
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(text, value)) + "]"
    return "~" if value is None else str(value)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows(spark, folder, other, key):
    ours = QUERIES[key](spark, folder)
    theirs = other.execute(SQL[key])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    order = [names.index(c) for c in ours.columns]
    found = sorted(tuple(map(text, row)) for row in ours.collect())
    wanted = sorted(tuple(text(row[i]) for i in order) for row in theirs.fetchall())
    assert found == wanted


def test_registry_is_consistent(spark):
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 200
    queries, sql = entry.queries(), entry.oracle_sql()
    assert QUERIES.items() <= queries.items() and SQL.items() <= sql.items()
    assert set(sql) <= set(queries)
    # What else there is belongs to the training-text operators, which may be absent.
    assert all(key == "pipeline" or key.startswith("op") for key in set(queries) - set(QUERIES))
    assert entry.entry(spark).count() == 25


# -- what is read and written on the way ------------------------------------------------

def noted(monkeypatch, module, name: str, note) -> list:
    """What `note` says of the arguments of each call."""
    found, function = [], getattr(module, name)

    def watched(*args, **options):
        found.append(note(*args))
        return function(*args, **options)

    monkeypatch.setattr(module, name, watched)
    return found


def test_features_do_not_write_the_fact(spark, folder, monkeypatch):
    written = noted(monkeypatch, registry, "materialize", lambda df, label: label)
    QUERIES["base_rate"](spark, folder)
    QUERIES["queue_reason"](spark, folder)
    assert written == ["orders", "orders"]


def test_written_tables_are_small(spark):
    assert all("zstd" in name for name in materialize(configure(spark).range(3)).inputFiles())


def test_a_replaced_year_comes_from_the_published_fact(spark, folder, monkeypatch):
    read = noted(monkeypatch, catalog, "replace_partitions", lambda df, name: df.inputFiles())
    QUERIES["publish_partitioned"](spark, folder)
    assert read[0] and not any("lineitem" in name for name in read[0])


def test_upkeep_of_a_mart_writes_what_it_reads(spark, folder, monkeypatch):
    published = noted(monkeypatch, catalog, "publish_table", lambda df, name: set(df.columns))
    QUERIES["mart_upkeep"](spark, folder)
    assert published[0] == {"sku", "year", "month", "quantity", "revenue", "margin"}


def test_the_report_is_made_over_published_tables(spark, folder, monkeypatch):
    read = noted(monkeypatch, gold, "fact_sales", lambda lines, orders, *more: orders.inputFiles())
    QUERIES["dq_report_measured"](spark, folder)
    assert read[-1] and not any(name.endswith("/orders.parquet") for name in read[-1])


def test_landing_files_are_ingested_side_by_side(spark, folder, monkeypatch):
    threads = noted(monkeypatch, landing, "bronze_ingest", lambda *args: threading.get_ident())
    QUERIES["row_count_reconcile"](spark, folder)
    assert len(threads) == len(landing.PLAIN) and len(set(threads)) > 1
