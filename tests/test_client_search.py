"""Client search by the index of three-letter runs."""

from __future__ import annotations

import pytest

from mercato.parameters import SEARCH_MAX
from mercato.plans.client_search import client_grams
from mercato.plans.table_functions import create_functions
from mercato.sources import catalog, versions

CLIENTS = [
    ("3", "José Conceição Ltda", "São Paulo", "a"), ("1", "CASA DO JOSE", "Rio", "b"), ("2", "Ab", "Li", "a"),
    ("4", None, "Josefina", "b"), ("5", "joint ventures", None, "a"), ("6", "100% Natural_x", "Rio", "a"), ("7", "", "", None),
]


@pytest.fixture(scope="module")
def search(spark, tmp_path_factory):
    schema = "client_search_test"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{tmp_path_factory.mktemp('cs')}/db'")
    clients = spark.createDataFrame(CLIENTS, "client_id string, legal_name string, city string, segment string")
    catalog.publish_table(clients, f"{schema}.dim_client")
    catalog.publish_table(client_grams(clients), f"{schema}.client_grams", partition_by=("slot",))
    spark.range(0).selectExpr("'r' rep", "1 position", "'x' legal_name", "'x' city", "0D score", "'b' band", "'r' reason", "'a' advice", "'1' client_id").createOrReplaceTempView("cs_queue")
    spark.sql(f"CREATE TABLE {schema}.weekly_queue AS SELECT * FROM cs_queue")
    spark.sql(f"CREATE TABLE {schema}.scores AS SELECT '1' client_id, 0D score, 'b' band")
    spark.sql(f"CREATE TABLE {schema}.features AS SELECT '1' client_id, 1 recency_days, 0D overdue_ratio")
    sources = {"queue": "weekly_queue", "scores": "scores", "clients": "dim_client", "features": "features", "grams": "client_grams"}
    create_functions(spark, {k: f"{schema}.{v}" for k, v in sources.items()}, prefix=f"{schema}.")
    catalog.set_namespace(spark, schema)
    yield lambda text: spark.sql(f"SELECT * FROM find_client({text})")
    catalog.set_namespace(spark, "default")


@pytest.mark.parametrize("term, ids", [
    ("'jose'", "134"), ("'JOSÉ'", "134"), ("'josé c'", "3"), ("'sao p'", "3"), ("'São'", "3"), ("'cao'", "3"), ("'jo'", "1345"),
    ("'li'", "2"), ("'100%'", "6"), ("'0% natural_'", "6"), ("'%'", "6"), ("'zzz'", ""), ("'joseph'", ""), ("''", "1234567"),
    ("'jose', 2", "13"), ("'', 3", "123"),
])
def test_finds_what_holds_the_term(search, term, ids):
    found = "".join(r["client_id"] for r in search(term).collect())
    assert found == ids


def test_three_letters_read_one_slot_and_no_client_table(search):
    plan = search("'jose'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "client_grams" in scans[0]
    assert "slot" in scans[0].split("PartitionFilters:")[1].split("]")[0] and "EqualTo(gram,jos)" in scans[0]
    short = search("'jo'")._jdf.queryExecution().executedPlan().toString()
    assert "client_grams" not in short and "dim_client" in short
    # Ranks are given to what the search leaves, not to all hits.
    assert f"limit={SEARCH_MAX}" in plan and plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_index_holds_each_run_once(spark):
    df = spark.createDataFrame([("1", "anana", "Ana", "s")], "client_id string, legal_name string, city string, segment string")
    assert sorted(r["gram"] for r in client_grams(df).collect()) == ["ana", "nan"]
    assert {r["slot"] for r in client_grams(df).collect()} <= set(range(64))


def test_parameters_have_comments(spark, search):
    told = "\n".join(r[0] for r in spark.sql("DESCRIBE FUNCTION EXTENDED client_search_test.find_client").collect())
    assert "part of a name or city" in told and "how many clients at most" in told
    assert versions.current(spark, "client_search_test.client_grams") == 1
