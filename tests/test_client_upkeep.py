"""Clients kept up from batches against a run over all raw rows."""

from __future__ import annotations

import pytest

from mercato.plans import client_upkeep, silver
from mercato.sources import versions

CLIENT = "client_id tax_id legal_name segment city state district registered_on active"
SLOTS = 4


def client(i, tax_id, since="2020-01-01", name="ACME corp"):
    return (i, tax_id, name, "S", "C", "ST", "D", since, "S")


@pytest.fixture()
def schema(spark, folder):
    name = f"c_{folder.rsplit('/', 1)[-1].replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return name


@pytest.fixture()
def apply(rows, schema):
    """Apply a batch; compare with a run over all batches as they last came."""
    came = {}

    def run(label, *values):
        came[label] = values
        found = client_upkeep.apply_batch(rows(CLIENT, *values) if values else empty(), label, schema, slots=SLOTS)
        everything = [v for batch in came.values() for v in batch]
        wanted = silver.client_tables(rows(CLIENT, *everything) if everything else empty())
        for mine, whole in zip(found, wanted):
            whole = whole.select(*mine.columns)
            assert sorted(map(str, mine.collect())) == sorted(map(str, whole.collect()))
        return found

    def empty():
        return rows(CLIENT, schema=", ".join(f"{n} string" for n in CLIENT.split()))

    return run


def state(spark, schema, table):
    name = f"{schema}.{table}"
    return versions.current(spark, name), versions.properties(spark, versions.current_table(spark, name))


def test_three_batches_equal_one_run_over_all_rows(spark, schema, apply):
    apply("1", client("1", "11", "2021-05-01"), client("2", "22"), client("3", None), client("4", "44", "no date"))
    # The survivor of 11 changes, 22 gains two ids, one without a date; 55 is new.
    clients, merges = apply("2", client("5", "11", "2019-01-01", "Older"), client("6", "22", None), client("7", "22"), client("8", "55"))
    assert {(r["merged_id"], r["client_id"]) for r in merges.collect()} == {("1", "5"), ("6", "2"), ("7", "2")}
    # An id merged late into a client that was alone, and rows without tax id.
    clients, merges = apply("3", client("9", "44", "2020-02-02"), client("10", None), client("11", ""))
    assert ("4", "9") in {(r["merged_id"], r["client_id"]) for r in merges.collect()}


def test_a_batch_again_a_corrected_one_and_an_empty_one(spark, schema, apply):
    first = [client("1", "11"), client("2", "22")]
    apply("1", *first)
    apply("2", client("3", "11", "2018-01-01"), client("3", "11", "2018-01-01"), client("4", "33"))
    apply("2", client("3", "11", "2018-01-01"), client("3", "11", "2018-01-01"), client("4", "33"))
    # Corrected: 3 belongs to 22, 4 is gone.
    clients, merges = apply("2", client("3", "22", "2018-01-01"))
    assert [(r["merged_id"], r["client_id"]) for r in merges.collect()] == [("2", "3")]
    before = state(spark, schema, client_upkeep.ROWS)[0]
    apply("3")
    assert state(spark, schema, client_upkeep.ROWS)[0] == before
    apply("2")
    clients, merges = apply("1")
    assert clients.count() == merges.count() == 0
    apply("4", *first)


def test_an_empty_first_batch(apply):
    apply("1")
    apply("2", client("1", "11"), client("2", "11"))


def test_only_slots_of_the_batch_are_rewritten(spark, schema, apply):
    apply("1", *[client(str(i), str(i)) for i in range(40)])
    used = {r["slot"] for r in spark.table(f"{schema}.{client_upkeep.ROWS}").select("slot").collect()}
    assert used == set(range(SLOTS))
    apply("2", client("100", "7"))
    for table in (client_upkeep.ROWS, client_upkeep.MAP):
        notes = state(spark, schema, table)[1]
        assert (notes["partitions_written"], notes["partitions_kept"]) == ("1", str(SLOTS - 1))


def test_a_run_that_broke_off_behind_the_rows_is_made_good(spark, schema, apply, rows):
    apply("1", client("1", "11"), client("2", "22"))
    # Corrected rows were stored, the map was not: the next batch, whichever, brings it up.
    client_upkeep.store_batch(rows(CLIENT, client("1", "33"), client("2", "22")), "1", f"{schema}.{client_upkeep.ROWS}", slots=SLOTS)
    clients, _ = client_upkeep.apply_batch(rows(CLIENT, client("3", "44")), "2", schema, slots=SLOTS)
    assert {r["tax_id"][-2:] for r in clients.collect()} == {"33", "22", "44"}


def test_other_number_of_slots_is_refused(apply, schema, rows):
    apply("1", client("1", "11"))
    with pytest.raises(ValueError, match="4 slots, not 5"):
        client_upkeep.apply_batch(rows(CLIENT, client("2", "11")), "2", schema, slots=5)
