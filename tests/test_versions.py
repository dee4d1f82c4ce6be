"""Publishing as versions: what readers see when a publication breaks off anywhere."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from mercato.operators.checks import CheckFailed
from mercato.sources import catalog, versions


class Killed(Exception):
    pass


@pytest.fixture()
def schema(spark, folder):
    name = f"v_{os.path.basename(folder).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return name


def kill_after(monkeypatch, calls: int, after: bool) -> dict:
    """The run ends at that catalog call: before it or, with `after`, behind it."""
    real, seen = versions.call, {"n": 0}

    def call(spark, statement):
        seen["n"] += 1
        if seen["n"] == calls and not after:
            raise Killed(statement)
        out = real(spark, statement)
        if seen["n"] == calls and after:
            raise Killed(statement)
        return out

    monkeypatch.setattr(versions, "call", call)
    return seen


def content(spark, name):
    return sorted(map(tuple, spark.table(name).collect()))


def numbers_frame(spark, n, text):
    return spark.range(n).withColumns({"x": F.lit(text), "part": F.col("id") % 3})


@pytest.mark.parametrize("after", [False, True])
def test_a_broken_publication_leaves_old_or_new(spark, schema, monkeypatch, after):
    name = f"{schema}.t"
    parts = {"partition_by": ("part",)}
    catalog.publish_table(numbers_frame(spark, 6, "a"), name, "One.", **parts)
    catalog.publish_table(numbers_frame(spark, 7, "b"), name, "One.", **parts)
    old, new = content(spark, name), sorted((i, "c", 0.5, i % 3) for i in range(8))
    begun = spark.table(name)
    # The new version has a column more and another comment.
    frame = numbers_frame(spark, 8, "c").withColumn("more", F.lit(0.5)).select("id", "x", "more", "part")
    at = 0
    while True:
        at += 1
        with monkeypatch.context() as patch:
            seen = kill_after(patch, at, after)
            try:
                catalog.publish_table(frame, name, "Two.", **parts)
                done = seen["n"] < at
            except Killed:
                done = False
        now = content(spark, name)
        assert now in (old, new), f"call {at}"
        assert spark.catalog.tableExists(name) and len(versions.numbers(spark, name)) >= 1
        if now == new and old != new:
            assert sorted(map(tuple, begun.collect())) == old
        if done:
            break
        if now == new:
            catalog.publish_table(numbers_frame(spark, 7, "b"), name, "One.", **parts)
            begun = spark.table(name)
    assert at > 4 and content(spark, name) == new
    assert spark.catalog.getTable(name).description == "Two."
    assert len(versions.numbers(spark, name)) == versions.KEPT


@pytest.mark.parametrize("after", [False, True])
def test_broken_partition_changes_leave_old_or_new(spark, schema, monkeypatch, after):
    name = f"{schema}.t"
    catalog.publish_table(numbers_frame(spark, 9, "a"), name, partition_by=("part",))
    change = numbers_frame(spark, 9, "z").where("part = 1")
    old = content(spark, name)
    new = sorted((i, "z" if i % 3 == 1 else "a", i % 3) for i in range(9))
    at, done = 0, False
    while not done:
        at += 1
        with monkeypatch.context() as patch:
            seen = kill_after(patch, at, after)
            try:
                catalog.replace_partitions(change, name)
                done = seen["n"] < at
            except Killed:
                pass
        assert content(spark, name) in (old, new)
        if not done:
            versions.point(spark, name, min(versions.numbers(spark, name)))
            assert content(spark, name) == old
    assert content(spark, name) == new


def test_calls_do_not_grow_with_partitions(spark, schema, monkeypatch):
    counts = {}
    for n in (3, 1000):
        name = f"{schema}.p{n}"
        df = spark.range(n).withColumns({"v": F.lit(1), "day": F.col("id").cast("string")})
        catalog.publish_table(df, name, partition_by=("day",))
        with monkeypatch.context() as patch:
            seen = kill_after(patch, -1, False)
            catalog.replace_partitions(df.where("id in (1, 2)").withColumn("v", F.lit(5)), name)
            counts[n] = seen["n"]
        assert spark.table(name).agg(F.sum("v"), F.count("v")).first()[:] == (n + 8, n)
        notes = versions.properties(spark, versions.current_table(spark, name))
        assert (notes["partitions_written"], notes["partitions_kept"]) == ("2", str(n - 2))
    assert counts[3] == counts[1000]


def test_partition_values_of_any_kind(spark, schema):
    name = f"{schema}.odd"
    rows = [(1, "a b", 1), (2, "x/y=z%", 2), (3, None, 3), (4, "it's", None)]
    df = spark.createDataFrame(rows, "v int, k string, n int")
    catalog.publish_table(df, name, partition_by=("k", "n"))
    catalog.replace_partitions(df.where("v = 1").withColumn("v", F.lit(9)), name)
    catalog.replace_partitions(df.where("v = 4").withColumn("v", F.lit(8)), name)
    assert sorted(spark.table(name).collect(), key=str) == sorted([(9, "a b", 1), (2, "x/y=z%", 2), (3, None, 3), (8, "it's", None)], key=str)


def test_old_versions_go_and_shared_folders_stay(spark, schema, folder):
    name = f"{schema}.t"
    catalog.publish_table(numbers_frame(spark, 9, "a"), name, partition_by=("part",))
    for k, text in enumerate("bcde"):
        catalog.replace_partitions(numbers_frame(spark, 9, text).where(f"part = {k % 2}"), name)
        assert len(versions.numbers(spark, name)) <= versions.KEPT
    assert content(spark, name) == sorted((i, "dea"[i % 3], i % 3) for i in range(9))
    left = {r for r, _, files in os.walk(f"{folder}/db__versions/t") if any(f.endswith(".parquet") for f in files)}
    # Of two versions: part 2 of the first, parts 0 and 1 of the last three changes.
    assert len(left) == 4
    catalog.publish_table(numbers_frame(spark, 2, "f"), name, partition_by=("part",))
    catalog.publish_table(numbers_frame(spark, 2, "g"), name, partition_by=("part",))
    left = {r for r, _, files in os.walk(f"{folder}/db__versions/t") if any(f.endswith(".parquet") for f in files)}
    assert len(left) == 4


def test_history_and_rollback(spark, schema):
    name = f"{schema}.t"
    for text in "abc":
        catalog.publish_table(numbers_frame(spark, 3, text), name)
    rows = versions.history(spark, name).orderBy("version").collect()
    assert [(r["version"], r["is_current"], r["operation"], r["parent"]) for r in rows] == [(2, False, "publish", 1), (3, True, "publish", 2)]
    assert versions.rollback(spark, name, 2).first()["x"] == "b"
    assert versions.read_version(spark, name, 3).first()["x"] == "c"
    with pytest.raises(LookupError):
        versions.rollback(spark, name, 1)
    assert catalog.publish_table(numbers_frame(spark, 3, "d"), name).first()["x"] == "d"


def test_a_plain_table_becomes_the_first_version(spark, schema):
    name = f"{schema}.t"
    numbers_frame(spark, 3, "a").write.saveAsTable(name)
    before = spark.table(name)
    catalog.publish_table(before.withColumn("x", F.lit("b")), name, "Now.")
    assert content(spark, name) == [(0, "b", 0), (1, "b", 1), (2, "b", 2)]
    assert versions.current(spark, name) == 1


def test_rules_and_measures_are_taken_while_writing(spark, schema):
    name = f"{schema}.t"
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(count, "id bigint")
    measures = {"total": F.sum("id"), "rows": F.count(F.lit(1)), "none": F.max(F.when(F.col("id") < 0, 1))}
    catalog.publish_table(df, name, rules={"small": F.col("id") < 100}, measures=measures)
    assert seen.value == 100
    assert catalog.measures_of(spark, name) == {"total": "4950", "rows": "100"}
    with pytest.raises(CheckFailed, match=r"small \(50\)"):
        catalog.publish_table(df, name, rules={"small": F.col("id") < 50})
    assert spark.table(name).count() == 100 and catalog.measures_of(spark, name)["rows"] == "100"
