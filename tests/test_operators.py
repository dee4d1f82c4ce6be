"""Skew-safe joins, distributed running totals, quantiles, AUC."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import groups, running, skew


@pytest.fixture()
def skewed(spark):
    values = [(i, "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i}")) for i in range(900)]
    left = spark.createDataFrame(values, "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("zz", 4)], "k string, v int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(skewed, how):
    left, right = skewed
    hot = skew.hot_keys(left, "k")["k"]
    assert list(hot.shares) == ["hot"] and hot.null > 0.3
    joined = skew.salted_join(left, right, "k", ["id"], how, hot)
    assert "salt" in joined._jdf.queryExecution().analyzed().toString()
    plain = left.join(right, "k", how)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, joined.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_salted_join_spreads_the_hot_key(skewed, spark):
    left, right = skewed
    hot = skew.hot_keys(left, "k")["k"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, "k", ["id"], "left", hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 450
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_plain_join_without_hot_keys(skewed):
    left, right = skewed
    joined = skew.salted_join(left, right, "k", ["id"])
    assert "salt" not in joined._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError):
        skew.salted_join(left, right, "k", ["id"], "outer")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_running_total_against_a_loop(spark, adaptive):
    rng = random.Random(1)
    data = [(f"id{i:04d}", rng.choice(["a", "b"]), rng.choice([0, 0, 0, 5, 7, rng.randint(1, 99)])) for i in range(2000)]
    df = spark.createDataFrame(data, "id string, g string, v bigint").repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = {r["id"]: int(r["running"]) for r in running.running_total(df, "v", ["-v", "id"]).collect()}
        per = {r["id"]: int(r["running"]) for r in running.running_total(df, "v", ["id"], group_by=["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total, wanted = 0, {}
    for i, _, v in sorted(data, key=lambda r: (-r[2], r[0])):
        total += v
        wanted[i] = total
    assert got == wanted
    sums, wanted = {"a": 0, "b": 0}, {}
    for i, g, v in sorted(data):
        sums[g] += v
        wanted[i] = sums[g]
    assert per == wanted


def test_ranked(spark):
    df = spark.range(50).withColumn("x", (F.col("id") * 37) % 50)
    assert sorted((r["x"], r["rank"]) for r in running.ranked(df, ["x"]).collect()) == [(i, i + 1) for i in range(50)]


def test_quantiles_match_linear_interpolation(spark):
    numpy = pytest.importorskip("numpy")
    rng = random.Random(2)
    values = [round(rng.random(), 2) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = running.exact_quantiles(df, "v", (0.0, 0.25, 0.5, 0.9, 1.0)).first()
    assert list(got) == pytest.approx(list(numpy.quantile(values, [0, 0.25, 0.5, 0.9, 1])), abs=1e-12)


def test_bands_with_equal_edges_and_nulls(spark):
    df = spark.createDataFrame([(1.0,)] * 7 + [(9.0,), (None,)], "score double")
    got = running.quartile_band(df, "score", "ABCD").groupBy("band").count().collect()
    assert {r["band"]: r["count"] for r in got} == {"A": 7, "D": 1, None: 1}


def test_auc_by_pairs(spark):
    rng = random.Random(3)
    data = [(rng.choice([0.1, 0.2, 0.3, 0.4]), rng.randint(0, 1), g) for _ in range(200) for g in "xy"]
    df = spark.createDataFrame(data, "s double, y int, g string")

    def pairs(part):
        pos, neg = [s for s, y, _ in part if y], [s for s, y, _ in part if not y]
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))

    assert running.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(pairs(data))
    got = {r["g"]: r["auc"] for r in running.roc_auc(df, "s", "y", ["g"]).collect()}
    assert got == {g: pytest.approx(pairs([r for r in data if r[2] == g])) for g in "xy"}
    assert running.roc_auc(df.where("y = 1"), "s", "y").first()["auc"] is None


def test_most_frequent_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "z"), ("a", "b"), ("b", "y"), ("b", "x")], "k string, v string")
    assert {r["k"]: r["v"] for r in groups.most_frequent(df, "k", "v").collect()} == {"a": "z", "b": "x"}


def test_keep_first_cuts_groups_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    kept = groups.keep_first(df, "k", [F.desc("id")])
    assert sorted(r["id"] for r in kept.collect()) == [97, 98, 99]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_group_size_counts_null_as_a_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, id int")
    got = {r["id"]: r["n"] for r in groups.group_size(df, "k", ["id"], "n").collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}
