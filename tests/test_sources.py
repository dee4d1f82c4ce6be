"""Reading and publishing tables and files."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from mercato.operators.checks import CheckFailed
from mercato.session import fresh_folder
from mercato.sources import catalog, landing, regroup, sample_tables


@pytest.fixture()
def schema(spark, folder):
    name = f"t_{os.path.basename(folder).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return name


def test_schemas_have_comments(spark, folder):
    names = catalog.create_schemas(spark, "mk_", folder)
    assert names == ["mk_bronze", "mk_silver", "mk_gold"]
    assert catalog.create_schemas(spark, "mk_", folder) == names
    assert spark.catalog.getDatabase("mk_gold").description == catalog.LAYERS["gold"]
    catalog.set_namespace(spark, "mk_gold")
    assert spark.catalog.currentDatabase() == "mk_gold"
    catalog.set_namespace(spark, "default")


def test_bad_rows_are_not_published(spark, schema):
    name = f"{schema}.t"
    catalog.publish_table(spark.range(3), name, "Numbers.", rules={"small": F.col("id") < 5})
    with pytest.raises(CheckFailed, match=r"small \(2\)"):
        catalog.publish_table(spark.range(7), name, rules={"small": F.col("id") < 5})
    assert spark.table(name).count() == 3
    assert spark.catalog.getTable(name).description == "Numbers."


def test_shuffle_files_go_with_the_query(spark, schema):
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    for n in range(3):
        frame = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
        before = kept()
        catalog.publish_table(frame, f"{schema}.grouped")
        until = time.monotonic() + 20
        while kept() > before and time.monotonic() < until:
            time.sleep(0.1)
        assert kept() <= before
    assert spark.table(f"{schema}.grouped").count() == 7


def test_raw_lines_are_shuffled_once_for_price_and_product(spark, data):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = sample_tables.line_raw(spark, data)
        joined = lines.join(sample_tables.product_raw(spark, data).select("sku", "brand"), "sku")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # One for the lines, one for each of the two tables they are joined with.
        assert plan.count("Exchange hashpartitioning") == 3
        assert joined.count() == lines.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_publish_partitioned_twice_and_replace_one(spark, schema):
    name = f"{schema}.p"
    df = spark.range(20).withColumns({"year": F.col("id") % 2 + 2000, "month": F.lit(1)})
    for _ in range(2):
        catalog.publish_table(df, name, "Parts.", partition_by=("year", "month"))
    assert spark.table(name).count() == 20
    catalog.replace_partitions(df.where("year = 2001").limit(1), name)
    assert sorted(map(tuple, spark.table(name).groupBy("year").count().collect())) == [(2000, 10), (2001, 1)]


ODD = [(n, f"text {n % 3}", [None, "a b", "a/b=c", "plain"][n % 4], n % 5) for n in range(200)]


def test_publishing_by_files_keeps_rows_and_leaves_no_files(spark, schema, monkeypatch):
    """Partitions with odd names, without a value, and larger than a share."""
    monkeypatch.setattr(regroup, "SHARE", 1)
    df = spark.createDataFrame(ODD, "id int, t string, kind string, n int").repartition(7)
    folders = []
    monkeypatch.setattr(catalog, "fresh_folder", lambda spark, label: folders.append(fresh_folder(spark, label)) or folders[-1])
    out = catalog.publish_table(
        df, f"{schema}.f", partition_by=("kind", "n"), by_files=True, measures={"rows": F.count(F.lit(1))}
    )
    assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert catalog.measures_of(spark, f"{schema}.f") == {"rows": "200"}
    assert folders and not any(os.path.exists(f) for f in folders)
    empty = catalog.publish_table(df.where("id < 0"), f"{schema}.e", partition_by=("kind", "n"), by_files=True)
    assert empty.count() == 0
    with pytest.raises(CheckFailed):
        catalog.publish_table(df, f"{schema}.g", partition_by=("n",), by_files=True, rules={"no": F.col("id") < 0})
    assert not any(os.path.exists(f) for f in folders)


def test_by_files_brings_partitions_together_without_a_shuffle(spark, folder):
    df = spark.range(8000).repartition(8).select("id", (F.col("id") % 4).cast("int").alias("n"), F.lit("x" * 50).alias("t"))
    for share, most in ((10**9, 1), (regroup.SHARE // 2**11, 4)):
        near = regroup.by_files(df, ["n"], f"{folder}/{share}", share)
        assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
        placed = near.select("n", F.spark_partition_id().alias("task"))
        tasks = placed.groupBy("n").agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("rows"))
        assert {(r["n"], r["rows"]) for r in tasks.collect()} == {(n, 2000) for n in range(4)}
        assert max(r["tasks"] for r in tasks.collect()) <= most < 8


def test_shares():
    assert regroup.shares({}, 10) == []
    assert regroup.shares({"a": 4, "b": 5}, 10) == [(["a", "b"], 1)]
    assert regroup.shares({"a": 25, "b": 9, "c": 9, "d": 9}, 10) == [(["a"], 3), (["b", "c"], 2), (["d"], 2)]


def test_log_grows_columns_and_keeps_rows(spark, schema):
    name = f"{schema}.log"
    catalog.rows_to_table(spark, [(1,)], "version int", name)
    catalog.rows_to_table(spark, [(0.5, 2)], "auc double, version int", name)
    catalog.rows_to_table(spark, [(3,)], "version int", name)
    assert sorted((r["version"], r["auc"]) for r in spark.table(name).collect()) == [(1, None), (2, 0.5), (3, None)]


PARTS = {
    "other order": ("a,b\n1,x\n", "b,a\ny,2\n"),
    "extra field": ("a,b\n1,x\n", "a,b\n2,y,z\n"),
    "short row": ("a,b\n1,x\n", "a,b\n2\n"),
}


@pytest.mark.parametrize("parts", PARTS.values(), ids=PARTS.keys())
def test_parts_that_do_not_match_are_refused_by_name(spark, folder, parts):
    path = f"{folder}/t.csv"
    os.makedirs(path)
    for n, text in enumerate(parts):
        with open(f"{path}/part-{n}.csv", "w") as out:
            out.write(text)
    with pytest.raises(Exception, match=r"part-\d\.csv"):
        landing.scan_csv_text(spark, path).collect()


def test_lineage_names_the_landing_file(spark, folder):
    os.makedirs(f"{folder}/crm/clients.csv")
    with open(f"{folder}/crm/clients.csv/part-0.csv", "w") as out:
        out.write("a,b\n1,x\n")
    with open(f"{folder}/crm/reps.csv", "w") as out:
        out.write("a,b\n1,x\n")
    for name in ("clients.csv", "reps.csv"):
        row = landing.lineage_columns(landing.scan_csv_text(spark, f"{folder}/crm/{name}")).first()
        assert row["source_file"] == name


def test_create_if_absent_keeps_rows(spark, schema):
    name = f"{schema}.e"
    catalog.create_if_absent(spark, name, "a INT, b STRING", "It's empty.")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'x')")
    assert catalog.create_if_absent(spark, name, "a INT, b STRING", "It's empty.").count() == 1


def test_original_extract_headers_are_understood(spark, schema, folder):
    file = next(f for f in landing.ORIGINAL if f.table == "rep")
    path = file.path(folder)
    os.makedirs(os.path.dirname(path))
    with open(path, "w", encoding="utf-8") as out:
        out.write("vendedor_id,nome,regiao,uf,data_admissao,data_desligamento,meta_mensal\n"
                  "007,José Conceição,Sul,PR,2020-01-01,,25000.00\n")
    landing.bronze_ingest(spark, folder, file, schema)
    bronze = spark.table(f"{schema}.rep")
    assert {t for c, t in bronze.dtypes if c != "ingested_at"} == {"string"}
    row = landing.raw_frame(spark, schema, file).first()
    assert row["rep_id"] == "007" and row["rep_name"] == "José Conceição" and row["terminated_on"] is None
    wrong = landing.LandingFile("crm", "vendedores", "rep", {"nope": "rep_id"})
    with pytest.raises(CheckFailed, match="lacks the columns nope"):
        landing.raw_frame(spark, schema, wrong)


def test_fixture_files(spark, folder):
    with open(os.path.join(folder, "a.json"), "w") as out:
        out.write('[{"a": 1}, {"a": 2}]')
    with open(os.path.join(folder, "a.csv"), "w") as out:
        out.write("a\n1\n")
    assert landing.load_fixture(spark, os.path.join(folder, "a.json")).count() == 2
    assert landing.load_fixture(spark, os.path.join(folder, "a.csv")).first()["a"] == "1"
    with pytest.raises(ValueError):
        landing.load_fixture(spark, "a.txt")
