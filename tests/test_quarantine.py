"""Landing rows that do not fit: where they go, and that none is lost."""

from __future__ import annotations

import os

import pytest

from mercato.operators.checks import CheckFailed
from mercato.sources import landing, versions

FILE = landing.LandingFile("crm", "t", "t", {"a": "a", "b": "b", "c": "c"})


@pytest.fixture()
def schema(spark, folder):
    name = f"q_{os.path.basename(folder).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return name


def land(folder, **parts):
    path = FILE.path(folder)
    os.makedirs(path)
    for name, text in parts.items():
        with open(f"{path}/{name}.csv", "w") as out:
            out.write(text)


GOOD = "a,b,c\n1,x,\n\n2, y ,\"q,q\"\n"
ODD = "a,b,c\n3,x\n4,x,y,z\n5,x,y\n6,x,y,\n7,\"x,y\n8\n"
TURNED = "c,b,a\nz,y,9\nz,y,10\n"


def test_rows_that_do_not_fit_are_kept_with_line_and_reason(spark, schema, folder):
    land(folder, good=GOOD, odd=ODD, turned=TURNED)
    kept = landing.bronze_quarantine(spark, folder, FILE, schema, max_share=0.8)
    assert sorted(tuple(r)[:3] for r in kept.collect()) == [("1", "x", None), ("2", " y ", "q,q"), ("5", "x", "y")]
    assert {r["source_file"] for r in kept.collect()} == {"t.csv"}
    bad = spark.table(f"{schema}.t_rejected").collect()
    found = sorted((os.path.basename(r["file"]), r["line"], r["reason"], r["value"]) for r in bad)
    assert found == [
        ("odd.csv", 2, "missing fields", "3,x"),
        ("odd.csv", 3, "extra fields", "4,x,y,z"),
        ("odd.csv", 5, "extra fields", "6,x,y,"),
        ("odd.csv", 6, "unreadable", '7,"x,y'),
        ("odd.csv", 7, "missing fields", "8"),
        ("turned.csv", 2, "other header", "z,y,9"),
        ("turned.csv", 3, "other header", "z,y,10"),
    ]
    log = landing.arrival_log(landing.arrival_check(spark, folder, (FILE,)), f"{schema}.arrival_log")
    counts = landing.row_count_reconcile(spark, schema, (FILE,), log).first()
    assert counts["match"] and counts["bronze"] == 10


def test_too_many_rejected_rows_leave_the_table_as_it_was(spark, schema, folder):
    land(folder, good=GOOD)
    landing.bronze_quarantine(spark, folder, FILE, schema)
    with open(f"{FILE.path(folder)}/odd.csv", "w") as out:
        out.write(ODD)
    with pytest.raises(CheckFailed, match="5 of 8 rows do not fit"):
        landing.bronze_quarantine(spark, folder, FILE, schema, max_share=0.5)
    assert spark.table(f"{schema}.t").count() == 2 and versions.current(spark, f"{schema}.t") == 1
    assert spark.table(f"{schema}.t_rejected").count() == 5


def test_lines_are_numbered_over_blocks(spark, folder):
    """A file of many splits: numbers are those of the file."""
    n = 4_000
    land(folder, big="a,b,c\n" + "".join(f"{k},x,y\n" if k % 7 else f"{k},x\n" for k in range(2, n)), small=GOOD)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        good, bad, blocks = landing.sorted_out(spark, FILE.path(folder), ["a", "b", "c"])
        assert blocks.count() > 10
        lines = {(r["line"], r["value"]) for r in bad.collect()}
        assert lines == {(k, f"{k},x") for k in range(2, n) if k % 7 == 0}
        assert good.count() == n - 2 - len(lines) + 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_and_missing_files(spark, schema, folder):
    land(folder, none="a,b,c\n")
    assert landing.bronze_quarantine(spark, folder, FILE, schema).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        landing.bronze_quarantine(spark, folder + "/x", FILE, schema)
