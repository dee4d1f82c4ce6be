"""Published tables: numbered versions behind one name.

The name is a view over one version, a table of its own folder in the database
`<database>__versions`. A new version is written and checked there; then one
statement points the view at it. Before that statement readers find the old version,
after it the new one, and a crash at any point leaves one of the two. The version before
the current one stays, so that a query that has begun ends on the version that it began
with; older ones are removed.

Partitions that do not change are not written again: the new version's entry names the
folder in which they lie. All of them are added with one statement."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

SUFFIX = "__versions"
NUMBER = re.compile(r"__v(\d{6,})\b")
KEPT = 2
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PROPERTY = "snapshot."


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def call(spark: SparkSession, statement: str) -> DataFrame:
    """Every change of the catalog goes through here."""
    return spark.sql(statement)


def split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def version_table(spark: SparkSession, name: str, number: int) -> str:
    database, table = split_name(spark, name)
    return f"{database}{SUFFIX}.{table}__v{number:06d}"


def _home(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/") + SUFFIX


def numbers(spark: SparkSession, name: str) -> list[int]:
    """All versions that the catalog has, published or left by a broken-off run."""
    database, table = split_name(spark, name)
    if not spark.catalog.databaseExists(database + SUFFIX):
        return []
    names = [t.name for t in spark.catalog.listTables(database + SUFFIX, f"{table}__v*")]
    own = re.compile(re.escape(table.lower()) + r"__v(\d{6,})")
    return sorted(int(m[1]) for m in map(own.fullmatch, names) if m)


def _described(spark: SparkSession, name: str, entry: str) -> str | None:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(f"col_name = '{entry}'").first()
    return row and row["data_type"]


def current(spark: SparkSession, name: str) -> int | None:
    """The version that readers of the name get."""
    if not spark.catalog.tableExists(name):
        return None
    text = _described(spark, name, "View Text")
    found = NUMBER.search(text or "")
    return int(found[1]) if found else None


def current_table(spark: SparkSession, name: str) -> str:
    """The table behind a published name; a name that is no version stands for itself."""
    number = current(spark, name)
    return name if number is None else version_table(spark, name, number)


def read_version(spark: SparkSession, name: str, number: int) -> DataFrame:
    return spark.table(version_table(spark, name, number))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix(PROPERTY): r["value"] for r in rows if r["key"].startswith(PROPERTY)}


def _note(spark: SparkSession, table: str, notes: Mapping[str, object]) -> None:
    """What is known of a version is kept with it."""
    listed = ", ".join(f"{quoted(PROPERTY + k)} = {quoted(str(v))}" for k, v in notes.items())
    call(spark, f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def next_place(spark: SparkSession, name: str) -> tuple[int, str, str]:
    """Number, table and folder of a version to be written. The folder is new even if
    a broken-off run has used the number."""
    database, table = split_name(spark, name)
    home = _home(spark, database)
    call(spark, f"CREATE DATABASE IF NOT EXISTS {database}{SUFFIX} COMMENT 'Versions of the tables of {database}.' LOCATION {quoted(home)}")
    number = max([0, *numbers(spark, name)]) + 1
    return number, version_table(spark, name, number), f"{home}/{table}/v{number:06d}-{uuid.uuid4().hex[:12]}"


def point(spark: SparkSession, name: str, number: int, comment: str | None = None) -> None:
    """Let readers of the name have that version: one statement."""
    body = f"SELECT * FROM {version_table(spark, name, number)}"
    if spark.catalog.tableExists(name) and current(spark, name) is None:
        # A plain table of that name, from before there were versions.
        call(spark, f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        text = f" COMMENT {quoted(comment)}" if comment else ""
        call(spark, f"CREATE VIEW {name}{text} AS {body}")
        return
    call(spark, f"ALTER VIEW {name} AS {body}")
    if comment and spark.catalog.getTable(name).description != comment:
        call(spark, f"ALTER VIEW {name} SET TBLPROPERTIES ('comment' = {quoted(comment)})")


def commit(
    spark: SparkSession, name: str, number: int, operation: str, comment: str | None = None,
    notes: Mapping[str, object] | None = None, keep: int = KEPT,
) -> None:
    """Note what the version is, point the name at it, remove what is too old."""
    parent = current(spark, name)
    stamp = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
    known = {"operation": operation, "parent": parent or 0, "written_at": stamp, **(notes or {})}
    _note(spark, version_table(spark, name, number), known)
    point(spark, name, number, comment)
    expire(spark, name, keep)


def rollback(spark: SparkSession, name: str, number: int) -> DataFrame:
    """An earlier version again; later ones go with the next publication."""
    if number not in numbers(spark, name):
        raise LookupError(f"{name} has no version {number}")
    point(spark, name, number)
    return spark.table(name)


def history(spark: SparkSession, name: str) -> DataFrame:
    """The versions still there: `version`, `is_current`, `operation`, `parent`,
    `written_at` and all `notes` as JSON."""
    now = current(spark, name)
    rows = []
    for n in numbers(spark, name):
        p = properties(spark, version_table(spark, name, n))
        rows.append((n, n == now, p.get("operation"), int(p.get("parent", 0)), p.get("written_at"), json.dumps(p, sort_keys=True)))
    return spark.createDataFrame(
        rows, "version int, is_current boolean, operation string, parent int, written_at string, notes string"
    )


# -- partitions --------------------------------------------------------------------

def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _path(uri: str) -> str:
    """A folder as files are named there, without the encoding of a URI."""
    parts = urlsplit(uri)
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path)}" if parts.scheme else uri


def folders(spark: SparkSession, table: str, depth: int) -> dict[str, str]:
    """Partition as its folders name it (`year=1997/month=4`) and where it lies, from
    the list of files."""
    places = {_path(os.path.dirname(f)) for f in spark.table(table).inputFiles()}
    return {"/".join(p.split("/")[-depth:]) if depth else "": p for p in places}


def partition_clause(partition: str, kinds: Mapping[str, str]) -> str:
    """`year=1997/month=4` for a statement."""
    parts = []
    for step in partition.split("/"):
        column, _, raw = step.partition("=")
        value = unquote(raw)
        if raw == NO_VALUE:
            text = "NULL"
        else:
            text = quoted(value) if kinds.get(column) in (None, "string", "date", "timestamp") else value
        parts.append(f"`{column}` = {text}")
    return f"PARTITION ({', '.join(parts)})"


def replace_partitions(
    df: DataFrame, name: str, operation: str = "replace partitions", notes: Mapping[str, object] | None = None,
    without: Sequence[str] = (),
) -> DataFrame:
    """A version in which the partitions that the frame has rows for hold these rows
    alone, and those named in `without` (`year=1997/month=4`) are gone; all others stay,
    unwritten. The number of statements is the same for any number of partitions."""
    spark = df.sparkSession
    old = current_table(spark, name)
    parts = partition_columns(spark, old)
    number, new, folder = next_place(spark, name)
    target = spark.table(old)
    changed = df.select(*target.columns).hint("rebalance", *parts)
    changed.write.partitionBy(*parts).parquet(folder)
    call(spark, f"CREATE TABLE {new} LIKE {old} USING parquet LOCATION {quoted(folder)}")
    call(spark, f"ALTER TABLE {new} RECOVER PARTITIONS")
    written = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {new}").collect()}
    kept = {p: place for p, place in folders(spark, old, len(parts)).items() if p not in written and unquote(p) not in without}
    if kept:
        kinds = {f.name: f.dataType.simpleString() for f in target.schema.fields}
        listed = " ".join(f"{partition_clause(p, kinds)} LOCATION {quoted(place)}" for p, place in sorted(kept.items()))
        call(spark, f"ALTER TABLE {new} ADD IF NOT EXISTS {listed}")
    commit(spark, name, number, operation, notes={"partitions_written": len(written), "partitions_kept": len(kept), **(notes or {})})
    return spark.table(name)


# -- removal -------------------------------------------------------------------------

def _files(spark: SparkSession, place: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _inside(spark: SparkSession, place: str, depth: int) -> list[str]:
    """Folders so many levels below a folder."""
    if not depth:
        return [place]
    system, path = _files(spark, place)
    found = [s.getPath() for s in system.listStatus(path) if s.isDirectory()] if system.exists(path) else []
    return [x for p in found for x in _inside(spark, p.toString(), depth - 1)]


def _plain(place: str) -> str:
    """A folder without scheme and host, to be compared."""
    return re.sub(r"^[a-z0-9]+:(//[^/]*)?(?=/)", "", place)


def chain(spark: SparkSession, name: str, keep: int) -> list[int]:
    """The current version and those it came from, `keep` in all."""
    out, there = [], set(numbers(spark, name))
    number = current(spark, name)
    while number in there and len(out) < keep:
        out.append(number)
        number = int(properties(spark, version_table(spark, name, number)).get("parent", 0))
    return out


def expire(spark: SparkSession, name: str, keep: int = KEPT) -> list[int]:
    """Remove all versions but the current one and the `keep` - 1 it came from; those
    left by a broken-off run go too. The catalog forgets a version before its files go.
    Files are found by listing, so what an earlier run could not remove goes as well; a
    partition's folder stays as long as a version reads it. One run at a time publishes
    a table."""
    stay = chain(spark, name, keep)
    if not stay:
        return []
    table = lambda n: version_table(spark, name, n)
    gone = [n for n in numbers(spark, name) if n not in stay]
    for n in gone:
        call(spark, f"DROP TABLE IF EXISTS {table(n)}")
    depth = len(partition_columns(spark, table(stay[0])))
    homes = {_plain(_path(_described(spark, table(n), "Location"))) for n in stay}
    used = {_plain(p) for n in stay for p in folders(spark, table(n), len(partition_columns(spark, table(n)))).values()}
    database, short = split_name(spark, name)
    for home in _inside(spark, f"{_home(spark, database)}/{short}", 1):
        if _plain(home) in homes:
            continue
        needed = any(p.startswith(_plain(home) + "/") for p in used)
        for place in _inside(spark, home, depth) if needed else [home]:
            if _plain(place) not in used:
                system, path = _files(spark, place)
                system.delete(path, True)
    return gone


def publish(
    df: DataFrame, name: str, comment: str | None = None, partition_by: Sequence[str] = (),
    check=None, notes=None, operation: str = "publish",
) -> DataFrame:
    """A new version from a frame, which may read the name itself. `check` is called
    with the written table and stops the publication by raising; `notes` gives what is
    to be noted once the frame is written."""
    spark = df.sparkSession
    number, table, folder = next_place(spark, name)
    writer = df.write.format("parquet").option("path", folder)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    if check:
        check(spark.table(table))
    commit(spark, name, number, operation, comment, notes() if notes else None)
    return spark.table(name)
