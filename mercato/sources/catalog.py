"""Tables, views and comments in the session catalog. Published tables are versions
behind a name (`versions`); logs are plain tables that grow."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.checks import Observed
from mercato.plans.descriptions import COLUMNS, TABLES
from mercato.session import fresh_folder
from mercato.sources import regroup, versions
from mercato.sources.versions import quoted

LAYERS = {
    "bronze": "Landing files as they came, all text.",
    "silver": "Cleaned and typed tables.",
    "gold": "Star schema, marts, views, features and queue.",
}


def _short(name: str) -> str:
    return name.rsplit(".", 1)[-1]


def create_schemas(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    names = []
    for layer, comment in LAYERS.items():
        name = prefix + layer
        where = f" LOCATION {quoted(os.path.join(location, layer))}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {quoted(comment)}{where}")
        names.append(name)
    return names


def set_namespace(spark: SparkSession, database: str) -> None:
    spark.catalog.setCurrentDatabase(database)


def with_comments(df: DataFrame, comments: Mapping[str, str] = COLUMNS) -> DataFrame:
    """Column comments travel in the schema, so one write sets them all."""
    for column in df.columns:
        if column in comments:
            df = df.withMetadata(column, {"comment": comments[column]})
    return df


def publish_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    partition_by: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    by_files: bool = False,
) -> DataFrame:
    """Replace a table by a frame, which may read the table itself.

    The frame becomes a new version; the name is pointed at it when it is written and its
    rows keep the rules, so bad rows are never published and a failed write leaves the
    old version. Broken rules are counted, and `measures` (aggregates by name) taken,
    while the rows are written, without a second scan; measures stay with the version
    (`measures_of`). Partitioned output is rebalanced by the partition columns, where
    Spark splits a large partition over several tasks instead of giving it to one. With
    `by_files`, for wide rows in some hundred partitions, files take the place of that
    shuffle (`regroup`); they are removed once the version is written."""
    spark, parts = df.sparkSession, None
    try:
        if partition_by and by_files:
            parts = fresh_folder(spark, "parts")
            df = regroup.by_files(df, partition_by, parts)
        elif partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df = with_comments(df)
        observed = Observed(rules or {}, measures or {})
        return versions.publish(
            observed.watch(df), name, comment or TABLES.get(_short(name)), partition_by,
            check=lambda written: observed.enforce(), notes=observed.notes,
        )
    finally:
        if parts:
            regroup.remove(spark, parts)


def measures_of(spark: SparkSession, name: str) -> dict[str, str]:
    """What was measured while the current version was written, as text."""
    noted = versions.properties(spark, versions.current_table(spark, name))
    return {k.removeprefix("measure."): v for k, v in noted.items() if k.startswith("measure.")}


def replace_partitions(df: DataFrame, name: str) -> DataFrame:
    """Overwrite only the partitions the frame has rows for, in one step for readers."""
    return versions.replace_partitions(with_comments(df), name)


def append_log(df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
    """Append rows; columns the table does not have yet are added to it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        with_comments(df).write.format("parquet").saveAsTable(name)
        text = comment or TABLES.get(_short(name))
        if text:
            comment_table(spark, name, text)
        return spark.table(name)
    have = spark.table(name)
    for field in df.schema.fields:
        if field.name not in have.columns:
            known = f" COMMENT {quoted(COLUMNS[field.name])}" if field.name in COLUMNS else ""
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({field.name} {field.dataType.simpleString()}{known})")
    merged = spark.table(name)
    aligned = merged.limit(0).unionByName(df, allowMissingColumns=True)
    aligned.write.insertInto(name)
    return spark.table(name)


def create_if_absent(spark: SparkSession, name: str, columns: str, comment: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet COMMENT {quoted(comment)}")
    return spark.table(name)


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {quoted(text)}")


def comment_columns(spark: SparkSession, name: str, comments: Mapping[str, str]) -> None:
    for column, text in comments.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT {quoted(text)}")


def create_commented_view(
    spark: SparkSession, name: str, query: str, comment: str | None = None,
    columns: Mapping[str, str] = COLUMNS,
) -> DataFrame:
    text = comment or TABLES[_short(name)]
    listed = ", ".join(
        f"{c} COMMENT {quoted(columns[c])}" if c in columns else c for c in spark.sql(query).columns
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({listed}) COMMENT {quoted(text)} AS {query}")
    return spark.table(name)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def rows_to_table(spark: SparkSession, rows: Iterable[tuple], schema: str, name: str) -> DataFrame:
    """For a handful of driver rows, such as one line of metrics."""
    return append_log(spark.createDataFrame(list(rows), schema), name)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
