"""Queries of this subpackage and their SQL, filled by `register`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
