"""Registered queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.checkset.ctes import (
    AS_OF, HORIZON, QUEUE_N, SCORE_CUTOFF, TRAIN_CUTOFF, with_ctes,
)
from mercato.plans import call_queue, features, gold, marketplace, propensity, silver
from mercato.session import configure, materialize
from mercato.sources import sample_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Frames:
    """All layers over one folder of test tables. Nothing is kept between queries.
    A table that one query reads several times is written first (`stored_*`), as a
    run over published tables would find it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return sample_tables.RAW[name](self.spark, self.folder)

    def given(self, name: str) -> DataFrame:
        return sample_tables.table(self.spark, self.folder, name)

    @cached_property
    def _client_tables(self) -> tuple[DataFrame, DataFrame]:
        return silver.client_tables(self.raw("client"))

    @property
    def clients(self) -> DataFrame:
        return self._client_tables[0]

    @property
    def merges(self) -> DataFrame:
        return self._client_tables[1]

    @cached_property
    def orders(self) -> DataFrame:
        return silver.silver_orders(self.raw("order"))

    @cached_property
    def products(self) -> DataFrame:
        return silver.silver_products(self.raw("product"))

    @cached_property
    def lines(self) -> DataFrame:
        return silver.typed_lines(self.raw("line"))

    @cached_property
    def reps(self) -> DataFrame:
        return silver.silver_reps(self.raw("rep"))

    @cached_property
    def visits(self) -> DataFrame:
        return silver.silver_visits(self.raw("visit"))

    @cached_property
    def payments(self) -> DataFrame:
        return silver.silver_payments(self.raw("payment"))

    @cached_property
    def portfolio(self) -> DataFrame:
        return silver.silver_portfolio(self.raw("portfolio"), self.reps)

    @cached_property
    def opportunities(self) -> DataFrame:
        return silver.silver_opportunities(self.raw("opportunity"))

    @cached_property
    def stock(self) -> DataFrame:
        return silver.silver_stock(self.raw("stock"))

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_sales(self.lines, self.orders, self.clients, self.merges, self.products)

    @cached_property
    def stored_fact(self) -> DataFrame:
        return materialize(self.fact, "fact")

    @cached_property
    def stored_orders(self) -> DataFrame:
        """What features at both cutoffs and the label are made from, as the features step
        writes it. The fact itself is not written: of its columns only those are made that
        features ask for."""
        wanted = features.up_to_label(self.fact, (TRAIN_CUTOFF, SCORE_CUTOFF), HORIZON)
        return materialize(features.client_orders(wanted), "orders")

    @cached_property
    def dim_client(self) -> DataFrame:
        return gold.dim_client(self.clients, self.merges, self.orders, AS_OF)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.products)

    @cached_property
    def dim_rep(self) -> DataFrame:
        return gold.dim_rep(self.reps)

    @cached_property
    def calendar(self) -> DataFrame:
        return gold.dim_calendar(self.orders)

    @cached_property
    def train_features(self) -> DataFrame:
        return features.features_train(
            self.stored_orders, self.visits, self.opportunities, self.clients, TRAIN_CUTOFF, HORIZON
        )

    @cached_property
    def stored_train_features(self) -> DataFrame:
        return materialize(self.train_features, "train-features")

    @cached_property
    def score_features(self) -> DataFrame:
        return features.client_features(
            self.stored_orders, self.visits, self.opportunities, self.clients, SCORE_CUTOFF
        )

    @cached_property
    def stored_score_features(self) -> DataFrame:
        return materialize(self.score_features, "score-features")

    # A formula stands in for the model where SQL must be able to follow.
    @staticmethod
    def _stand_in(df: DataFrame) -> DataFrame:
        return df.withColumn("score", F.round(1.0 / (1 + F.col("recency_days")), 6))

    @cached_property
    def judged(self) -> DataFrame:
        return self._stand_in(self.stored_train_features)

    @cached_property
    def scores(self) -> DataFrame:
        plain = self._stand_in(self.stored_score_features).select("client_id", "score")
        return propensity.score_bands(plain)

    @cached_property
    def queue(self) -> DataFrame:
        return call_queue.weekly_queue(
            self.scores, self.portfolio, self.dim_rep, self.clients, self.stored_score_features, QUEUE_N
        )

    @cached_property
    def market_reviews(self) -> DataFrame:
        return marketplace.reviews(sample_tables.marketplace_review(self.spark, self.folder))

    @cached_property
    def market_fact(self) -> DataFrame:
        return marketplace.fact_lines(self.lines, self.payments, self.market_reviews)


def check(key: str, sql: str | None = None):
    """Registers a query; `sql` is its text for the other engine."""

    def register(build: Callable[[Frames], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Frames(spark, folder))
        if sql is not None:
            SQL[key] = with_ctes(sql)
        return build

    return register
