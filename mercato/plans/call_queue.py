"""The weekly call queue: the best-scored clients of reps still employed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.columns import banded
from mercato.operators.groups import group_size
from mercato.operators.running import ranked
from mercato.operators.skew import salted_join
from mercato.parameters import AT_RISK_DAYS, OVERDUE_RATIO, QUEUE_SIZE
from mercato.vocabulary import ENGLISH, Vocabulary


def queue_eligible(scores: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Scores with every current rep of the client. Joined before any cut, so that
    clients without a working rep cannot take places in the queue."""
    pairs = portfolio.where("current").select("client_id", "rep_id").distinct()
    return salted_join(pairs, scores.select("client_id", "score", "band"), "client_id", ["rep_id"])


def best(eligible: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    return eligible.orderBy(F.desc("score"), F.asc("client_id"), F.asc("rep_id")).limit(n)


def rep_label(reps: DataFrame) -> DataFrame:
    """(rep_id, rep): the name, with the id where reps share it."""
    sized = group_size(reps.select("rep_id", "rep_name"), "rep_name", ["rep_id"], "namesakes")
    shared = F.concat("rep_name", F.lit(" (#"), "rep_id", F.lit(")"))
    return sized.select(
        "rep_id", F.when(F.col("namesakes") > 1, shared).otherwise(F.col("rep_name")).alias("rep")
    )


def _rules() -> Sequence[Column]:
    return (
        F.col("recency_days") > AT_RISK_DAYS,
        F.col("overdue_ratio") > OVERDUE_RATIO,
        F.col("recent_orders") == 0,
    )


def queue_reason(features: DataFrame, words: Vocabulary = ENGLISH) -> DataFrame:
    """(client_id, reason, advice) by the first rule that holds."""
    quiet, overdue, slower = _rules()
    days = F.col("recency_days").cast("string")
    times = F.round("overdue_ratio", 1).cast("string")
    reason = banded(
        [
            (quiet, F.concat(F.lit(words.reason_quiet[0]), days, F.lit(words.reason_quiet[1]))),
            (overdue, F.concat(F.lit(words.reason_overdue[0]), times, F.lit(words.reason_overdue[1]))),
            (slower, words.reason_slower),
        ],
        words.reason_likely,
    )
    advice = banded(
        [(quiet, words.advice_quiet), (overdue, words.advice_overdue), (slower, words.advice_slower)],
        words.advice_likely,
    )
    return features.select("client_id", reason.alias("reason"), advice.alias("advice"))


def rank_in_group(df: DataFrame, key: str, order: Sequence[str], into: str = "position") -> DataFrame:
    """1, 2, ... in a unique order ('-score' descends) within each group, of any size."""
    return ranked(df, order, into, [key])


def weekly_queue(
    scores: DataFrame, portfolio: DataFrame, reps: DataFrame, clients: DataFrame, features: DataFrame,
    n: int = QUEUE_SIZE, words: Vocabulary = ENGLISH,
) -> DataFrame:
    """The n best pairs with position per rep. After the cut only n rows are left,
    so the joins start from them and the window is small by construction."""
    top = best(queue_eligible(scores, portfolio), n)
    joined = (
        clients.select("client_id", "legal_name", "city")
        .join(top, "client_id")
        .join(rep_label(reps), "rep_id")
        .join(queue_reason(features, words), "client_id")
    )
    by_rep = Window.partitionBy("rep_id").orderBy(F.desc("score"), F.asc("client_id"))
    placed = joined.withColumn("position", F.row_number().over(by_rep))
    return placed.select(
        "client_id", "rep", "position", "legal_name", "city", "score", "band", "reason", "advice"
    )
