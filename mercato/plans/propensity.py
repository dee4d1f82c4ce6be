"""Purchase propensity: split, train, score and judge a model, all in Spark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import safe_ratio
from mercato.operators.checks import CheckFailed
from mercato.operators.running import quartile_band, ranked, roc_auc
from mercato.parameters import (
    AUC_CEILING, AUC_FLOOR, BOOSTING_ROUNDS, HOLDOUT, IMPORTANCE_REPEATS, SEED,
)
from mercato.plans.features import LABEL, NUMERIC_FEATURES
from mercato.session import materialize
from mercato.vocabulary import ENGLISH

SWAPPABLE = (*NUMERIC_FEATURES, "segment", "multichannel")


def lot(key: str, seed: int) -> Column:
    """A fixed pseudo-random draw per row."""
    return F.md5(F.concat(F.col(key), F.lit("|"), F.lit(str(seed))))


def with_holdout(
    df: DataFrame, label: str = LABEL, fraction: float = HOLDOUT, seed: int = SEED, key: str = "client_id"
) -> DataFrame:
    """Marks the given share of every label class, drawn by lot, as holdout. The
    draw is ranked across the cluster, so a class may be as large as it likes."""
    placed = ranked(df.withColumn("lot", lot(key, seed)), ["lot", key], "place", [label])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    return (
        placed.join(sizes, label)
        .withColumn("holdout", F.col("place") <= F.round(F.col("class_rows") * fraction))
        .drop("lot", "place", "class_rows")
    )


def split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    marked = materialize(with_holdout(df, **options), "split")
    return (
        marked.where(~F.col("holdout")).drop("holdout"),
        marked.where("holdout").drop("holdout"),
    )


# -- training and scoring ------------------------------------------------------

def _numbers(df: DataFrame) -> SQLTransformer:
    """Numbers as doubles with the median for a missing one, and a flag that it was
    missing: no overdue ratio means a client with one order, which the trees should
    see. A column without any value becomes 0. Part of the saved model."""
    typed = df.select(*[F.col(c).cast("double") for c in NUMERIC_FEATURES])
    medians = typed.approxQuantile(list(NUMERIC_FEATURES), [0.5], 0.001)
    made = []
    for name, median in zip(NUMERIC_FEATURES, medians):
        fill = repr(float(median[0])) if median else "0.0"
        made.append(f"coalesce(cast({name} AS double), cast({fill} AS double)) AS {name}_in")
        made.append(f"cast({name} IS NULL AS double) AS {name}_missing")
    made.append("cast(multichannel AS double) AS multichannel_flag")
    return SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")


def train(df: DataFrame, label: str = LABEL, seed: int = SEED, max_iter: int = BOOSTING_ROUNDS) -> PipelineModel:
    inputs = [f"{c}_{part}" for part in ("in", "missing") for c in NUMERIC_FEATURES]
    steps = [
        _numbers(df),
        # Unknown segments become the last index, which dropLast turns into zeros.
        StringIndexer(inputCol="segment", outputCol="segment_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="segment_index", outputCol="segment_flags"),
        VectorAssembler(inputCols=[*inputs, "segment_flags", "multichannel_flag"], outputCol="features"),
        GBTClassifier(labelCol=label, featuresCol="features", seed=seed, maxIter=max_iter),
    ]
    return Pipeline(stages=steps).fit(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The frame with the probability of buying in `score`."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("score"))


def importance_by_gain(model: PipelineModel) -> list[tuple[str, float]]:
    trees, assembler = model.stages[-1], model.stages[-2]
    names = [c for c in assembler.getInputCols()[:-2]]
    names += [f"segment={v}" for v in model.stages[1].labels] + ["multichannel_flag"]
    return list(zip(names, (float(x) for x in trees.featureImportances.toArray())))


# -- judging ---------------------------------------------------------------------

def baselines(test: DataFrame, label: str = LABEL) -> DataFrame:
    """AUC of three single columns taken as scores, in one pass: the columns are
    stacked and ranked per name."""
    by_hand = {
        "recency": -F.col("recency_days").cast("double"),
        "revenue": F.col("revenue_total"),
        "overdue": F.coalesce("overdue_ratio", F.lit(0.0)),
    }
    stacked = test.select(
        F.col(label),
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("name"), v.alias("score")) for k, v in by_hand.items()])
        ).alias("entry"),
    ).select(label, "entry.*")
    return roc_auc(stacked, "score", label, ["name"])


def lift_at_k(df: DataFrame, k: int, score_col: str = "score", label: str = LABEL, key: str = "client_id") -> DataFrame:
    """Buyers among the k highest scores, as a share of k, against the base rate. Ties
    by id. With fewer than k clients the empty places count as misses."""
    top = df.select(key, score_col, label).orderBy(F.desc(score_col), F.asc(key)).limit(k)
    rate = df.agg(F.avg(label)).scalar()
    return top.agg(F.sum(label).cast("bigint").alias("hits")).select(
        "hits", rate.alias("base_rate"),
        safe_ratio(F.col("hits").cast("double") / k, rate).alias("lift"),
    )


def permutation_importance(
    model: PipelineModel, test: DataFrame, repeats: int = IMPORTANCE_REPEATS, seed: int = SEED,
    label: str = LABEL, key: str = "client_id",
) -> DataFrame:
    """Mean drop in AUC when one feature is replaced by that of another client."""
    return permutation_drops(lambda df: score(model, df), test, repeats, seed, label, key)


def permutation_drops(
    scored: Callable[[DataFrame], DataFrame], test: DataFrame, repeats: int = IMPORTANCE_REPEATS, seed: int = SEED,
    label: str = LABEL, key: str = "client_id",
) -> DataFrame:
    """The same for anything that adds `score` to a frame with the features.

    Clients are numbered once in drawn order; repeat r gives each client the
    features of the one a drawn distance ahead, round the circle, which is a
    permutation and a plain equi-join. All features and repeats are then scored
    and ranked together."""
    placed = materialize(
        ranked(test.withColumn("lot", lot(key, seed)), ["lot", key], "place").drop("lot"), "placed"
    )
    rows = placed.agg(F.count(F.lit(1)).alias("rows")).scalar()
    step = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("repeat").cast("string"))), 1, 12), 16, 10)
    numbered = placed.withColumn("rows", rows).withColumn(
        "repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))
    )
    # 1 .. rows - 1 places ahead, so nobody is their own donor.
    ahead = 1 + F.pmod(step.cast("bigint"), F.greatest(F.lit(1), F.col("rows") - 1))
    wanted = numbered.withColumn("donor_place", F.pmod(F.col("place") - 1 + ahead, F.col("rows")) + 1)
    donors = placed.select(
        F.col("place").alias("donor_place"), F.struct(*SWAPPABLE).alias("donor")
    )
    paired = wanted.join(donors, "donor_place")
    names = F.array(*[F.lit(c) for c in SWAPPABLE])
    stacked = paired.withColumn("feature", F.explode(names))
    swapped = stacked.select(
        "feature", "repeat", label,
        *[
            F.when(F.col("feature") == c, F.col("donor")[c]).otherwise(F.col(c)).alias(c)
            for c in SWAPPABLE
        ],
    )
    after = roc_auc(scored(swapped), "score", label, ["feature", "repeat"])
    before = roc_auc(scored(test), "score", label).select("auc").scalar()
    return after.groupBy("feature").agg(F.avg(before - F.col("auc")).alias("auc_drop"))


def most_important(drops: DataFrame) -> DataFrame:
    return drops.orderBy(F.desc("auc_drop"), F.asc("feature")).limit(1)


def calibration(
    scored: DataFrame, labels: Sequence[str] = ENGLISH.bands, score_col: str = "score", label: str = LABEL
) -> DataFrame:
    """Clients, buyers, mean score and buying rate per score quartile."""
    return quartile_band(scored, score_col, labels).groupBy("band").agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum(label).cast("bigint").alias("buyers"),
        F.avg(score_col).alias("mean_score"),
        F.avg(label).alias("buying_rate"),
    )


def score_bands(scored: DataFrame, labels: Sequence[str] = ENGLISH.bands) -> DataFrame:
    return quartile_band(scored, "score", labels)


def model_gate(
    auc: float, lift: float, bounds: tuple[float, float] = (AUC_FLOOR, AUC_CEILING), lift_floor: float = 1.0
) -> None:
    """A model must beat chance and must not be too good to be true."""
    low, high = bounds
    problems = []
    if not auc < high:
        problems.append(f"AUC {auc:.4f} reaches the ceiling of {high}, which a sound split cannot")
    if not auc > low:
        problems.append(f"AUC {auc:.4f} stays within the floor of {low}")
    if not lift > lift_floor:
        problems.append(f"the first clients of the ranking buy no more often than others (lift {lift:.2f})")
    if problems:
        raise CheckFailed("; ".join(problems))
