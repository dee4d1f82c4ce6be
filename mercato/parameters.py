"""Everything a run depends on besides the data."""

from __future__ import annotations

from dataclasses import dataclass

from mercato.vocabulary import ENGLISH, Vocabulary

# Business constants of the sales model.
PEAK_MONTHS = (4, 6, 10)
MARKETPLACE_PEAK_MONTHS = (5, 8, 11, 12)
AT_RISK_DAYS = 90
RECENT_DAYS = 90
LAUNCH_DAYS = 120
OVERDUE_RATIO = 1.5
ABC_LIMITS = (0.80, 0.95)
QUEUE_SIZE = 200
SEARCH_SIZE = 20
SEARCH_MAX = 1_000
HOLDOUT = 0.3
SEED = 42
BOOSTING_ROUNDS = 20
AUC_FLOOR = 0.6
AUC_CEILING = 0.99
IMPORTANCE_REPEATS = 5
REVENUE_TOLERANCE = "0.01"


@dataclass(frozen=True)
class RunParameters:
    """`as_of` stands for today, so that a rerun gives the same result."""

    as_of: str
    train_cutoff: str
    score_cutoff: str
    fact_rows: tuple[int, int]
    horizon_days: int = 7
    recent_days: int = RECENT_DAYS
    queue_size: int = QUEUE_SIZE
    words: Vocabulary = ENGLISH
    label_includes_cutoff: bool = False
    stage_as_of_cutoff: bool = True
    auc_bounds: tuple[float, float] = (AUC_FLOOR, AUC_CEILING)
    boosting_rounds: int = BOOSTING_ROUNDS
    # A ranking must find buyers this many times as often as chance.
    lift_floor: float = 1.0
