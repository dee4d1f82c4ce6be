"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of the rows on, so at most 1 / HOT_SHARE keys are
# hot. That bounds what comes to the driver and goes into the plan.
HOT_SHARE = 0.005
MAX_HOT_KEYS = int(1 / HOT_SHARE)
# Heavy-hitter sketch size: its error stays far below HOT_SHARE.
SKETCH_ITEMS = 4096
# More salts than the key's share of the partitions, as hashing them leaves some
# partitions several.
SPREAD = 4


class HotKeys(NamedTuple):
    """Shares of the rows by hot value, and of NULL (0 if that is not hot)."""

    shares: dict = {}
    null: float = 0.0

    def __bool__(self) -> bool:
        return bool(self.shares) or self.null > 0

    def salts(self, key: Column, partitions: int) -> Column:
        """Into how many parts the rows of a key are spread; 1 for an ordinary key."""
        many = lambda share: F.lit(max(1, math.ceil(share * partitions * SPREAD)))
        out = F.when(key.isNull(), many(self.null)) if self.null else F.when(F.lit(False), F.lit(1))
        for value, share in self.shares.items():
            out = out.when(key == value, many(share))
        return out.otherwise(F.lit(1))


def hot_keys(df: DataFrame, *keys: str, share: float = HOT_SHARE) -> dict[str, HotKeys]:
    """For each named column, the values holding at least `share` of the rows. Runs one
    pass over those columns when called; tasks ship sketches, not rows. A value missed
    or added here changes where rows are joined, never the result."""
    counts = [F.count(F.lit(1)).alias("rows")]
    for key in keys:
        counts.append(F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {SKETCH_ITEMS})").alias(f"{key}_top"))
        counts.append(F.count_if(F.col(key).isNull()).alias(f"{key}_nulls"))
    found = df.agg(*counts).first()
    rows = max(1, found["rows"])
    out = {}
    for key in keys:
        top = found[f"{key}_top"] or ()
        shares = {
            t["item"]: t["count"] / rows for t in top if t["item"] is not None and t["count"] >= share * rows
        }
        nulls = found[f"{key}_nulls"] / rows
        out[key] = HotKeys(shares, nulls if nulls >= share else 0.0)
    return out


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join a large left side whose `on` may be hot to a right side with few rows
    per key. Nothing runs here: without `hot` this is the plain join, whose skewed
    partitions Spark splits itself. With the `hot` keys of a published table, rows are
    spread beforehand, for joins that Spark cannot split, as under an aggregate.

    Left rows of a hot key go to as many parts as its share calls for, by a hash of
    `spread_by` (stable, so a recomputed task places rows as before); the few right
    rows of that key are repeated once per part. All other rows have salt 0. A NULL
    key matches nothing and, if frequent, is spread as well."""
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does not do {how}")
    if not hot:
        return left.join(right, on, how)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = hot.salts(F.col(on), partitions)
    place = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), salts).cast("int")
    spread = left.withColumn("salt", place)
    repeated = right.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return spread.join(repeated, [on, "salt"], how).drop("salt")
