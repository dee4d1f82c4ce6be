"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """`v`, `root` for every vertex of `edges` (`a`, `b`): the root is one vertex of
    the component, the same for all of it. Each round every vertex moves to its
    smallest neighbour, and edges inside a vertex vanish; a hot vertex is
    pre-aggregated before the shuffle."""
    links = scratch.write(edges.select("a", "b").where("a <> b").distinct(), "edges")
    moves = []
    while links.limit(1).count():
        both = links.select(F.col("a").alias("v"), F.col("b").alias("w")).unionAll(
            links.select(F.col("b").alias("v"), F.col("a").alias("w"))
        )
        move = scratch.write(
            both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("to")), "moves"
        )
        moves.append(move)
        a = move.select(F.col("v").alias("a"), F.col("to").alias("x"))
        b = move.select(F.col("v").alias("b"), F.col("to").alias("y"))
        after = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        shorter = scratch.write(after.where("a <> b").distinct(), "edges")
        scratch.drop(links)
        links = shorter
    if not moves:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
    root = moves[0].select("v", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("v").alias("root"), "to")
        root = root.join(step, "root", "left").select("v", F.coalesce("to", "root").alias("root"))
    return root
