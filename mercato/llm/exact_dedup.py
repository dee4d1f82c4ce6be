"""Exact dedup by deterministic block naming, DataFrame functions only.

A text is cut into blocks of a fixed number of characters. Equal blocks get one
integer name: the distinct blocks are sorted within their partitions and numbered.
Adjacent names are then named in pairs, again and again, until a document has one
name. Two documents have the same name at the same level exactly if their texts
are equal, whatever the hash functions do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch

SPACES = r"[\x20\x09-\x0D]+"
BLOCK_CHARACTERS = 8192
NO_NAME = -1


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _blocks(text: Column, characters: int) -> Column:
    """At least one block, for an empty text the empty one."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{characters}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys with integer names in sorted order within each partition. To be
    written before use, so that a name never changes."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def block_identities(
    documents: DataFrame,
    scratch: Scratch,
    characters: int = BLOCK_CHARACTERS,
    place: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """`doc_id`, `text_sha256`, `uid` (a number of the row), `level` and `name` for
    each row of `documents` (`doc_id`, `text`). `place` only decides where blocks
    meet: blocks that share a place get different names, and are then told apart by
    their text."""
    text = normalised(F.col("text"))
    blocks = _blocks(F.col("norm"), characters)
    cut = documents.select("doc_id", text.alias("norm")).withColumn("blocks", blocks)
    names = scratch.write(
        _numbered(
            cut.select(F.explode("blocks").alias("block"))
            .select(place(F.col("block")).alias("place"), "block")
            .distinct(),
            "place",
            "block",
        ).withColumn("block", F.lit(None).cast("string")),
        "names",
    )
    shared = names.groupBy("place").count().where("count > 1").limit(1).count() > 0
    keys = ["place"]
    if shared:
        # Two texts met in one place, so the names are taken by text.
        keys = ["place", "block"]
        scratch.drop(names)
        names = scratch.write(
            _numbered(
                cut.select(F.explode("blocks").alias("block"))
                .select(place(F.col("block")).alias("place"), "block")
                .distinct(),
                *keys,
            ),
            "names",
        )
    seen = F.transform("blocks", lambda b: F.struct(place(b).alias("place"), *([b.alias("block")] if shared else [])))
    rows = scratch.write(
        cut.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            seen.alias("seen"),
        ),
        "rows",
    )
    current = scratch.write(
        rows.select("uid", F.size("seen").alias("n"), F.posexplode("seen").alias("no", "at"))
        .select("uid", "n", "no", "at.*")
        .join(names.select(*keys, "name"), keys)
        .select("uid", "n", "no", "name"),
        "level0",
    )
    scratch.drop(names)
    done = [current.where("n = 1").select("uid", F.lit(0).alias("level"), "name")]
    level, open_rows = 0, current.where("n > 1")
    while open_rows.limit(1).count():
        level += 1
        side = lambda odd: F.max(F.when(F.col("no") % 2 == odd, F.col("name")))
        pairs = scratch.write(
            open_rows.groupBy("uid", "n", F.expr("no div 2").cast("int").alias("no")).agg(
                side(0).alias("first"), F.coalesce(side(1), F.lit(NO_NAME)).alias("second")
            ),
            f"pairs{level}",
        )
        pair_names = scratch.write(_numbered(pairs.select("first", "second").distinct(), "first", "second"), "names")
        current = scratch.write(
            pairs.join(pair_names, ["first", "second"]).select(
                "uid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "no", "name"
            ),
            f"level{level}",
        )
        scratch.drop(pairs, pair_names)
        done.append(current.where("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        open_rows = current.where("n > 1")
    identities = done[0]
    for more in done[1:]:
        identities = identities.unionAll(more)
    return rows.select("uid", "doc_id", "text_sha256").join(identities, "uid")


def exact_copies(documents: DataFrame, characters: int = BLOCK_CHARACTERS, place=F.xxhash64) -> DataFrame:
    """One row for each row of `documents`: `doc_id`, `keep_id` (the smallest doc_id
    with an equal text), `group_size`, `kept`, `text_sha256`.

    Texts are compared after each run of white space became one space. A null text
    counts as empty. A null doc_id counts as larger than any other. Rows repeated
    with the same doc_id and text are copies like others: they count in
    `group_size`, and one of them is kept. An empty table gives an empty result;
    other columns are not read."""
    scratch = Scratch(documents.sparkSession, "exact-dedup")
    named = scratch.write(
        block_identities(documents.select("doc_id", "text"), scratch, characters, place), "identities"
    )
    groups = named.groupBy("level", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )
    groups = scratch.write(groups.where("group_size > 1"), "groups")
    stays = F.coalesce(F.col("first.uid") == F.col("uid"), F.lit(True))
    return named.join(groups, ["level", "name"], "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that stay, with all their columns; of rows with the
    same doc_id and equal text one stays."""
    kept = exact_copies(documents).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    marked = documents.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("sha"), F.struct("*").alias("whole"))
    match = marked["doc_id"].eqNullSafe(kept["kept_id"]) & (marked["sha"] == kept["kept_sha"])
    return marked.join(kept, match, "left_semi").dropDuplicates(["doc_id", "sha"]).select("whole.*")


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


@register("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark, sf_dir):
    return exact_copies(table(spark, sf_dir, "documents"))
