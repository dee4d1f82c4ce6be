"""From raw documents to packed sequences: five stages, each over all that the stage
before it kept. Each stage is written as Parquet and read again as the next one's
documents. All stages but the last keep the columns of their documents, whatever else
there is and however it is named; no documents give none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import exact_dedup, mixing, ngram_join, ordinal_quality, packing
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is high enough. A null text is judged
    like an empty one; without any rating none is kept. Repeated rows share their fate."""
    graded = ordinal_quality.graded(docs, table(spark, sf_dir, "labels"))
    return graded.where("kept").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest doc_id. Null
    counts as empty; of rows repeated with their doc_id one stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word shingles, the one with the smallest
    doc_id. Texts without words are linked with nothing and stay."""
    return ngram_join.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it. A null source is a source;
    texts without words, which have no size, are never taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences. Copies that the mix made
    are packed each for itself."""
    return packing.pack_documents(docs, with_ids=False)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# The classifier, the shingle links and the search over bins are beyond SQL.
ORACLE_SQL = None


@register("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
