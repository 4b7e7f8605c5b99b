"""Corpus pipeline: toxicity, quality rules, near-duplicates, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import mixing, neardup, packing, quality, tokens, toxicity
from tidewheel.llm.base import boxed, table, written

#: The machine's score from which a document is rejected.
TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the machine learns from the labelled documents at hand.

    Null and empty texts have no terms and get the score of none; repeated rows are judged alike; without labels nothing is rejected; an
    empty table gives no rows.  All columns come back, whatever their names.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return toxicity.score(docs, model, name).where(F.col(name) < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep.

    Null and empty texts fail the base rules; repeated rows are judged alike; null languages are one of their own; an empty table gives no rows.
    """
    return quality.judge(boxed(docs, "text", "lang"), keep_text=False).where("kept").select("_doc.*")


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8 or more).

    Of equal rows one stays, whatever their ids; texts without words are a group each; an empty table gives no rows.
    """
    return neardup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks: equal ids are drawn alike, texts without words count as size 0, null is a
    source of its own, an empty table gives no rows."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their token ids and their place in a sequence; a text that is null or empty is its closing id alone."""
    return packing.pack_documents(docs, tokens.default_vocabulary())


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near-dedup", neardup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: A trained model decides the first stage; tests/llm compares the whole with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again before the next; empty tables give no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
