"""A corpus cleaned and packed: each stage reads what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import decontamination, packing, quality, simhash, toxicity
from claimloom.llm.common import held_out, table, written
from claimloom.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """All columns in one, beside the text, so that none can clash with a score."""
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "text")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; without labels all of them."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 4, 2))
    return quality.with_quality(_packed(docs), model, "score").filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; without labels all of them."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 3, 1))
    return toxicity.with_toxicity(_packed(docs), model, "score").filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by SimHash fingerprints at two bits or fewer, over shingles of three words."""
    return simhash.without_near_copies(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences."""
    return packing.pack_documents(docs, *tokenizer(), with_ids=False, special_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("simhash_near_dedup", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("packing", packed_documents),
]

# fitted models and packing can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
