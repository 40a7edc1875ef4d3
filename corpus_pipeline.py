"""The corpus pipeline: documents to a deduplicated, decontaminated, pseudonymised and mixed corpus.

Each stage gets the documents that its predecessor kept, written as Parquet and read again, and
returns those it keeps, with the columns of ``documents``; the last one adds tokens, domain
memberships, ``rate`` and ``copies`` (how often to use a document) and keeps every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import decontaminate, mixing, pii, simhash, toxicity
from salesflow.llm.queries import PII_KEY, held_out, table
from salesflow.staging import stage

TARGETS = {"clean": 0.92, "junk": 0.08}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. Labels kept for testing are not learned from."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.drop_toxic(docs, toxicity.fit(labels, docs), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), id_col="item_id")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values are replaced; no document goes."""
    return pii.pseudonymise(docs, PII_KEY).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the tokens of good and of poor documents to their targets. Toxic ones are
    gone, so there is no domain for the few that were not found."""
    domain = F.when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")
    return mixing.mix(docs, table(spark, sf_dir, "labels"), domain, TARGETS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("mixing", mix),
]
# models, components and descent are not SQL; tests hold each stage against plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
