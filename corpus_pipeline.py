"""From raw documents to packed sequences: five stages, each over all rows that the one before kept.

Every stage but the last returns the columns of `documents`. Stages state what
they do with nulls, empty and long texts, ties, repeated rows and clashing
names in the modules that they call; an empty table passes through all of them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import queries
from ledgerloom.llm.common import saved
from ledgerloom.llm.exact_dedup import drop_exact_duplicates
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.near_dedup import drop_similar
from ledgerloom.llm.packing import pack
from ledgerloom.llm.toxicity import drop_toxic

#: The share of the tokens that the mixture keeps; no document is repeated.
BUDGET_SHARE = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return drop_toxic(docs, queries.toxicity_model(spark, docs, sf_dir), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by pairs whose sets of five-word shingles are similar by 0.8 or more; candidates by SimHash and pivot distance tables, beyond their reach by minimum hashes."""
    return drop_similar(docs, words=5, similarity=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target mixture takes, each once at most."""
    plan = replace(queries.MIXTURE, max_epochs=1)
    taken = mix(docs, plan, queries.source_domain(), BUDGET_SHARE)
    return taken.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(docs.columns)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, queries.tokenizer("word_bpe_49k.json"), capacity=2048, end_id=1)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Stages one, four and five learn, draw by seeds and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
