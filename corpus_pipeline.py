"""From raw documents to packed sequences: the stages in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbend.llm import decontaminate, packing, pii, simhash, toxicity
from riverbend.llm.common import table
from riverbend.llm.queries import PII_KEY, TOKENIZER
from riverbend.session import save


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymize_documents(docs, PII_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash near-dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("pii", pseudonymize),
    ("packing", pack),
]

#: No stage but the last two is a plain SQL expression; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
