"""From raw documents to packed training sequences.

Each stage calls one operator on all that the stage before kept; its result is written and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import decontaminate, near_dup, pii, quality, queries
from tillmark.llm.ship import ship
from tillmark.llm.store import Store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"), least=0.3)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others keep their whole text."""
    return decontaminate.remove(docs, queries.table(spark, sf_dir, "benchmark"), "documents")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; `n_chars` follows the text."""
    out = pii.redact(docs)
    if "n_chars" not in out.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as op3 returns them."""
    return queries.packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# A trained classifier and a tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    store = Store(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = store.hold(stage(spark, docs, sf_dir), name)
        if before:
            store.drop(before)
        before = name
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
