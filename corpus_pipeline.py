"""From raw documents to packed training sequences, stage by stage.

Every stage gets what the one before kept, written as Parquet and read again, and all but the last
return the columns of ``documents``: toxic documents go, of equal texts the smallest doc_id stays,
of near copies likewise, sources are mixed to their target weights (a document may repeat up to
three times or drop out), and what is left is cut into pieces and packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconry.llm import exact, jaccard, mixing, packing, toxicity
from beaconry.session import persist_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, 0.8."""
    return jaccard.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies),
          ("source_mixing", mix_sources), ("best_fit_packing", pack)]

ORACLE_SQL = None  # fitted scores and a packing order are beyond SQL; tests/llm compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = persist_table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
