"""The corpus pipeline: quality rules, exact dedup, near-copies, mixing, packing; each stage written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from prosemill.llm import exactdedup, mixing, packing, quality, simhash
from prosemill.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; the model is fitted on the labelled ones among docs."""
    return quality.kept_documents(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exactdedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-copies (five-word shingles, similarity 0.8), the row with the smallest doc_id."""
    return simhash.near_deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 1024 tokens."""
    return packing.packed(docs, 1024, 2)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the trees nor the sketches nor the tokens; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what stands between two stages is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{shared_dir(spark)}/prosemill/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{i}-{name}")
        docs = spark.read.parquet(f"{place}/{i}-{name}")
    return docs
