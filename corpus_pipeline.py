"""A cleaning pipeline over documents, each stage one operator of marginalia.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm.stages import benchmark_decontamination, line_dedup, mixing, near_dedup, quality_classifier
from marginalia.llm.store import materialise

STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", mixing),
]

#: Not in SQL: perplexities, signatures and block-max retrieval; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
