"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, all but the last with the columns of docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text finds no more perplexing than its language's threshold."""
    from .kneser_ney import keep_fluent

    return keep_fluent(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines and the single long lines that an earlier place has; those with nothing left
    go."""
    from .winnowing import MIN_BYTES, drop_repeated_runs

    return drop_repeated_runs(docs, line_bytes=MIN_BYTES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    from .lsh_forest import drop_near_duplicates

    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from .decontaminate import drop_contaminated

    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    from .apportion import mix_documents

    return mix_documents(docs).drop("source", "shard")
