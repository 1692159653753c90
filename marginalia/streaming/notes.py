"""Notes as a stream: a folder that fills becomes span rows. All of it is stateless and keyed by the note."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extraction
from ..operators.sections import with_sections


def stream_notes(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """(record_id, raw_text) of the .txt files as they come."""
    rows = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.txt").text(folder)
    return rows.select(F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.txt$", "").alias("record_id"), F.col("value").alias("raw_text"))


def stream_spans(notes: DataFrame) -> DataFrame:
    """Rule spans without the parts that need a window over a note: drugs, diagnoses and symptoms."""
    n = with_sections(notes)
    return extraction.union(extraction.dosed_drugs(n), extraction.drug_aliases(n), extraction.diagnosis_lexicon(n), extraction.symptom_lexicon(n))


def write_spans(spans: DataFrame, folder: str, checkpoint: str):
    """Appends to Parquet, exactly once, all that has come."""
    return spans.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
