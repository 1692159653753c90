"""Sinks of results."""

from __future__ import annotations

import io
import json
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import numeric_order


def write_json(documents: DataFrame, folder: str) -> None:
    """B1 at any size: (record_id, entities) as JSON text, one partition of the folder for each record."""
    documents.select("record_id", F.to_json("entities").alias("value")).write.mode("overwrite").partitionBy("record_id").text(folder)


def file_bodies(documents: DataFrame) -> DataFrame:
    """(record_id, body): entities as indented JSON with plain Unicode."""

    def run(frames):
        for f in frames:
            f["body"] = [json.dumps(json.loads(x), ensure_ascii=False, indent=2) for x in f["body"]]
            yield f

    return documents.select("record_id", F.to_json("entities").alias("body")).mapInPandas(run, "record_id string, body string")


def zip_bytes(documents: DataFrame, folder: str = "output") -> bytes:
    """B2: a deflated zip of {folder}/{record_id}.json in numeric order, records streamed to the driver one by one."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for r in file_bodies(documents).orderBy(*numeric_order(F.col("record_id"))).toLocalIterator():
            z.writestr(f"{folder}/{r.record_id}.json", r.body)
    return out.getvalue()


def alias_lines(aliases: DataFrame, header: str) -> DataFrame:
    """A comment, then the five fields by (concept, lower alias)."""
    rows = aliases.select(F.lit(1).alias("k"), "concept_id", F.lower("alias").alias("l"), F.concat_ws("\t", "alias", "canonical", "concept_id", "source", "semantic_type").alias("value"))
    top = aliases.sparkSession.createDataFrame([(0, "", "", f"# {header}")], rows.schema)
    return rows.union(top).orderBy("k", "concept_id", "l").select("value")


def write_aliases(aliases: DataFrame, path: str, header: str) -> None:
    alias_lines(aliases, header).coalesce(1).write.mode("overwrite").text(path)
