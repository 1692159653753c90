"""WARC records and their Merkle fixity audit. The audit uses DataFrame functions only.

Method: records are laid end to end in archives, each with its offset and length. The leaf of a record is the SHA-256
of its bytes; `fanout` ordered neighbours, an unbroken range of offsets, form a node, whose digest covers their
digests and the range; nodes form nodes up to one root for an archive. Replicas compare roots; where they differ only
the children of differing nodes are compared, level by level, down to the records. A missing or additional record or
subtree differs from nothing and is reported too.

Defined cases: a null payload is an empty one and differs from no other empty one; records are ordered by ordinal, ties
and repeated ordinals by offset and digest, all of them hashed; null ordinals come first; a null archive is an archive
of its own; an empty replica differs everywhere, two empty ones nowhere; extra columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialise

FANOUT, RECORDS_PER_ARCHIVE = 16, 1000


def warc_record(url: Column, body: Column, record_id: Column) -> Column:
    """The bytes of a WARC/1.0 response record."""
    payload = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("null")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), payload, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", per_archive: int = RECORDS_PER_ARCHIVE, offsets: bool = True) -> DataFrame:
    """(archive, ordinal, offset, length, record): pages as records of archives of `per_archive` consecutive ids; an
    archive is bounded, so are the windows over it. Without `offsets` there is no such column and no shuffle of the
    records; merkle_tree() then lays them end to end by their lengths."""
    r = pages.select(F.col(id_col).cast("long").alias("ordinal"), warc_record(F.col(url_col), F.col(body_col), F.col(id_col)).alias("record"))
    r = r.withColumn("archive", F.floor(F.col("ordinal") / per_archive)).withColumn("length", F.octet_length("record").cast("long"))
    if not offsets:
        return r.select("archive", "ordinal", "length", "record")
    w = Window.partitionBy("archive").orderBy("ordinal", F.sha2("record", 256)).rowsBetween(Window.unboundedPreceding, -1)
    return r.select("archive", "ordinal", F.coalesce(F.sum("length").over(w), F.lit(0)).alias("offset"), "length", "record")


def merkle_tree(records: DataFrame, fanout: int = FANOUT, name: str = "tree") -> list[DataFrame]:
    """Levels from the leaves to the roots: (archive, node, digest, begin, end). Records are hashed where they are read;
    windows and groups, within one archive or one node, move digests alone."""
    leaves = records.withColumn("digest", F.sha2(F.coalesce("record", F.lit(b"")), 256)).drop("record")
    if "offset" not in leaves.columns:
        before = Window.partitionBy("archive").orderBy("ordinal", "digest").rowsBetween(Window.unboundedPreceding, -1)
        leaves = leaves.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    leaves = leaves.select("archive", "ordinal", "offset", "digest", "length")
    w = Window.partitionBy("archive").orderBy("ordinal", "offset", "digest")
    level = materialise(leaves.withColumn("node", (F.row_number().over(w) - 1).cast("long")).select("archive", "node", "digest", F.col("offset").alias("begin"), (F.col("offset") + F.col("length")).alias("end"), "ordinal"), name)
    levels = [level]
    while (level.agg(F.max("node")).first()[0] or 0) > 0:
        child = F.concat_ws(":", F.col("digest"), F.col("begin"), F.col("end"))
        up = level.groupBy("archive", F.floor(F.col("node") / fanout).alias("node")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", child.alias("c")))), lambda x: x["c"]), "|"), 256).alias("digest"), F.min("begin").alias("begin"), F.max("end").alias("end"))
        level = materialise(up, name)
        levels.append(level)
    return levels


def audit(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(archive, node, ordinal, begin, end, digest_a, digest_b, verdict) of the records in which the replicas differ."""
    depth = max(len(a), len(b))
    suspects = None
    for k in range(depth - 1, -1, -1):
        empty = lambda x: x[k] if k < len(x) else x[-1].limit(0)
        x, y = empty(a), empty(b)
        if suspects is not None:
            own = lambda t: t.withColumn("_up", F.floor(F.col("node") / fanout)).join(suspects, F.col("archive").eqNullSafe(F.col("_a")) & (F.col("_up") == F.col("_n")), "left_semi")  # noqa: E731, B023
            x, y = own(x), own(y)
        x = x.select("archive", "node", "digest", "begin", "end", *(["ordinal"] if k == 0 else []))
        y = y.select(*[F.col(c).alias(f"b_{c}") for c in ("archive", "node", "digest", "begin", "end", *(["ordinal"] if k == 0 else []))])
        key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
        j = x.withColumn("_k", key("archive")).join(y.withColumn("_l", key("b_archive")), (F.col("_k") == F.col("_l")) & (F.col("node") == F.col("b_node")), "full")
        j = j.where(~(F.col("digest").eqNullSafe(F.col("b_digest")) & F.col("begin").eqNullSafe(F.col("b_begin")) & F.col("end").eqNullSafe(F.col("b_end"))))
        if k:
            suspects = materialise(j.select(F.coalesce("archive", "b_archive").alias("_a"), F.coalesce("node", "b_node").alias("_n")), "suspects")
    pick = lambda c: F.coalesce(c, f"b_{c}").alias(c)
    verdict = F.when(F.col("b_digest").isNull(), "missing").when(F.col("digest").isNull(), "additional").when(F.col("digest") != F.col("b_digest"), "corrupt").otherwise("moved")
    return j.select(pick("archive"), pick("node"), pick("ordinal"), pick("begin"), pick("end"), F.col("digest").alias("digest_a"), F.col("b_digest").alias("digest_b"), verdict.alias("verdict"))


def write_warc(records: DataFrame, path: str) -> None:
    """One .warc file body for each archive, as binary rows of (archive, content) in Parquet, which keep the exact
    bytes: record after record. An archive is bounded by its number of records."""

    def body(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("ordinal", "ascending"), ("offset", "ascending")])
        return pa.table({"archive": rows["archive"].slice(0, 1), "content": pa.array([b"".join(x or b"" for x in rows["record"].to_pylist())], pa.binary())})

    kind = dict(records.dtypes)["archive"]
    own = records.select("archive", "ordinal", "offset", "record")
    own.groupBy("archive").applyInArrow(body, f"archive {kind}, content binary").write.mode("overwrite").parquet(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, offset, length, uri, record, valid) of .warc and .warc.gz files by any path that Spark reads. A
    file without a valid record header at some place, or cut short, ends there with a row that has the rest of its bytes
    and `valid` false."""

    def run(frames):
        import gzip
        import re

        import pandas as pd

        for f in frames:
            for name, blob in zip(f["path"], f["content"]):
                data, at, rows = gzip.decompress(blob) if name.endswith(".gz") else bytes(blob), 0, []
                while (m := re.compile(rb"WARC/\d\.\d\r\n(.*?)\r\n\r\n", re.S).match(data, at)) and (n := re.search(rb"(?im)^Content-Length:\s*(\d+)", m[1])):
                    end = min(len(data), m.end() + int(n[1]) + 4)
                    uri = re.search(rb"(?im)^WARC-Target-URI:\s*(\S*)", m[1])
                    whole = m.end() + int(n[1]) + 4 <= len(data)
                    rows.append((name, len(rows), at, end - at, uri[1].decode("utf-8", "replace") if uri else None, data[at:end], whole))
                    at = end
                if at < len(data):
                    rows.append((name, len(rows), at, len(data) - at, None, data[at:], False))
                yield pd.DataFrame(rows, columns=["file", "ordinal", "offset", "length", "uri", "record", "valid"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, ordinal long, offset long, length long, uri string, record binary, valid boolean")
