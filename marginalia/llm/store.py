"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch, and bytes of a row group, while a table is written: both are held in memory by each task.
ARROW_ROWS, ROW_GROUP = 1024, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset a temporary one is set in local mode; on a cluster
    that raises, since executors don't share the driver's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jsc.isDefined():
            return jsc.get()
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marginalia-"))
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most ARROW_ROWS rows for what runs inside; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    if not 0 < int(own) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, own)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df once as Parquet in the shared folder and reads it back: later uses neither recompute it nor
    depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_shared_path"] = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table of materialise() that nothing reads any more."""
    path = df.__dict__.get("_shared_path")
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(p, True)


#: Bytes of ids that are broadcast; a number or a date counts as 8.
BROADCAST_IDS = 32 << 20


def by_ids(df: DataFrame, ids: DataFrame, column: str, how: str, bound: int = BROADCAST_IDS) -> DataFrame:
    """df joined (left_semi or left_anti) with the distinct ids of the one-column table `ids`. The ids are written and
    measured: up to `bound` bytes are broadcast, so that long texts aren't shuffled for a test of their id; more are
    joined by a shuffle. Null ids match nothing."""
    own = materialise(ids.toDF("_own_id").where("_own_id IS NOT NULL").distinct(), "ids")
    size = F.octet_length("_own_id") if dict(own.dtypes)["_own_id"] in ("string", "binary") else F.lit(8)
    held = own.agg(F.sum(F.greatest(size, F.lit(8)))).first()[0] or 0
    own = F.broadcast(own) if held <= bound else own
    return df.join(own, df[column] == own["_own_id"], how)


def bounded(df: DataFrame, name: str, rows: int = 100_000) -> DataFrame:
    """df written and counted, to be broadcast in joins where it has at most `rows` short rows: a table of languages or
    sources by rule, which a shuffle would meet with a few hot keys."""
    own = materialise(df, name)
    return F.broadcast(own) if own.count() <= rows else own
