"""Line dedup by winnowing over line hashes. DataFrame functions only.

Method: a text is the sequence of its lines. Of every window of `window` lines the line with the least hash (the last
of equal ones) is selected; only selected lines are kept, as fingerprints with their positions, so any run of `window`
lines has one wherever it stands. Positions join on the fingerprint; those whose fingerprint stands nowhere else go.
From the others the match is extended to both sides: for each window that selected the line, a hash of the lines to
its left and right is compared with that of the earliest place (in the order id, line) that agrees. A later place is a
repeat; repeats that touch chain to maximal runs. All lines of a repeat go, which leaves the first place of every run
of `window` lines. A run needs `min_bytes` bytes besides blanks, so that chance repeats of short lines stay. With
`line_bytes` a line of that many bytes besides blanks is a window of its own, whatever stands around it (the rule of
the query, of its SQL and of the pipeline). Places meet the least place of a hash, never each other, so a
line that thousands of documents hold costs as many rows.

Defined cases: lines end at a line feed; a null text has no lines and stays null; empty text is one empty line; a text
shorter than a window has none; repeats within one text count; null ids are read but never delete or lose lines;
texts that repeat an id are told apart by a hash of the text, so rows equal in id and text are one text, which all
lose the same lines; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

WINDOW, MIN_BYTES = 2, 40
#: Bytes of line numbers to delete that are broadcast to the texts (48 a text, 4 a line); beyond it texts are shuffled.
BROADCAST_BYTES = 32 << 20


def fingerprints(rows: DataFrame, window: int, min_bytes: int, line_bytes: int | None) -> DataFrame:
    """(_id, _key, i, fp, ext) of rows (_id, _key, l array<struct<a,b,n>>): the selected lines. ext has an entry for each
    window of enough bytes that selects the line: `left`, the lines of the window before it, `m`, the window's length,
    and two hashes of its lines. Lines without such a window aren't kept."""
    size = F.size("l")
    # the lines around line i, as many to either side as a window can reach
    around = F.transform("l", lambda x, i: F.struct(i.alias("i"), x.alias("x"), F.slice("l", F.greatest(i - (window - 2), F.lit(1)), F.least(i, F.lit(window - 1)) + window).alias("c"), F.least(i, F.lit(window - 1)).alias("at")))
    one = rows.select("_id", "_key", size.alias("_size"), F.explode(around).alias("s")).select("_id", "_key", "_size", "s.*")

    def extension(left):
        """The window with `left` lines before line i, null where line i isn't its selected one."""
        w = F.slice(F.col("c"), F.greatest(F.col("at") - left + 1, F.lit(1)), window)
        inside = (left <= F.col("at")) & (F.col("i") - left + window <= F.col("_size"))
        before = F.forall(F.slice(w, 1, left), lambda y: y["a"] >= F.col("x.a"))
        after = F.forall(F.slice(w, left + 2, F.greatest(F.lit(window) - left - 1, F.lit(0))), lambda y: y["a"] > F.col("x.a"))
        enough = F.aggregate(w, F.lit(0), lambda s, y: s + y["n"]) >= min_bytes
        entry = F.struct(left.cast("int").alias("left"), F.lit(window).alias("m"), F.xxhash64(F.transform(w, lambda y: y["a"])).alias("k1"), F.xxhash64(F.transform(w, lambda y: y["b"])).alias("k2"))
        return F.when(inside & before & after & enough, entry)

    ext = F.array(*[extension(F.lit(k)) for k in range(window)])
    if line_bytes is not None:
        alone = F.struct(F.lit(0).alias("left"), F.lit(1).alias("m"), F.xxhash64(F.array("x.a")).alias("k1"), F.xxhash64(F.array("x.b")).alias("k2"))
        ext = F.concat(ext, F.array(F.when(F.col("x.n") >= line_bytes, alone)))
    out = one.select("_id", "_key", "i", F.col("x.a").alias("fp"), F.array_compact(ext).alias("ext"))
    return out.where(F.size("ext") > 0)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_bytes: int = MIN_BYTES, line_bytes: int | None = None) -> DataFrame:
    """(_id, _key, gone): numbers, from 0, of the lines to delete in each text that has any; _key tells texts of one id
    apart."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.select("_id", F.xxhash64("_text").alias("_key"), F.split("_text", "\n").alias("l"))
    rows = rows.select("_id", "_key", F.transform("l", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(7)).alias("b"), F.octet_length(F.translate(x, " \t\r", "")).alias("n"))).alias("l"))
    prints = materialise(fingerprints(rows, window, min_bytes, line_bytes), "prints")
    often = prints.groupBy("fp").agg(F.count("*").alias("c")).where("c > 1").select("fp")
    shared = prints.join(often, "fp", "left_semi")
    wins = shared.select("_id", "_key", F.col("i").alias("at"), F.explode("ext").alias("x")).select("_id", "_key", (F.col("at") - F.col("x.left")).alias("i"), "x.m", "x.k1", "x.k2")
    first = wins.groupBy("k1", "k2").agg(F.count("*").alias("c"), F.min(F.struct("_id", "_key", "i")).alias("f")).where("c > 1")
    later = wins.join(first, ["k1", "k2"]).where(F.struct("_id", "_key", "i") > F.col("f"))
    gone = later.select("_id", "_key", F.explode(F.sequence("i", F.col("i") + F.col("m") - 1)).alias("i")).groupBy("_id", "_key")
    return gone.agg(F.array_sort(F.collect_set("i")).alias("gone"))


def _cut(docs: DataFrame, id_col: str, text_col: str, window: int, min_bytes: int, line_bytes: int | None = None) -> DataFrame:
    """docs with the text shortened, and _wl_n (lines) and _wl_gone (numbers of the deleted ones)."""
    gone = materialise(repeated_lines(docs, id_col, text_col, window, min_bytes, line_bytes), "gone").toDF("_wl_id", "_wl_key", "_wl_gone")
    size = gone.agg(F.count("*"), F.sum(F.size("_wl_gone"))).first()
    gone = F.broadcast(gone) if 48 * size[0] + 4 * (size[1] or 0) <= BROADCAST_BYTES else gone
    own = docs.withColumn("_wl_hash", F.xxhash64(F.col(text_col).cast("string")))
    j = own.join(gone, (own[id_col] == F.col("_wl_id")) & (F.col("_wl_hash") == F.col("_wl_key")), "left")
    lines = F.split(F.col(text_col).cast("string"), "\n")
    kept = F.array_join(F.transform(F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains("_wl_gone", s["i"])), lambda s: s["x"]), "\n")
    j = j.withColumn("_wl_n", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"))
    j = j.withColumn("_wl_gone", F.coalesce("_wl_gone", F.array().cast("array<int>")))
    return j.withColumn(text_col, F.when(F.size("_wl_gone") > 0, kept).otherwise(F.col(text_col))).select(*docs.columns, "_wl_n", "_wl_gone")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_bytes: int = MIN_BYTES, line_bytes: int | None = None) -> DataFrame:
    """docs with the text shortened, and n_lines, n_removed and removed (line numbers from 0), which replace columns of
    these names."""
    cut = _cut(docs, id_col, text_col, window, min_bytes, line_bytes)
    return cut.withColumns({"n_lines": F.col("_wl_n"), "n_removed": F.size("_wl_gone").cast("long"), "removed": F.col("_wl_gone")}).drop("_wl_n", "_wl_gone")


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_bytes: int = MIN_BYTES, line_bytes: int | None = None) -> DataFrame:
    """docs with repeated runs cut; a document of which nothing but blanks is left goes, one that had nothing stays."""
    cut = _cut(docs, id_col, text_col, window, min_bytes, line_bytes)
    return cut.where((F.size("_wl_gone") == 0) | (F.length(F.trim(F.translate(text_col, "\n\t\r", ""))) > 0)).select(*docs.columns)
