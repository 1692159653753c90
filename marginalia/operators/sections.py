"""Document structure: sections, sentences, clauses, chunks, lab blocks. Arrays on the note row, no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as T

SECTION = "struct<name:string,start:int,end:int,heading_text:string>"
HEADING = r"(?Umd)^[ \t]*(?:[#*\-]+|\d+[.)])?[ \t]*(?:[^\n:]{2,90}):?"


def heading_class(n: Column) -> Column:
    """C1, on a heading's normal form without its bullet and its colon: the first section one of whose names it
    contains."""
    out = F.when(F.lit(False), F.lit(""))
    for name, words in L.SECTIONS.items():
        out = out.when(reduce(Column.__or__, [n.contains(w) for w in words]) & (F.length(n) <= 90), F.lit(name))
    return out


def with_sections(notes: DataFrame) -> DataFrame:
    """Column `sections`, array<struct<name,start,end,heading_text>>: from each heading to the next; text before the
    first is `unknown`, so is a text without headings. In steps, so that no step is computed more than once."""
    raw = F.col("raw_text")
    bare = lambda x: F.substring_index(F.regexp_replace(x, r"(?U)^\s*(?:[#*\-]+|\d+[.)])\s*", ""), ":", 1)
    strip = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")
    rows = notes.withColumn("_m", T.hits(raw, HEADING))
    rows = rows.withColumn("_m", F.transform("_m", lambda h: F.struct(h["start"].alias("start"), strip(T.cut(raw, h["start"], h["end"])).alias("line"))))
    rows = rows.withColumn("_m", F.transform("_m", lambda h: F.struct(h["start"].alias("start"), h["line"].alias("line"), T.norm(bare(h["line"])).alias("n"))))
    rows = rows.withColumn("_m", F.filter(F.transform("_m", lambda h: F.struct(h["start"].alias("start"), h["line"].alias("line"), heading_class(h["n"]).alias("name"))), lambda h: h["name"].isNotNull()))
    rows = rows.withColumns({"_e": F.concat(F.slice(F.col("_m.start"), 2, F.greatest(F.size("_m"), F.lit(1))), F.array(F.length(raw))), "_b": F.coalesce(F.get("_m", F.lit(0))["start"], F.length(raw))})
    named = F.zip_with("_m", F.slice("_e", 1, F.size("_m")), lambda h, e: F.struct(h["name"].alias("name"), h["start"].alias("start"), e.alias("end"), h["line"].alias("heading_text")))
    lead = F.struct(F.lit("unknown").alias("name"), F.lit(0).alias("start"), F.col("_b").alias("end"), F.lit("").alias("heading_text"))
    whole = F.when((F.size("_m") == 0) | (F.col("_b") > 0), F.concat(F.array(lead), named)).otherwise(named)
    return rows.withColumn("sections", whole.cast(f"array<{SECTION}>")).drop("_m", "_e", "_b")


def section_of(secs: Column, start: Column, end: Column) -> Column:
    """The section with the largest overlap, the earliest of equal ones, `unknown` without any."""
    over = F.transform(secs, lambda s, i: F.struct(F.greatest(F.lit(0), F.least(s["end"], end) - F.greatest(s["start"], start)).alias("n"), (-i).alias("i"), s["name"].alias("name")))
    best = F.array_max(over)
    return F.when(best["n"] > 0, best["name"]).otherwise(F.lit("unknown"))


def sentences(raw: Column) -> Column:
    """C4: array<struct<start,end>> of the trimmed text between runs of full stops and line feeds."""
    return T.hits(raw, r"(?U)[^.\n\s](?:[^.\n]*[^.\n\s])?")


def sentence_window(raw: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """(left context of at most 80 characters, sentence); the sentence begins with the stop before it."""
    prefix, suffix = F.substring(raw, 1, start), F.substring(raw, end + 1, F.length(raw))
    left = F.regexp_extract(prefix, r"(?s)(?:[.\n])?[^.\n]*\z", 0)
    right = F.regexp_extract(suffix, r"^[^.\n]*", 0)
    return F.when(F.length(left) > 80, F.substring(left, -80, 80)).otherwise(left), F.concat(left, T.cut(raw, start, end), right)


def clause_window(raw: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """(left part, clause) between . ; : line feed ! ?"""
    left = F.regexp_extract(F.substring(raw, 1, start), r"[^.;:\n!?]*\z", 0)
    right = F.regexp_extract(F.substring(raw, end + 1, F.length(raw)), r"^[^.;:\n!?]*", 0)
    return left, F.concat(left, T.cut(raw, start, end), right)


def context_window(raw: Column, start: Column, end: Column, size: int = 120) -> Column:
    """C7."""
    a = F.greatest(start - size, F.lit(0))
    return T.cut(raw, a, F.least(F.length(raw), end + size))


def marked_context(raw: Column, start: Column, end: Column, size: int = 180) -> Column:
    """C7 with the mention marked, the input of assertion classifiers."""
    a, b = F.greatest(start - size, F.lit(0)), F.least(F.length(raw), end + size)
    return F.concat(T.cut(raw, a, start), F.lit(" [MENTION] "), T.cut(raw, start, end), F.lit(" [/MENTION] "), T.cut(raw, end, b))


def chunks(notes: DataFrame, size: int = 320, overlap: int = 48) -> DataFrame:
    """(record_id, chunk_ord, start, text). A chunk of `size` characters that doesn't reach the end is cut before the
    last line feed or behind the last blank of its second half, where there is one (sentence and clause ends, a mark and
    a blank, never lie behind that). The next one begins `overlap` characters before the cut, or further left behind the
    nearest white space, but behind the start of this one; without any, at the cut. Where a chunk begins depends on the
    one before: an Arrow iterator, a note at a time."""
    import pandas as pd

    size = max(80, size)
    overlap = min(max(0, overlap), size // 3)

    def pieces(text: str):
        at, n = 0, len(text)
        while at < n:
            stop = min(n, at + size)
            if stop < n:
                feed, blank = (text.rfind(mark, at + size // 2, stop) for mark in "\n ")
                stop = stop if max(feed, blank) < 0 else max(feed, blank + 1)
            yield at, text[at:stop]
            if stop >= n:
                return
            back = max(at + 1, stop - overlap)
            at = next((k for k in range(back, at, -1) if text[k - 1].isspace()), stop)

    def run(frames):
        for f in frames:
            out = [(r, i, a, t) for r, raw in zip(f["record_id"], f["raw_text"]) if raw for i, (a, t) in enumerate(pieces(raw))]
            yield pd.DataFrame(out, columns=["record_id", "chunk_ord", "start", "text"])

    kind = dict(notes.dtypes)["record_id"]
    return notes.select("record_id", "raw_text").mapInPandas(run, f"record_id {kind}, chunk_ord int, start int, text string")


def lines(notes: DataFrame) -> DataFrame:
    """(record_id, line_ord, start, line): lines of each note with offsets."""
    arr = F.split("raw_text", "\n", -1)
    begin = F.aggregate(F.slice(arr, 1, F.col("line_ord")), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return notes.where("raw_text IS NOT NULL").select("record_id", arr.alias("_l"), "raw_text").select("record_id", F.posexplode("_l").alias("line_ord", "line"), "raw_text").select("record_id", "line_ord", begin.alias("start"), "line")


def lab_lines(raw: Column) -> Column:
    """array<struct<start,line>> of the lines inside lab blocks. The latest opening or closing heading decides, so
    the state of a line is a running fold over the lines; opening headings themselves are skipped."""
    starts = lambda key, heads: reduce(Column.__or__, [key.startswith(h) for h in heads])
    keyed = F.transform(F.split(raw, "\n", -1), lambda line: F.struct(line.alias("line"), T.folded(F.btrim(line, F.lit(" -*\t:"))).alias("key")))
    first = F.struct(F.lit(0).alias("at"), F.lit(False).alias("on"), F.array().cast("array<struct<start:int,line:string>>").alias("out"))

    def step(acc, x):
        line, opened = x["line"], starts(x["key"], L.LAB_BLOCK_OPEN)
        on = F.when(opened, True).when(starts(x["key"], L.LAB_BLOCK_CLOSE), False).otherwise(acc["on"])
        take = on & ~opened & (F.length(T.squeeze(line)) > 0)
        return F.struct((acc["at"] + F.length(line) + 1).alias("at"), on.alias("on"), F.when(take, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), line.alias("line"))))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(keyed, first, step, lambda a: a["out"])


def lab_lines_by_window(notes: DataFrame) -> DataFrame:
    """C9 over rows, for notes too long for one fold: the last marker before each line, by a window in the note."""
    key = T.folded(F.btrim("line", F.lit(" -*\t:")))
    starts = lambda heads: F.exists(F.array(*[F.lit(h) for h in heads]), lambda h: F.col("key").startswith(h))
    li = lines(notes).withColumn("key", key).withColumn("mark", F.when(starts(L.LAB_BLOCK_OPEN), "open").when(starts(L.LAB_BLOCK_CLOSE), "close"))
    w = Window.partitionBy("record_id").orderBy("line_ord")
    on = F.last("mark", ignorenulls=True).over(w) == "open"
    return li.withColumn("on", on).where("on AND coalesce(mark, '') <> 'open'").where(F.length(T.squeeze(F.col("line"))) > 0).select("record_id", "line_ord", "start", "line")


def in_lab_block(raw: Column, start: Column, back: int = 1200) -> Column:
    """The last lab heading in the text before is later than the last other heading."""
    a = F.greatest(start - back, F.lit(0))
    lab = ["ket qua xet nghiem", "xet nghiem can lam sang", "laboratory results"]
    other = ["ket qua chan doan hinh anh", "chan doan hinh anh", "chan doan", "danh gia", "dieu tri", "thuoc", "ke hoach"]

    def later(before: Column, back_to_front: Column) -> Column:
        last = lambda words: F.greatest(*[F.when(F.instr(before, w) > 0, F.length(before) - F.instr(back_to_front, w[::-1]) - len(w) + 1).otherwise(-1) for w in words])
        return T.let(last(lab), lambda n: (n >= 0) & (n > last(other)))

    return T.let(T.cut(raw, a, start), lambda near: T.let(T.folded(near), lambda before: T.let(F.reverse(before), lambda r: later(before, r))))
