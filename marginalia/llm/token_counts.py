"""Token counts of a BPE piece vocabulary without token ids.

Method: a pre-token is a run of spaces (or of the mark that stands for them) with a run of marks or of other characters
behind it, or a run of line feeds and tabs; no piece of the vocabulary crosses such a border (checked when the model is
loaded; where one would, whole texts are the pre-tokens). Pieces are counted once for each distinct pre-token. The
most frequent ones of a hashed sample of about `sample` documents (at most `head`, of at most `head_chars` characters,
so at most head x head_chars x 4 bytes) are counted first, once each, and this table is joined to the
frequencies while a document is read; all other pre-tokens go by an exact way: rows (pre-token, document, frequency)
are shuffled by pre-token, each distinct one is counted once, and the products are summed for each document.

Defined cases: null text counts as empty (0 bytes, 0 tokens); null ids and repeated ids give one row per input row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

SAMPLE, HEAD, HEAD_CHARS, LIMIT = 8000, 300_000, 32, 4096
_SPACE = "▁"


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, sample: int = SAMPLE, head: int = HEAD, head_chars: int = HEAD_CHARS) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit), one row for each input row."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    id_type = dict(texts.dtypes)["_id"]
    model = spark.sparkContext.broadcast(open(model_path, "rb").read())

    def pieces(batches):
        count, _ = _from_bytes(model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count(b.column(0).to_pylist()) if b.num_rows else [], pa.int32())], names=["pre", "pieces"])

    def found(batches):
        _, pat = _from_bytes(model.value)
        seen = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(p for p in pat.findall(" " + t) if len(p) <= head_chars)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pre", "n"])

    share = min(1.0, sample / max(1, docs.count()))
    picked = texts.where(F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000)) < int(share * 1_000_000)).select("_text")
    known = picked.mapInArrow(found, "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(head).select("pre").mapInArrow(pieces, "pre string, pieces int")
    table = spark.sparkContext.broadcast({r[0]: r[1] for r in known.collect()})

    def first_pass(batches):
        _, pat = _from_bytes(model.value)
        known = table.value
        for b in batches:
            ids = b.column(0)
            for lo in range(0, b.num_rows, 256):
                nb, nt, tp, tf = [], [], [], []
                part = b.column(1).slice(lo, 256).to_pylist()
                for t in part:
                    nb.append(len(t.encode()))
                    got = [(known.get(p), p) for p in pat.findall(" " + t)] if t else []
                    nt.append(sum(n for n, _ in got if n is not None))
                    rest: dict[str, int] = {}
                    for n, p in got:
                        if n is None:
                            rest[p] = rest.get(p, 0) + 1
                    tp.append(list(rest))
                    tf.append(list(rest.values()))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(part)), pa.array(nb, pa.int64()), pa.array(nt, pa.int64()), pa.array(tp, pa.list_(pa.string())), pa.array(tf, pa.list_(pa.int32()))], names=["_id", "n_bytes", "n", "pres", "freqs"])

    read = texts.mapInArrow(first_pass, f"_id {id_type}, n_bytes long, n long, pres array<string>, freqs array<int>")
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "pretokens")
    tail = read.select("row", F.explode(F.arrays_zip("pres", "freqs")).alias("z")).select("row", F.col("z.pres").alias("pre"), F.col("z.freqs").alias("f"))
    lexicon = tail.select("pre").distinct().mapInArrow(pieces, "pre string, pieces int")
    rest = tail.join(lexicon, "pre").groupBy("row").agg(F.sum(F.col("f") * F.col("pieces")).alias("rest"))
    n = F.col("n") + F.coalesce("rest", F.lit(0))
    return read.join(rest, "row", "left").select(F.col("_id").alias(id_col), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def pretoken_pattern(pieces: list[str]) -> str:
    """Where no piece of the vocabulary crosses: between white space of lines and all else, between marks and other
    characters, and before spaces that follow something else. The class of marks is ASCII punctuation with all
    characters that share a piece with a member."""
    joint = {a + b for p in pieces for a, b in zip(p, p[1:])}
    if any(b == _SPACE != a for a, b in joint) or any(set(p) & set("\n\t") for p in pieces):
        return r"(?s:.+)"
    marks = {chr(c) for c in range(33, 127) if not chr(c).isalnum()}
    while more := {c for a, b in joint if (a in marks) != (b in marks) for c in (a, b)} - marks - {_SPACE}:
        marks |= more
    m = re.escape("".join(sorted(marks)))
    return f"[ {_SPACE}]*(?:[{m}]+|[^ {_SPACE}\n\t{m}]+)|[\n\t]+|[ {_SPACE}]+"


def _from_bytes(blob: bytes):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    base = len(sp.encode("\n"))

    def count(pretokens: list[str]) -> list[int]:
        """Behind a line feed, which no piece holds, a pre-token has the pieces that it has inside a text."""
        return [len(x) - base for x in sp.encode(["\n" + p for p in pretokens], num_threads=1)]

    pattern = pretoken_pattern(pieces)
    if pattern == r"(?s:.+)":  # whole texts, read with the space put before them
        return lambda texts: [len(x) for x in sp.encode([t[1:] for t in texts], num_threads=1)], re.compile(pattern)
    return count, re.compile(pattern)
