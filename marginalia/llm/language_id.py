"""Language identification by cross-parsing entropy.

Method: a bounded sample of labelled text per language (`docs_per_language` documents found by hash, `sample_bytes` in
all; less where the transition tables of all languages would pass `table_bytes`) is made into a suffix automaton over
64 byte classes (case folded). A text is parsed into the longest matches with each language's sample; the language
that needs the fewest phrases, each weighed by the log of its sample's length, per byte wins. Texts are parsed whole,
in blocks of 512 bytes that phrases do not cross, all blocks of a batch in step. `score` is 1 - best / second.

Defined cases: null text and text without a letter give `und` and score 0, so does a table without labelled rows;
ties go to the first language in code-point order; with one language learned it always wins with score 1; a null id is
never learned from and not held out; repeated ids are separate rows; an empty table gives an empty result; `lang` and
all other columns are never read for a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

SAMPLE_BYTES, DOCS, TABLE_BYTES, BLOCK, CLASSES = 32_768, 64, 96 << 20, 512, 64


def byte_classes() -> np.ndarray:
    """0 pads; 1-26 letters, 27 white space, 28 digits, 29 other ASCII, 30-61 continuation bytes (bit 5 dropped, which
    folds Latin-1 case), 62-63 lead bytes."""
    b = np.arange(256)
    out = np.full(256, 29)
    out[65:91] = out[97:123] = np.arange(1, 27)
    out[[9, 10, 11, 12, 13, 32]] = 27
    out[48:58] = 28
    out[128:192] = 30 + (b[128:192] & 31)
    out[192:] = 62 + (b[192:] >= 224)
    return out.astype(np.uint8)


def suffix_automaton(codes: list[int]) -> list[tuple[int, int, int]]:
    """Transitions (state, class, next state) of the automaton that accepts every substring; state 0 is its start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return [(s, c, t) for s, d in enumerate(nexts) for c, t in d.items()]


def parse_table(transitions: np.ndarray) -> np.ndarray:
    """Entry state x 64 + class: the next state x 64, plus 1 where the match ends and the next phrase begins."""
    n = int(transitions[:, [0, 2]].max()) + 1 if len(transitions) else 1
    t = np.full((n, CLASSES), -1, np.int32)
    t[transitions[:, 0], transitions[:, 1]] = transitions[:, 2] * CLASSES
    # every way out of the start begins a phrase; a class that the sample lacks is one of its own and leads back there
    out = np.where(t >= 0, t, np.where(t[0] >= 0, t[0], 0)[None, :] + 1)
    out[0] = np.where(t[0] >= 0, t[0], 0) + 1
    out[:, 0] = 0
    return out.reshape(-1)


def phrases(codes: np.ndarray, offs: np.ndarray, tables: list[np.ndarray], block: int = BLOCK) -> np.ndarray:
    """(texts, languages): phrases of each text."""
    n = np.diff(offs)
    parts = -(-n // block)
    doc = np.repeat(np.arange(len(n)), parts)
    begin = offs[:-1][doc] + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * block
    end = np.minimum(begin + block, offs[1:][doc])
    out = np.zeros((len(n), len(tables)), np.int64)
    if not len(doc):
        return out
    order = np.argsort(begin - end, kind="stable")  # full blocks first: a step works on those that still run
    begin, end, doc = begin[order], end[order], doc[order]
    size = end - begin
    alive = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    count = np.zeros((len(tables), len(doc)), np.int64)
    state = np.zeros((len(tables), len(doc)), np.int32)
    for t in range(int(size[0])):
        k = alive[t]
        c = codes[begin[:k] + t]
        for i, table in enumerate(tables):
            v = table[state[i, :k] + c]
            f = v & 1
            count[i, :k] += f
            state[i, :k] = v - f
    for i in range(len(tables)):
        out[:, i] = np.bincount(doc, weights=count[i], minlength=len(n)).astype(np.int64)
    return out


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_bytes: int, docs_per_language: int, table_bytes: int, learnable) -> dict[str, tuple[int, np.ndarray]]:
    """Language -> (bytes of its sample, transitions). The driver gets docs_per_language texts a language."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text")).where(learnable & F.col("_lang").isNotNull() & F.col("_text").rlike("\\p{L}"))
    salt = F.pmod(F.xxhash64("_id"), F.lit(docs_per_language))
    found = rows.groupBy("_lang", salt.alias("s")).agg(F.min(F.struct(F.xxhash64("_id", F.lit(1)).alias("h"), "_id")).alias("m")).select("_lang", F.col("m._id").alias("_id"))
    ids = [r[0] for r in found.select("_id").collect()]
    if not ids:
        return {}
    each = max(1, sample_bytes // docs_per_language)
    picked = rows.where(F.col("_id").isin(ids)).select("_lang", "_id", F.substring("_text", 1, 4 * each).alias("t")).collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(picked, key=lambda r: (r[0], str(r[1]), r[2])):
        texts.setdefault(r[0], []).append(r[2].encode())
    size = max(256, min(sample_bytes, table_bytes // (len(texts) * 2 * CLASSES * 4)))
    lut, out = byte_classes(), {}
    for lang, parts in sorted(texts.items()):
        share = max(1, size // len(parts))
        # what short documents leave goes to the longer ones
        while sum(min(len(p), share) for p in parts) < size and share < max(map(len, parts)):
            share *= 2
        joined = b"\n".join(p[:share] for p in parts)[:size]
        codes = lut[np.frombuffer(joined, np.uint8)]
        out[lang] = (len(codes), np.array(suffix_automaton(codes.tolist()), np.int32))
    return out


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES, docs_per_language: int = DOCS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(id_col, held_out, lang_pred, score), one row for each input row."""
    fold = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5))
    model = learn(docs, id_col, text_col, lang_col, sample_bytes, docs_per_language, table_bytes, fold(F.col("_id")) != 0)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.when(F.col(text_col).cast("string").rlike("\\p{L}"), F.col(text_col).cast("string")).alias("_text"))
    if not model:
        return rows.select(F.col("_id").alias(id_col), "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs = list(shared.value)
        tables = [parse_table(t) for _, t in shared.value.values()]
        bits = np.log2(np.array([max(2, n) for n, _ in shared.value.values()]))
        lut, names = byte_classes().astype(np.int32), np.array([*langs, "und"], object)
        for b in batches:
            data, offs = kit.buffers(b.column(2))
            for lo, hi, d, o in kit.slices(data, offs, 4 << 20):
                cost = phrases(lut[d], o, tables) * bits
                best = cost.argmin(axis=1)
                low = cost[np.arange(len(cost)), best]
                rest = cost.copy()
                rest[np.arange(len(cost)), best] = np.inf
                score = 1 - low / rest.min(axis=1) if len(langs) > 1 else np.ones(len(cost))
                none = np.diff(o) == 0
                best[none], score = len(langs), np.where(none, 0.0, np.clip(score, 0, 1))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score)], names=["_id", "held_out", "lang_pred", "score"])

    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(run, f"_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("_id", id_col)
