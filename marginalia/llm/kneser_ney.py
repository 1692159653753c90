"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

Method: 5-grams of UTF-8 bytes are counted over all trusted documents (labels say so), sharded by n-gram; lower orders
count distinct left extensions, and discounts come from the counts of counts of each order. The counts grow with the
text the model is trained on; nothing of them is collected but order 2 (at most 256^2 rows).

Documents are scored by joins too, pre-aggregated by block. A block is the documents of a file split, dealt over as many
parts as its length needs. The distinct 5-grams of each block go, in SHARDS parts by the two bytes before the last, to
the part of the counts with the same two bytes (where there are many blocks, to one of several copies of it). There the
contexts' totals and weights and the probabilities are made, and the surprises come back to the block's texts. So an n-gram is sent once for a block, not once for a document, and every byte
of every document is scored.

A document is rejected when its mean surprise, shrunk towards the trusted mean of its language by `prior` bytes (short
texts say little), is above the language's quantile of the same figure over trusted documents by more than `margin`
nats. Means and quantiles come from one of `FOLDS` parts of the trusted documents (by a hash of the id), which the model
isn't trained on: text that a model has seen surprises it less.

Defined cases: a null or empty text has no surprise and is kept; a language with fewer than `least` trusted documents
held out, or none named, takes the threshold of all that are held out; where those are fewer than `least`, all trusted
documents serve for both; without trusted text nothing is rejected; labels with
null ids or repeated ids count once; repeated documents are separate rows; extra columns stay and are not read; a NUL
byte reads as the mark before a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit
from .store import bounded, by_ids, discard, materialise

QUANTILE, MARGIN, PRIOR, LEAST, FOLDS = 0.99, 0.02, 200, 20, 5
ORDER = 5
#: Bytes of text read at a time; n-grams cost about 40 bytes of memory for each.
SLICE = 1 << 18
#: Bytes of a file that make a block, parts of the n-grams and of the model, and blocks that share a copy of the model.
BLOCK, SHARDS, SHARED = 16 << 20, 64, 256


def grams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The 5-gram that ends at each byte, as 40 bits; before a text stand four zeros."""
    c = data.astype(np.int64)
    at = np.arange(len(c)) - np.repeat(offs[:-1], np.diff(offs))
    out = c.copy()
    for j in range(1, ORDER):
        prev = np.concatenate((np.zeros(min(j, len(c)), np.int64), c[:-j])) if len(c) else c
        out |= np.where(at >= j, prev, 0) << (8 * j)
    return out


def _shard(middle):
    """The part of an n-gram by the two bytes before its last; for arrays and columns alike."""
    if isinstance(middle, np.ndarray):
        return ((middle * 40503) & 65535) * SHARDS >> 16
    return F.shiftright((middle * 40503).bitwiseAND(65535) * SHARDS, 16).cast("int")


def _discounts(n: list[int]) -> list[float]:
    """The discounts of n-grams seen once, twice and more often, from how many are seen 1, 2, 3 and 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    return [min(k, max(0.0, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] and n[k] else 0.5 * k for k in (1, 2, 3)]


def estimates(g: np.ndarray, n: np.ndarray, cuts: list[float]) -> tuple[np.ndarray, ...]:
    """Ascending n-grams of one order and their own part of the probability; their contexts and the weight that each
    gives to the order below. All n-grams of a context must be there."""
    h = g >> 8
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    cut = np.asarray(cuts)[np.minimum(n, 3) - 1]
    total = np.add.reduceat(n, first)
    return g, (n - cut) / np.repeat(total, np.diff(first, append=len(g))), h[first], np.add.reduceat(cut, first) / total


def train(texts: DataFrame) -> tuple[np.ndarray, dict[int, list[float]], DataFrame] | None:
    """The model of (_text): the probabilities of all pairs of bytes, the discounts of the orders above 2, and the counts
    (kind, g, n) of their n-grams: of order 5 how often they occur, of those below how many bytes stand before them."""

    def count(batches):
        for b in batches:
            data, offs = kit.buffers(b.column(0))
            for _, _, d, o in kit.slices(data, offs, SLICE):
                v = pa.array(grams(d, o)).value_counts()
                yield pa.RecordBatch.from_arrays([v.field("values"), v.field("counts")], names=["g", "n"])

    tables = {ORDER: materialise(texts.mapInArrow(kit.tidy(count), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")), "grams")}
    for k in range(ORDER - 1, 1, -1):
        fewer = tables[k + 1].select(F.col("g").bitwiseAND((1 << 8 * k) - 1).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
        tables[k] = materialise(fewer, f"order{k}") if k > 2 else fewer
    pairs = tables[2].toArrow()  # 256^2 rows at most
    if not pairs.num_rows:
        return None
    g2, n2 = (c.to_numpy() for c in pairs.columns)
    g2, n2 = g2[np.argsort(g2)], n2[np.argsort(g2)]
    g1, n1 = np.unique(g2 & 255, return_counts=True)
    low = np.full(256, 1 / 256)
    for k, g, n in ((1, g1, n1), (2, g2, n2)):
        g, own, h, weight = estimates(g, n, _discounts([int((n == j).sum()) for j in (1, 2, 3, 4)]))
        w = np.ones(256 ** (k - 1))
        w[h] = weight
        low = np.outer(w, low).reshape(-1)
        low[g] += own
    model = None
    for k in range(3, ORDER + 1):
        one = tables[k].select(F.lit(k).alias("kind"), "g", "n")
        model = one if model is None else model.unionByName(one)
    seen = {(r.kind, r.n): r["count"] for r in model.where("n <= 4").groupBy("kind", "n").count().collect()}  # 12 rows
    return low, {k: _discounts([seen.get((k, j), 0) for j in (1, 2, 3, 4)]) for k in range(3, ORDER + 1)}, model


def surprises(g: np.ndarray, low: np.ndarray, model: dict[int, tuple[np.ndarray, ...]]) -> np.ndarray:
    """-ln p of 5-grams: of each order the n-gram's own part, and what its context gives to the order below. The model
    has the estimates by order."""

    def find(keys: np.ndarray, values: np.ndarray, x: np.ndarray, other: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        return np.where(keys[at] == x, values[at], other)

    q = low[g & 65535]
    for k, (keys, own, contexts, weights) in sorted(model.items()):
        x = g & ((1 << 8 * k) - 1)
        q = find(keys, own, x, 0.0) + find(contexts, weights, x >> 8, 1.0) * q
    return -np.log(np.maximum(q, 1e-30))


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed."""
    return pa.Codec("zstd").compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T), asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.Codec("zstd").decompress(data, n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).reshape(-1).view(kind)


def _distinct(column: pa.Array) -> np.ndarray:
    data, offs = kit.buffers(column)
    found = [np.unique(grams(d, o)) for _, _, d, o in kit.slices(data, offs, SLICE) if len(d)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _merge(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def _by_block(batch: pa.RecordBatch):
    """(block, its rows) of a batch whose last column is the block."""
    names = batch.column(batch.num_columns - 1).dictionary_encode()
    code = names.indices.to_numpy()
    for k, name in enumerate(names.dictionary.to_pylist()):
        yield name, batch if len(names.dictionary) == 1 else batch.take(pa.array(np.flatnonzero(code == k)))


def block_grams(batches):
    """(_block, shard, n, grams): the distinct n-grams of each block, ascending in each shard, as packed differences.
    The rows of a split are read one after the other, so a block is done when its split doesn't come any more."""
    held: dict[str, list[np.ndarray]] = {}

    def out(block):
        g = _merge(held.pop(block))
        part = _shard((g >> 8) & 65535)
        order = np.argsort(part, kind="stable")
        g, ends = g[order], np.searchsorted(part[order], np.arange(SHARDS + 1))
        rows = [(s, int(hi - lo), _pack(np.diff(g[lo:hi], prepend=0))) for s, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
        return pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["_block", "shard", "n", "grams"])

    for b in batches:
        splits = set()
        for block, rows in _by_block(b):
            splits.add(block.rsplit(":", 1)[0])
            have = held.setdefault(block, [])
            have.append(_distinct(rows.column(0)))
            if len(have) > 8:
                held[block] = [_merge(have)]
        for block in [x for x in held if x.rsplit(":", 1)[0] not in splits]:
            yield out(block)
    for block in list(held):
        yield out(block)


def pack_rows(batches):
    """(_block, rows): the rows of each block as compressed Arrow streams."""
    for b in batches:
        for block, rows in _by_block(b):
            rows = rows.select(range(rows.num_columns - 1))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(rows)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.string()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["_block", "rows"])


def _is_scan(df: DataFrame) -> bool:
    """Whether df is a projection of files alone, so that its rows come from the same splits whenever it is read."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() == "Project":
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation"


def score(docs: DataFrame, low: np.ndarray, cuts: dict[int, list[float]], model: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n (bytes) and total (their surprise) of (keys..., _text), written. A text whose block comes back without the
    surprise of one of its n-grams stops the job."""
    own = docs.select(*keys, "_text")
    rows = own if _is_scan(own) else materialise(own, "texts")
    parts = F.greatest(F.lit(1), F.ceil(F.input_file_block_length() / BLOCK))
    block = F.concat_ws(":", F.input_file_name(), F.input_file_block_start(), F.pmod(F.xxhash64(*keys, "_text"), parts))
    named = rows.withColumn("_block", block)
    copies = 1 + rows.rdd.getNumPartitions() // SHARED
    sent = named.select("_text", "_block").mapInArrow(kit.tidy(block_grams), "_block string, shard int, n int, grams binary").withColumn("copy", F.pmod(F.xxhash64("_block"), F.lit(copies)))
    middle = F.shiftright("g", 8).bitwiseAND(65535)
    dealt = model.select("kind", "g", "n", _shard(middle).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"))
    shared = docs.sparkSession.sparkContext.broadcast((low, cuts))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        low, cuts = shared.value
        kinds, g, n = (right.column(c).to_numpy() for c in ("kind", "g", "n"))
        order = np.lexsort((g, kinds))
        ends = np.searchsorted(kinds[order], np.arange(3, ORDER + 2))
        tables = {k: estimates(g[order[lo:hi]], n[order[lo:hi]], cuts[k]) for k, lo, hi in zip(range(3, ORDER + 1), ends, ends[1:]) if hi > lo}
        back = [_pack(surprises(np.cumsum(_unpack(x, m, np.int64)), low, tables).astype(np.float32)) for x, m in zip(left.column("grams").to_pylist(), left.column("n").to_pylist())]
        kit.give_back()
        return pa.table([left.column("_block"), left.column("shard"), left.column("n"), pa.array(back, pa.binary())], names=["_block", "shard", "n", "found"])

    found = sent.groupBy("shard", "copy").cogroup(dealt.groupBy("shard", "copy")).applyInArrow(look, "_block string, shard int, n int, found binary")
    packed = named.select(*keys, "_text", "_block").mapInArrow(kit.tidy(pack_rows), "_block string, rows binary")
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n long, total double"

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        streams = left.column("rows").to_pylist()
        texts = lambda x: pa.ipc.open_stream(x).read_all().combine_chunks()
        every: list[np.ndarray] = []
        for x in streams:
            every.append(_distinct(texts(x).column("_text")))
            every = [_merge(every)] if len(every) > 8 else every
        g = _merge(every) if every else np.zeros(0, np.int64)
        part, value = _shard((g >> 8) & 65535), np.full(len(g), np.nan, np.float32)
        for s, n, x in zip(*(right.column(c).to_pylist() for c in ("shard", "n", "found"))):
            value[part == s] = _unpack(x, n, np.float32)
        if np.isnan(value).any():
            raise RuntimeError("n-grams of a block were not looked up: its texts are not the same in both readings")
        out = []
        for x in streams:
            t = texts(x)
            data, offs = kit.buffers(t.column("_text"))
            for lo, hi, d, o in kit.slices(data, offs, SLICE):
                n, total = np.diff(o), np.zeros(hi - lo)
                if len(d):
                    seen, at = np.unique(grams(d, o), return_inverse=True)
                    run = np.concatenate(([0.0], np.cumsum(value[np.searchsorted(g, seen)][at], dtype=np.float64)))
                    total = run[o[1:]] - run[o[:-1]]
                out.append(pa.table([*(t.column(k).slice(lo, hi - lo) for k in keys), pa.array(n), pa.array(total)], names=[*keys, "n", "total"]))
        kit.give_back()
        return pa.concat_tables(out)

    scored = materialise(packed.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(add, schema), "scores")
    if rows is not own:
        discard(rows)
    return scored


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN, prior: int = PRIOR, least: int = LEAST) -> DataFrame:
    """(id_col, lang, n_bytes, surprise, perplexity, threshold, rejected), one row for each input row; labels have
    doc_id, quality and toxic, and trusted documents are those of quality 1 that are not toxic."""
    trusted = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_id"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    chosen = by_ids(rows, trusted, "_id", "left_semi")
    apart = F.pmod(F.xxhash64("_id"), F.lit(FOLDS)) == 0
    split = chosen.where(apart & (F.length("_text") > 0)).count() >= least
    model = train((chosen.where(~apart) if split else chosen).select("_text"))
    if model is None:
        return rows.select(F.col("_id").alias(id_col), F.col("_lang").alias("lang"), F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("n_bytes"), *(F.lit(None).cast("double").alias(c) for c in ("surprise", "perplexity", "threshold")), F.lit(False).alias("rejected"))
    scored = score(rows, *model, ["_id", "_lang"])
    held = trusted.where(apart) if split else trusted
    seen = materialise(by_ids(scored, held, "_id", "left_semi").where("n > 0"), "held_out")
    means = bounded(seen.groupBy("_lang").agg(F.count("*").alias("docs"), (F.sum("total") / F.sum("n")).alias("mean")).where((F.col("docs") >= least) & F.col("_lang").isNotNull()).select(F.col("_lang").alias("_l"), "mean"), "means")
    every = seen.agg(F.sum("total") / F.sum("n")).first()[0]

    def shrunk(df: DataFrame) -> DataFrame:
        towards = F.coalesce("mean", F.lit(every))
        return df.join(means, F.col("_lang") == F.col("_l"), "left").withColumn("surprise", F.when(F.col("n") > 0, (F.col("total") + prior * towards) / (F.col("n") + prior))).drop("_l")

    q = lambda: F.percentile_approx("surprise", quantile, 10_000)
    cuts = bounded(shrunk(seen).where("mean IS NOT NULL").groupBy(F.col("_lang").alias("_c")).agg(q().alias("cut")), "cuts")
    default = shrunk(seen).agg(q()).first()[0]
    out = shrunk(scored).join(cuts, F.col("_lang") == F.col("_c"), "left").withColumn("threshold", F.coalesce("cut", F.lit(default)) + margin)
    return out.select(F.col("_id").alias(id_col), F.col("_lang").alias("lang"), F.col("n").alias("n_bytes"), "surprise", F.exp(F.col("total") / F.when(F.col("n") > 0, F.col("n"))).alias("perplexity"), "threshold", F.coalesce(F.col("surprise") > F.col("threshold"), F.lit(False)).alias("rejected"))


def keep_fluent(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """docs without the rejected ones; of rows that repeat an id, all go if one is rejected. Null ids stay."""
    gone = classify(docs, labels, id_col, **how).where("rejected").select(id_col)
    return by_ids(docs, gone, id_col, "left_anti")
