"""MinHash near-duplicates by an LSH forest, links confirmed on full shingle sets.

Method: every distinct shingle set gets `trees` x 4 MinHash values. A tree sorts the sets by its own order of the
values; sets that share a prefix of 4 values form a region. A region of up to `small` sets compares all of them; a
larger one compares each set with its first and descends to prefixes of 6, then 8 values, which connects most of it at
little cost. Pairs whose MinHash agreement is under `screen` (six standard deviations below the threshold) go; all
others are confirmed exactly. Then all pairs of a crowded region that are not connected yet are compared exactly, in
tiles of bounded size. So regions of any size compare all of their sets, and a pair at the threshold is compared with
probability 1 - (1 - 0.8^4)^24 = 0.999997.

Defined cases: a null or wordless text has no shingles and links with nothing; equal sets are one class, named by a
64-bit hash of the set, and are not expanded into pairs; a null id gives a null component and is kept; repeated ids give
one row per input row: equal texts the same answer, other texts that of their own set; a component is named by the least
id that any of its texts has; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit
from .components import components
from .store import by_ids, discard, materialise
from .tiles import crowd_links

TREES, SMALL, SCREEN, SEED = 24, 32, 0.55, 17


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))


def signatures(docs: DataFrame, k: int, hashes: int, seed: int = SEED, inside: np.ndarray = kit.NONSPACE) -> DataFrame:
    """(_id, n, k1, sig) from (_id, _text): size of the set of k-word shingles (A-Z lowered), a 64-bit sum that names
    the set, and the MinHash values as little-endian 32-bit integers."""

    def run(batches):
        powers, seeds = kit.Powers(), kit.seeds(hashes, seed)
        for batch in batches:
            data, offs = kit.buffers(batch.column(1))
            for lo, hi, d, o in kit.slices(data, offs):
                d = kit.LOWER[d]
                start, end, first = kit.words(d, o, inside)
                h, hf = kit.distinct_by_text(*kit.shingles(kit.span_hashes(d, start, end, powers), first, k))
                sig = kit.minhash(h, hf, seeds)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * hashes), hi - lo, [None, pa.py_buffer(sig.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(hf)), pa.array(kit.set_sums(h, hf, 0x51)), flat.cast(pa.binary())], names=["_id", "n", "k1", "sig"])

    return docs.mapInArrow(kit.tidy(run), "_id long, n long, k1 long, sig binary")


def shingle_sets(docs: DataFrame, k: int, inside: np.ndarray = kit.NONSPACE) -> DataFrame:
    """(rep, set array<long>) of the distinct shingle hashes and their sum k1 of signatures()."""

    def run(batches):
        powers = kit.Powers()
        for batch in batches:
            data, offs = kit.buffers(batch.column(1))
            for _, _, d, o in kit.slices(data, offs):
                d = kit.LOWER[d]
                start, end, first = kit.words(d, o, inside)
                h, hf = kit.distinct_by_text(*kit.shingles(kit.span_hashes(d, start, end, powers), first, k))
                yield pa.RecordBatch.from_arrays([pa.array(kit.set_sums(h, hf, 0x51)), pa.ListArray.from_arrays(pa.array(hf.astype(np.int32)), pa.array(kit.signed(h)))], names=["rep", "set"])

    return docs.mapInArrow(kit.tidy(run), "rep long, set array<long>")


def _orders(trees: int) -> np.ndarray:
    """For each tree the eight values that its order looks at: four of its own, then four drawn from the others."""
    others = [np.random.RandomState(1000 + t).permutation(np.delete(np.arange(4 * trees), range(4 * t, 4 * t + 4)))[:4] for t in range(trees)]
    return np.stack([np.concatenate((np.arange(4 * t, 4 * t + 4), o)) for t, o in enumerate(others)])


def _prefixes(values: np.ndarray, trees: np.ndarray, depths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of the first `depths` values of each row, the tree's number hashed in."""
    acc, out = kit.mix(trees.astype(np.uint64) + np.uint64(1)), []
    with np.errstate(over="ignore"):
        for i in range(max(depths)):
            acc = kit.mix(acc * np.uint64(0x2545F4914F6CDD1D) + values[..., i])
            if i + 1 in depths:
                out.append(acc.reshape(-1).view(np.int64))
    return out


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1).astype(np.uint64)


def tree_labels(reps: DataFrame, trees: int) -> DataFrame:
    """(rep, n, tree, p4) of (rep, sig, n): for each tree the hash of its first four values."""

    def run(batches):
        order = _orders(trees)[:, :4]
        for batch in batches:
            n = batch.num_rows
            if n:
                (p4,) = _prefixes(_signatures(batch.column(1))[:, order], np.broadcast_to(np.arange(trees), (n, trees)), (4,))
                rep, size = (pa.array(np.repeat(batch.column(i).to_numpy(zero_copy_only=False), trees)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([rep, size, pa.array(np.tile(np.arange(trees, dtype=np.int8), n)), pa.array(p4)], names=["rep", "n", "tree", "p4"])

    return reps.mapInArrow(kit.tidy(run), "rep long, n long, tree byte, p4 long")


def deeper_labels(rows: DataFrame, reps: DataFrame, trees: int) -> DataFrame:
    """(rep, p6, p8) of rows (rep, tree) in crowded regions."""

    def run(batches):
        order = _orders(trees)
        for batch in batches:
            if batch.num_rows:
                tree = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                values = np.take_along_axis(_signatures(batch.column(2)), order[tree], axis=1)
                p6, p8 = _prefixes(values, tree, (6, 8))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p6), pa.array(p8)], names=["rep", "p6", "p8"])

    return rows.join(reps.select("rep", "sig"), "rep").select("rep", "tree", "sig").mapInArrow(kit.tidy(run), "rep long, p6 long, p8 long")


def _regions(rows: DataFrame, key: str, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the regions with one key: all pairs of the small ones, first-to-each pairs of the large, rows of the large.
    The rows are dealt by key once; sizes and members come from that one shuffle."""
    dealt = rows.repartition(key)
    size = dealt.groupBy(key).agg(F.count("*").alias("held"), F.min("rep").alias("hub")).where("held > 1")
    own = materialise(dealt.join(size, key), "regions")  # what shares a prefix at all: read several times below
    few = own.where(F.col("held") <= small).groupBy(key).agg(F.sort_array(F.collect_list("rep")).alias("m"))
    pairs = few.select(F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> named_struct('a', x, 'b', y))))")).alias("p")).select("p.a", "p.b")
    big = own.where(F.col("held") > small)
    return pairs, big.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")), big.select(*rows.columns)


def _full_sets(texts: DataFrame, reps: DataFrame, need: DataFrame, k: int) -> DataFrame:
    """(rep, set) of the classes in the one-column table `need`: one text of each is read again. Other texts that share
    its id give sets that nothing asks for."""
    ids = reps.select("rep", "first").join(need.toDF("rep"), "rep", "left_semi").select("first")
    return shingle_sets(by_ids(texts, ids, "_id", "left_semi"), k).dropDuplicates(["rep"])


def verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, k: int, threshold: int, screen: float) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= threshold * union of their full sets."""
    sig = reps.select("rep", "sig")

    def agree(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3)) if batch.num_rows else (np.zeros((0, 1)),) * 2
            keep = np.flatnonzero((x == y).mean(axis=1) >= screen) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep))], names=["a", "b"])

    seen = pairs.distinct().join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
    cand = materialise(seen.select("a", "b", "sa", "sb").mapInArrow(kit.tidy(agree), "a long, b long"), "candidates")
    sets = materialise(_full_sets(texts, reps, cand.select(F.explode(F.array("a", "b"))), k), "sets")
    both = cand.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    inter = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", inter.alias("i"), (F.size("x") + F.size("y") - inter).alias("u")).where(F.col("i") * 100 >= F.col("u") * threshold).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, threshold: int = 80, trees: int = TREES, small: int = SMALL, screen: float = SCREEN) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row for each input row."""
    texts = _texts(docs, id_col, text_col)
    sigs = materialise(signatures(texts, k, 4 * trees), "signatures")
    full = sigs.where("n > 0 AND _id IS NOT NULL")
    # a set has one signature, whichever of its texts it is taken from
    reps = materialise(full.groupBy(F.col("k1").alias("rep")).agg(F.min("_id").alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    labels = materialise(tree_labels(reps.select("rep", "sig", "n"), trees), "labels")
    p4, h4, r4 = _regions(labels, "p4", small)
    discard(labels)
    p6, h6, r6 = _regions(deeper_labels(r4, reps, trees), "p6", small)
    p8, h8, _ = _regions(r6, "p8", small)
    pairs = p4
    for x in (h4, p6, h6, p8, h8):
        pairs = pairs.union(x)
    links = materialise(verified(pairs, reps, texts, k, threshold, screen), "links")
    comp = materialise(components(links, "a", "b"), "components")
    # what is still apart in a crowded region: all its pairs, on full sets
    more = crowd_links(r4.select(F.col("p4").alias("key"), "rep", "n"), comp, lambda need: _full_sets(texts, reps, need, k), threshold)
    if more is not None:
        links = links.union(materialise(more, "links"))
        comp = materialise(components(links, "a", "b"), "components")
    led = reps.select("rep", "first").join(comp.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    heads = led.groupBy("c").agg(F.min("first").alias("head"))
    led = led.join(heads, "c").select(F.col("rep").alias("k1"), F.col("head").alias("c"))
    # texts without shingles, however many, meet nothing and are dealt by their id
    out = sigs.select("_id", "n", F.when(F.col("n") > 0, F.col("k1")).otherwise(F.xxhash64("_id")).alias("k1")).join(led, "k1", "left")
    c = F.when(F.col("_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("c")), F.col("_id")))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), c.alias("component_id"), F.coalesce(c == F.col("_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80) -> DataFrame:
    """docs without the rows whose component has a smaller id; of rows that repeat an id, all stay or all go."""
    gone = near_duplicates(docs, id_col, text_col, k, threshold).where("NOT kept").select(id_col)
    return by_ids(docs, gone, id_col, "left_anti")
