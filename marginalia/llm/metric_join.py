"""Exact metric range join of embeddings: all pairs with cosine >= threshold.

Method: unit vectors lie in Euclidean space, where cosine >= t is distance <= eps = sqrt(2 - 2t). Pivots (a hashed
sample; their number follows the number of vectors, up to `max_pivots`) partition the vectors by the nearest one.
A vector is replicated to another cell only if the triangle inequality lets a vector of that cell lie within eps:
its distance to the cell's pivot exceeds that to its own by at most 2 eps, and exceeds the cell's radius by at most
eps. Each cell then joins its own vectors with all that reached it, without the others; so each vector finds all its
links in its own cell. A cell with many vectors is split into tiles of at most `tile` x `tile`, so that no task
holds an unbounded cell. The test of a pair is the cosine in double precision.

Defined cases: null, zero, non-finite and empty vectors link with nothing (n_links 0, own component); so do vectors of
another dimension than the pivots' majority, compared only among themselves by their own dimension's pivots; equal
vectors are one class and are not expanded; a null id gives a null component and is kept; repeated ids count as
separate vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import materialise

TILE, MAX_PIVOTS, SEED = 4096, 4096, 29
_SLACK = 1e-7  # of distances: rounding of sqrt(2 - 2 u.v) near zero


def _matrix(column) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1)


def range_join(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, tile: int = TILE, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row for each input row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(vec_col) if dict(vectors.dtypes)[vec_col] == "array<float>" else F.col(vec_col).cast("array<double>")).alias("v"))
    fit = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = materialise(rows.select("id", F.when(fit, F.col("v")).alias("v")), "vectors")
    good = rows.where("v IS NOT NULL AND id IS NOT NULL")
    classes = materialise(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.countDistinct("id").alias("ids")), "classes")
    parts = []
    for (dim,) in classes.select(F.size("v").alias("d")).distinct().orderBy("d").collect():
        parts.append(_links(spark, classes.where(F.size("v") == dim).select("rep", "copies", "v"), threshold, tile, max_pivots))
    out = parts[0] if parts else spark.createDataFrame([], "rep long, n long, root long")
    for x in parts[1:]:
        out = out.union(x)
    out = materialise(out, "links")
    counts = out.groupBy("rep").agg(F.sum("n").alias("n"))
    comp = components(out.where("rep <> root"), "rep", "root")
    told = classes.select("v", "rep", "copies").join(counts, "rep", "left").join(comp.toDF("rep", "c"), "rep", "left")
    told = told.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "rep").alias("c"))
    res = rows.join(told, "v", "left")
    ok = F.col("id").isNotNull()
    c = F.when(ok, F.coalesce("c", "id"))
    return res.select(F.col("id").alias(id_col), F.when(ok, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"), c.alias("component_id"), F.coalesce(c == F.col("id"), F.lit(True)).alias("kept"))


def _links(spark, classes: DataFrame, threshold: float, tile: int, max_pivots: int) -> DataFrame:
    """(rep, n, root): links of each class within one tile, and the least class it is connected with there."""
    kind = dict(classes.dtypes)["v"]
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    total = classes.count()
    wanted = min(max_pivots, -(-total // tile))
    share = min(1.0, 4 * wanted / total)
    picked = classes.select("v", F.xxhash64("rep", F.lit(SEED)).alias("h")).where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 64).orderBy("h").limit(wanted).select("v").collect()
    pivots = np.array([r[0] for r in picked] or [classes.select("v").first()[0]], np.float64)
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]

    def distances(x):
        u = x / np.linalg.norm(x, axis=1)[:, None]
        return np.sqrt(np.maximum(0, 2 - 2 * u @ pivots.T))

    def home(batches):
        for b in batches:
            if b.num_rows:
                d = distances(_matrix(b.column(2)))
                c = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(c.astype(np.int32)), pa.array(d[np.arange(len(c)), c])], names=["rep", "copies", "v", "cell", "far"])

    homes = materialise(classes.mapInArrow(home, f"rep long, copies long, v {kind}, cell int, far double"), "homes")
    stat = {r[0]: (r[1], r[2]) for r in homes.groupBy("cell").agg(F.count("*"), F.max("far")).collect()}
    radius = np.array([stat.get(i, (0, -np.inf))[1] for i in range(len(pivots))])
    blocks = np.array([-(-stat.get(i, (0, 0))[0] // tile) for i in range(len(pivots))])

    def reached(x, own):
        """Which cells each vector can have a neighbour in, its own included."""
        d = distances(x)
        at = np.arange(len(d))
        near = (blocks > 0) & (d <= d[at, own][:, None] + 2 * eps + _SLACK) & (d <= radius + eps + _SLACK)
        near[at, own] = True
        return near

    def tally(batches):
        n = np.zeros(len(pivots), np.int64)
        for b in batches:
            x, own = _matrix(b.column(2)), b.column(3).to_numpy()
            for lo in range(0, len(x), 1024):
                n += reached(x[lo : lo + 1024], own[lo : lo + 1024]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], names=["cell", "n"])

    seen = dict(homes.mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect())
    spans = np.array([max(1, -(-seen.get(i, 0) // (4 * tile))) for i in range(len(pivots))])

    def send(batches):
        """Each vector as a row to every column block of its own row block, and as a column to its column block of
        every row block of each cell it reaches."""
        for b in batches:
            x, rep, own = _matrix(b.column(2)), b.column(0).to_numpy(), b.column(3).to_numpy()
            h = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34)).astype(np.int64)
            for lo in range(0, len(x), 1024):
                o, hh = own[lo : lo + 1024], h[lo : lo + 1024]
                at, cell = np.nonzero(reached(x[lo : lo + 1024], o))
                n = blocks[cell]
                part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at, cell = np.repeat(at, n), np.repeat(cell, n)
                m = spans[o]
                row = np.repeat(np.arange(len(o)), m)
                span = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                out = [np.concatenate(z) for z in ((cell, o[row]), (part, (hh // 64 % blocks[o])[row]), (hh[at] % spans[cell], span), (at, row))]
                is_row = np.concatenate((np.zeros(len(at), bool), np.ones(len(row), bool)))
                idx = pa.array(out[3] + lo)
                yield pa.RecordBatch.from_arrays([*(pa.array(z.astype(np.int32)) for z in out[:3]), pa.array(is_row), b.column(0).take(idx), b.column(1).take(idx), b.column(2).take(idx)], names=["cell", "rb", "cb", "is_row", "rep", "copies", "v"])

    def join(key, table):
        is_row = table["is_row"].to_numpy()
        rep, copies, x = table["rep"].to_numpy(), table["copies"].to_numpy(), _matrix(table["v"])
        norm = np.linalg.norm(x, axis=1)
        r, c = np.flatnonzero(is_row), np.flatnonzero(~is_row)
        r, c = r[np.argsort(rep[r])], c[np.argsort(rep[c])]
        out_rep, out_n, out_root = [], [], []
        if len(r) and len(c):
            nodes = np.unique(rep)
            root, ci, ri = np.arange(len(nodes)), np.searchsorted(nodes, rep[c]), np.searchsorted(nodes, rep[r])
            y, yn = x[c], norm[c]
            count = np.zeros(len(r), np.int64)
            for lo in range(0, len(r), 256):
                rr = r[lo : lo + 256]
                hit = (x[rr] @ y.T) / (norm[rr][:, None] * yn[None, :]) >= threshold
                hit &= ci[None, :] != ri[lo : lo + 256][:, None]
                count[lo : lo + 256] = hit @ copies[c]
                some = hit.any(axis=1)
                for a in np.flatnonzero(some):
                    links = ci[np.flatnonzero(hit[a])]
                    both = np.append(links, ri[lo + a])
                    tops = root[both]
                    while (root[tops] != tops).any():
                        tops = root[tops]
                    low = tops.min()
                    root[tops] = low
                    root[both] = low
            while (root[root] != root).any():
                root = root[root]
            used = np.zeros(len(nodes), bool)
            used[ri[count > 0]] = True
            # a column that is linked shares its row's root
            moved = (root != np.arange(len(nodes))) | used
            n_of = np.zeros(len(nodes), np.int64)
            n_of[ri] = count
            keep = np.flatnonzero(moved)
            out_rep, out_n, out_root = nodes[keep], n_of[keep], nodes[root[keep]]
        return pa.table({"rep": pa.array(out_rep, pa.int64()), "n": pa.array(out_n, pa.int64()), "root": pa.array(out_root, pa.int64())})

    sent = homes.mapInArrow(send, f"cell int, rb int, cb int, is_row boolean, rep long, copies long, v {kind}")
    return sent.groupBy("cell", "rb", "cb").applyInArrow(join, "rep long, n long, root long")
