"""All pairs of crowded groups, in tiles of bounded size.

Method: members of one group are ordered by (component, size of set, member) and cut into tiles of at most `docs`
members and about `weight` hashes. Every two tiles of a group meet in a task of their own, unless all their members are
of one component already, or their sizes are so far apart that no set of one can reach the threshold with one of the
other. Where one tile is of a single component, the other sends only its members of other components. A task counts the
common hashes of all its pairs exactly and gives the links between components as a spanning forest, which is all that
components need. No pair of two components that can link is left out; the tile pairs grow as the square of what a group
holds besides its largest component.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit
from .store import materialise

WEIGHT, DOCS, COLUMNS = 1 << 17, 512, 4096


def _common(codes: np.ndarray, doc: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Common codes of each of the rows a with each of the rows b; (doc, codes) are the sets of n rows."""
    row = np.full((2, n), -1)
    row[0, a], row[1, b] = np.arange(len(a)), np.arange(len(b))
    top = int(codes.max()) + 1 if len(codes) else 0
    in_a, in_b = (np.bincount(codes[r[doc] >= 0], minlength=top) for r in row)
    # a code of one row alone is common to no pair
    use = (in_a > 0) & (in_b > 0) & (np.bincount(codes, minlength=top) > 1)
    column = np.cumsum(use) - 1
    own = use[codes]
    doc, at = doc[own], column[codes[own]]
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, int(use.sum()), COLUMNS):
        part = slice(*np.searchsorted(at, (lo, lo + COLUMNS)))
        x = np.zeros((n, COLUMNS), np.float32)
        x[doc[part], at[part] - lo] = 1
        out += x[a] @ x[b].T
    return out.astype(np.int64)


def _forest(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Links (x, y) that connect the same, without circles."""
    up: dict[int, int] = {}

    def root(v):
        while up.setdefault(v, v) != v:
            up[v] = v = up[up[v]]
        return v

    out = []
    for p, q in np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1), axis=0).tolist():
        r, s = root(p), root(q)
        if r != s:
            up[max(r, s)] = min(r, s)
            out.append((p, q))
    return out


def _tile_links(table: pa.Table, threshold: int) -> pa.Table:
    t = table.combine_chunks()
    i, j, tile, c = (t.column(k).to_numpy() for k in ("i", "j", "tile", "c"))
    sets = t.column("set").chunk(0)
    size = np.diff(sets.offsets.to_numpy()).astype(np.int64)
    codes = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
    doc = np.repeat(np.arange(len(size)), size)
    a, b = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    if not len(a) or not len(b):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    both = _common(codes, doc, a, b, len(size))
    hit = (both * 100 >= (size[a][:, None] + size[b][None, :] - both) * threshold) & (c[a][:, None] != c[b][None, :])
    x, y = np.nonzero(hit)
    links = _forest(c[a[x]], c[b[y]])
    return pa.table({"a": pa.array([p for p, _ in links], pa.int64()), "b": pa.array([q for _, q in links], pa.int64())})


def crowd_links(crowd: DataFrame, comp: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: int, weight: int = WEIGHT, docs: int = DOCS) -> DataFrame | None:
    """Links (a, b) between components that join all members (key, rep, n; n is the size of the set) of one group with 100 * intersection >=
    threshold * union. comp has the components found so far, without members that are alone; `sets` gives (rep, set)
    of a table of members. None where no group has two components."""
    named = crowd.join(comp.toDF("rep", "c"), "rep", "left").select("key", "rep", "n", F.coalesce("c", "rep").alias("c"))
    mixed = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    rows = materialise(named.join(mixed, "key"), "crowd")
    if rows.isEmpty():
        return None
    own = materialise(sets(rows.select("rep").distinct()), "crowd_sets")
    step = weight // docs
    cut = F.expr(f"cast((sum(n + {step}) over (partition by key order by c, n, rep) - 1) div {weight} as int)")
    tiles = materialise(rows.withColumn("tile", cut).select("key", "tile", "rep", "c", "n"), "tiles")
    span = tiles.groupBy("key", "tile").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most"))
    x, y = span.toDF("key", "i", "xl", "xh", "xn", "xm"), span.toDF("key", "j", "yl", "yh", "yn", "ym")
    near = f"xm * 100 >= yn * {threshold} AND ym * 100 >= xn * {threshold}"
    meet = x.join(y, "key").where(f"i <= j AND NOT (xl = xh AND yl = yh AND xl = yl) AND {near}")
    # `without`: the one component of the tile that it meets
    side = lambda a, b, l, h: F.struct(F.col(a).alias("tile"), F.when((F.col("i") < F.col("j")) & (F.col(l) == F.col(h)), F.col(l)).alias("without"))
    meet = meet.select("key", "i", "j", F.explode(F.array_distinct(F.array(side("i", "j", "yl", "yh"), side("j", "i", "xl", "xh")))).alias("s")).select(F.col("key").alias("k"), "i", "j", F.col("s.tile").alias("t"), "s.without")
    placed = meet.join(tiles, (F.col("k") == F.col("key")) & (F.col("t") == F.col("tile")) & (F.col("without").isNull() | (F.col("without") != F.col("c"))))
    placed = placed.select("key", "i", "j", "tile", "c", "rep").join(own, "rep").select("key", "i", "j", "tile", "c", "set")

    return placed.groupBy("key", "i", "j").applyInArrow(lambda t: _tile_links(t, threshold), "a long, b long").distinct()
