"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialise


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star step over links (u, v), u > v. Large: every larger neighbour of u links to the least vertex near u.
    Small: u and its smaller neighbours link to the least of them."""
    near = (e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e).toDF("u", "v")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    pair = near.join(least, "u")
    if large:
        out = pair.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = pair.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every vertex with a link; component is the least vertex reachable. Null ends and loops
    link nothing; repeated links count once; an empty table gives an empty one. Each round is written to the
    shared folder, so lost executors cost one round; the rounds grow with the log of the longest path."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = materialise(e, "cc")
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(e)
    while seen[0]:
        nxt = materialise(_star(_star(e, True), False), "cc")
        now = mark(nxt)
        discard(e)
        e = nxt
        if now == seen:
            break
        seen = now
    root = e.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(root).groupBy("id").agg(F.min("component").alias("component"))
