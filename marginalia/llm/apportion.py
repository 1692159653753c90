"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks. DataFrame functions only.

Method: sources in code-point order (null last) take the weights in turn. Together they get `share` of all words, a
target stopping at `cap` times its source's size and the excess going to the others by weight until none is above.
Each source is dealt into shards by a seeded hash, so many that a shard holds about `shard_words`; blocks of
`block_words` words are then given to the shards by highest quotients target / (2 seats + 1), no shard above `cap`
times its size. The documents of a shard lie on a circular tape in seeded order; the shard's quota is so many whole
rounds plus a run of blocks from a seeded start, and `taken` is what of both falls on the document.

The quotients are not listed: seats = round(target / divisor), so the divisor is bracketed by four aggregations over
the shards, and only the quotients inside the last bracket are ranked.

Defined cases: null text has size 0 and takes 0; a null source is a source of its own, the last; sources of size 0 have
target 0; repeated ids are separate rows laid side by side; an empty table gives an empty result; other columns are
carried by mix_documents() and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

BLOCK_WORDS, SHARD_WORDS, WEIGHTS, SHARE, CAP, SEED = 8, 1_000_000, (3, 1, 2), 1.5, 2, "mix-1"


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ runs."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]++")), F.lit(0)).cast("long")


def _targets(sources: DataFrame, total: int, weights, share: float, cap: int) -> DataFrame:
    """(source, source_size, target): the level at which weight x level, stopped at cap x size, adds up to the share.
    Windows over one row per source."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("top", (F.col("source_size") * cap).cast("double"))
    by = Window.orderBy(F.col("top") / F.col("w"), F.col("source").isNull(), "source")
    # were all sources before this one at their cap, the others would share what is left at this level
    s = s.withColumn("full", F.coalesce(F.sum("top").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("rest", F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.lit(float(total) * share) - F.col("full")) / F.col("rest"))
    s = s.withColumn("open", F.col("level") * F.col("w") <= F.col("top"))
    s = s.withColumn("least", F.min(F.when(F.col("open"), F.struct(F.col("top") / F.col("w"), F.col("source").isNull(), "source", "level"))).over(Window.partitionBy()))
    return s.select("source", "source_size", F.coalesce(F.least(F.col("top"), F.col("w") * F.col("least.level")), F.col("top")).alias("target"))


def sainte_lague(units: DataFrame, seats: int, value: str = "value", most: str = "most", key: str = "unit") -> DataFrame:
    """units with `seats`: the given number of seats by highest quotients value / (2 k - 1), none above `most`; equal
    quotients go by key. Only numbers reach the driver."""
    v, m = F.col(value), F.col(most)
    got = lambda d: F.when(v > 0, F.least(m, F.floor(v / d + 0.5).cast("long"))).otherwise(0)
    low_high = units.agg(F.sum(v), F.max(v)).first()
    if not low_high[0] or seats <= 0:
        return units.withColumn("seats", F.lit(0).cast("long"))
    low, high = 1e-9 * low_high[0] / seats, 4.0 * low_high[1] + 1
    for _ in range(6):
        step = (high / low) ** (1 / 33)
        at = [low * step**i for i in range(1, 33)]
        sums = units.agg(*[F.sum(got(F.lit(x))) for x in at]).first()
        for d, n in zip(at, sums):
            if n >= seats:
                low = max(low, d)
            else:
                high = min(high, d)
                break
        if high / low < 1 + 1e-15 or sums[0] == seats:
            break
    base = units.withColumn("_base", got(F.lit(high))).withColumn("_upto", got(F.lit(low)))
    left = seats - (base.agg(F.sum("_base")).first()[0] or 0)
    more = base.where("_upto > _base").select(key, F.col(value), F.explode(F.expr("sequence(_base + 1, _upto)")).alias("k"))
    won = more.orderBy((F.col(value) / (2 * F.col("k") - 1)).desc(), key).limit(max(0, left)).groupBy(key).agg(F.count("*").alias("_won"))
    return base.join(won, key, "left").withColumn("seats", F.col("_base") + F.coalesce("_won", F.lit(0))).drop("_base", "_upto", "_won")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, cap: int = CAP, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """(id_col, source, size, source_size, target, shard, taken), one row for each input row."""
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    sized = materialise(sized.withColumn("_h", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("_id").cast("string"), F.lit("null"))))), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    targets = materialise(_targets(sources, total, weights, share, cap).withColumn("shards", F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / shard_words).cast("long")), "targets")
    slot = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long")
    named = targets.withColumnRenamed("source", "_source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("_source")), "left").select("_id", "source", "size", "_h", "source_size", "target", F.pmod(slot, F.col("shards")).alias("shard"))
    unit = F.concat(F.lpad(F.col("shard").cast("string"), 12, "0"), F.lit(":"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    rows = materialise(rows.withColumn("unit", unit), "dealt")
    units = rows.groupBy("unit").agg(F.sum("size").alias("shard_size"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    units = units.withColumn("value", F.when(F.col("source_size") > 0, F.col("target") * F.col("shard_size") / F.col("source_size")).otherwise(0.0)).withColumn("most", F.floor(F.col("shard_size") * cap / block_words).cast("long"))
    units = materialise(units, "units")
    room = units.agg(F.sum("most")).first()[0] or 0
    quota = sainte_lague(units, min(room, int(total * share / block_words + 0.5)))
    # whole rounds, and the run of the last round
    n, want = F.col("shard_size"), F.col("seats") * block_words
    quota = quota.select("unit", "shard_size", F.when(n > 0, F.floor(want / n)).otherwise(0).cast("long").alias("rounds"), F.when(n > 0, want % n).otherwise(0).cast("long").alias("run"))
    begin = F.when(n > 0, F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), "unit")), 1, 8), 16, 10).cast("long"), F.greatest(F.lit(1), F.floor(n / block_words))) * block_words).otherwise(0).cast("long")
    quota = quota.withColumn("begin", begin)
    tape = Window.partitionBy("unit").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = rows.withColumn("hi", F.sum("size").over(tape)).withColumn("lo", F.col("hi") - F.col("size")).join(quota, "unit")
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(F.col("hi"), b) - F.greatest(F.col("lo"), a))
    past = F.col("begin") + F.col("run")
    part = overlap(F.col("begin"), F.least(past, F.col("shard_size"))) + overlap(F.lit(0), past - F.col("shard_size"))
    taken = (F.col("rounds") * F.col("size") + part).cast("long")
    return laid.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", "shard", taken.alias("taken"))
