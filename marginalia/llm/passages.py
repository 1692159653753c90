"""Substring dedup: paragraphs by MinHash banding, passages inside paragraphs by content-defined cuts.

Method: a paragraph is a line of at least `min_words` words. Its distinct 5-word shingles give 30 MinHash values in 10
bands of 3, which catch a pair at Jaccard 0.8 with probability 1 - (1 - 0.8^3)^10 = 0.9992. Equal shingle sets are
one class; colliding classes are joined (all pairs of a band; in one of more than `small` classes each class with the
first, then in tiles of bounded size all pairs that are not connected yet), verified by exact Jaccard, and clustered by
components; all but the first place of a cluster is removed.

Banding can't see a passage that others embed in paragraphs of their own, so a second path, outside the method named,
finds those that repeat to the word: lines are cut before each word whose hash is the least of the 5 words on either
side, which cuts equal passages alike wherever they stand. Pieces of at least `piece_words` words and `piece_bytes`
bytes that an earlier place has (a band over the whole piece: Jaccard 1) chain to runs where they touch at both places;
a run of `seed_words` words or more is a seed. Seeds are extended word by word to either side, by up to `context` words
of their line, as long as both places agree, and removed if they then have `min_words` words. Each removed word has an equal one at an
earlier place, so its first place stays. Touching spans are merged.

Defined cases: places are ordered by (id, byte). Words are runs of bytes other than white space, A-Z lowered; each
character of a script without blanks between words is one. Null and empty texts have no paragraphs; null ids are not
read; texts that repeat an id are read as further places of that id; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit
from .components import components
from .store import BROADCAST_IDS, by_ids, discard, materialise
from .tiles import crowd_links

BANDS, ROWS, SHINGLE, MIN_WORDS, PIECE_WORDS, PIECE_BYTES, REACH, SMALL, SEED = 10, 3, 5, 20, 6, 40, 5, 16, 43
SEED_WORDS, CONTEXT = 12, 32


def _lines(d: np.ndarray, o: np.ndarray):
    """Start and end of all lines, and the text of each."""
    cut = np.flatnonzero(d == 10)
    start = np.unique(np.concatenate((o[:-1][np.diff(o) > 0], cut + 1)))
    start = start[start < len(d)]
    text = np.searchsorted(o, start, side="right") - 1
    end = np.minimum(np.append(cut, len(d))[np.searchsorted(cut, start)], o[1:][text]) if len(start) else start
    return start, end, text


def _pieces(h: np.ndarray, line_first: np.ndarray) -> np.ndarray:
    """First word of each piece: line starts, and words with the least hash of those around them."""
    if not len(h):
        return np.zeros(0, np.int64)
    pad = np.concatenate((np.full(REACH, ~np.uint64(0)), h, np.full(REACH, ~np.uint64(0))))
    low = np.lib.stride_tricks.sliding_window_view(pad, 2 * REACH + 1).min(axis=1) == h
    low[line_first[line_first < len(h)]] = True
    return np.flatnonzero(low)


def _units(batches, what: str):
    powers, seeds = kit.Powers(), kit.seeds(BANDS * ROWS, SEED)
    for b in batches:
        data, offs = kit.buffers(b.column(1))
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for lo, _hi, d, o in kit.slices(data, offs):
            ls, le, text = _lines(d, o)
            low = kit.LOWER[d]
            ws, we, _ = kit.words(low, o, kit.NONSPACE, kit.UNSPACED)
            h = kit.span_hashes(low, ws, we, powers)
            first = np.searchsorted(ws, np.append(ls, len(d)))
            count = np.diff(first)
            if what == "pieces":
                cut = _pieces(h, first[:-1])
                nxt = np.append(cut[1:], len(h))
                n, size = nxt - cut, we[nxt - 1] - ws[cut] if len(cut) else cut
                ok = (n >= PIECE_WORDS) & (size >= PIECE_BYTES)
                cut, nxt = cut[ok], nxt[ok]
                line = np.searchsorted(first, cut, side="right") - 1
                with np.errstate(over="ignore"):
                    run = np.concatenate(([np.uint64(0)], np.cumsum(kit.mix(h) * powers.get(len(h) + 1)[0][:-1], dtype=np.uint64)))
                    key = kit.mix((run[nxt] - run[cut]) * powers.get(len(h) + 1)[1][cut])
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo + text[line]]), pa.array((ws[cut] - o[text[line]]).astype(np.int32)), pa.array((we[nxt - 1] - o[text[line]]).astype(np.int32)), pa.array((nxt - cut).astype(np.int32)), pa.array(key.view(np.int64))], names=["id", "s", "e", "n", "k1"])
                continue
            keep = np.flatnonzero(count >= MIN_WORDS)
            # words of the kept lines, end to end
            at = np.concatenate([np.arange(first[i], first[i + 1]) for i in keep]) if len(keep) else np.zeros(0, np.int64)
            lf = np.concatenate(([0], np.cumsum(count[keep])))
            u, uf = kit.distinct_by_text(*kit.shingles(h[at], lf, SHINGLE))
            base = [pa.array(ids[lo + text[keep]]), pa.array((ls[keep] - o[text[keep]]).astype(np.int32)), pa.array((le[keep] - o[text[keep]]).astype(np.int32))]
            if what == "sets":
                yield pa.RecordBatch.from_arrays([*base, pa.ListArray.from_arrays(pa.array(uf.astype(np.int32)), pa.array(u.view(np.int64)))], names=["id", "s", "e", "set"])
                continue
            with np.errstate(over="ignore"):
                sums = [np.concatenate(([np.uint64(0)], np.cumsum(kit.mix(u ^ np.uint64(x)), dtype=np.uint64))) for x in (0x51, 0xA7F3)]
                k1, k2 = ((z[uf[1:]] - z[uf[:-1]]).view(np.int64) for z in sums)
                sig = kit.minhash(u, uf, seeds).astype(np.uint64).reshape(len(keep), BANDS, ROWS)
                band = np.broadcast_to(kit.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(keep), BANDS))
                for r in range(ROWS):
                    band = kit.mix(band * np.uint64(0x2545F4914F6CDD1D) + sig[:, :, r])
            flat = pa.ListArray.from_arrays(pa.array((np.arange(len(keep) + 1) * BANDS).astype(np.int32)), pa.array(band.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*base, pa.array(k1), pa.array(k2), pa.array(np.diff(uf).astype(np.int64)), flat], names=["id", "s", "e", "k1", "k2", "n", "bands"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80, small: int = SMALL) -> DataFrame:
    """(id_col, start, end, first_id, first_start): every span, in bytes, that repeats an earlier place; unmerged."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = materialise(rows.mapInArrow(kit.tidy(lambda b: _units(b, "lines")), "id long, s int, e int, k1 long, k2 long, n long, bands array<long>"), "lines")
    place = F.struct("id", "s", "e")
    classes = materialise(lines.groupBy("k1", "k2").agg(F.min(place).alias("p"), F.first("n").alias("n"), F.first("bands").alias("bands")).withColumn("rep", F.xxhash64("k1", "k2")), "classes")
    hashed = classes.select("rep", "n", F.explode("bands").alias("key"))
    size = hashed.groupBy("key").agg(F.count("*").alias("held"), F.min("rep").alias("hub")).where("held > 1")
    own = materialise(hashed.join(size, "key"), "bands")
    few = own.where(F.col("held") <= small).groupBy("key").agg(F.sort_array(F.collect_list("rep")).alias("m"))
    pairs = few.select(F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> named_struct('a', x, 'b', y))))")).alias("p")).select("p.a", "p.b")
    many = own.where((F.col("held") > small) & (F.col("rep") != F.col("hub")))
    pairs = pairs.union(many.select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    pairs = materialise(pairs.where("a <> b").distinct(), "pairs")
    crowd = own.where(F.col("held") > small).select("key", "rep", "n")
    need = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct().join(classes.select("rep", "p"), "rep").select("rep", "p.*")
    need = materialise(need, "needed")
    # one place of each class is read again for its full set
    texts = by_ids(rows, need.select("id"), "id", "left_semi").mapInArrow(lambda b: _units(b, "sets"), "id long, s int, e int, set array<long>")
    sets = materialise(texts.join(need, ["id", "s", "e"]).groupBy("rep").agg(F.first("set").alias("set")), "sets")
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    inter = F.size(F.array_intersect("x", "y"))
    links = both.where(inter * 100 >= (F.size("x") + F.size("y") - inter) * threshold).select("a", "b")
    links = materialise(links, "links")
    comp = materialise(components(links, "a", "b"), "components")
    # what is still apart in a crowded band: all its pairs (every member is in a pair, with the hub at least)
    more = crowd_links(crowd, comp, lambda reps: sets.join(reps, "rep", "left_semi"), threshold)
    if more is not None:
        comp = materialise(components(links.union(materialise(more, "links")), "a", "b"), "components")
    for table in (own, pairs, need, sets):  # nothing reads them any more
        discard(table)
    comp = comp.toDF("rep", "c")
    led = classes.join(comp, "rep", "left").select("k1", "k2", "p", F.coalesce("c", "rep").alias("c"))
    heads = led.groupBy("c").agg(F.min("p").alias("first"))
    named = led.join(heads, "c").select("k1", "k2", "first")
    out = lines.select("id", "s", "e", "k1", "k2").join(named, ["k1", "k2"]).where(place > F.col("first")).select("id", "s", "e", "first")
    more = _embedded(rows)
    return out.union(more).select(F.col("id").alias(id_col), F.col("s").alias("start"), F.col("e").alias("end"), F.col("first.id").alias("first_id"), F.col("first.s").alias("first_start"))


def _contexts(batches):
    """(id, s, e, and the hashes and bounds of up to CONTEXT words of the line before s and behind e, nearest first) of
    rows (id, text, want array<struct<s,e>>). Whole lines have none: lines that repeat one behind the other chain."""
    powers = kit.Powers()
    for b in batches:
        data, offs = kit.buffers(b.column(1))
        ids = b.column(0).to_numpy(zero_copy_only=False)
        want = b.column(2)
        place, at = want.flatten(), want.offsets.to_numpy().astype(np.int64)
        s, e, at = place.field(0).to_numpy().astype(np.int64), place.field(1).to_numpy().astype(np.int64), at - at[0]
        for lo, hi, d, o in kit.slices(data, offs):
            low = kit.LOWER[d]
            ws, we, _ = kit.words(low, o, kit.NONSPACE, kit.UNSPACED)
            ls, le, _ = _lines(d, o)
            h = kit.span_hashes(low, ws, we, powers).astype(np.uint32).view(np.int32)
            mine = slice(at[lo], at[hi])
            text = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))
            begin, end = s[mine] + o[text], e[mine] + o[text]
            columns = [pa.array(ids[lo + text]), pa.array(s[mine].astype(np.int32)), pa.array(e[mine].astype(np.int32))]
            first = np.searchsorted(ws, begin)
            last = np.searchsorted(ws, end)
            top = np.searchsorted(ws, ls[np.searchsorted(ls, begin, side="right") - 1]) if len(begin) else first
            low_end = np.searchsorted(ws, le[np.searchsorted(ls, end - 1, side="right") - 1]) if len(end) else last
            for n, step, origin in ((np.minimum(first - top, CONTEXT), -1, first - 1), (np.minimum(low_end - last, CONTEXT), 1, last)):
                n = np.maximum(n, 0)
                cut = np.concatenate(([0], np.cumsum(n)))
                k = np.repeat(origin, n) + step * (np.arange(cut[-1]) - np.repeat(cut[:-1], n))
                bound = ((ws if step < 0 else we)[k] - np.repeat(o[text], n)).astype(np.int32)
                lists = pa.array(cut.astype(np.int32))
                columns += [pa.ListArray.from_arrays(lists, pa.array(h[k])), pa.ListArray.from_arrays(lists, pa.array(bound))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "s", "e", "lh", "lb", "rh", "rb"])


def _embedded(rows: DataFrame) -> DataFrame:
    """(id, s, e, first struct<id,s,e>): passages inside paragraphs that an earlier place has word for word."""
    place = F.struct("id", "s", "e")
    pieces = materialise(rows.mapInArrow(kit.tidy(lambda b: _units(b, "pieces")), "id long, s int, e int, n int, k1 long"), "pieces")
    often = pieces.groupBy("k1").agg(F.count("*").alias("c"), F.min(place).alias("first")).where("c > 1").select("k1", "first")
    later = pieces.join(often, "k1").where(place > F.col("first")).select("id", "s", "e", "n", F.col("first.id").alias("fid"), F.col("first.s").alias("fs"), F.col("first.e").alias("fe"))
    order = Window.partitionBy("id").orderBy("s", "fid", "fs", "e")
    before = lambda c: F.lag(c).over(order)
    touch = (before("fid") == F.col("fid")) & (F.col("s") - before("e") <= 2) & (F.col("fs") - before("fe") <= 2) & (F.col("s") - before("s") == F.col("fs") - before("fs"))
    chained = later.withColumn("new", F.when(F.coalesce(touch, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    runs = chained.groupBy("id", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"), F.min("fid").alias("fid"), F.min("fs").alias("fs"), F.max("fe").alias("fe"))
    seeds = materialise(runs.where(F.col("n") >= SEED_WORDS).drop("run"), "seeds")
    discard(pieces)
    both = seeds.select("id", "s", "e").union(seeds.select("fid", "fs", "fe")).distinct()
    want = materialise(both.groupBy("id").agg(F.collect_list(F.struct("s", "e")).alias("want")), "wanted")
    held = want.agg(F.sum(16 + 8 * F.size("want"))).first()[0] or 0
    texts = rows.join(F.broadcast(want) if held <= BROADCAST_IDS else want, "id").select("id", "text", "want")
    around = texts.mapInArrow(kit.tidy(_contexts), "id long, s int, e int, lh array<int>, lb array<int>, rh array<int>, rb array<int>")
    # a repeated id may have several texts with words at the same place; one of them stands for it, always the same
    around = materialise(around.groupBy("id", "s", "e").agg(F.min(F.struct("lh", "lb", "rh", "rb")).alias("a")).select("id", "s", "e", "a.*"), "contexts")
    own, other = around, around.select(F.col("id").alias("fid"), F.col("s").alias("fs"), F.col("e").alias("fe"), F.col("lh").alias("flh"), F.col("lb").alias("flb"), F.col("rh").alias("frh"))

    def agreeing(x, y):
        """How many words agree from the first on."""
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        at = F.array_position(same, False)
        return F.when(at == 0, F.size(same)).otherwise(at - 1).cast("int")

    j = seeds.join(own, ["id", "s", "e"]).join(other, ["fid", "fs", "fe"])
    j = j.withColumns({"l": agreeing("lh", "flh"), "r": agreeing("rh", "frh")}).where(F.col("n") + F.col("l") + F.col("r") >= MIN_WORDS)
    pick = lambda c, n, plain: F.when(F.col(n) > 0, F.get(F.col(c), F.col(n) - 1)).otherwise(F.col(plain))
    return j.select("id", pick("lb", "l", "s").alias("s"), pick("rb", "r", "e").alias("e"), F.struct(F.col("fid").alias("id"), pick("flb", "l", "fs").alias("s"), F.col("fe").alias("e")).alias("first"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id_col, n_spans, removed_bytes, spans, first_ids): one row for each text with repeats; spans are the merged
    byte ranges to remove, first_ids the texts that keep them."""
    spans = repeats(docs, id_col, text_col, **how).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"), F.array_sort(F.collect_set("first_id")).alias("first_ids"))
    # a gap of up to two bytes is the space or line feed between two spans
    merged = F.expr("aggregate(s, cast(array() AS array<struct<start:int,end:int>>), (acc, x) -> CASE WHEN size(acc) > 0 AND x.start <= element_at(acc, -1).end + 2 THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end)))) ELSE concat(acc, array(x)) END)")
    out = spans.withColumn("spans", merged)
    return out.select(id_col, F.size("spans").cast("long").alias("n_spans"), F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)").alias("removed_bytes"), "spans", "first_ids")


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with the repeated spans cut from the texts; of texts that repeat an id, none is cut."""
    once = docs.groupBy(id_col).agg(F.count("*").alias("_n")).where("_n = 1").select(F.col(id_col).alias("_once"))
    found = repeated_passages(docs, id_col, text_col, **how).join(once, F.col(id_col) == F.col("_once"), "left_semi").select(F.col(id_col).alias("_cut_id"), F.col("spans").alias("_spans"))
    j = docs.join(found, docs[id_col] == F.col("_cut_id"), "left")
    kept = F.expr(f"decode(aggregate(_spans, named_struct('t', cast('' AS binary), 'at', 0), (a, x) -> named_struct('t', concat(a.t, substring(encode(`{text_col}`, 'UTF-8'), a.at + 1, x.start - a.at)), 'at', x.end), a -> concat(a.t, substring(encode(`{text_col}`, 'UTF-8'), a.at + 1, 2147483647))), 'UTF-8')")
    return j.withColumn(text_col, F.when(F.col("_spans").isNotNull(), kept).otherwise(F.col(text_col))).drop("_cut_id", "_spans")
