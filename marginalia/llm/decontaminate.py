"""Benchmark decontamination: BM25 over test items with block-max WAND, every training passage a query.

Method: items (question, and an answer where there is one) are indexed by BM25 in the driver; impacts are divided by
the item's score for itself, so 1 is a passage with all its words and one threshold serves items of any length.
Every document is read whole as overlapping passages of twice the longest item (64 words at least), so that any
occurrence of an item lies inside one. For all passages of a batch at once, the block maxima of a passage's rare words
are summed for each block of items; where even with all that frequent words can add no block reaches the threshold,
no item can (the pivot test on block maxima). The other passages go through block-max WAND item by item over the
postings, which returns all items at or above the threshold. Each is verified: of the question's distinct 5-word shingles a share of `overlap` or
more must lie in the passage, and as much of the answer's words.
The index is sent to the workers; its size is taken as 60 times the text of its items, and items beyond `index_bytes`
form further indexes, each with its own reading of the documents (a stated set of queries in blocks). An index that
is larger than that all the same is refused.

Defined cases: words are runs of letters and digits, lower case. Null or wordless items match nothing, null texts
hold nothing, null ids of documents are kept by drop_contaminated() and appear with a null id; equal items are
reported each; items without an answer need only the question; repeated ids are separate rows; empty tables give
empty results; extra columns are not read.
"""

from __future__ import annotations

import bisect
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit
from .store import by_ids

THRESHOLD, OVERLAP, K1, B, SHINGLE, POSTING_BLOCK, ITEM_BLOCK, INDEX_BYTES = 0.5, 0.8, 1.2, 0.75, 5, 32, 2, 64 << 20


def _tokens(texts: list[str]) -> list[np.ndarray]:
    powers = kit.Powers()
    data, offs = kit.buffers(pc.utf8_lower(pa.array(texts, pa.string())))
    s, e, first = kit.words(data, offs, kit.ALNUM)
    h = kit.span_hashes(data, s, e, powers)
    return [h[first[i] : first[i + 1]] for i in range(len(texts))]


def _grams(h: np.ndarray) -> np.ndarray:
    """Distinct 5-word shingles; of a question of fewer words, its words in one run."""
    return np.unique(kit.shingles(h, np.array([0, len(h)]), max(1, min(SHINGLE, len(h))))[0])


def build_index(items: list[tuple[int, str, str | None]], threshold: float) -> dict:
    """Terms with their postings (item, impact) in item order and block maxima; the frequent terms whose impacts on no
    item add up to more than half the threshold; what verification needs of each item."""
    q = _tokens([i[1] or "" for i in items])
    a = _tokens([i[2] or "" for i in items])
    words = [np.concatenate(x) for x in zip(q, a)]
    keep = [k for k, w in enumerate(words) if len(w)]
    n, mean = len(keep), np.mean([len(words[k]) for k in keep]) if keep else 1.0
    tf = [dict(zip(*(x.tolist() for x in np.unique(words[k], return_counts=True)))) for k in keep]
    df: dict[int, int] = {}
    for t in tf:
        for w in t:
            df[w] = df.get(w, 0) + 1
    idf = {w: float(np.log(1 + (n - c + 0.5) / (c + 0.5))) for w, c in df.items()}
    post: dict[int, list[tuple[int, float]]] = {}
    for j, t in enumerate(tf):
        raw = {w: idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(words[keep[j]]) / mean)) for w, c in t.items()}
        total = sum(raw.values())
        for w, x in raw.items():
            post.setdefault(w, []).append((j, x / total))
    frequent, load = set(), np.zeros(max(1, n))
    for w in sorted(post, key=lambda w: (-len(post[w]), w)):
        more = load.copy()
        for j, x in post[w]:
            more[j] += x
        if more.max() > threshold / 2:
            break
        load, _ = more, frequent.add(w)
    rare = np.array(sorted(w for w in post if w not in frequent), np.uint64)
    return {
        "post": {w: ([j for j, _ in p], [x for _, x in p], [max(x for _, x in p[k : k + POSTING_BLOCK]) for k in range(0, len(p), POSTING_BLOCK)], max(x for _, x in p)) for w, p in post.items()},
        "rare": rare,
        "spare": np.array([load[k : k + ITEM_BLOCK].max() for k in range(0, len(load), ITEM_BLOCK)]),
        **_block_maxima([post[int(w)] for w in rare]),
        "items": [(items[k][0], max(1, min(SHINGLE, len(q[k]))), _grams(q[k]), np.unique(a[k])) for k in keep],
        "longest": max([len(words[k]) for k in keep], default=1),
    }


def _block_maxima(posts: list[list[tuple[int, float]]]) -> dict:
    """For each term, the blocks of items that have it and its largest impact in each, end to end."""
    first, block, most = [0], [], []
    for p in posts:
        top: dict[int, float] = {}
        for j, x in p:
            top[j // ITEM_BLOCK] = max(x, top.get(j // ITEM_BLOCK, 0.0))
        block.extend(top)
        most.extend(top.values())
        first.append(len(block))
    return {"block_first": np.array(first), "block": np.array(block, np.int64), "block_most": np.array(most)}


def block_max_wand(post: dict, query: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (item, score) with score >= threshold of a query of distinct terms."""
    end = 1 << 60
    lists = [post[w] for w in query if w in post]
    cur = [[p[0][0], 0, p] for p in lists]  # item, position, postings
    out, slack = [], 1e-9
    while cur:
        cur.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for k, c in enumerate(cur):
            if c[0] == end:
                break
            total += c[2][3]
            if total >= threshold - slack:
                pivot = k
                break
        if pivot < 0:
            return out
        item = cur[pivot][0]
        while pivot + 1 < len(cur) and cur[pivot + 1][0] == item:
            pivot += 1
        # the blocks that hold the pivot, if their lists reach so far
        bound, until = 0.0, end
        for c in cur[: pivot + 1]:
            ids = c[2][0]
            at = bisect.bisect_left(ids, item, c[1])
            if at < len(ids):
                blk = at // POSTING_BLOCK
                bound += c[2][2][blk]
                until = min(until, ids[min(len(ids), (blk + 1) * POSTING_BLOCK) - 1] + 1)
        if bound >= threshold - slack:
            if cur[0][0] == item:
                got = sum(c[2][1][c[1]] for c in cur[: pivot + 1])
                if got >= threshold - slack:
                    out.append((item, got))
                nxt = item + 1
            else:
                nxt = item
        else:
            nxt = max(until, item + 1)
            if pivot + 1 < len(cur):
                nxt = max(item + 1, min(nxt, cur[pivot + 1][0]))
        for c in cur[: pivot + 1]:
            if c[0] < nxt:
                ids = c[2][0]
                c[1] = bisect.bisect_left(ids, nxt, c[1])
                c[0] = ids[c[1]] if c[1] < len(ids) else end
    return out


def find(index: dict, h: np.ndarray, first: np.ndarray, threshold: float, overlap: float):
    """(text, item, score, question share, answer share) for the verified items of each text's passages."""
    stride = max(64, index["longest"])
    rare, best = index["rare"], {}
    if not len(h) or not len(index["items"]):
        return best
    bits = np.zeros(1 << 16, bool)
    bits[(rare & np.uint64(0xFFFF)).astype(int)] = True
    maybe = np.flatnonzero(bits[(h & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(rare, h[maybe])
    at[at == len(rare)] = 0
    true = rare[at] == h[maybe] if len(rare) else np.zeros(len(maybe), bool)
    where, term = maybe[true], at[true]
    text = np.searchsorted(first, where, side="right") - 1
    inside = (where - first[text]) // stride
    # a word lies in the passage that begins at its stride, and in the one before
    passages = np.concatenate(([0], np.cumsum(-(-np.diff(first) // stride))))
    cell = passages[text] + inside
    terms = len(rare) + 1
    key = np.unique(np.concatenate((cell * terms + term, (cell[inside > 0] - 1) * terms + term[inside > 0])))
    num, trm = key // terms, key % terms
    n = np.diff(index["block_first"])[trm]
    at = np.repeat(index["block_first"][:-1][trm] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    nb = len(index["spare"])
    pair = np.repeat(num, n) * nb + index["block"][at]
    if passages[-1] * nb <= 1 << 20:
        back = pair
        pair = np.arange(passages[-1] * nb)
    else:
        pair, back = np.unique(pair, return_inverse=True)
    reach = np.bincount(back, weights=index["block_most"][at], minlength=len(pair)).reshape(-1) + index["spare"][pair % nb] >= threshold - 1e-9
    memo: dict[bytes, list] = {}
    for p in np.unique(pair[reach] // nb):
        t = int(np.searchsorted(passages, p, side="right")) - 1
        k = int(p - passages[t])
        lo = first[t] + k * stride
        span = h[lo : min(first[t + 1], lo + 2 * stride)]
        name = span.tobytes()
        if name not in memo:
            hits = block_max_wand(index["post"], np.unique(span).tolist(), threshold)
            found, g = [], {}
            for j, s in hits:
                _, width, qs, aw = index["items"][j]
                if width not in g:
                    g[width] = kit.shingles(span, np.array([0, len(span)]), width)[0]
                qo = np.isin(qs, g[width]).mean() if len(qs) else 1.0
                ao = float(np.isin(aw, span).mean()) if len(aw) else 1.0
                if qo >= overlap and ao >= overlap:
                    found.append((j, s, float(qo), ao))
            memo[name] = found
        for j, s, qo, ao in memo[name]:
            if (t, j) not in best or best[t, j] < (qo, ao, s):
                best[t, j] = (qo, ao, s)
    return best


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", question_col: str = "text", answer_col: str | None = None, threshold: float = THRESHOLD, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(id_col, item_id, bm25, question_overlap, answer_overlap): each item that each document holds. Without an
    answer column the last sentence of an item of several is its answer, as far as it has words."""
    text = F.col(question_col).cast("string")
    if answer_col:
        told = items.select(F.col(item_col).alias("i"), text.alias("q"), F.col(answer_col).cast("string").alias("a"))
    else:
        last = F.regexp_extract(text, r"(?s)^.*[.?!]\s+(\S.*)$", 1)
        told = items.select(F.col(item_col).alias("i"), F.when(F.length(last) > 0, F.regexp_extract(text, r"(?s)^(.*[.?!])\s+\S.*$", 1)).otherwise(text).alias("q"), F.when(F.length(last) > 0, last).alias("a"))
    told = told.where("q IS NOT NULL OR a IS NOT NULL")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kinds, item_kind = dict(rows.dtypes), dict(told.dtypes)["i"]
    out = None
    # about 60 bytes of index for each byte of text; a share of the items by hash for each index
    size = told.agg(F.sum(F.octet_length(F.concat_ws(" ", "q", "a")))).first()[0] or 0
    parts = max(1, -(-int(size) * 60 // index_bytes))
    for part in range(parts):
        few = sorted((r[0], r[1], r[2]) for r in told.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).select("i", F.coalesce("q", F.lit("")), F.coalesce("a", F.lit(""))).collect())
        index = build_index(few, threshold)
        if len(few) > 1 and (held := len(pickle.dumps(index))) > 2 * index_bytes:
            raise ValueError(f"an index of {held} bytes; give a larger index_bytes")
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index, powers = shared.value, kit.Powers()
            for b in batches:
                # lower case a slice at a time: a batch of texts is held once
                for lo, hi, _, _ in kit.slices(*kit.buffers(b.column(1))):
                    d, o = kit.buffers(pc.utf8_lower(b.column(1).slice(lo, hi - lo)))
                    s, e, first = kit.words(d, o, kit.ALNUM)
                    best = find(index, kit.span_hashes(d, s, e, powers), first, threshold, overlap)
                    if best:
                        keys = sorted(best)
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([lo + t for t, _ in keys])), pa.array([index["items"][j][0] for _, j in keys]), *(pa.array([best[k][x] for k in keys], pa.float64()) for x in (2, 0, 1))], names=["_id", "item_id", "bm25", "question_overlap", "answer_overlap"])

        found = rows.mapInArrow(kit.tidy(run), f"_id {kinds['_id']}, item_id {item_kind}, bm25 double, question_overlap double, answer_overlap double")
        out = found if out is None else out.union(found)
    return out.withColumnRenamed("_id", id_col)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """docs without those that hold an item; of rows that repeat an id, all go if one holds an item."""
    return by_ids(docs, contaminated(docs, items, id_col, **how).select(id_col), id_col, "left_anti")
