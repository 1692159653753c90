"""Vectorised text primitives over Arrow string buffers: whole batches of documents as one byte array.

Nothing here loops over words in Python. Memory is bounded by `slice_bytes` (a longer single text forms a
slice of its own, and costs about 40 bytes per byte of it)."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_ODD = 0x9E3779B97F4A7C15 | 1
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)

#: [^\x20\x09-\x0D]: bytes of words in the sense of the contracts.
NONSPACE = np.ones(256, bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Letters and digits; every byte of a non-ASCII character counts as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def tidy(run):
    """A function of batches for mapInArrow that gives what `run` has freed back to the system at its end. Workers stay
    for later tasks, and their allocators would keep it beside the stages that follow."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def slices(data: np.ndarray, offs: np.ndarray, slice_bytes: int = SLICE_BYTES):
    """Runs of whole texts of about slice_bytes: (first, past last, bytes, offsets)."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + slice_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


#: First bytes of the characters of scripts that set no blanks between words (U+3000 to U+DFFF, three bytes each).
UNSPACED = np.zeros(256, bool)
UNSPACED[0xE3:0xEE] = True


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray, alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the text of every maximal run of bytes in `inside`; runs end with their text. Characters
    of three bytes whose first is in `alone` are words by themselves."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    m = inside[data]
    edge = np.zeros(len(m) + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], m[:-1])) & ~edge[:-1]
    after = np.concatenate((m[1:], [False])) & ~edge[1:]
    begins = m & ~before
    if alone is not None:
        lead = m & alone[data]
        begins |= lead
        begins[3:] |= lead[:-3] & m[3:]
        after &= ~np.concatenate((begins[1:], [False]))
    start = np.flatnonzero(begins)
    end = np.flatnonzero(m & ~after) + 1
    first = np.searchsorted(start, offs)  # of each text, in start
    return start, end, first


class Powers:
    """Powers of the hash's base and of its inverse, grown when a longer slice comes."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, SLICE_BYTES + 4096)
            with np.errstate(over="ignore"):
                self.up = np.concatenate(([np.uint64(1)], np.full(m - 1, _ODD, np.uint64))).cumprod(dtype=np.uint64)
                self.down = np.concatenate(([np.uint64(1)], np.full(m - 1, _ODD_INVERSE, np.uint64))).cumprod(dtype=np.uint64)
        return self.up[:n], self.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of the byte spans, by one running sum of a polynomial; equal bytes give equal hashes anywhere."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers.get(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mix((total[end] - total[start]) * down[start])


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of k words within each text, and where each text's runs begin (one more entry than texts).
    A text of 1 to k-1 words has its whole sequence as one shingle; one without words has none."""
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    out_first = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(out_first[-1]) - out_first[:-1][doc] + first[:-1][doc]
    length = np.minimum(k, n_words[doc])
    with np.errstate(over="ignore"):
        acc = np.zeros(len(at), np.uint64)
        for j in range(k):
            use = length > j
            nxt = h[np.where(use, at + j, at)] if len(at) else np.zeros(0, np.uint64)
            acc = np.where(use, mix(acc * np.uint64(0x2545F4914F6CDD1D) + nxt + np.uint64(j + 1)), acc)
    return acc, out_first


def distinct_by_text(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, ascending, with their new starts."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((h, doc)) if n > 1 else np.argsort(h)
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.searchsorted(doc[keep], np.arange(n + 1))


def set_sums(h: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each text's set of distinct hashes: the sum of their mixed values."""
    with np.errstate(over="ignore"):
        run = np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)))
        return mix(run[first[1:]] - run[first[:-1]]).view(np.int64)


def minhash(h: np.ndarray, first: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum of each seeded 32-bit hash over each text's shingles: (texts, seeds); texts without any get all ones."""
    n = len(first) - 1
    out = np.full((n, len(seeds)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        low, high = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
        at = first[:-1][full]
        with np.errstate(over="ignore"):
            for j, (a, b) in enumerate(seeds):
                x = low * a
                x ^= high * b
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                out[full, j] = np.minimum.reduceat(x, at)
    return out


def seeds(k: int, seed: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(1, 1 << 31, size=(k, 2)).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
