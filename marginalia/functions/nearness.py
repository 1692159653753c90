"""Strings near a string by the Indel ratio, exact: 100 * 2 * longest common subsequence / total length.

A sorted table is walked as the tree of its prefixes, all asked strings at once and a level at a time, so what names
begin with alike is computed once. A node carries the bit vector of Hyyrö's recurrence; it is left as soon as no name
below it can reach the cutoff. Asked strings of more than 64 characters take Python's integers for the vectors."""

from __future__ import annotations

import numpy as np

_ROOM = 1_000_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.array([len(x) for x in texts], np.int64)


class Prefixes:
    """The prefix tree of distinct, not empty strings in the order of code points."""

    def __init__(self, names: list[str]):
        self.n = len(names)
        flat, self.lens = _codes(names)
        off = np.cumsum(self.lens) - self.lens
        self.letters, flat = np.unique(flat, return_inverse=True)
        alike = np.zeros(self.n, np.int64)
        rows, depth = np.arange(1, self.n), 0
        while rows.size:
            rows = rows[np.minimum(self.lens[rows], self.lens[rows - 1]) > depth]
            rows = rows[flat[off[rows] + depth] == flat[off[rows - 1] + depth]]
            depth += 1
            alike[rows] = depth
        # level: first row, letter, shortest and longest name of each node, and which nodes of the next level lie below
        self.levels = []
        above, ends = np.zeros(1, np.int64), np.array([self.n])
        for i in range(1, int(self.lens.max(initial=0)) + 1):
            first = np.flatnonzero((alike < i) & (self.lens >= i))
            below = np.searchsorted(first, above), np.searchsorted(first, ends)
            short = np.maximum(np.minimum.reduceat(self.lens, first), i)
            self.levels.append((first, flat[off[first] + i - 1], short, np.maximum.reduceat(self.lens, first), *below))
            cuts = np.append(np.flatnonzero(alike < i), self.n)
            cuts = cuts[cuts > 0]
            above, ends = first, cuts[np.searchsorted(cuts, first, "right")]

    def near(self, asked: list[str], cutoff: float):
        """(place in `asked`, place among the names, ratio) of every pair at or above the cutoff, in pieces; a piece has
        all pairs of its asked strings."""
        for wide in (False, True):
            some = [i for i, x in enumerate(asked) if x and (len(x) > 64) == wide]
            step = max(1, _ROOM // max(1, self.n))
            for k in range(0, len(some), step):
                part = np.array(some[k : k + step])
                a, b, r = self._walk([asked[i] for i in part], cutoff, wide)
                yield part[a], b, r

    def _walk(self, asked: list[str], cutoff: float, wide: bool):
        kind = object if wide else np.uint64
        ones = np.frompyfunc(int.bit_count, 1, 1) if wide else np.bitwise_count
        flat, size = _codes(asked)
        full = np.array([(1 << len(x)) - 1 for x in asked], dtype=kind)
        bit = np.array([1 << j for x in asked for j in range(len(x))], dtype=kind)
        letter = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
        known = self.letters[letter] == flat
        mask = np.zeros((len(asked), len(self.letters)), dtype=kind)
        np.bitwise_or.at(mask, (np.repeat(np.arange(len(asked)), size)[known], letter[known]), bit[known])
        who, node, state = np.arange(len(asked)), np.zeros(len(asked), np.int64), full
        out = []
        for i, (first, char, short, long, lo, hi) in enumerate(self.levels, 1):
            many = hi[node] - lo[node]
            rep = np.repeat(np.arange(len(node)), many)
            child = np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many) + lo[node][rep]
            who, s = who[rep], state[rep]
            u = s & mask[who, char[child]]
            s = ((s + u) | (s - u)) & full[who]
            m = size[who]
            common = m - ones(s).astype(np.int64)
            n = np.clip(m - common + i, short[child], long[child])
            keep = 100.0 * (2 * np.minimum(m, common + n - i) / (m + n)) >= cutoff
            who, child, s, m, common = who[keep], child[keep], s[keep], m[keep], common[keep]
            ratio = 100.0 * (2 * common / (m + i))
            done = (self.lens[first[child]] == i) & (ratio >= cutoff)
            out.append((who[done], first[child][done], ratio[done]))
            node, state = child, s
            if not node.size:
                break
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def nearest(asked: list[str], names: list[str], first: list[int], cutoff: float, limit: int):
    """(asked, name, first of the name, ratio): for each asked string its `limit` best names at or above the cutoff that
    share no word with it, equal ratios by `first`."""
    order = sorted(range(len(names)), key=names.__getitem__)
    names, first = [names[i] for i in order], np.array([first[i] for i in order], np.int64)
    words = [frozenset(x.split(" ")) for x in names]
    for a, b, r in Prefixes(names).near(asked, cutoff) if names else ():
        best = np.lexsort((first[b], -r, a))
        a, b, r = a[best], b[best], r[best]
        cuts = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            left, own = limit, frozenset(asked[a[lo]].split(" "))
            for k in range(lo, hi):
                if left and own.isdisjoint(words[b[k]]):
                    left -= 1
                    yield asked[a[lo]], names[b[k]], int(first[b[k]]), float(r[k])
                elif not left:
                    break
