"""Periodic runs of words, by suffix trees of a text and of its reversal.

A run is a maximal stretch of words with a smallest period q that is long enough to count. By the runs
theorem every run holds a Lyndon root: a word that is the longest Lyndon word at its place for one of two
opposite orders of the alphabet. Those words end before the next smaller suffix, so there are two
candidates for each place. A candidate (place i, period q) is extended to the right by the longest common
extension of i and i + q and to the left by that of the reversal; both are the string depth of the lowest
common ancestor of two leaves in Ukkonen's suffix tree, found in constant time on the tree's Euler tour.

Words that can stand in no long run are left out first: a run of at least `POWER` periods and `LEAST` words
repeats each of its three-word shingles `SHINGLES` times. What is left of many texts shares one tree, with
a symbol of its own between the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed
from specloom.llm.jaccard import mix

# A run has at least so many words, and so many periods.
LEAST = 6
POWER = 4
# Occurrences of each three-word shingle inside such a run.
WIDTH = 3
SHINGLES = 3
# Words that are filtered at a time, and words that share a tree; a longer piece has a tree of its own.
BLOCK_WORDS = 200_000
TREE_WORDS = 60_000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_GOLD = np.uint64(0x9E3779B97F4A7C15)


class SuffixTree:
    """Ukkonen's tree of a list of small numbers, the last of which occurs once.

    Leaves are numbered as they are made, which is the order of their suffixes. `start` and `end` bound the
    label of the edge above a node; `down` maps node * width + symbol to the child.
    """

    def __init__(self, symbols: list[int], width: int):
        n = len(symbols)
        self.symbols, self.width, self.n = symbols, width, n
        start, end, link, leaf, down = [0], [0], [0], [-1], {}
        node = edge = length = open_suffixes = leaves = 0
        get = down.get
        for i, symbol in enumerate(symbols):
            last = 0
            open_suffixes += 1
            while open_suffixes:
                if not length:
                    edge = i
                key = node * width + symbols[edge]
                child = get(key)
                if child is None:
                    down[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    leaf.append(leaves)
                    leaves += 1
                    if last:
                        link[last] = node
                    last = node
                else:
                    first = start[child]
                    size = end[child] - first
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    if symbols[first + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner = len(start)
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    leaf += (-1, leaves)
                    leaves += 1
                    down[key] = inner
                    down[inner * width + symbol] = inner + 1
                    start[child] = first + length
                    down[inner * width + symbols[first + length]] = child
                    if last:
                        link[last] = inner
                    last = inner
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_suffixes + 1
        self.start, self.end, self.leaf, self.down = start, end, leaf, down

    def tour(self, separators: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks of the suffixes in two orders of the alphabet, and the tour. The first order is that of
        the symbols, the second its opposite, but that symbols below `separators` come first in both. The
        tour holds, for each leaf in the first order, the string depth of the node at which the Euler tour
        turns between the leaf before and this one."""
        keys = np.fromiter(self.down.keys(), dtype=np.int64, count=len(self.down))
        child = np.fromiter(self.down.values(), dtype=np.int64, count=len(self.down))
        above, symbol = keys // self.width, keys % self.width
        sizes = np.array(self.end) - np.array(self.start)
        counts = np.bincount(above, minlength=sizes.size)
        ends = np.cumsum(counts).tolist()
        begins = (np.cumsum(counts) - counts).tolist()
        kids = child[np.lexsort((-symbol, above))].tolist()  # the last is the smallest and leaves the stack first
        size, leaf = sizes.tolist(), self.leaf
        depth = [0] * len(size)
        order, turns = [], []
        stack, at, turn = kids[begins[0] : ends[0]], [0] * (ends[0] - begins[0]), 0
        while stack:
            v = stack.pop()
            top = at.pop()
            if top < turn or not order:
                turn = top
            if leaf[v] >= 0:
                order.append(leaf[v])
                turns.append(turn)
                turn = self.n + 1
                continue
            d = depth[v] = top + size[v]
            a, b = begins[v], ends[v]
            stack += kids[a:b]
            at += [d] * (b - a)
        rank = np.empty(self.n, dtype=np.int64)
        rank[np.array(order)] = np.arange(self.n)
        opposite = child[np.lexsort((np.where(symbol < separators, symbol + self.width, symbol), above))].tolist()
        stack, order = opposite[begins[0] : ends[0]], []
        while stack:
            v = stack.pop()
            if leaf[v] >= 0:
                order.append(leaf[v])
            else:
                stack += opposite[begins[v] : ends[v]]
        other = np.empty(self.n, dtype=np.int64)
        other[np.array(order)] = np.arange(self.n)
        return rank, other, np.array(turns, dtype=np.int32)


class Extension:
    """Longest common extension of two places in constant time: the smallest string depth on the tour
    between their leaves, from a table of minima over spans of 1, 2, 4, ... turns."""

    def __init__(self, rank: np.ndarray, turns: np.ndarray):
        self.rank = rank
        self.table = [turns]
        width = 1
        while 2 * width <= turns.size:
            low = self.table[-1]
            self.table.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a <> b."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        out = np.empty(a.size, dtype=np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.table[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """Place of the next smaller suffix of each place; the length where there is none."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank.tolist()):
        while stack and stack[-1][0] > r:
            out[stack.pop()[1]] = i
        stack.append((r, i))
    return np.array(out, dtype=np.int64)


def runs_of(pieces: list[np.ndarray], least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Rows (piece, start, length, period) of the runs of some lists of numbers that have at least `least`
    symbols and `power` periods, in order."""
    sizes = np.array([p.size for p in pieces], dtype=np.int64)
    if not int(sizes.sum()):
        return np.zeros((4, 0), dtype=np.int64)
    codes = np.unique(np.concatenate(pieces), return_inverse=True)[1] + len(pieces)
    begins = np.cumsum(sizes + 1) - sizes - 1
    n = int(sizes.sum()) + len(pieces)
    inside = np.ones(n, dtype=bool)
    inside[begins + sizes] = False
    symbols = np.empty(n, dtype=np.int64)
    symbols[inside] = codes
    symbols[begins + sizes] = np.arange(len(pieces))
    width = int(codes.max()) + 1
    rank, other, turns = SuffixTree(symbols.tolist(), width).tour(len(pieces))
    ahead = Extension(rank, turns)
    places = np.flatnonzero(inside)
    found = [np.stack([places, next_smaller(r)[places] - places]) for r in (rank, other)]
    place, period = np.unique(np.concatenate(found, axis=1), axis=1)
    right = ahead.of(place, place + period)
    del ahead
    # The reversal: its last symbol must occur once, so the first separator is moved to its end.
    back, _, turns = SuffixTree([*symbols[:-1][::-1].tolist(), int(symbols[-1])], width).tour(len(pieces))
    behind = Extension(back, turns)
    left = np.zeros(place.size, dtype=np.int64)
    at = np.flatnonzero((place > 0) & (symbols[place - 1] == symbols[place + period - 1]))
    # Place p of the symbols is place n - 2 - p of the reversal.
    left[at] = behind.of(n - 1 - place[at], n - 1 - place[at] - period[at])
    length = left + period + right
    good = (length >= least) & (length >= power * period)
    start = (place - left)[good]
    piece = np.searchsorted(begins, start, side="right") - 1
    rows = np.stack([piece, start - begins[piece], length[good], period[good]])
    return np.unique(rows, axis=1)


def _stretches(owner: np.ndarray, codes: np.ndarray, least: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of words of one owner each of whose shingles occurs often enough in
    the owner. Counts are those of hashed shingles, `exact` up to collisions of 64 bits, else of as many
    buckets as eight times the words; more is counted than there is, never less."""
    n = max(0, codes.size - WIDTH + 1)
    key = owner[:n].astype(np.uint64) * _GOLD
    for j in range(WIDTH):
        key = mix(key + codes[j : j + n].astype(np.uint64) + _GOLD)
    if exact:
        _, key, counts = np.unique(key, return_inverse=True, return_counts=True)
    else:
        key = (key & np.uint64((1 << (8 * n + 1).bit_length()) - 1)).astype(np.int64)
        counts = np.bincount(key)
    often = (counts[key] >= SHINGLES) & (owner[:n] == owner[WIDTH - 1 :]) if n else np.zeros(0, dtype=bool)
    edge = np.diff(np.concatenate([[0], often.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + WIDTH - 1
    keep = end - begin >= least
    return begin[keep], end[keep]


def candidate_pieces(owner: np.ndarray, codes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the pieces that can hold a run; every run lies whole in one of them. The count of
    shingles is repeated inside the pieces until none gets shorter."""
    begin, end = _stretches(owner, codes, least, False)
    while begin.size:
        sizes = end - begin
        places = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        b, e = _stretches(np.repeat(np.arange(begin.size), sizes), codes[places], least, True)
        if int((e - b).sum()) == places.size and b.size == begin.size:
            break
        begin, end = places[b] if b.size else b, places[e - 1] + 1 if e.size else e
    return begin, end


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each list of words, by start, then period."""
    if not texts:
        return []
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    names: dict[bytes, int] = {}
    codes = np.array([names.setdefault(w, len(names)) for t in texts for w in t], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin, end = candidate_pieces(owner, codes)
    found: list[np.ndarray] = []
    at = 0
    ends = np.cumsum(end - begin)
    while at < begin.size:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + TREE_WORDS, side="right")))
        rows = runs_of([codes[a:b] for a, b in zip(begin[at:to], end[at:to], strict=True)])
        text = owner[begin[at:to]][rows[0]]
        found.append(np.stack([text, rows[1] + begin[at:to][rows[0]] - begins[text], rows[2], rows[3]]))
        at = to
    rows = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    rows = rows[:, np.lexsort((rows[3], rows[1], rows[0]))]
    return np.split(rows[1:], np.searchsorted(rows[0], np.arange(1, len(texts))), axis=1)


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs.shape[1]:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[0] + runs[2], 1)
    np.add.at(change, runs[0] + runs[1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(text: Column) -> Column:
    """struct<runs: array<struct<start, length, period>>, collapsed: string> of a text column.

    Words are what stands between blanks (space and 0x09 to 0x0D), numbered from 0; case counts. Runs are
    maximal, by start, then period, with the smallest period and at least max(6, 4 * period) words.
    `collapsed` holds the words that stand in no run after its first period, joined by one space. Null and
    empty texts have no runs and an empty `collapsed`. A text is whole in one task: filtering takes about
    50 bytes a word, a tree about 500 bytes for each word that can stand in a run.
    """
    text_batches()

    @F.arrow_udf(f"struct<runs:{RUNS},collapsed:string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in trimmed(batches):
            every, collapsed, held, size = [], [], [], 0
            for k in range(len(batch) + 1):
                if held and (k == len(batch) or size >= BLOCK_WORDS):
                    runs = find_runs(held)
                    every += runs
                    collapsed += [b" ".join(kept_words(w, r)) for w, r in zip(held, runs, strict=True)]
                    held, size = [], 0
                if k < len(batch):
                    # bytes.split() cuts at exactly the blanks named above.
                    held.append((batch[k].as_py() or "").encode("utf-8", "surrogatepass").split())
                    size += len(held[-1])
            flat = np.concatenate(every, axis=1) if every else np.zeros((3, 0), dtype=np.int64)
            offsets = pa.array(np.cumsum([0, *(r.shape[1] for r in every)]).astype(np.int32))
            rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], ["start", "length", "period"])
            texts = pa.array(collapsed, pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, rows), texts], ["runs", "collapsed"])

    return found(text)
