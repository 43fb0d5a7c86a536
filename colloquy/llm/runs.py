"""Periodic runs of words, by the tandem-repeat method of Gusfield and Stoye.

The words of many documents are numbered and laid end to end, each document
with numbers and an end mark of its own, so that nothing matches across two.
The suffix tree is held as a suffix array: prefix doubling orders the suffixes
and leaves a table of names for every stretch of 2, 4, 8, ... words, which
answer how far two places agree, forwards and backwards.

1. Ziv-Lempel blocks: at each place the longest stretch that also starts
   earlier. A leftmost square lies around the start of the block of its centre
   or of the one behind it, so a few lengths at each block start give squares
   that cover the leftmost one of every kind.
2. Walks along suffix links, from the suffix at i to that at i + 1, give the
   other rotations of these squares: the vocabulary is complete.
3. The suffixes that begin with a square of the vocabulary stand side by side;
   these are all its occurrences, and consecutive ones merge into runs.

A document's work is proportional to its words but for the sorting, and it
takes about 4 bytes a word for each doubling its longest repeat needs, beside
some 100 bytes. Documents are taken together up to BATCH words; a longer one
stands alone.

Edge cases: null, empty and white-space texts have no words and no runs; a null
id plants nothing; repeated rows count each, other columns are ignored, an empty
table gives an empty result; very long texts are taken whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .columns import WORD, map_batches

#: Words that are searched together, and pairs of places that are compared together.
BATCH, SLAB = 1 << 18, 1 << 20
#: Shortest run in words, and in periods.
LEAST, TIMES = 6, 4
_words = re.compile(WORD).findall


class Suffixes:
    """Order of the suffixes of a sequence of numbers, and names of its stretches.

    Numbers are below their count and the last one occurs once. slots holds the
    places in the order, of suffixes that share two numbers or more with another.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        codes = codes.astype(np.int64)
        self.names = [codes.astype(np.int32)]
        key = codes * (int(codes.max()) + 1)
        key[:-1] += codes[1:]
        self.order = np.argsort(key)
        names, slots = np.empty(n, np.int32), np.arange(n)
        names, shared = self._rename(names, key[self.order], self.order, slots)
        self.names.append(names)
        self.slots = slots = slots[shared]
        step = 2
        while len(slots):
            places = self.order[slots]
            key = names[places].astype(np.int64) * n + names[places + step]
            by = np.argsort(key)
            places = places[by]
            self.order[slots] = places
            names, shared = self._rename(names.copy(), key[by], places, slots)
            self.names.append(names)
            slots = slots[shared]
            step *= 2

    @staticmethod
    def _rename(names: np.ndarray, key: np.ndarray, places: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name places by the slot at which their sorted key begins; say which keys occur again."""
        begins = np.ones(len(key) + 1, bool)
        np.not_equal(key[1:], key[:-1], out=begins[1:-1])
        first = np.flatnonzero(begins[:-1])
        names[places] = np.repeat(slots[first], np.diff(np.append(first, len(key))))
        return names, ~(begins[:-1] & begins[1:])

    def ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Numbers that agree from places x and y on."""
        x, y = x.copy(), y.copy()
        began = x.copy()
        for level in reversed(range(len(self.names))):
            step = (self.names[level][x] == self.names[level][y]).astype(np.int64) << level
            x += step
            y += step
        return x - began

    def behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Numbers that agree before places x and y; x is the smaller."""
        x, y = x.copy(), y.copy()
        began = x.copy()
        for level in reversed(range(len(self.names))):
            from_x, from_y = np.maximum(x - (1 << level), 0), np.maximum(y - (1 << level), 0)
            step = ((x >> level > 0) & (self.names[level][from_x] == self.names[level][from_y])).astype(np.int64) << level
            x -= step
            y -= step
        return began - x


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left, -1 if none; pointers jump over larger ones."""
    padded = np.append(values, np.iinfo(np.int64).min)
    to, open_ = np.arange(-1, len(values) - 1), np.arange(len(values))
    while len(open_):
        open_ = open_[padded[to[open_]] > values[open_]]
        to[open_] = to[to[open_]]
    return to


def _blocks(codes: np.ndarray, found: Suffixes) -> np.ndarray:
    """Starts of the Ziv-Lempel blocks, and the end."""
    n = len(codes)
    places = found.order[found.slots].astype(np.int64)
    # Places are compared within those that share two numbers: later groups are lower throughout.
    group = np.cumsum(np.diff(found.names[1][places], prepend=-1) != 0)
    low = places - group * (n + 1)
    length = np.zeros(len(places), np.int64)
    for flip in (slice(None), slice(None, None, -1)):
        own, at = places[flip], group[flip]
        near = _nearest_smaller(low[flip] if flip.step is None else own - (group.max(initial=0) - at) * (n + 1))
        have = np.flatnonzero((near >= 0) & (at[near] == at))
        length[flip][have] = np.maximum(length[flip][have], found.ahead(own[near[have]], own[have]))
    inside, done = np.zeros(n + 1, np.int32), 0
    for i in np.argsort(places):
        at, size = int(places[i]), int(length[i])
        if at >= done and size > 1:
            done = at + size
            inside[at + 1] += 1
            inside[done] -= 1
    return np.append(np.flatnonzero(np.cumsum(inside[:-1]) == 0), n)


def _slabs(starts: np.ndarray, sizes: np.ndarray):
    """(start, k) for k from 1 to each start's size, in slabs."""
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + SLAB, "right")))
        size = sizes[begin:end]
        before = np.cumsum(size) - size
        yield np.repeat(starts[begin:end], size), np.arange(1, int(size.sum()) + 1) - np.repeat(before, size)
        begin = end


def _covering(codes: np.ndarray, found: Suffixes) -> list[np.ndarray]:
    """Rows (start, end, period) of stretches that hold the leftmost square of every kind."""
    n, cuts = len(codes), _blocks(codes, found)
    size = np.diff(cuts)
    rows = []

    def add(at: np.ndarray, other: np.ndarray, k: np.ndarray) -> None:
        """Squares around `at` and `other`, which is k further on."""
        right, left = found.ahead(at, other), found.behind(at, other)
        keep = right + left >= k
        at, k, right, left = at[keep], k[keep], right[keep], left[keep]
        rows.append(np.stack([at - left, at + right + k, k]))

    for h, k in _slabs(cuts[1:-1], size[:-1]):  # the right half reaches over the block's end
        same = codes[h] == codes[h - k]
        h, k = h[same], k[same]
        add(h - k, h, k)
    wide = size + np.append(size[1:], 0)
    for h, k in _slabs(cuts[1:-1], wide[1:]):  # the left half reaches over the block's start
        inside = h + k < n
        h, k = h[inside], k[inside]
        same = (codes[h] == codes[h + k]) & (codes[h - 1] == codes[h + k - 1])
        h, k = h[same], k[same]
        add(h, h + k, k)
    return rows


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of rows with the same start and end, that with the smallest period."""
    rows = rows[:, np.lexsort(rows[::-1])]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
    return rows[:, first]


def maximal_runs(codes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), by start and period, of all stretches of at least two periods that none extends.

    codes: numbers below their count plus one; the last occurs nowhere else.
    """
    found = Suffixes(codes)
    rows = _covering(codes, found)
    runs = _smallest(np.concatenate(rows, axis=1)) if rows else np.zeros((3, 0), np.int64)
    if not runs.shape[1]:
        return runs
    slots = found.slots
    places = found.order[slots].astype(np.int64)
    common = np.zeros(len(slots), np.int64)
    joined = np.flatnonzero(found.names[1][places[1:]] == found.names[1][places[:-1]]) + 1
    common[joined] = found.ahead(places[joined - 1], places[joined])
    # Place in slots of each suffix; those that share no two numbers are their own only occurrence.
    where = np.full(len(codes), -1, np.int64)
    where[places] = np.arange(len(slots))
    by_period = runs[:, np.argsort(runs[2], kind="stable")]
    cuts = np.append(np.flatnonzero(np.diff(by_period[2], prepend=0)), by_period.shape[1])
    merged = []
    for begin, end in zip(cuts[:-1], cuts[1:]):
        start, stop, period = by_period[:, begin:end]
        k = int(period[0])
        # The walk along suffix links: every rotation once.
        turns = np.minimum(k, stop - start - 2 * k + 1)
        walk = np.repeat(start - (np.cumsum(turns) - turns), turns) + np.arange(int(turns.sum()))
        squares = [walk]
        slot = where[walk]
        slot = slot[slot >= 0]
        if len(slot):
            edges = np.append(np.flatnonzero(common < 2 * k), len(slots))
            which = np.unique(np.searchsorted(edges, slot, "right") - 1)
            low, count = edges[which], edges[which + 1] - edges[which]
            many = count > 1
            low, count = low[many], count[many]
            spread = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            squares.append(places[spread])
        at = np.unique(np.concatenate(squares))
        breaks = np.flatnonzero(np.diff(at) != 1)
        merged.append(np.stack([at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)] + 2 * k, np.full(len(breaks) + 1, k)]))
    # A walk of one period leaves out squares of its own stretch, which the stretch itself has.
    runs = _smallest(np.concatenate([runs, *merged], axis=1))
    order = np.lexsort((runs[2], runs[0]))
    runs = runs[:, order]
    return runs[:, ~_within_same(runs)]


def _within_same(runs: np.ndarray) -> np.ndarray:
    """Which rows lie in another one of the same period."""
    by = np.lexsort((-runs[1], runs[0], runs[2]))
    start, end, period = runs[:, by]
    # Ends grow within a period, so the largest end before tells.
    base = period * (int(end.max(initial=0)) + 1)
    before = np.maximum.accumulate(np.append(-1, (base + end)[:-1]))
    out = np.zeros(runs.shape[1], bool)
    out[by] = base + end <= before
    return out


def planted(words: list[str], key: str | None) -> list[str]:
    """The words with the run that the query plants in one document of ten."""
    if key is None or not words:
        return words
    h = zlib.crc32(key.encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def word_runs(texts: list[list[str]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Runs (start, length, period) of each list of words, with length >= max(least, times * period); times is at least 2."""
    codes, ends, base, at = [], [], 0, 0
    for words in texts:
        own: dict[str, int] = {}
        codes.append(np.array([own.setdefault(w, len(own)) for w in words] + [len(own)], np.int64) + base)
        base += len(own) + 1
        at += len(words) + 1
        ends.append(at)
    if not codes:
        return []
    runs = maximal_runs(np.concatenate(codes))
    length = runs[1] - runs[0]
    start, length, period = np.stack([runs[0], length, runs[2]])[:, length >= np.maximum(least, times * runs[2])]
    begins = np.array([0, *ends[:-1]])
    cuts = np.searchsorted(start, [*begins, at])
    return [np.stack([start[a:b] - begin, length[a:b], period[a:b]], axis=1) for a, b, begin in zip(cuts[:-1], cuts[1:], begins)]


def collapse(words: list[str], runs: np.ndarray) -> list[str]:
    """The words that no run repeats: of each run its first period stays, unless another run drops it."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _digest(key: str | None, words: list[str], runs: np.ndarray) -> tuple:
    listed = runs.tolist()
    best = min(listed, key=lambda r: (-r[1], r[0], r[2])) if listed else (None, None, None)
    exponent = best[1] * 1000 // best[2] if listed else None
    return key, len(listed), *best, exponent, _sha("".join("%d,%d,%d\n" % tuple(r) for r in listed)), _sha(" ".join(collapse(words, runs)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def document_runs(docs: DataFrame, plant=planted, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run, and digests of all runs and of the collapsed words.

    plant(words, id as text) gives the words that are searched.
    """

    def some(held: list[tuple]) -> list[tuple]:
        return [_digest(key, words, runs) for (key, words), runs in zip(held, word_runs([words for _, words in held], least, times))]

    def run(batches):
        for batch in batches:
            rows, held, size = [], [], 0
            for key, text in zip(batch["doc_id"], batch["text"]):
                words = plant(_words(text or ""), key)
                if held and size + len(words) > BATCH:
                    rows += some(held)
                    held, size = [], 0
                held.append((key, words))
                size += len(words) + 1
            rows += some(held)
            out = pd.DataFrame(rows, columns=["doc_id", *COLUMNS])
            yield out.astype({c: "Int64" for c in COLUMNS[:5]})

    schema = docs.select("doc_id").schema
    for c in COLUMNS:
        schema = schema.add(c, "string" if c.endswith("sha256") else "long")
    return map_batches(docs.select("doc_id", "text"), run, schema)
