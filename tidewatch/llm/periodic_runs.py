"""Periodic runs of words in whole texts, by suffix trees.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends.  For every text, Ukkonen trees of its words and of
their reversal answer longest-common-extension queries in constant time: the
string depth of two leaves' lowest common ancestor is the smallest depth between
them on the Euler tour.  Roots of runs are Lyndon words: for each of two opposite
word orders the longest Lyndon word at every position (up to the next smaller
suffix, read off the tree's leaf order) is a candidate period, extended in both
directions.  Every run has such a root in one of the orders.

Trees are built for the stretches of a text that can hold a run: all three-word
sequences inside a run of exponent e occur at least e - 1 times, so words outside
of such sequences belong to none.  Nothing is cut off: the stretches hold every run
whole.  Each text is independent work, so rows need no shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.common import map_texts

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Tour entries per block of the range-minimum index.
BLOCK = 16
_END = -1


class SuffixTree:
    """Ukkonen's tree of a list of ids >= 0.  Leaf k is the suffix from k; the
    end mark, a leaf of its own, has the highest number."""

    def __init__(self, ids: list[int]):
        self.size = len(ids)
        word = ids + [_END]
        total = len(word)
        start, stop, link = [0], [0], [0]
        kids: list[dict | None] = [{}]
        leaf = [-1]
        node = edge = length = waiting = leaves = 0
        for i, c in enumerate(word):
            last = 0
            waiting += 1
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(word[edge])
                if child is None:
                    kids[node][word[edge]] = len(start)
                    parent = node
                else:
                    begin = start[child]
                    span = (stop[child] if stop[child] <= i else i + 1) - begin
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if word[begin + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    parent = len(start)
                    start.append(begin)
                    stop.append(begin + length)
                    link.append(0)
                    leaf.append(-1)
                    start[child] = begin + length
                    kids.append({word[begin + length]: child, c: parent + 1})
                    kids[node][word[edge]] = parent
                start.append(i)
                stop.append(total)
                link.append(0)
                kids.append(None)
                leaf.append(leaves)
                leaves += 1
                if last:
                    link[last] = parent
                last = parent
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self._start, self._stop, self._kids, self._leaf = start, stop, kids, leaf
        self._tour()

    def _tour(self) -> None:
        """Euler tour of string depths, and each leaf's place on it."""
        total = self.size + 1
        depth = [0] * len(self._start)
        tour, place, stack = [], [0] * total, [0]
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(~node)
            elif (kids := self._kids[node]) is None:
                place[self._leaf[node]] = len(tour)
                tour.append(total - self._leaf[node])
            else:
                here = depth[node]
                tour.append(here)
                for symbol in sorted(kids, reverse=True):
                    child = kids[symbol]
                    depth[child] = here + self._stop[child] - self._start[child]
                    stack += (~here, child)
        self._place = np.array(place)
        self._index(np.array(tour, np.int32))

    def _index(self, tour: np.ndarray) -> None:
        """Range minima: prefixes and suffixes of blocks, doubling tables over blocks."""
        blocks = -(-len(tour) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(tour)] = tour
        rows = padded.reshape(blocks, BLOCK)
        self._flat = padded
        self._head = np.minimum.accumulate(rows, axis=1).ravel()
        self._tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self._doubled = [rows.min(axis=1)]
        while 2 ** len(self._doubled) <= blocks:
            half = 2 ** (len(self._doubled) - 1)
            below = self._doubled[-1]
            self._doubled.append(np.minimum(below[:-half], below[half:]))

    def _minima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        first, last = low // BLOCK, high // BLOCK
        out = np.minimum(self._tail[low], self._head[high])
        near = np.flatnonzero(first == last)
        if len(near):
            steps = np.minimum(low[near, None] + np.arange(BLOCK), high[near, None])
            out[near] = self._flat[steps].min(axis=1)
        gap = last - first - 1
        far = np.flatnonzero(gap > 0)
        levels = np.frexp(gap[far])[1] - 1
        for level in np.unique(levels):
            at = far[levels == level]
            table = self._doubled[level]
            out[at] = np.minimum(out[at], np.minimum(table[first[at] + 1], table[last[at] - 2 ** level]))
        return out

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of the suffixes from ``a`` and ``b`` (different places)."""
        x, y = self._place[a], self._place[b]
        return self._minima(np.minimum(x, y), np.maximum(x, y)).astype(np.int64)

    def ranks(self, descending: bool) -> list[int]:
        """Each suffix's rank by ascending or descending ids; ends come first."""
        ranks, n, stack = [0] * (self.size + 1), 0, [0]
        while stack:
            node = stack.pop()
            kids = self._kids[node]
            if kids is None:
                ranks[self._leaf[node]] = n
                n += 1
                continue
            symbols = sorted(kids, reverse=not descending)      # the last one is visited first
            if descending and symbols[0] == _END:
                symbols.append(symbols.pop(0))
            stack += [kids[s] for s in symbols]
        return ranks


def lyndon_lengths(ranks: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at every position: up to the next
    smaller suffix."""
    size = len(ranks) - 1
    out = [0] * size
    open_, held = [], []
    for i, r in enumerate(ranks):
        while held and held[-1] > r:
            held.pop()
            j = open_.pop()
            out[j] = i - j
        open_.append(i)
        held.append(r)
    return np.array(out, np.int64)


def runs_of(ids: list[int], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of all runs of ``ids``, by start and period."""
    size = len(ids)
    forward, backward = SuffixTree(ids), SuffixTree(ids[::-1])
    at, period = [], []
    for descending in (False, True):
        lengths = lyndon_lengths(forward.ranks(descending))
        some = np.flatnonzero(lengths * min_exponent <= size)
        at.append(some)
        period.append(lengths[some])
    i, p = np.concatenate(at), np.concatenate(period)
    left = backward.extension(size - i, size - i - p)
    length = left + p + forward.extension(i, i + p)
    good = length >= np.maximum(min_length, min_exponent * p)
    return np.unique(np.stack([i - left, length, p], axis=1)[good], axis=0)


def _stretches(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Spans of words covered by three-word sequences that occur ``least`` times."""
    if len(ids) < 3:
        return []
    width = int(ids.max()) + 1
    _, pair = np.unique(ids[:-1] * width + ids[1:], return_inverse=True)
    _, triple, counts = np.unique(pair[:-1] * width + ids[2:], return_inverse=True, return_counts=True)
    often = np.concatenate([[False], counts[triple] >= least, [False]])
    turns = np.flatnonzero(often[1:] != often[:-1])
    return [(int(b), int(e) + 2) for b, e in zip(turns[::2], turns[1::2])]


def text_runs(words: list, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start and period."""
    if min_exponent < 2 or min_length < 3:
        raise ValueError("runs have an exponent of at least 2 and at least 3 words")
    if len(words) < min_length:
        return []
    names: dict = {}
    ids = [names.setdefault(w, len(names)) for w in words]
    if len(names) == len(ids):
        return []
    least = min(max(min_length, min_exponent) - 2, min_exponent - 1)
    found, todo = [], _stretches(np.array(ids, np.int64), least)
    while todo:
        begin, end = todo.pop()
        if end - begin < min_length:
            continue
        part = np.array(ids[begin:end], np.int64)
        again = _stretches(np.unique(part, return_inverse=True)[1], least)
        if again and again[0] == (0, end - begin):
            local: dict = {}
            for start, length, period in runs_of([local.setdefault(w, len(local)) for w in part.tolist()], min_exponent, min_length).tolist():
                found.append((begin + start, length, period))
        else:
            todo += [(begin + b, begin + e) for b, e in again]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return [w for w, gone in zip(words, covered.tolist()) if not gone]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
_FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
    T.StructField("strongest", _RUN), T.StructField("collapsed", T.StringType()),
]


def with_runs(docs: DataFrame, keep: list[str], text_col: str = "text",
              min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """The runs of every whole text: ``row`` (the ``keep`` columns), ``n_words``,
    ``runs`` (all of them, by start and period), ``strongest`` (greatest length /
    period, ties to the smallest start, then period; null without runs) and
    ``collapsed`` (the words left when each run keeps its first period, joined by
    one space).  Words end at ``\\x20`` and ``\\x09-\\x0D`` and are compared byte
    for byte.

    Defined cases: null, empty and white-space texts have no words, no runs and an
    empty ``collapsed``; texts of any length are read whole, one text in one task;
    repeated rows give equal results, one per row; carried columns may have any
    name or value, null ids included; an empty table gives an empty result.
    """
    def make():
        def apply(texts: list) -> tuple:
            n_words, runs, tops, left = [], [], [], []
            for text in texts:
                words = (text or "").encode().split()
                found = text_runs(words, min_exponent, min_length)
                top = strongest(found)
                named = [dict(zip(("start", "length", "period"), r)) for r in found]
                n_words.append(len(words))
                runs.append(named)
                tops.append(named[found.index(top)] if top else None)
                left.append(b" ".join(collapse(words, found)).decode())
            return n_words, runs, tops, left
        return apply

    return map_texts(docs, text_col, keep, make, _FIELDS)
