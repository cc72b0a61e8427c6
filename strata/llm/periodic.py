"""Runs of repeated words by the branching-tandem test on an enhanced suffix array.

The words of a document are sorted as suffixes; the LCP array cuts them into
intervals of suffixes with the same beginning. For an interval of depth d and
a suffix i in it, the words from i repeat at once (a square of period d) if
suffix i + d lies in the interval as well, and the square is *branching*
(the word after it breaks the period) if the two lie in different children of
the interval. It is enough to look from the smaller children, at i + d and
at i - d, by a membership test on the inverse suffix array: O(n log n) looks,
and no tree is built.

A branching square is the last one of its run: rotated to the left word by
word, as long as the period holds, it gives the run. Squares of a run whose
period is a multiple of a shorter one's end where that run ends, and are left out.

All documents of a batch are sorted together, their words numbered apart, so
that numpy works on long arrays and no suffix reaches into another document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import utf8

MIN_LENGTH = 12
SLICE_BYTES = 1 << 20  # text of documents that are sorted together (one document at least)

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RUNS = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4 ... symbols) of a sequence of numbers >= 0.

    Prefix doubling; a round sorts only suffixes that are still equal to another. A suffix
    that ends sorts before one that goes on.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_by = symbols[order]
    fresh = np.concatenate(([True], sorted_by[1:] != sorted_by[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))  # the first place of its group
    levels = [rank]
    width = 1
    open_ = ~(fresh & np.append(fresh[1:], True))  # places in groups of several
    while open_.any():
        places = np.flatnonzero(open_)
        suffixes = order[places]
        ahead = suffixes + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[suffixes]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[places] = suffixes
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank = rank.copy()
        rank[suffixes] = np.maximum.accumulate(np.where(new, places, 0))
        levels.append(rank)
        open_[places] = ~(new & np.append(new[1:], True))
        width *= 2
    return order, levels


def lcp_array(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[k]: symbols that the suffixes at places k - 1 and k have in common (lcp[0] = 0)."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        width = 1 << level
        inside = np.flatnonzero(np.maximum(a, b) + width <= n)
        same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
        common[same] += width
        a[same] += width
        b[same] += width
    return np.concatenate(([0], common)) if n else common


def _small_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, depth, low, high): each child [first, last] of an LCP interval [low, high] of that depth,
    but for one largest child of the interval."""
    found: list[tuple[int, int, int, int, int]] = []
    # stack of open intervals: depth, first place, starts of the children so far
    stack: list[tuple[int, int, list[int]]] = []

    def close(depth: int, low: int, starts: list[int], high: int) -> None:
        ends = [s - 1 for s in starts[1:]] + [high]
        sizes = [e - s for s, e in zip(starts, ends)]
        largest = sizes.index(max(sizes))
        found.extend((s, e, depth, low, high) for c, (s, e) in enumerate(zip(starts, ends)) if c != largest)

    places = np.flatnonzero(lcp)
    before = -1
    for k, depth in zip(places.tolist(), lcp[places].tolist()):
        if k != before + 1:  # zeros in between close all
            while stack:
                d, low, starts = stack.pop()
                close(d, low, starts, before)
        low = k - 1
        while stack and stack[-1][0] > depth:
            d, low, starts = stack.pop()
            close(d, low, starts, k - 1)
        if stack and stack[-1][0] == depth:
            stack[-1][2].append(k)
        else:
            stack.append((depth, low, [low, k]))
        before = k
    while stack:
        d, low, starts = stack.pop()
        close(d, low, starts, before)
    return tuple(np.array(found, np.int64).reshape(-1, 5).T)


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that the next symbol (or the end) breaks, by period and start."""
    if len(symbols) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order, levels = suffix_array(symbols)
    place = levels[-1]  # the inverse suffix array
    first, last, depth, low, high = _small_children(lcp_array(order, levels))
    size = last - first + 1
    child = np.repeat(np.arange(len(size)), size)
    i = order[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[child]]
    d = depth[child]
    starts, periods = [], []
    for other, start in ((i + d, i), (i - d, i - d)):
        there = np.flatnonzero((other >= 0) & (other < len(symbols)))
        c, p = child[there], place[other[there]]
        apart = (p >= low[c]) & (p <= high[c]) & ((p < first[c]) | (p > last[c]))
        starts.append(start[there[apart]])
        periods.append(d[there[apart]])
    pairs = np.unique(np.stack((np.concatenate(periods), np.concatenate(starts)), axis=1), axis=0)
    return pairs[:, 1], pairs[:, 0]


def _rotated(symbols: np.ndarray, start: int, period: int, least: int) -> int:
    """How far to the left the square at ``start`` can be rotated: the start of its run (not below ``least``)."""
    step = 16
    while start > least:
        at = max(least, start - step)
        apart = np.flatnonzero(symbols[at:start] != symbols[at + period:start + period])
        if len(apart):
            return at + int(apart[-1]) + 1
        start, step = at, step * 2
    return start


def find_runs(symbols: np.ndarray, firsts: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period), at least two periods long, by start and period.

    ``firsts`` are the starts of the documents that ``symbols`` holds one after another, no symbol in two of them.
    """
    firsts = np.zeros(1, np.int64) if firsts is None else firsts
    starts, periods = branching_squares(symbols)
    least = firsts[np.searchsorted(firsts, starts, "right") - 1]
    ending: dict[int, list[tuple[int, int]]] = {}  # end -> runs that end there: (start, period)
    out = []
    for i, p, low in zip(starts.tolist(), periods.tolist(), least.tolist()):
        runs = ending.setdefault(i + 2 * p, [])
        if any(p % q == 0 and s <= i for s, q in runs):
            continue  # a square of a shorter period's run
        start = _rotated(symbols, i, p, low)
        runs.append((start, p))
        out.append((start, i + 2 * p - start, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _slices(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t or b"")
        size += len(part[-1])
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _of_slice(texts: list[bytes], min_length: int) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """The runs and the collapsed text of each of some documents, sorted together."""
    words = [t.split() for t in texts]  # on bytes: the six ASCII blanks
    counts = np.array([len(w) for w in words], np.int64)
    firsts = np.cumsum(counts) - counts
    symbols = np.empty(int(counts.sum()), np.int64)
    base = 0
    for w, first in zip(words, firsts.tolist()):
        codes: dict[bytes, int] = {}
        symbols[first:first + len(w)] = [codes.setdefault(x, base + len(codes)) for x in w]
        base += len(codes)
    held = np.flatnonzero(counts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(symbols, firsts[held]):
        if length >= min_length:
            doc = int(held[np.searchsorted(firsts[held], start, "right") - 1])
            found[doc].append((start - int(firsts[doc]), length, period))
    for w, runs in zip(words, found):
        if runs:
            edges = np.zeros(len(w) + 1, np.int64)
            for start, length, period in runs:
                edges[start + period] += 1
                edges[start + length] -= 1
            w = [w[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
        yield runs, b" ".join(w).decode()


def periodic(text: str | Column, min_length: int = MIN_LENGTH) -> Column:
    """struct(runs, collapsed) of a whole text, see ``periodic_runs``."""
    def run(texts: pa.Array) -> pa.Array:
        runs, collapsed = [], []
        for part in _slices(utf8(texts)):
            for found, kept in _of_slice(part, min_length):
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                collapsed.append(kept)
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        return pa.StructArray.from_arrays([pa.array(runs, kind), pa.array(collapsed, pa.string())], ["runs", "collapsed"])

    return F.arrow_udf(run, RUNS)(text)


def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with two more columns, ``runs`` and ``collapsed``.

    Words are what lies between ASCII blanks, numbered from 0. ``runs``: array of struct(start,
    length, period) by start, then period: the stretches of consecutive words with smallest period
    ``period``, at least two periods and ``min_length`` words long, that no neighbouring word extends.
    ``collapsed``: the words that stay, joined by one blank, where every run keeps its first period.

    Null, empty and blank texts have no runs and collapse to the empty text. Every row stands for
    itself: repeated rows and ids stay, an empty table stays empty, and columns of ``docs`` named
    ``runs`` or ``collapsed`` give way. No shuffle. A task sorts about ``SLICE_BYTES`` of text at once,
    or one longer document, in memory proportional to its words times the logarithm of its longest repeat.
    """
    kept = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    found = docs.select(*kept, periodic(text_col, min_length).alias("runs"))
    return found.select(*kept, F.col("runs")["runs"].alias("runs"), F.col("runs")["collapsed"].alias("collapsed"))
