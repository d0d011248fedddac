"""Periodic run detection by online dyadic square catching.

A run is a maximal stretch of words with smallest period q, at least
``max(least, 2 q)`` words long; it is what the squares (a word sequence twice in a
row) of period q that overlap merge into.

Method. Words are appended to a stream. Each level k cuts the stream into completed
blocks of ``2**k`` words. A square of period ``2 * 2**k <= q < 4 * 2**k`` holds a whole
block in its first half, so the block comes again q words later: the catchers of a
level are its blocks two and three blocks back, whose periods are in that range.
Every appended word compares the last ``2**k`` words (the suffix) with the
two live catchers of each level. Where a catcher first agrees it reaches back over
fewer than ``2**k`` words and then forward as words come; the stretch of words equal
to the word q before them is the run, open until a word differs. Catchers that
agree after the one before them agreed belong to the same run and report nothing.
Periods below 8 are caught by blocks of two words, as a run has ``least`` words.

Equality of ``2**k`` words is that of a 64-bit tree hash of two hashes of half the
length. ``append`` takes any number of words, one or a whole document: the comparisons
are the same and run as array operations. Work is n log n, memory one hash a word and
level, in one task, for one block of texts (or one longer text).

Rows: null or empty text has no words, no run. Null and repeated doc_ids are ordinary
rows: every row is judged alone. Extra columns are ignored; an empty table gives none.
Ties cannot occur: start and period tell runs apart.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.common import U, Words, mix64, text_blocks

#: shortest run
LEAST = 12
#: words appended at once
CHUNK = 1 << 16
#: the lowest level, and the periods its blocks catch
LOWEST, SMALL = 1, 8

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SquareCatcher:
    """Runs of a stream of word hashes, kept up to date as words are appended."""

    def __init__(self, capacity: int = 0, least: int = LEAST):
        self.n, self.least, self.capacity = 0, least, capacity
        self.names: list[np.ndarray] = []  # names[k][i]: hash of words i .. i + 2**k
        self.done: list[int] = []  # how many of names[k] are there
        none = np.zeros(0, np.int64)
        self.open = (none, none, none)  # (period, first, end) of stretches that reach the last word
        self.closed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Add words; ``longest``: no run among them is longer than this."""
        n0, n1 = self.n, self.n + len(words)
        if n1 > self.capacity:
            self.capacity = max(n1, 2 * self.capacity, 64)
            self.names = [np.concatenate([x, np.zeros(self.capacity - len(x), U)]) for x in self.names]
        self.n = n1
        self._name(words, n0, longest)
        period, first, end = self.open
        found = [(period, first, self._forward(end, period, 0))]
        for k in range(LOWEST, self.levels):
            found += self._catch(k, n0, n1)
        period, first, end = (np.concatenate(x) for x in zip(*found, strict=True))
        live = end + period == n1
        self.open = (period[live], first[live], end[live])
        whole = ~live & (end - first + period >= np.maximum(self.least, 2 * period))
        self.closed.append((period[whole], first[whole], end[whole]))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of the runs so far, by start, then period."""
        period, first, end = (np.concatenate(x) for x in zip(*self.closed, self.open, strict=True))
        whole = end - first + period >= np.maximum(self.least, 2 * period)
        period, start, end = period[whole], first[whole], (end + period)[whole]
        # a multiple of a run's smallest period has the same extent
        order = np.lexsort((period, end, start))
        period, start, end = period[order], start[order], end[order]
        new = np.ones(len(order), bool)
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        period, start, end = period[new], start[new], end[new]
        order = np.lexsort((period, start))
        return start[order], (end - start)[order], period[order]

    def _name(self, words: np.ndarray, n0: int, longest: int | None) -> None:
        if not self.names:
            self.names.append(np.zeros(self.capacity, U))
            self.done.append(0)
        self.names[0][n0:self.n] = words
        self.done[0] = self.n
        k = 1
        # a level's first suffix to compare ends after three blocks, its shortest square has four
        while k == LOWEST or 3 << k <= self.n and (longest is None or 4 << k <= longest):
            if k == len(self.names):
                self.names.append(np.zeros(self.capacity, U))
                self.done.append(0)
            half, last = 1 << k - 1, max(0, self.n - (1 << k) + 1)
            at = self.done[k]
            if last > at:
                below = self.names[k - 1]
                x = below[at:last] * U(0x9E3779B97F4A7C15)
                x += below[at + half:last + half]
                x ^= x >> U(29)
                x *= U(0xBF58476D1CE4E5B9)
                x ^= x >> U(32)
                self.names[k][at:last] = x
                self.done[k] = last
            k += 1
        self.levels = k

    def _catch(self, k: int, n0: int, n1: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stretches that a catcher of level k meets in words n0 .. n1."""
        size, names = 1 << k, self.names[k]
        out = []
        for back in range(SMALL // size) if k == LOWEST else (2, 3):
            # row r: the suffixes that end at r * size .. (r + 1) * size, against one block
            low, high = max((n0 + 1) // size - 1, back + 1), n1 // size + 1
            if low >= high:
                continue
            same = names[(low - 1) * size:(high - 1) * size].reshape(-1, size) == names[(low - back - 1) * size:(high - back - 1) * size:size, None]
            new = same.copy()
            new[1:] &= ~same[:-1]
            at = np.flatnonzero(new)
            t, period = low * size + at, at % size + back * size
            ok = (t > n0) & (t <= n1) & (period > 0)
            t, period = t[ok], period[ok]
            if len(t):
                out.append((period, self._backward(t - period - size, period, k), self._forward(t - period, period, k)))
        return out

    def _backward(self, i: np.ndarray, period: np.ndarray, k: int) -> np.ndarray:
        """The first word of the stretch that holds i .. ; fewer than 2**k words back."""
        i = i.copy()
        for h in range(k - 1, -1, -1):
            to = i - (1 << h)
            ok = to >= 0
            ok[ok] = self.names[h][to[ok]] == self.names[h][(to + period)[ok]]
            i[ok] = to[ok]
        return i

    def _forward(self, i: np.ndarray, period: np.ndarray, k: int) -> np.ndarray:
        """The end of the stretch up to i: ever longer steps, then ever shorter ones."""
        i = i.copy()

        def step(h: int, some: np.ndarray) -> np.ndarray:
            some = some[(i + period)[some] + (1 << h) <= self.n]
            some = some[self.names[h][i[some]] == self.names[h][(i + period)[some]]]
            i[some] += 1 << h
            return some

        some, h = np.arange(len(i)), k
        while len(some):
            some, h = step(h, some), min(h + 1, self.levels - 1)
        every = np.arange(len(i))
        for h in range(self.levels - 1, -1, -1):
            step(h, every)
        return i


def _stream_runs(hashes: np.ndarray, bounds: np.ndarray, least: int):
    """Runs of each document of a block: (document, start in it, length, period).

    The documents form one stream, longest first, each ended by a word of its own,
    which no run can hold."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= least]
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    sizes = sizes[order]
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    stream = np.empty(at[-1], U)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    stream[inside] = hashes[np.arange(sizes.sum()) + np.repeat(bounds[order] - (np.cumsum(sizes) - sizes), sizes)]
    stream[~inside] = mix64(np.arange(1, len(order) + 1, dtype=U) * U(0xD6E8FEB86659FD93))
    catcher = SquareCatcher(len(stream), least)
    for s in range(0, len(stream), CHUNK):
        d = np.searchsorted(at, s, "right") - 1
        catcher.append(stream[s:s + CHUNK], int(sizes[d]))
    start, length, period = catcher.runs()
    d = np.searchsorted(at, start, "right") - 1
    return order[d], start - at[d], length, period


def _runs(least: int):
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for i, j, data, off in text_blocks(batch.column(1)):
                words = Words(data, off)
                doc, start, length, period = _stream_runs(words.hashes(), words.bounds, least)
                by = np.lexsort((period, start, doc))
                doc, start, length, period = doc[by], start[by], length[by], period[by]
                first = words.bounds[doc] + start
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, first + period, 1)
                np.add.at(change, first + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                at = np.searchsorted(doc, np.arange(j - i + 1))
                collapsed = []
                for d in range(j - i):
                    text = data[off[d]:off[d + 1]].tobytes().split()  # bytes.split: exactly the six ASCII white spaces
                    if at[d] < at[d + 1]:
                        text = compress(text, kept[words.bounds[d]:words.bounds[d + 1]].tolist())
                    collapsed.append(b" ".join(text))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)),
                                                 pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)], fields=list(struct)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(words.bounds).astype(np.int64)), lists, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, its runs by start, then period, and the text collapsed:
    its words without those that a run holds after its first period, joined by a space."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_runs(least), SCHEMA)
