"""Substring dedup: repeated windows of a fixed number of words.

Method. Every window of ``width`` words gets a Rabin-Karp hash; windows are
counted in Spark and the repeated ones merge into maximal removal intervals.
A word goes when some window that covers it also starts in a document with a
smaller ``doc_id`` (judged on the input, not on what is left).

Counting one row per window would shuffle as many rows as the corpus has
words, so windows are pre-aggregated without loss:

* Each window is assigned the leftmost smallest hash of its ``GRAM``-word
  grams, its *anchor*. The anchor depends on the window's words alone, so equal
  windows share it. Consecutive windows with the same anchor occurrence form a
  *run* (about 20 windows); a run's hash covers all its words.
* Runs are counted by anchor, with partial aggregates. An anchor seen once has
  only unrepeated windows and leaves (most of the corpus).
* Equal runs hold equal windows: all documents but the first of a run lose all
  of its windows. Runs learn their first document by a join on the run; a run that holds
  a great share of all rows gets it by broadcast instead, so no task gathers one run. One occurrence per distinct run is left to compare.
* Where an anchor has several distinct runs (edges of shared passages, edits),
  the Rabin-Karp hashes of their windows are counted: a window of the first
  document of a run goes when the same window starts in an earlier document.

Equality is decided on 128 bits (anchor hash and window or run hash).
Null doc_id rows have no order: they are returned unchanged and remove nothing.
Null text has no words. Rows that repeat a doc_id are parts of one document:
none removes from the other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.common import U, Rolling, Words, mix64, signed, text_blocks, written

#: words of an anchor gram
GRAM = 8
#: a run with more than one HEAVY_SHARE-th of all rows (and HEAVY_LEAST rows) is heavy: there are fewer than HEAVY_SHARE
HEAVY_SHARE, HEAVY_LEAST = 1000, 1000

RUNS = "doc_id long, t long, g long, r long, start int, n int"
WINDOWS = "doc_id long, t long, g long, r long, i int, h long"
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, removed array<struct<s:int,e:int>>"


def _leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value of every stretch of ``width``."""
    idx, reach = np.arange(len(values)), 1
    while 2 * reach <= width:
        a, b = idx[:-reach], idx[reach:]
        idx = np.where(values[a] <= values[b], a, b)
        reach *= 2
    if reach < width:
        shift = width - reach
        a, b = idx[:-shift], idx[shift:]
        idx = np.where(values[a] <= values[b], a, b)
    return idx


def _runs(words: Words, roll: Rolling, width: int, gram: int):
    """(document row, first window, windows, anchor hash, run hash) of every run."""
    n_win = len(words.starts) - width + 1
    if n_win <= 0:
        return None
    doc = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    inside = doc[:n_win] == doc[width - 1:]
    grams = roll.windows(gram)
    anchor = _leftmost_min(grams, width - gram + 1)[:n_win]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (doc[1:n_win] != doc[:n_win - 1])
    end = inside.copy()
    end[:-1] &= new[1:] | ~inside[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    if not len(first):
        return None
    n, at = last - first + 1, anchor[first]
    r = mix64(roll.spans(first, last + width) + (at - first).astype(U) * U(0xA24BAED4963EE407))
    return doc[first], first, n, grams[at], r


def _scan(width: int, gram: int):
    def run(batches):
        for batch in batches:
            ids, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for i, j, data, off in text_blocks(batch.column(2)):
                words = Words(data, off)
                found = _runs(words, Rolling(words.hashes()), width, gram)
                if found is None:
                    continue
                d, first, n, g, r = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j][d]), pa.array(marks[i:j][d]), pa.array(signed(g)), pa.array(signed(r)),
                     pa.array((first - words.bounds[d]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["doc_id", "t", "g", "r", "start", "n"])
    return run


def _window_hashes(width: int):
    """Window hashes of the runs listed beside a document's text."""
    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            some = [k for k in range(len(lists)) if lists[k].is_valid]
            if not some:
                continue
            rows = batch.take(pa.array(some))
            ids, marks = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = rows.column(3)
            flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
            start, n, g, r = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "g", "r"))
            at = np.concatenate([[0], np.cumsum(sizes)])
            for i, j, data, off in text_blocks(rows.column(2)):
                words = Words(data, off)
                h = Rolling(words.hashes()).windows(width)
                own = slice(at[i], at[j])
                row = np.repeat(np.arange(i, j), sizes[i:j])
                k = n[own].astype(np.int64)
                base = np.repeat(words.bounds[row - i] + start[own], k)
                step = np.arange(len(base)) - np.repeat(np.cumsum(k) - k, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[row], k)), pa.array(np.repeat(marks[row], k)), pa.array(np.repeat(g[own], k)),
                     pa.array(np.repeat(r[own], k)), pa.array(step.astype(np.int32)), pa.array(signed(h[base + step]))],
                    names=["doc_id", "t", "g", "r", "i", "h"])
    return run


def _cut(width: int):
    """Apply a document's window intervals to its text."""
    out = pa.struct([("s", pa.int32()), ("e", pa.int32())])

    def run(batches):
        for batch in batches:
            cols = [[], [], [], [], [], []]
            for doc_id, text, cuts in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                words = (text or "").encode().split()  # bytes.split: exactly the six ASCII white spaces
                spans = []
                for s, e in sorted((c["s"], c["e"] + width - 1) for c in cuts or ()):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                kept, at = [], 0
                for s, e in spans:
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                left = b" ".join(kept)
                for c, v in zip(cols, (doc_id, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest(),
                                       left.decode(), [{"s": s, "e": e} for s, e in spans])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.list_(out))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"])
    return run


def substring_dedup(docs: DataFrame, width: int = 50, gram: int = GRAM) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256, the kept text (words joined
    by one space) and ``removed``, its maximal removal intervals in words."""
    gram = min(gram, width)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # t tells rows that repeat a doc_id apart
    texts = texts.select("doc_id", F.xxhash64("text").alias("t"), "text")
    runs = written(texts.where("doc_id IS NOT NULL").mapInArrow(_scan(width, gram), RUNS), "runs")
    # anchors that occur more than once; several distinct runs: compare windows
    shared = written(
        runs.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min("r").alias("r0"), F.max("r").alias("r1"))
        .where("c > 1").select("g", (F.col("r0") != F.col("r1")).alias("several")), "anchors")
    hits = written(runs.join(shared, "g"), "shared-runs")
    first = written(hits.groupBy("g", "r").agg(F.min(F.struct("doc_id", "t", "start", "n")).alias("at"), F.count(F.lit(1)).alias("c")), "first-runs")
    # runs with a great share of all rows are few: their first documents are broadcast and their rows stay in place
    many = max(HEAVY_LEAST, hits.count() // HEAVY_SHARE)
    heavy = written(first.where(F.col("c") > many).select(F.col("g").alias("hg"), F.col("r").alias("hr"), F.col("at.doc_id").alias("d0")), "heavy-runs")
    marked = hits.join(F.broadcast(heavy), (F.col("g") == F.col("hg")) & (F.col("r") == F.col("hr")), "left").drop("hg", "hr")
    light = marked.where("d0 IS NULL").drop("d0").join(first.where(F.col("c") <= many).select("g", "r", F.col("at.doc_id").alias("d0")), ["g", "r"])
    own = marked.where("d0 IS NOT NULL").unionByName(light)
    later = own.where("doc_id > d0").select("doc_id", "t", F.col("start").alias("s"), (F.col("start") + F.col("n")).alias("e"))
    # one occurrence of each distinct run of an anchor with several: its window hashes
    reps = (first.join(shared.where("several").select("g"), "g").select("g", "r", "at.*")
            .groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "n", "g", "r")).alias("cuts")))
    windows = texts.join(reps, ["doc_id", "t"], "left").select("doc_id", "t", "text", "cuts")
    windows = written(windows.mapInArrow(_window_hashes(width), WINDOWS), "windows")
    earliest = written(
        windows.groupBy("g", "h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("g", "h", "lo"),
        "repeated-windows")
    gone = windows.join(earliest, ["g", "h"]).where("lo < doc_id").groupBy("g", "r").agg(F.collect_list("i").alias("at"))
    partly = (own.where("several AND doc_id = d0").select("g", "r", "doc_id", "t", "start").join(gone, ["g", "r"])
              .select("doc_id", "t", "start", F.explode("at").alias("i"))
              .select("doc_id", "t", (F.col("start") + F.col("i")).alias("s"), (F.col("start") + F.col("i") + 1).alias("e")))
    cuts = later.unionByName(partly).groupBy("doc_id", "t").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))
    return texts.join(cuts, ["doc_id", "t"], "left").select("doc_id", "t", "text", "cuts").mapInArrow(_cut(width), DIGEST)
