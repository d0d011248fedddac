"""Toxicity by the nearest labelled examples, in exact TF-IDF cosine.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.

Fit. ``FIT_ROWS`` labelled documents with the smallest hashes of their ids, whole, are the
examples (equal texts with equal labels are one). The vocabulary is the words whose
presence tells the labels apart: likelihood-ratio statistic G² at least ``STRENGTH``
(chance under one in 200,000 a word). Words that do not would drown the cosine of a long
text in a few insults. Document frequencies of the vocabulary are counted over all documents.

Space. Weight (1 + ln count) * idf, idf = ln((1 + N) / (1 + df)) + 1, length 1; similarity is
the cosine.

Search. The examples lie in blocks of ``BLOCK``, alike ones together. The index holds for
each term and block the postings and their largest weight. A text adds up its bound
in every block, visits blocks from the highest bound and stops where a
bound is under its ``neighbours``-th best similarity: exact, no example is lost. Similarities
are held to 9 decimals; ties go to the smaller doc_id, then label 0.

Score. Neighbours vote for their label with weight similarity / (distance + ``SOFT``),
beside a vote of the rate of label 1 among examples without any vocabulary word. A logistic
curve, fitted to the leave-one-out votes of the examples, turns votes into probabilities. A
text without a vocabulary word (null and empty texts too) has no neighbour and scores that
rate. evidence lists the neighbours: doc_id, label, similarity.

Rows: null and repeated doc_ids are scored as ordinary rows; as an example a repeated doc_id
counts once, with its smallest text. Labels other than 0 and 1 are no labels; without labels of both
kinds the score is the rate of 1 (0.5 with none). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.common import Words, byte_table, text_blocks

#: labelled documents that may be examples
FIT_ROWS = 4000
#: least G² of a vocabulary word
STRENGTH = 22.0
NEIGHBOURS, BLOCK, SOFT = 15, 32, 0.05
EPS = 1e-9

#: bytes of words, before A-Z is lower-cased
LETTERS = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def _pairs(texts: pa.Array, vocabulary: np.ndarray | None = None):
    """(row, word hash or vocabulary index, count) of every distinct word of every text."""
    for i, j, data, off in text_blocks(texts):
        words = Words(data, off, LETTERS, lower=True)
        h = words.hashes()
        row = np.repeat(np.arange(i, j), np.diff(words.bounds))
        if vocabulary is None:
            kinds, h = np.unique(h, return_inverse=True)
        else:
            kinds = np.arange(len(vocabulary))
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            known = vocabulary[at] == h
            h, row = at[known], row[known]
        key, count = np.unique(row * max(1, len(kinds)) + h, return_counts=True)
        yield i, j, key // max(1, len(kinds)), kinds[key % max(1, len(kinds))], count


def _telling(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """G² of a word in ``a`` of n1 and ``b`` of n0 texts."""
    n, total = n1 + n0, 0.0
    for seen, expected in ((a, (a + b) * n1 / n), (b, (a + b) * n0 / n), (n1 - a, (n - a - b) * n1 / n), (n0 - b, (n - a - b) * n0 / n)):
        total = total + 2 * seen * np.log(np.where(seen > 0, seen / np.maximum(expected, 1e-300), 1.0))
    return total


def vocabulary(texts: list[str], labels: np.ndarray, strength: float = STRENGTH) -> np.ndarray:
    """Sorted hashes of the words that tell label 1 from label 0."""
    n1, n0 = int((labels == 1).sum()), int((labels == 0).sum())
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    found = [(h, labels[row]) for _, _, row, h, _ in _pairs(pa.array(texts, pa.string()))]
    h, label = (np.concatenate(x) for x in zip(*found, strict=True))
    kinds, at = np.unique(h, return_inverse=True)
    a, b = np.bincount(at[label == 1], minlength=len(kinds)), np.bincount(at[label == 0], minlength=len(kinds))
    return kinds[_telling(a, b, n1, n0) >= strength]


class Index:
    """Block-max inverted index of unit vectors: postings and bounds by term and block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        """``vectors``: (terms, weights) of the examples, none empty."""
        self.block, self.n = block, len(vectors)
        # alike examples share blocks: by their heaviest terms
        lead = [tuple(t[np.argsort(-w, kind="stable")].tolist()) for t, w in vectors]
        self.ids = np.array(sorted(range(self.n), key=lambda e: (lead[e], e)), np.int64)
        self.n_blocks = -(-self.n // block)
        self.bounds = np.zeros((n_terms, self.n_blocks))
        place, term, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for p, e in enumerate(self.ids):
            t, w = vectors[e]
            place.append(np.full(len(t), p))
            term.append(t)
            weight.append(w)
            self.bounds[t, p // block] = np.maximum(self.bounds[t, p // block], w)
        place, term, weight = (np.concatenate(x) for x in (place, term, weight))
        cell = term * self.n_blocks + place // block
        order = np.argsort(cell, kind="stable")
        self.start = np.searchsorted(cell[order], np.arange(n_terms * self.n_blocks + 1))
        self.place, self.weight = place[order], weight[order]
        self.visited = 0

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of the k most similar ones above 0, without example ``without``."""
        best, sims = np.zeros(0, np.int64), np.zeros(0)
        if not self.n or not len(terms):
            return best, sims
        bound = weights @ self.bounds[terms]
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(sims) == k and bound[b] < sims[-1] - EPS:
                break
            self.visited += 1
            cell = terms * self.n_blocks + b
            start, size = self.start[cell], self.start[cell + 1] - self.start[cell]
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            first = b * self.block
            sim = np.bincount(self.place[at] - first, self.weight[at] * np.repeat(weights, size), min(self.block, self.n - first))
            some = np.flatnonzero(sim > 0)
            e = self.ids[first + some]
            best, sims = np.concatenate([best, e[e != without]]), np.concatenate([sims, np.round(sim[some], 9)[e != without]])
            order = np.lexsort((best, -sims))[:k]
            best, sims = best[order], sims[order]
        return best, sims


def _unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf[terms]
    return w / np.sqrt((w * w).sum())


def _vectors(n: int, pairs, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = [(np.zeros(0, np.int64), np.zeros(0))] * n
    for _, _, row, term, count in pairs:
        rows, at = np.unique(row, return_index=True)
        for r, s, e in zip(rows, at, [*at, len(row)][1:], strict=True):
            out[r] = (term[s:e], _unit(term[s:e], count[s:e], idf))
    return out


def _vote(sims: np.ndarray, labels: np.ndarray, rate: float) -> float:
    w = sims / (1 - sims + SOFT)
    return (float(w @ labels) + rate) / (float(w.sum()) + 1)


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _curve(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of labels ~ logistic(slope * logit(vote) + offset), drawn to (1, 0)."""
    x = np.column_stack([_logit(votes), np.ones(len(votes))])
    start = w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - labels) + (w - start))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if np.isfinite(w).all() and w[0] > 0 else (1.0, 0.0)


def examples(docs: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> list[tuple[int, str, int]]:
    """At most ``fit_rows`` (doc_id, text, toxic); ``labelled`` is (doc_id, toxic)."""
    some = labelled.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_rows)
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    seen = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.toxic)):
        seen.setdefault((r.text, r.toxic), (r.doc_id, r.text, r.toxic))
    return list(seen.values())


def _count(words):
    def run(batches):
        n, df = 0, np.zeros(len(words.value), np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, _, _, term, _ in _pairs(batch.column(0), words.value):
                df += np.bincount(term, minlength=len(df))
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *term.tolist()], pa.int32()), pa.array([n, *df[term].tolist()], pa.int64())], names=["term", "n"])
    return run


def fit(docs: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS, neighbours: int = NEIGHBOURS, strength: float = STRENGTH) -> dict:
    """The model: vocabulary, idf over all of ``docs``, index of the examples, curve."""
    rows = examples(docs, labelled, fit_rows)
    y = np.array([r[2] for r in rows], np.int64)
    words = vocabulary([r[1] for r in rows], y, strength)
    model = {"words": words, "rate": (float(y.sum()) + 0.5) / (len(y) + 1), "neighbours": neighbours, "curve": (1.0, 0.0)}
    if not len(words):
        return model
    sent = docs.sparkSession.sparkContext.broadcast(words)
    df = dict(docs.select(F.col("text").cast("string")).mapInArrow(_count(sent), "term int, n long").groupBy("term").agg(F.sum("n")).collect())
    idf = np.log((1 + df.get(-1, 0)) / (1 + np.array([df.get(t, 0) for t in range(len(words))]))) + 1
    vectors = _vectors(len(rows), _pairs(pa.array([r[1] for r in rows], pa.string()), words), idf)
    known = np.array([len(t) > 0 for t, _ in vectors])
    model["rate"] = rate = (float(y[~known].sum()) + 0.5) / (float((~known).sum()) + 1)
    named = [r for r, ok in zip(rows, known, strict=True) if ok]
    vectors, y = [v for v, ok in zip(vectors, known, strict=True) if ok], y[known]
    index = Index(vectors, len(words))
    votes = []
    for e, (t, w) in enumerate(vectors):
        near, sims = index.nearest(t, w, neighbours, without=e)
        votes.append(_vote(sims, y[near], rate))
    return model | {"idf": idf, "index": index, "ids": np.array([r[0] for r in named], np.int64), "labels": y, "curve": _curve(np.array(votes), y)}


EVIDENCE = pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())])


def _score(model):
    def run(batches):
        m = model.value
        slope, offset = m["curve"]
        for batch in batches:
            score, evidence = np.full(batch.num_rows, m["rate"]), [[] for _ in range(batch.num_rows)]
            for r, (t, w) in enumerate(_vectors(batch.num_rows, _pairs(batch.column(1), m["words"]), m["idf"]) if len(m["words"]) else ()):
                if len(t):
                    near, sims = m["index"].nearest(t, w, m["neighbours"])
                    score[r] = 1 / (1 + np.exp(-slope * _logit(_vote(sims, m["labels"][near], m["rate"])) - offset))
                    evidence[r] = [{"doc_id": i, "label": y, "similarity": s} for i, y, s in zip(m["ids"][near].tolist(), m["labels"][near].tolist(), sims.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(evidence, pa.list_(EVIDENCE))], names=["doc_id", "score", "evidence"])
    return run


def toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """Per row: doc_id, score, evidence."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return texts.mapInArrow(_score(sent), "doc_id long, score double, evidence array<struct<doc_id:long,label:int,similarity:double>>")
