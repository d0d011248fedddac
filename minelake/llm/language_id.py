"""Language identification with a string kernel.

Kernel. The blended spectrum presence kernel of two texts counts the character
n-grams (n = 1 .. ``MAX_N``) that occur in both, divided by the square root of
the product of their own counts. Characters are lower-cased letters (an alphabet
of the ``ALPHABET`` most frequent ones of the fit sample and one symbol for all
others); every run of non-letters is one blank.

Model. ``LANDMARKS`` texts per language span a Nyström feature space; one-versus-
rest ridge regression in it gives one weight vector per language. Both steps fold
into one matrix over the landmarks' n-grams, so a batch of documents is scored by
one product (documents x n-grams) @ (n-grams x languages).

Fit. On a bounded sample: per language the ``FIT_ROWS`` distinct texts with the
smallest hashes, whole. Nothing else is sampled; every text is scored
whole. A language with a single row is learned too.

score: the softmax of ``SHARPNESS`` times the outputs, for the best language (0 to
1). Ties go to the language that sorts first. Null texts and texts without a letter
get ``und`` and score 0. With no labelled row every text is ``und``. Null or
repeated doc_ids are ordinary rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minelake.llm.common import written

MAX_N, ALPHABET = 3, 62
FIT_ROWS, LANDMARKS = 300, 40
#: texts whose n-gram rows are in memory at once, in the fit and in a worker
FIT_BLOCK, SCORE_BLOCK = 256, 64
RIDGE, SHARPNESS = 1.0, 6.0


class Grams:
    """Texts -> sets of n-gram codes below ``size``, by a fixed alphabet.

    Code 0 is the blank, 1 .. the alphabet, the last code any other letter."""

    def __init__(self, letters: list[str]):
        self.letters = letters
        self.base = ALPHABET + 2
        self.size = sum(self.base ** n for n in range(1, MAX_N + 1))
        self.low = np.zeros(0x250, np.uint8)
        for c in range(0x250):
            if chr(c).isalpha():
                self.low[c] = self.code(chr(c).lower())

    def code(self, c: str) -> int:
        return 1 + self.letters.index(c) if c in self.letters else self.base - 1

    def codes(self, text: str) -> np.ndarray:
        """Symbol codes with one blank for every run of non-letters, and at both ends."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.zeros(len(points) + 2, np.uint8)
        if len(points) and points.max() < len(self.low):
            out[1:-1] = self.low[points]
        else:
            kinds, back = np.unique(points, return_inverse=True)
            out[1:-1] = np.array([self.code(chr(c).lower()) if chr(c).isalpha() else 0 for c in kinds], np.uint8)[back]
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] > 0) | (out[:-1] > 0)
        return out[keep]

    def present(self, text: str, marks: np.ndarray) -> int:
        """Set the text's n-grams in ``marks``; how many letters it has."""
        c = self.codes(text).astype(np.int32)
        at = 0
        for n in range(1, MAX_N + 1):
            if len(c) >= n:
                g = c[:len(c) - n + 1].copy()
                for k in range(1, n):
                    g *= self.base
                    g += c[k:len(c) - n + 1 + k]
                marks[at + g] = 1
            at += self.base ** n
        return int((c > 0).sum())


def fit(rows: list[tuple[str, str]]) -> dict | None:
    """Model of (text, language) rows."""
    seen = Counter()
    for text, _ in rows:
        seen.update(c for c in text.lower() if c.isalpha())
    letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]]
    grams = Grams(letters)
    langs = sorted({lang for _, lang in rows})
    if not langs or not letters:
        return None
    per = Counter()
    chosen = []
    for k, (_, lang) in enumerate(rows):
        per[lang] += 1
        if per[lang] <= LANDMARKS:
            chosen.append(k)
    marks = np.zeros(grams.size, np.uint8)

    def matrix(texts, used):
        out, norm = np.zeros((len(texts), len(used)), np.float32), np.zeros(len(texts), np.float32)
        for k, t in enumerate(texts):
            marks[:] = 0
            grams.present(t, marks)
            out[k], norm[k] = marks[used], max(1, np.count_nonzero(marks))
        return out, np.sqrt(norm)

    any_mark = np.zeros(grams.size, np.uint8)
    for k in chosen:
        grams.present(rows[k][0], any_mark)
    used = np.flatnonzero(any_mark)
    land, land_norm = matrix([rows[k][0] for k in chosen], used)
    land /= land_norm[:, None]
    spectrum, vectors = np.linalg.eigh((land @ land.T).astype(np.float64))
    ok = spectrum > 1e-6 * spectrum.max()
    whiten = vectors[:, ok] / np.sqrt(spectrum[ok])
    # normal equations, added up in blocks: the driver holds one block of the n-gram matrix
    left, right = RIDGE * np.eye(whiten.shape[1]), np.zeros((whiten.shape[1], len(langs)))
    for s in range(0, len(rows), FIT_BLOCK):
        block = rows[s:s + FIT_BLOCK]
        x, norm = matrix([t for t, _ in block], used)
        z = ((x / norm[:, None]) @ land.T).astype(np.float64) @ whiten
        left += z.T @ z
        right += z.T @ np.array([[1.0 if lang == other else -1.0 for other in langs] for _, lang in block])
    w = np.linalg.solve(left, right)
    return {"letters": letters, "langs": langs, "used": used, "weights": (land.T.astype(np.float64) @ (whiten @ w)).astype(np.float32)}


def _score(model):
    def run(batches):
        m = model.value
        grams, marks = Grams(m["letters"]), None
        marks = np.zeros(grams.size, np.uint8)
        used, weights, langs = m["used"], m["weights"], np.array(m["langs"], object)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            pred, score = [], []
            for s in range(0, len(texts), SCORE_BLOCK):
                block = texts[s:s + SCORE_BLOCK]
                x, norm, has = np.zeros((len(block), len(used)), np.float32), np.ones(len(block), np.float32), np.zeros(len(block), bool)
                for k, t in enumerate(block):
                    if t:
                        marks[:] = 0
                        has[k] = grams.present(t, marks) > 0
                        x[k], norm[k] = marks[used], max(1, np.count_nonzero(marks))
                out = SHARPNESS * (x @ weights) / np.sqrt(norm)[:, None]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                best = out.argmax(axis=1)
                pred += np.where(has, langs[best], "und").tolist()
                score += np.where(has, out.max(axis=1) / out.sum(axis=1), 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names[2:], "lang_pred", "score"])
    return run


def fit_sample(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(lang, k, text): per language the ``fit_rows`` distinct texts with the smallest hashes.

    Only (language, hash) pairs are shuffled for the choice, and of a language with many texts
    only the hashes below a bound that leaves some four times ``fit_rows`` meet in one task."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.xxhash64("text").alias("h"), "text")
    pairs = written(rows.select("lang", "h").distinct(), "hashes")
    per = pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * fit_rows + 100) / F.col("n"))
    bound = F.when(share < 1, (F.lit(-(2.0 ** 63)) + share * 2.0 ** 64).cast("long")).otherwise(F.lit((1 << 63) - 1))
    near = pairs.join(bounded(per.select("lang", bound.alias("most"))), "lang").where("h <= most")
    order = Window.partitionBy("lang").orderBy("h")
    chosen = bounded(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= fit_rows).select("lang", "h", "k"))
    return rows.join(chosen, ["lang", "h"]).groupBy("lang", "k").agg(F.min("text").alias("text"))


def bounded(df: DataFrame) -> DataFrame:
    """Written, so that its bytes decide whether it is broadcast."""
    return written(df, "side")


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> dict | None:
    """Fit on ``labelled`` (text, lang): at most ``fit_rows`` distinct texts a language
    reach the driver; they are chosen by hash, so no text is shuffled for the choice."""
    return fit([(r.text, r.lang) for r in fit_sample(labelled, fit_rows).orderBy("lang", "k").collect()])


def predict(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score, from its text alone."""
    kept = [F.col(c) for c in keep]
    if model is None:
        return docs.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(F.lit(0).alias("row"), F.col("text").cast("string").alias("scored_text"), *kept)
    out = T.StructType([*rows.schema.fields[2:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), out)
