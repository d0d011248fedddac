"""Document fingerprints: one-permutation MinHash (built-ins only).

Every five-word shingle of the lower-cased text (fewer words: the whole sequence)
is hashed once; the high bits of the hash choose one of ``BINS`` bins, and a bin
keeps its smallest hash. Empty bins are filled by optimal densification: each
probes its own sequence of bins until one is filled (after ``PROBES`` probes it
takes the filled bin of its smallest probe hash, which is the same draw made
total). Of every bin the low-order 8 bits are stored, packed as two hex digits.
likeness: the share m of equal positions, corrected for the chance agreement of
8-bit values, (m - 2**-8) / (1 - 2**-8), within 0 and 1.

Finding a bin's minimum needs no grouping: the hashes are sorted together with one
sentinel per bin, and the first entry of each bin is its minimum or the sentinel.

Text without words: the fingerprint is empty, likeness 1 with another empty one
and 0 with any other. Null text counts as empty. "Next document" is the one before
in ascending doc_id (nulls first, rows that repeat a doc_id by text hash); the first
wraps to the last. Extra columns are ignored.

Neighbours: rows are dealt by doc_id quantiles, one shuffle of the texts; only the
last row of each part crosses to the next part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_LOG2, BITS, PROBES, SHINGLE = 8, 8, 8, 5
BINS = 1 << BINS_LOG2
_SHIFT = 63 - BINS_LOG2
PART_ROWS, MOST_PARTS = 2000, 10_000


def _lower_words(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: array<tinyint> of BINS values, empty for a text without words."""
    words, hashes, small, filled = (f"_{out}_{k}" for k in ("words", "hashes", "small", "filled"))
    mask = (1 << _SHIFT) - 1
    sentinels = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.shiftleft(j.cast("long"), _SHIFT).bitwiseOR(F.lit(mask)))
    df = df.withColumn(words, _lower_words(F.col(text)))
    w = F.col(words)
    shingle = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]), 1)
    df = df.withColumn(hashes, F.sort_array(F.concat(
        F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0))), shingle)).otherwise(F.array().cast("array<bigint>")),
        sentinels)))
    h = F.col(hashes)
    first = F.filter(h, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(h, i - 1), _SHIFT)))
    df = df.withColumn(small, F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(mask)) != mask, (x.bitwiseAND(F.lit((1 << BITS) - 1)) - 128).cast("tinyint"))))
    s = F.col(small)
    df = df.withColumn(filled, F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.get(s, b).isNotNull()))
    probe = lambda j, t: F.get(s, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int"))
    least = lambda j: F.get(s, F.array_min(F.transform(F.col(filled), lambda b: F.struct(F.xxhash64(j, b, F.lit(-1)), b.alias("b"))))["b"])
    dense = F.transform(s, lambda x, j: F.coalesce(x, *[probe(j, t) for t in range(PROBES)], least(j)))
    return df.withColumn(out, F.when(F.size(filled) > 0, dense).otherwise(F.array().cast("array<tinyint>"))).drop(words, hashes, small, filled)


def packed(bins: Column) -> Column:
    return F.array_join(F.transform(bins, lambda x: F.lpad(F.lower(F.hex(x.cast("int") + 128)), 2, "0")), "")


def likeness(x: Column, y: Column) -> Column:
    """Bias-corrected estimate of the Jaccard similarity of two fingerprints."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0), lambda a, i: a + (F.get(x, i) == F.get(y, i)).cast("int"))
    chance = 2.0 ** -BITS
    return (F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))))


def _with_next(rows: DataFrame, parts: int) -> DataFrame:
    """Add bins, next_text and next_bins of the row before in ascending doc_id, wrapping around.

    Each part also gets a copy of the last row of the part before, so the window
    finds every neighbour inside its part."""
    probs = [k / parts for k in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", probs, 10 * parts).alias("b")).first()["b"] if probs else None
    bounds = sorted(set(bounds or []))
    if bounds:
        at = F.array(*[F.lit(b).cast("long") for b in bounds])
        steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
        part = F.aggregate(steps, F.lit(0), lambda pos, s: F.when(F.get(at, pos + s - 1) < F.col("doc_id"), pos + s).otherwise(pos))
    else:
        part = F.lit(0)
    rows = rows.withColumn("part", part)
    last = rows.groupBy("part").agg(F.max(F.struct("doc_id", "t")).alias("last"))
    every = Window.orderBy(F.desc("part"))  # one row per part
    to = F.coalesce(F.lag("part").over(every), F.min("part").over(Window.partitionBy()))
    last = last.select(F.col("last.doc_id").alias("e_id"), F.col("last.t").alias("e_t"), to.alias("to"))
    # at most MOST_PARTS keys are broadcast
    ends = rows.join(F.broadcast(last), F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("t") == F.col("e_t")))
    ends = ends.groupBy("to").agg(F.min("text").alias("text")).select(
        F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("t"), F.col("to").alias("part"), F.lit(False).alias("own"))
    rows = with_fingerprint(rows.withColumn("own", F.lit(True)).unionByName(ends), "text", "bins")
    order = Window.partitionBy("part").orderBy("own", F.col("doc_id").asc_nulls_first(), "t")
    for c in ("text", "bins"):
        rows = rows.withColumn(f"next_{c}", F.lag(c).over(order))
    return rows.where("own").drop("part", "own")


def fingerprints(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = max(1, min(MOST_PARTS, -(-docs.count() // part_rows)))
    rows = _with_next(rows.withColumn("t", F.xxhash64("text")), parts).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_bins")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"), packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"), likeness(F.col("bins"), F.col("next_bins")).alias("near_next"))
