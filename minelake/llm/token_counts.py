"""Token counts by a map-side two-tier lookup.

First tier: a compact table of frequent pre-token lengths, broadcast. It is
gathered from the whole corpus without shuffling pre-tokens: each task counts
its own and reports only those with a share of at least 1 / ``SHARE`` of its
pre-tokens (at most ``SHARE`` rows a task); the ``TABLE`` most frequent are
encoded once. Second tier: a cache per Python worker for everything else. Both serve every
text, of whatever script; only a text that holds a special string of the file is encoded whole.
Counts never depend on either table's content. Memory is bounded by ``TABLE``
and the cache limit.

Null text counts as empty (0 bytes, 0 tokens). doc_id may be null or repeated:
one output row per input row. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.pretokens import BYTE_LEVEL, Cutter, Misses, load

SHARE, TABLE = 4096, 32768

_worker: dict = {}


def _frequent(path: str):
    def run(batches):
        cut = _tiers(path, None)[1]
        seen, total, floor = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = cut(text) if text else None
                if found:
                    total += len(found)
                    seen.update(found)
                    if len(seen) > 300_000:  # lossy counting: drop what is rare so far
                        floor = max(floor, total // (4 * SHARE))
                        seen = Counter({w: c for w, c in seen.items() if c > floor})
                        floor = floor if len(seen) < 150_000 else 2 * floor + 1
        top = [(w, c) for w, c in seen.items() if c * SHARE >= total]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], names=["w", "c"])
    return run


def _tiers(path: str, table):
    """The worker's tokenizer, cutter and look-up, kept between tasks."""
    key, words, lengths = table or (None, "", b"")
    if _worker.get("key") != (path, key):
        tok, model, specials = load(path)
        first = dict(zip(words.split("\x00"), lengths)) if words else {}
        _worker.update(key=(path, key), got=(tok, Cutter(tok, specials, BYTE_LEVEL, False), Misses(model, len, first)))
    return _worker["got"]


def _count(path: str, table):
    def run(batches):
        tok, cut, cache = _tiers(path, table.value)
        for batch in batches:
            n = []
            for text in batch.column(1).to_pylist():
                found = cut(text) if text else []
                if found is not None:
                    n.append(sum(map(cache.__getitem__, found)))
                    cache.trim()
                else:
                    n.append(len(tok.encode(text, add_special_tokens=False).ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per row."""
    spark = docs.sparkSession
    _, model, _ = load(path)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    top = (docs.select(text.alias("text")).mapInArrow(_frequent(path), "w string, c long")
           .where("w NOT LIKE '%\\0%'").groupBy("w").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "w").limit(TABLE))
    words = [r.w for r in top.select("w").collect()]  # at most TABLE pre-tokens
    lengths = Misses(model, len)
    table = spark.sparkContext.broadcast((hash(tuple(words)), "\x00".join(words), bytes(min(lengths[w], 255) for w in words)))
    # lengths of one byte: longer ones are left to the workers' caches
    if any(lengths[w] >= 255 for w in words):
        words = [w for w in words if lengths[w] < 255]
        table = spark.sparkContext.broadcast((hash(tuple(words)), "\x00".join(words), bytes(lengths[w] for w in words)))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(_count(path, table), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
