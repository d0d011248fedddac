"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike (A-Z to lower case, words of
ASCII letters, digits and non-ASCII characters, one space between words). The
automaton holds every window of ``width`` consecutive item words (an item of
fewer words is one window); each document's normalised text is scanned once, and
matches map back to words and to character offsets of the original text.

The windows travel by broadcast only up to ``BLOCK_BYTES`` of item text: a larger
benchmark is cut into blocks by text hash, each with its own automaton and scan,
whose hits are merged by document; the driver holds one block at a time. Automata are
kept per Python worker.

Null or empty texts have no words and no windows. Items that repeat an item_id
count as one item, as do all items without one, under the name ``NO_ID``. Rows that repeat a doc_id stay apart
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minelake.llm.common import written

WIDTH = 10
#: the name of benchmark rows without item_id
NO_ID = "null"
BLOCK_BYTES = 4 << 20

_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_TABLE = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FOUND = ["doc_id", "t", "n_words", "words", "items", "spans"]
HITS = "doc_id long, t long, n_words long, words array<struct<start:int,end:int>>, items array<string>, spans array<struct<start:int,end:int>>"

_worker: dict = {}


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _automaton(key: str, items: list[tuple[str, str]], width: int):
    """Windows of the items -> their items; kept between tasks, one at a time."""
    if _worker.get("key") != key:
        import ahocorasick

        windows: dict[str, set[str]] = {}
        for item_id, text in items:
            words = [w.decode() for w in normal_words(text)]
            for k in range(max(1, len(words) - width + 1) if words else 0):
                windows.setdefault(" " + " ".join(words[k:k + width]) + " ", set()).add(item_id)
        auto = ahocorasick.Automaton()
        for window, ids in windows.items():
            auto.add_word(window, (window.count(" ") - 1, tuple(ids)))
        auto.make_automaton()
        _worker.update(key=key, auto=auto if windows else None)
    return _worker["auto"]


def _merged(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _scan(block, width: int):
    def run(batches):
        auto = _automaton(block.value[0], block.value[1], width)
        for batch in batches:
            cols = [[], [], [], []]
            for text in batch.column(2).to_pylist():
                words = normal_words(text)
                spans, items = [], set()
                if auto is not None and words:
                    line = " " + b" ".join(words).decode() + " "
                    found = list(auto.iter(line))
                    at, seen = 0, 0
                    for end, (n, ids) in found:  # matches come in ascending order of their end
                        seen += line.count(" ", at, end)
                        at = end
                        spans.append((seen - n, seen))
                        items.update(ids)
                spans = _merged(spans)
                where = [m.span() for m in WORD.finditer(text)] if spans else []
                cols[0].append(len(words))
                cols[1].append([{"start": s, "end": e} for s, e in spans])
                cols[2].append(sorted(items))
                cols[3].append([{"start": where[s][0], "end": where[e - 1][1]} for s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], _SPANS),
                 pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], _SPANS), *batch.columns[3:]],
                names=[*FOUND, *batch.schema.names[3:]])
    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Blocks of (item name, text) of about ``block_bytes``, dealt by hash; the driver holds one at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit(NO_ID)).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = written(items.distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    at = F.pmod(F.xxhash64("text"), F.lit(n))
    for k in range(n):
        yield sorted((r.item_id, r.text) for r in items.where(at == k).collect())


def _merge(batches):
    """One row per copy of a document from the hits of all blocks."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            words, spans = (_merged({(x["start"], x["end"]) for block in r[c] for x in block}) for c in ("words", "spans"))
            row = {"doc_id": r["doc_id"], "t": r["t"], "n_words": r["n_words"], "items": sorted({i for b in r["items"] for i in b}),
                   "words": [{"start": s, "end": e} for s, e in words], "spans": [{"start": s, "end": e} for s, e in spans]}
            out += [row] * r["copies"]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("doc_id", pa.int64()), ("t", pa.int64()), ("n_words", pa.int64()), ("words", _SPANS), ("items", pa.list_(pa.string())), ("spans", _SPANS)]))


def _scans(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int) -> list:
    """The scan of every block, over a broadcast of it."""
    out = []
    for items in _blocks(benchmark, block_bytes):
        name = hashlib.sha256(repr((width, items)).encode()).hexdigest()
        out.append(_scan(docs.sparkSession.sparkContext.broadcast((name, items)), width))
    return out


def _hits(docs: DataFrame, scans: list) -> DataFrame:
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    found = [rows.mapInArrow(s, HITS) for s in scans]
    if len(found) == 1:
        return found[0]
    union = reduce(DataFrame.unionByName, [s.withColumn("block", F.lit(k)) for k, s in enumerate(found)])
    return union.groupBy("doc_id", "t", "n_words").agg(
        F.sum((F.col("block") == 0).cast("int")).alias("copies"), *(F.collect_set(c).alias(c) for c in ("words", "items", "spans"))).mapInArrow(_merge, HITS)


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without a hit, whole. Rows travel as one struct, so no column name can clash."""
    scans = _scans(docs, benchmark, width, block_bytes)
    text = F.col("text").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    if len(scans) == 1:
        # one scan: the row travels with its hits
        whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("t"), text.alias("text"), row)
        hits = whole.mapInArrow(scans[0], T.StructType([*T.StructType.fromDDL(HITS).fields, whole.schema["row"]]))
        return hits.where(F.size("words") == 0).select("row.*")
    bad = _hits(docs, scans).where(F.size("words") > 0).select(F.col("doc_id").alias("bad_id"), F.col("t").alias("bad_t")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.xxhash64(text).alias("t"), row)
    return rows.join(bad, F.col("key").eqNullSafe(F.col("bad_id")) & (F.col("t") == F.col("bad_t")), "left_anti").select("row.*")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items (sorted strings), items_sha256,
    contaminated, spans (merged character intervals of hits in the original text)."""
    hits = _hits(docs, _scans(docs, benchmark, width, block_bytes))
    n_hit = F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("words") > 0).alias("contaminated"), "spans")
