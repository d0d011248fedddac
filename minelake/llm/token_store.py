"""Token ids as binary shards with a minimal perfect hash index.

Layout of a store (one folder, any file system pyarrow can write):

* ``ids-<range>-<shard>-<attempt>.bin``: a 16-byte header (magic, bytes per id,
  ids) and raw little-endian ids, 2 bytes each if the vocabulary allows it, else
  4. Shards follow ascending doc_id and hold at most ``SHARD_IDS`` ids (a longer
  document is a shard of its own).
* ``index-<part>-<attempt>.npz``: minimal perfect hash index of the keys of one
  hash partition; per key number a 32-bit fingerprint, shard, offset and length. Keys
  whose 64-bit hashes are equal are listed themselves.
* a manifest of shards and index parts, and the catalogue of keys, as Parquet
  that Spark commits. A file of a failed or repeated attempt is in no manifest.

A key is (doc_id, occurrence): rows that repeat a doc_id count up from 0 in text
hash order, null doc_id is a key of its own. A keyed read opens its index part and the byte
ranges of its documents (the whole shard where they are half of it or more). Null text has only the end id.
Extra columns are ignored.

Scale: one shuffle of the texts (by doc_id ranges); ids go from the task to its
shard; keys, offsets and lengths are all that is shuffled afterwards.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minelake.llm import perfect_hash
from minelake.llm.common import U, mix64, shared_folder, written
from minelake.llm.pretokens import LOWER_WORDS, Cutter, Misses, load

SHARD_IDS = 4 << 20
INDEX_KEYS = 50_000
MAGIC = b"IDS1"
_HEADER = struct.Struct("<4sIQ")

_worker: dict = {}


def _pack(size: int, ids: int) -> bytes:
    return _HEADER.pack(MAGIC, size, ids)


def _open(folder: str):
    """pyarrow's file system of a folder; Hadoop's names of a store mean the same store."""
    folder = re.sub("^file:/+", "/", folder)
    folder = re.sub("^s3[an]:", "s3:", folder)
    return (pafs.LocalFileSystem(), folder) if folder.startswith("/") else pafs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, data: bytes) -> None:
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as f:
        f.write(data)


def _get(folder: str, name: str) -> bytes:
    system, path = _open(folder)
    with system.open_input_stream(f"{path}/{name}") as f:
        return f.read()


def _get_ids(folder: str, name: str, offsets: list[int], counts: list[int]) -> list[np.ndarray]:
    """The ids of some documents of a shard: byte ranges of it, or all of it where they are most of it."""
    system, path = _open(folder)
    with system.open_input_file(f"{path}/{name}") as f:
        total_bytes = f.size()
        magic, size, total = _HEADER.unpack(f.read(_HEADER.size))
        if magic != MAGIC or total_bytes != _HEADER.size + size * total:
            raise ValueError(f"damaged shard {name}")
        kind = "<u2" if size == 2 else "<u4"
        if 2 * sum(counts) >= total:
            ids = np.frombuffer(f.read(), kind)
            return [ids[o:o + n] for o, n in zip(offsets, counts, strict=True)]
        out = []
        for o, n in zip(offsets, counts, strict=True):
            f.seek(_HEADER.size + o * size)
            out.append(np.frombuffer(f.read(n * size), kind))
        return out


def encoder(path: str, lower_words: bool):
    """text -> id bytes of the tokenizer file, and the bytes per id."""
    if _worker.get("path") != path:
        tok, model, specials = load(path)
        size = 2 if tok.get_vocab_size() <= 1 << 16 else 4
        cache = Misses(model, lambda found: b"".join([t.id.to_bytes(size, "little") for t in found]))
        _worker.update(path=path, got=(tok, Cutter(tok, specials, LOWER_WORDS, True), size, cache))
    tok, cut, size, cache = _worker["got"]
    kind = "<u2" if size == 2 else "<u4"

    def encode(text: str) -> bytes:
        found = cut(text) if lower_words else None
        if found is not None:
            cache.trim()
            return b"".join(map(cache.__getitem__, found))
        return np.array(tok.encode(text, add_special_tokens=False).ids, kind).tobytes()

    return encode, size


def _write_shards(folder: str, path: str, lower_words: bool, end_id: int, shard_ids: int):
    def run(batches):
        encode, size = encoder(path, lower_words)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        end, shard, ids, rows, last, occurrence = end_id.to_bytes(size, "little"), 0, [], [], None, 0
        n_ids = 0

        def flush():
            nonlocal shard, ids, rows, n_ids
            name = f"ids-{part:06d}-{shard:05d}-{attempt}.bin"
            _put(folder, name, _pack(size, n_ids) + b"".join(ids))
            k = len(rows)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * k, pa.int32()), pa.array([shard] * k, pa.int32()), pa.array([name] * k),
                 *(pa.array(c, pa.int64()) for c in zip(*rows))],
                names=["part", "shard", "file", "doc_id", "occurrence", "offset", "n"])
            shard, ids, rows, n_ids = shard + 1, [], [], 0
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = encode(text or "") + end
                n = len(data) // size
                if rows and (n_ids + n > shard_ids or len(rows) >= 1 << 17):
                    yield flush()
                occurrence = occurrence + 1 if last is not None and last[0] == doc_id else 0
                last = (doc_id,)
                rows.append((doc_id, occurrence, n_ids, n))
                ids.append(data)
                n_ids += n
        if rows:
            yield flush()
    return run


def key_hash(doc_id: pa.Array, occurrence: np.ndarray) -> np.ndarray:
    """64-bit keys: a permutation of doc_id for first occurrences."""
    null = doc_id.is_null().to_numpy(zero_copy_only=False)
    key = mix64(doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U))
    key = np.where(null, mix64(key ^ U(0x6A09E667F3BCC909)), key)
    again = occurrence != 0
    return np.where(again, mix64(key + occurrence.astype(U) * U(0x9E3779B97F4A7C15)), key)


def _with_part(parts: int):
    def run(batches):
        for b in batches:
            h = key_hash(b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("occurrence")).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((h >> U(8)).astype(np.int64) % parts), pa.array(h.view(np.int64))],
                                             names=[*b.schema.names, "index_part", "key"])
    return run


def _build_index(folder: str):
    def run(table: pa.Table) -> pa.Table:
        keys = np.ascontiguousarray(table["key"].to_numpy()).view(U)
        found, rest = perfect_hash.build(keys)
        at = np.full(len(keys), -1, np.int64)
        placed = np.setdiff1d(np.arange(len(keys)), rest)
        at[found.lookup(keys[placed])] = placed
        at[len(placed):] = rest  # keys with equal hashes: numbered after the others, told apart by themselves
        again = table.select(["doc_id", "occurrence"]).take(pa.array(rest))
        buf = io.BytesIO()
        np.savez(buf, sizes=found.sizes, words=found.words, samples=found.samples, fingerprint=(mix64(keys) >> U(32)).astype(np.uint32)[at],
                 rest=np.array(json.dumps(list(zip(*(again[c].to_pylist() for c in ("doc_id", "occurrence")), strict=True)))),
                 **{c: table[c].to_numpy()[at] for c in ("part", "shard", "offset", "n")})
        part = table["index_part"][0].as_py()
        name = f"index-{part:06d}-{uuid.uuid4().hex[:8]}.npz"
        _put(folder, name, buf.getvalue())
        return pa.table({"index_part": [part], "index_file": [name], "keys": [len(keys)]})
    return run


def _find(folder: str):
    """Look up a part's keys; unknown keys get a null place."""
    def run(table: pa.Table) -> pa.Table:
        index = np.load(io.BytesIO(_get(folder, table["index_file"][0].as_py())))
        keys = np.ascontiguousarray(table["key"].to_numpy()).view(U)
        held = perfect_hash.Hash(index["sizes"], index["words"], index["samples"])
        at = held.lookup(keys)
        rest = {tuple(k): i for i, k in enumerate(json.loads(str(index["rest"])))}
        if rest:
            first = len(index["fingerprint"]) - len(rest)
            for i, k in enumerate(zip(table["doc_id"].to_pylist(), table["occurrence"].to_pylist(), strict=True)):
                at[i] = first + rest[k] if k in rest else at[i]
        known = (at >= 0) & (index["fingerprint"][at] == (mix64(keys) >> U(32)).astype(np.uint32))
        out = {c: pa.array(index[c][at], mask=~known) for c in ("part", "shard", "offset", "n")}
        return pa.table({"doc_id": table["doc_id"], "occurrence": table["occurrence"], **out})
    return run


def _payload(folder: str, with_ids: bool):
    """Cut the documents asked for out of their shard."""
    def run(table: pa.Table) -> pa.Table:
        crc, lists = [], []
        for own in _get_ids(folder, table["file"][0].as_py(), table["offset"].to_pylist(), table["n"].to_pylist()):
            own = own.astype("<u4")
            crc.append(zlib.crc32(own.tobytes()))
            lists.append(own if with_ids else None)
        out = {c: table[c] for c in ("doc_id", "occurrence", "start")} | {"n_tokens": table["n"].cast(pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
        return pa.table(out | ({"ids": pa.array(lists, pa.list_(pa.int64()))} if with_ids else {}))
    return run


@dataclass
class TokenStore:
    folder: str
    catalogue: DataFrame  # doc_id, occurrence of every document
    shards: DataFrame     # part, shard, file, base: ids before the shard
    index: DataFrame      # index_part, index_file, keys
    parts: int

    def find(self, keys: DataFrame) -> DataFrame:
        """doc_id, occurrence, part, shard, offset, n of ``keys`` (doc_id, occurrence), through the index."""
        asked = keys.select("doc_id", "occurrence").mapInArrow(_with_part(self.parts), "doc_id long, occurrence long, index_part long, key long")
        place = "doc_id long, occurrence long, part int, shard int, offset long, n long"
        return asked.join(self.index, "index_part").groupBy("index_part").applyInArrow(_find(self.folder), place)

    def fetch(self, keys: DataFrame, with_ids: bool = False) -> DataFrame:
        """doc_id, occurrence, start, n_tokens, ids_crc32 (and ids) read back from the files."""
        found = self.find(keys).join(self.shards, ["part", "shard"]).withColumn("start", F.col("base") + F.col("offset"))
        return found.groupBy("part", "shard").applyInArrow(
            _payload(self.folder, with_ids), "doc_id long, occurrence long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def write_tokens(docs: DataFrame, path: str, end_id: int, lower_words: bool = True, shard_ids: int = SHARD_IDS, index_keys: int = INDEX_KEYS) -> TokenStore:
    """Encode, write and index every document. ``lower_words`` names the word
    pattern of the tokenizer file; without it the library encodes each text."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "tokens")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    catalogue = written(ordered.mapInArrow(_write_shards(folder, path, lower_words, end_id, shard_ids),
                                           "part int, shard int, file string, doc_id long, occurrence long, offset long, n long"), "catalogue")
    sums = catalogue.groupBy("part", "shard", "file").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = written(sums.select("part", "shard", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "shards")
    parts = max(1, -(-catalogue.count() // index_keys))
    keyed = catalogue.select("doc_id", "occurrence", "part", "shard", "offset", "n").mapInArrow(
        _with_part(parts), "doc_id long, occurrence long, part int, shard int, offset long, n long, index_part long, key long")
    index = written(keyed.groupBy("index_part").applyInArrow(_build_index(folder), "index_part long, index_file string, keys long"), "index")
    _put(folder, "meta.json", json.dumps({"end_id": end_id, "index_parts": parts}).encode())
    return TokenStore(folder, catalogue.select("doc_id", "occurrence"), shards, index, parts)
