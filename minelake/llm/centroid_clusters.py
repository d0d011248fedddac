"""Centroid clustering: dimension-sharded Lloyd iterations over exact integers.

Vectors are stored by column blocks: a chunk of up to ``CHUNK`` vectors has one
shard for every ``shard_columns`` of its components. A round is

* a task per shard of a chunk: the exact partial squared distances of its vectors
  to the shard's slice of every centroid;
* reduceByKey over the chunk: the partial distances of its shards add up, the
  smallest sum names the centroid (ties: the smaller number);
* the labels, some bytes a vector, go back to the shards, which keep their place (the
  same partitioner, so no component is shuffled); each shard adds up its own columns
  by centroid, and its centroid slice becomes the componentwise floor(sum / count). A
  centroid without vectors keeps its place.

Only centroids (``k`` rows) and their counts reach the driver. Distances of a
chunk are k numbers a vector and shard; everything else about a vector stays put.

Exactness. A component x counts as the integer floor(scale * x), x as double. Sums run
in double matrix products where every number is below 2**53, else in 64-bit integers.

Rows: a vector is kept if it has ``dims`` components, none null or non-finite, and no
integer beyond ``LARGEST`` (so that distances fit a long; a float32 embedding near 1
is far below). Null and repeated vec_ids are ordinary rows. The first centroids are the
``k`` kept rows with the smallest seed hash of their vec_id (ties: the smaller vector;
null vec_ids last); with fewer rows there are fewer centroids, without rows no
result row. A sum of distances beyond a long is null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minelake.llm.common import written

#: vectors of a chunk
CHUNK = 2048
#: largest integer component
LARGEST = 1 << 27

CHUNKS = "chunk long, ids array<long>, shards array<binary>"
ROWS = "vec_id long, cluster int, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and the integer components of the kept vectors."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) <= LARGEST / scale))
    return vectors.where((F.size("embedding") == dims) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _chunks(dims: int, width: int):
    """Rows of (chunk, vec_ids, the bytes of every column block)."""
    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for s in range(0, batch.num_rows, CHUNK):
                part = batch.slice(s, CHUNK)
                x = part.column(1).flatten().to_numpy().reshape(-1, dims)
                small = next(t for t in (np.int16, np.int32) if np.abs(x).max() <= np.iinfo(t).max)
                shards = [np.ascontiguousarray(x[:, c:c + width].astype(small)).tobytes() for c in range(0, dims, width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([shards], pa.list_(pa.binary()))],
                    names=["chunk", "ids", "shards"])
                chunk += 1
    return run


def _matrix(n: int, data: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(data, np.int16 if len(data) == 2 * n * columns else np.int32).reshape(n, columns)


def _squared(x: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to those of ``slice_``."""
    largest = int(max(np.abs(x.astype(np.int64)).max(), np.abs(slice_).max()))
    if 4 * largest * largest * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), slice_.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    a = x.astype(np.int64)
    return np.stack([((a - c) ** 2).sum(axis=1) for c in slice_], axis=1)


def _narrow(m: np.ndarray) -> np.ndarray:
    return m.astype(np.int32) if m.size and m.max() < 1 << 31 else m


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _narrow(np.add(a, b, dtype=np.int64))


def _sums(k: int):
    """(shard, its columns' counts and sums by centroid) of a partition's labels and blocks."""
    def run(rows):
        labels, out = {}, {}
        for key, (kind, value) in rows:
            if kind == 0:
                labels[key] = value
                continue
            label, x = labels.pop(key).astype(np.int64), value.astype(np.int64)
            if key[1] not in out:
                out[key[1]] = (np.zeros(k, np.int64), np.zeros((k, x.shape[1]), np.int64))
            count, total = out[key[1]]
            count += np.bincount(label, minlength=k)
            order = np.argsort(label, kind="stable")
            some, first = np.unique(label[order], return_index=True)
            total[some] += np.add.reduceat(x[order], first, axis=0)
        return out.items()
    return run


def lloyd(vectors: DataFrame, dims: int, k: int, rounds: int, seed: int = 1, scale: int = 64, shard_columns: int = 16) -> tuple[DataFrame, list[list[int]]]:
    """(rows of vec_id, cluster, distance; the final centroids)."""
    spark = vectors.sparkSession
    kept = integers(vectors, dims, scale)
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    if not first:
        return spark.createDataFrame([], ROWS), []
    centroids = np.array([r.x for r in first], np.int64)
    k, columns = len(centroids), [slice(c, min(c + shard_columns, dims)) for c in range(0, dims, shard_columns)]
    table = written(kept.mapInArrow(_chunks(dims, shard_columns), CHUNKS), "chunks")

    def blocks_of(row):
        return [((row.chunk, s), (1, _matrix(len(row.ids), data, columns[s].stop - columns[s].start))) for s, data in enumerate(row.shards)]

    stored = table.rdd
    parts = max(spark.sparkContext.defaultParallelism, stored.getNumPartitions())
    blocks = stored.flatMap(blocks_of).partitionBy(parts).persist(StorageLevel.DISK_ONLY)

    def distances():
        slices = spark.sparkContext.broadcast([centroids[:, c] for c in columns])  # k x dims numbers
        return blocks.map(lambda b: (b[0][0], _narrow(_squared(b[1][1], slices.value[b[0][1]])))).reduceByKey(_add, parts)

    for _ in range(rounds):
        labels = distances().mapValues(lambda m: m.argmin(axis=1).astype(np.min_scalar_type(k)))
        back = labels.flatMap(lambda x: [((x[0], s), (0, x[1])) for s in range(len(columns))]).partitionBy(parts)
        old = spark.sparkContext.broadcast([centroids[:, c] for c in columns])

        def moved(item, old=old):
            shard, (count, total) = item
            return shard, np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], old.value[shard])

        sums = back.union(blocks).mapPartitions(_sums(k)).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), len(columns))
        for shard, new in sums.map(moved).collect():  # k x dims numbers in all
            centroids[:, columns[shard]] = new
    ends = distances().map(lambda x: (x[0], x[1].argmin(axis=1).astype(np.int32).tobytes(), x[1].min(axis=1).astype(np.int64).tobytes()))
    named = spark.createDataFrame(ends, "chunk long, labels binary, distances binary").join(table.select("chunk", "ids"), "chunk")
    rows = written(named.mapInArrow(_spread, ROWS), "assigned")
    blocks.unpersist()
    return rows, centroids.tolist()


def _spread(batches):
    """A row for every vector of a chunk."""
    for batch in batches:
        for c in range(batch.num_rows):
            labels, distances = (np.frombuffer(batch.column(i)[c].as_buffer(), t) for i, t in ((1, np.int32), (2, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(3)[c].values, pa.array(labels), pa.array(distances)], names=["vec_id", "cluster", "distance"])


def centroid_clusters(vectors: DataFrame, dims: int = 64, k: int = 16, rounds: int = 3, **options) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, the sums of distances of its cluster
    and of all, and the sha256 of its centroid's components."""
    rows, centroids = lloyd(vectors, dims, k, rounds, **options)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], RESULT)
    named = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    names = vectors.sparkSession.createDataFrame(named, "cluster int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))  # k rows
    sums = sums.withColumn("inertia", F.try_sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    return rows.join(F.broadcast(sums.join(F.broadcast(names), "cluster")), "cluster").select(*[f.split()[0] for f in RESULT.split(", ")])
