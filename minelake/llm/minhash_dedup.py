"""MinHash near-dedup with circulant permutations, banding and exact checks.

Method. A document's set holds its distinct five-word shingles (fewer words: the
whole sequence as one). Two permutations of the 32-bit words generate every
signature coordinate: the first, sigma, is applied once to each shingle hash; the
second, pi, is applied to sigma shifted circularly by k steps, and coordinate k is
the minimum of pi(sigma + k * STEP mod 2**32). ``BANDS`` bands of ``ROWS``
coordinates give the candidates; a pair at the threshold of 0.75 misses all bands
with probability (1 - 0.75**4)**40 = 2.5e-7. Links are confirmed on full sets of
64-bit shingle hashes: threshold_pct * union <= 100 * intersection.

Scale. Groups of copies never expand into pairs:

* Documents with equal sets (128-bit set fingerprint) collapse to their smallest
  doc_id first.
* Within a band's bucket, every member is checked against the smallest member
  only. Components of the confirmed links settle most buckets.
* Where a bucket still spans several components (after a second round against
  another centre), its members are compared across components in blocks of about
  ``BLOCK``, one row per block pair. A pair leaves it for the exact check unless
  the bitmaps of its two sets prove it apart (an upper bound of the intersection,
  so nothing is lost); hardly any pair below the threshold does.
* Only texts of documents in a shared bucket are shuffled for the check.

Null or empty text, or no words: an empty set (n_shingles 0), linked with nothing.
Rows that repeat a doc_id: each row is its own document for n_shingles and for links; all
share the component of the doc_id, which joins what any of them is linked with. Null doc_id rows: component null, kept true.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.common import U, Rolling, Words, mix64, signed, text_blocks, written
from minelake.llm.components import components

SHINGLE = 5
ROWS, BANDS = 4, 40
#: members of a block
BLOCK = 256
_STEP = 0x9E3779B1


def shingle_sets(texts: pa.Array, width: int = SHINGLE):
    """Per block: (first row, last row + 1, sorted distinct shingle hashes, bounds)."""
    for i, j, data, off in text_blocks(texts):
        words = Words(data, off, lower=True)
        roll = Rolling(words.hashes())
        counts = np.diff(words.bounds)
        whole = counts < width
        n = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
        doc = np.repeat(np.arange(j - i), n)
        begin = words.bounds[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        end = np.where(whole[doc], words.bounds[doc + 1], begin + width) if len(doc) else begin
        h = roll.spans(begin, end)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        yield i, j, h, np.searchsorted(doc, np.arange(j - i + 1))


def _pi(x: np.ndarray) -> np.ndarray:
    """The second permutation of the 32-bit words."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(h: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant signatures of the non-empty sets among ``bounds``; others stay at the maximum."""
    out = np.full((len(bounds) - 1, coordinates), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        sigma = (mix64(h ^ U(0x5851F42D4C957F2D)) >> U(32)).astype(np.uint32)
        at = bounds[:-1][some]
        for k in range(coordinates):
            out[some, k] = np.minimum.reduceat(_pi(sigma + np.uint32(k * _STEP & 0xFFFFFFFF)), at)
    return out


def _profile(rows: int, bands: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, h, bounds in shingle_sets(batch.column(1)):
                sig = signatures(h, bounds, rows * bands).astype(U).reshape(j - i, bands, rows)
                key = np.arange(bands, dtype=U)[None, :] * U(0x9FB21C651E98DF25)
                for r in range(rows):
                    key = mix64(key + sig[:, :, r])
                total = np.concatenate([[U(0)], np.cumsum(mix64(h), dtype=U)])
                other = np.concatenate([[U(0)], np.cumsum(mix64(h ^ U(0x94D049BB133111EB)), dtype=U)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(np.diff(bounds)),
                     pa.array(signed(total[bounds[1:]] - total[bounds[:-1]])), pa.array(signed(other[bounds[1:]] - other[bounds[:-1]])),
                     pa.ListArray.from_arrays(np.arange(0, key.size + 1, bands, dtype=np.int32), pa.array(signed(key.ravel()))),
                     pa.array([bitmap(h[s:e]) for s, e in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["doc_id", "t", "n_shingles", "f1", "f2", "keys", "bits"])
    return run


def _linked(threshold_pct: int):
    """Of rows (a, b, text_a, text_b), the pairs whose full sets are alike."""
    def sets(ids: np.ndarray, texts: pa.Array) -> tuple[list, np.ndarray]:
        _, at, back = np.unique(ids, return_index=True, return_inverse=True)
        found = []
        for _, _, h, bounds in shingle_sets(texts.take(pa.array(at))):
            found += [h[s:e] for s, e in zip(bounds[:-1], bounds[1:])]
        return found, back

    def run(batches):
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            (sa, ia), (sb, ib) = sets(a, batch.column(2)), sets(b, batch.column(3))
            keep = np.zeros(len(a), bool)
            for k in range(len(a)):
                x, y = sa[ia[k]], sb[ib[k]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = both > 0 and 100 * both >= threshold_pct * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
    return run


def bitmap(h: np.ndarray) -> bytes:
    """The set as a bitmap of 8 bits or more a shingle, a power of two of bytes."""
    size = max(32, 1 << max(0, len(h) - 1).bit_length())
    bits = np.zeros(8 * size, np.uint8)
    bits[(h >> U(20)) & U(8 * size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(rows: list[bytes], size: int) -> np.ndarray:
    """Bitmaps folded to ``size`` bytes: position modulo the smaller size."""
    return np.stack([np.bitwise_or.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0) for x in rows])


def _across(threshold_pct: int):
    """Of block pairs of one bucket, the pairs across components that may be alike."""
    def members(column: pa.Array, k: int):
        m = column[k].values
        return *(m.field(x).to_numpy(zero_copy_only=False) for x in ("id", "n", "c")), m.field("bits").to_pylist()

    def pairs(x, y):
        (ids, n, c, bits), (ids2, n2, c2, bits2) = x, y
        sizes = np.array([len(v) for v in bits2])
        for size in np.unique([min(len(v), w) for v in bits for w in np.unique(sizes)]):
            left = [k for k, v in enumerate(bits) if len(v) >= size]
            right = np.flatnonzero(sizes >= size)
            own, other = _folded([bits[k] for k in left], size), _folded([bits2[k] for k in right], size)
            for k, mine in zip(left, own):
                some = np.flatnonzero((c2[right] != c[k]) & (np.minimum(len(bits[k]), sizes[right]) == size)
                                      & (100 * np.minimum(n[k], n2[right]) >= threshold_pct * np.maximum(n[k], n2[right])))
                at, theirs = right[some], other[some]
                most = np.minimum(n[k] - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
                                  n2[at] - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64))
                at = at[100 * most >= threshold_pct * (n[k] + n2[at] - most)]
                yield np.stack([np.minimum(ids[k], ids2[at]), np.maximum(ids[k], ids2[at])])

    def run(batches):
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for k in range(batch.num_rows):
                found += pairs(members(batch.column(0), k), members(batch.column(1), k))
            both = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, threshold_pct: int = 75, rows: int = ROWS, bands: int = BANDS, centres: int = 2) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))
    profile = written(texts.mapInArrow(_profile(rows, bands), "doc_id long, t long, n_shingles long, f1 long, f2 long, keys array<long>, bits binary"), "profiles")
    # a node is a doc_id; where a doc_id repeats with several sets, each further set is a node of its own
    sets = profile.where("n_shingles > 0 AND doc_id IS NOT NULL")
    own = F.struct("f1", "f2")
    several = written(sets.groupBy("doc_id").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo <> hi").select("doc_id", "lo"), "several")
    repeats = several.limit(1).count() > 0
    if repeats:
        extra = F.xxhash64("doc_id", "f1", "f2", "n_shingles")
        sets = sets.join(several, "doc_id", "left").withColumn("node", F.when(F.col("lo").isNull() | (F.col("lo") == own), F.col("doc_id")).otherwise(extra)).drop("lo")
    else:
        sets = sets.withColumn("node", F.col("doc_id"))
    # equal sets: one representative, of a row whose text is known by its hash t
    classes = sets.groupBy("f1", "f2", "n_shingles").agg(F.min(F.struct("node", "t")).alias("at"))
    classes = written(classes.select("f1", "f2", "n_shingles", F.col("at.node").alias("rep"), F.col("at.t").alias("rep_t")), "classes")
    member = sets.join(classes, ["f1", "f2", "n_shingles"]).select("doc_id", "t", "node", "rep", "rep_t", F.col("n_shingles").alias("n"), "keys", "bits")
    lead = member.where("node = rep AND t = rep_t").select(F.col("node").alias("id"), "doc_id", "t", "n", "keys", "bits")
    banded = lead.select("id", "doc_id", "t", "n", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    found = written(banded.join(shared, "key").distinct(), "buckets")
    bucket = found.select("id", "n", "key")
    inside = written(texts.join(found.select("id", "doc_id", "t").distinct(), ["doc_id", "t"]).groupBy("id").agg(F.min("text").alias("text")), "bucket-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = inside.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = inside.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        near = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        return near.mapInArrow(_linked(threshold_pct), "a long, b long")

    bitmaps = lead.select("id", "n", "bits")
    sized = f"100 * least(n, m) >= {threshold_pct} * greatest(n, m)"
    links = docs.sparkSession.createDataFrame([], "a long, b long")
    if repeats:  # the sets of one doc_id belong together
        other, first = (member.where(w).select("doc_id", F.col("rep").alias(c)) for w, c in (("node <> doc_id", "a"), ("node = doc_id", "b")))
        links = written(other.join(first, "doc_id").select("a", "b").distinct(), "sets-of-one")
    tried = label = None
    for turn in range(centres + 1):
        if label is None:
            at = bucket.withColumn("c", F.col("id"))
        else:
            at = bucket.join(label, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
            open_ = at.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("key")
            at = at.join(open_, "key")
        if turn < centres:
            # each member against one centre of its bucket, another centre each turn
            order = F.xxhash64(F.col("c"), F.lit(turn)) if turn else F.col("c")
            pick = F.struct(order.alias("first"), "c", "id", "n")
            centre = at.groupBy("key").agg(F.min(pick).alias("p")).select("key", F.col("p.c").alias("d"), F.col("p.id").alias("o"), F.col("p.n").alias("m"))
            pairs = (at.join(centre, "key").where("c <> d").where(sized)
                     .select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct())
        else:
            # what is left: across components, in blocks
            sizes = at.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
            blocks = (at.join(sizes, "key").join(bitmaps, ["id", "n"])
                      .groupBy("key", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
                      .agg(F.collect_list(F.struct("id", "n", "c", "bits")).alias("x")))
            blocks = written(blocks, "blocks")
            other = blocks.select("key", F.col("block").alias("block2"), F.col("x").alias("y"))
            pairs = (blocks.join(other, "key").where("block <= block2").select("x", "y")
                     .mapInArrow(_across(threshold_pct), "a long, b long").distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        new = written(confirmed(pairs), "links")
        links = links.union(new)
        tried = pairs if tried is None else tried.union(pairs)
        label = written(components(links), "components")
    whole = member.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(label.withColumnRenamed("id", "rep"), "rep", "left")
    whole = whole.select("doc_id", F.coalesce("component", "rep").alias("c"))
    if repeats:  # a component's smallest node may be no doc_id then
        least = whole.groupBy("c").agg(F.min("doc_id").alias("least"))
        whole = whole.join(least, "c").select("doc_id", F.col("least").alias("c"))
    return (profile.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
