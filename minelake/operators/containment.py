"""Itemset-in-group containment and the reports built on it (FLT6, JON4, JON5,
AGG9-AGG11, WIN1-WIN2, MIN18-MIN20).

Itemsets and group baskets are packed bit masks over one item dictionary: ``items ⊆ basket``
is a bitwise and. The itemsets to test are ranked once (support desc, items asc) and taken
in chunks of ``CHUNK``, whose masks are constants inside the row expression; a group is one
row of a few 64-bit words, tested in place. So nothing fans out: no basket is copied, no
(itemset, group) pair is a row unless it is a hit that was asked for, and no
plan holds a predicate join.

* The dictionary holds only the items of the chunk's itemsets, so a mask has at most
  ``CHUNK`` x itemset size / 64 words, whatever the vocabulary.
* The masks of the groups are one ``bit_or`` aggregate by group key with partial
  aggregates, which reuses the partitioning of the baskets where they are grouped by that key.
* Top ``k`` stops early inside the row: itemsets are tested in rank order in batches of
  growing size, and a later batch is not evaluated where ``k`` hits are found.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast, shared_table

#: itemsets tested in one pass over the groups; the first batch inside a chunk
CHUNK, BATCH = 8128, 64

_MASK, _HITS = "_ml_mask", "_ml_hits"


def is_subset(items: str, basket: str):
    """FLT6 as a row predicate (for already-paired rows)."""
    return F.size(F.array_except(F.col(items), F.col(basket))) == 0


class _Chunk:
    """Ranked itemsets as masks: word numbers and masks by position, padded to one length."""

    def __init__(self, rows: Sequence, items_col: str, batch: int):
        self.batch, self.size = batch, len(rows)
        self.items = sorted({x for r in rows for x in r[items_col]})
        self.words = max(1, -(-len(self.items) // 64))
        at = {x: i for i, x in enumerate(self.items)}
        masks = []
        for r in rows:
            m: dict[int, int] = {}
            for x in r[items_col]:
                m[at[x] // 64 + 1] = m.get(at[x] // 64 + 1, 0) | 1 << at[x] % 64
            masks.append(sorted(m.items()) or [(1, 0)])
        self.width = max(map(len, masks))
        self.masks = [m + [m[0]] * (self.width - len(m)) for m in masks]

    def table(self, ranked: Sequence, spark, schema) -> DataFrame:
        """(position, itemset columns) of the chunk's itemsets."""
        return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(ranked)], schema)

    def _held(self, first: int, last: int) -> Column:
        """Positions first .. last (1-based) of the itemsets that the row's mask holds."""
        tests = []
        for j in range(self.width):
            words = ", ".join(str(m[j][0]) for m in self.masks[first - 1:last])
            masks = ", ".join(f"{m[j][1] - (1 << 64) if m[j][1] >= 1 << 63 else m[j][1]}L" for m in self.masks[first - 1:last])
            masks = masks.replace(f"-{1 << 63}L", "shiftleft(1L, 63)")
            word = f"element_at({_MASK}, element_at(array({words}), i))" if self.words > 1 else f"element_at({_MASK}, 1)"
            tests.append(f"({word} & element_at(array({masks}), i)) = element_at(array({masks}), i)")
        found = F.expr(f"filter(sequence(1, {last - first + 1}), i -> {' AND '.join(tests)})")
        return F.transform(found, lambda i: i + (first - 1)) if first > 1 else found

    def batches(self) -> Iterator[tuple[int, int]]:
        first, size = 1, self.batch
        while first <= self.size:
            yield first, min(self.size, first + size - 1)
            first, size = first + size, 2 * size

    def hits(self, masks: DataFrame, k: int | None = None) -> DataFrame:
        """``_HITS``: ascending positions of the held itemsets, all or the first ``k``."""
        if k is None:
            return masks.withColumn(_HITS, self._held(1, self.size))
        out = masks.withColumn(_HITS, F.array().cast("array<int>"))
        for first, last in self.batches():
            more = F.concat(_HITS, self._held(first, last))
            out = out.withColumn(_HITS, F.when(F.size(_HITS) >= k, F.col(_HITS)).otherwise(more))
        return out.withColumn(_HITS, F.slice(_HITS, 1, k))


def _chunks(itemsets: DataFrame, items_col: str, chunk: int, batch: int) -> Iterator[tuple[_Chunk, DataFrame]]:
    """The (distinct) itemsets by support desc, items asc, in chunks, each with its table.

    The driver holds one chunk; the next one is a top-n query beyond the last row of this one."""
    text = F.array_join(items_col, ",")
    stored = shared_table(itemsets.withColumn("_ml_text", text), "itemsets")
    spark, rest = itemsets.sparkSession, stored
    while True:
        rows = rest.orderBy(F.desc("support"), "_ml_text").limit(chunk).collect()
        if not rows:
            return
        packed = _Chunk(rows, items_col, batch)
        schema = "_ml_at int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)
        yield packed, packed.table(rows, spark, schema).drop("_ml_text")
        if len(rows) < chunk:
            return
        s, t = F.lit(rows[-1]["support"]), F.lit(rows[-1]["_ml_text"])
        rest = stored.where((F.col("support") < s) | ((F.col("support") == s) & (F.col("_ml_text") > t)))


def packed_baskets(groups: DataFrame, group_key: str, group_items: str, dictionary: Sequence[str], words: int) -> DataFrame:
    """(group_key, mask words) of every group, groups without a dictionary item included."""
    named = groups.sparkSession.createDataFrame([(x, i // 64, i % 64) for i, x in enumerate(dictionary)], "_ml_item string, _ml_word int, _ml_bit int")
    long = groups.select(group_key, F.explode_outer(group_items).alias("_ml_item")).join(F.broadcast(named), "_ml_item", "left")
    bit = F.expr("shiftleft(1L, _ml_bit)")
    masks = long.groupBy(group_key).agg(*[F.coalesce(F.bit_or(F.when(F.col("_ml_word") == w, bit)), F.lit(0).cast("long")).alias(f"_ml_{w}") for w in range(words)])
    return masks.select(group_key, F.array(*[f"_ml_{w}" for w in range(words)]).alias(_MASK))


def _held_by(itemsets: DataFrame, groups: DataFrame, group_key: str, items_col: str, group_items: str, chunk: int = CHUNK, batch: int = BATCH):
    """Per chunk: (the chunk, its table, the groups' masks)."""
    for packed, table in _chunks(itemsets, items_col, chunk, batch):
        yield packed, table, packed_baskets(groups, group_key, group_items, packed.items, packed.words)


def contained_pairs(itemsets: DataFrame, groups: DataFrame, group_key: str,
                    items_col: str = "items", group_items: str = "items") -> DataFrame:
    """JON4: (itemset columns..., group_key) for every group holding the itemset."""
    out = None
    for packed, table, masks in _held_by(itemsets, groups, group_key, items_col, group_items):
        hits = packed.hits(masks).select(group_key, F.explode(_HITS).alias("_ml_at"))
        pairs = hits.join(F.broadcast(table), "_ml_at").select(*itemsets.columns, group_key)
        out = pairs if out is None else out.unionByName(pairs)
    return out if out is not None else _no_pairs(itemsets, groups, group_key)


def contained_counts(itemsets: DataFrame, groups: DataFrame, group_key: str, out: str = "n_itemsets",
                     items_col: str = "items", group_items: str = "items") -> DataFrame:
    """AGG9/AGG11: itemsets held per group, zero included, without a row per pair."""
    parts = None
    for packed, _table, masks in _held_by(itemsets, groups, group_key, items_col, group_items):
        part = packed.hits(masks).select(group_key, F.size(_HITS).cast("long").alias(out))
        parts = part if parts is None else parts.unionByName(part).groupBy(group_key).agg(F.sum(out).alias(out))
    return parts if parts is not None else groups.select(group_key).distinct().withColumn(out, F.lit(0).cast("long"))


def _no_pairs(itemsets: DataFrame, groups: DataFrame, group_key: str) -> DataFrame:
    return itemsets.limit(0).withColumn(group_key, F.lit(None).cast(groups.schema[group_key].dataType))


def groups_with_at_least(coverage: DataFrame, n: int, col: str = "n_itemsets") -> DataFrame:
    """AGG10: number of groups holding at least ``n`` of the itemsets, the most, the mean."""
    return coverage.agg(F.count_if(F.col(col) >= n).alias(f"n_groups_ge_{n}"), F.max(col).alias("max_itemsets"), F.avg(col).alias("avg_itemsets"))


def top_per_group(pairs: DataFrame, group_key: str, k: int = 3,
                  score: str = "support", items_col: str = "items") -> DataFrame:
    """WIN1/WIN2: top ``k`` itemsets per group by support (ties: items asc).

    ``row_number() <= k`` plans as a WindowGroupLimit, which cuts each map
    partition to ``k`` rows per group before the shuffle, so a hot group
    costs ``k`` rows per partition, not all of its rows.
    """
    w = Window.partitionBy(group_key).orderBy(F.desc(score), F.array_join(items_col, ","))
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def presence_matrix(pairs: DataFrame, itemsets: DataFrame, group_key: str,
                    groups: Sequence, items_col: str = "items") -> DataFrame:
    """JON5: itemset x group 0/1 grid, built by ``pivot`` on the chosen groups.

    ``groups`` is the short list of column values (top-10 by coverage);
    every listed itemset gets a row and every group a column, zeros kept,
    without a cross join.
    """
    marks = pairs.select(F.array_join(items_col, ",").alias("itemset"), group_key,
                         F.lit(1).alias("present"))
    grid = (itemsets.select(F.array_join(items_col, ",").alias("itemset")).distinct()
            .join(marks, "itemset", "left")
            .groupBy("itemset").pivot(group_key, list(groups)).agg(F.max("present")))
    return grid.fillna(0, subset=[str(g) for g in groups])


def pivot_to_long(grid: DataFrame, id_col: str, value_name: str, var_name: str) -> DataFrame:
    """Unpivot a presence grid back to (id, var, value) rows."""
    cols = [c for c in grid.columns if c != id_col]
    return grid.unpivot(id_col, cols, var_name, value_name)


def top_contained_per_group(itemsets: DataFrame, groups: DataFrame, group_key: str, k: int = 3,
                            items_col: str = "items", group_items: str = "items",
                            chunk: int = CHUNK, batch: int = BATCH) -> DataFrame:
    """Itemset columns, group_key and rank of the top ``k`` contained itemsets per group (support
    desc, items asc), exact.

    A chunk decides every group that holds ``k`` of its itemsets (all later ones rank lower); the
    others go on to the next chunk with the hits they have, through the shared folder.
    """
    out, found = None, None  # found: (group_key, hits so far) of the groups with fewer than k
    for packed, table, masks in _held_by(itemsets, groups, group_key, items_col, group_items, chunk, batch):
        if found is not None:
            left = bounded_broadcast(found.withColumnRenamed(group_key, "_ml_key"))
            masks = masks.join(left, F.col(group_key).eqNullSafe(F.col("_ml_key"))).drop("_ml_key")
        hits = packed.hits(masks, k)
        had = F.col("_ml_n") if found is not None else F.lit(0)
        if packed.size == chunk or found is not None:
            hits = shared_table(hits.select(group_key, _HITS, had.alias("_ml_n")), "hits")
            had = F.col("_ml_n")
        ranked = hits.select(group_key, had.alias("_ml_n"), F.posexplode(_HITS).alias("_ml_pos", "_ml_at"))
        ranked = ranked.withColumn("rank", (F.col("_ml_n") + F.col("_ml_pos") + 1).cast("int")).where(F.col("rank") <= k)
        part = ranked.join(F.broadcast(table), "_ml_at").select(*itemsets.columns, group_key, "rank")
        out = part if out is None else out.unionByName(part)
        if packed.size < chunk:
            break
        found = hits.select(group_key, (F.col("_ml_n") + F.size(_HITS)).alias("_ml_n")).where(F.col("_ml_n") < k)
    return out if out is not None else _no_pairs(itemsets, groups, group_key).withColumn("rank", F.lit(None).cast("int"))


def export_group_itemsets(itemsets: DataFrame, groups: DataFrame, group_key: str,
                          size: int = 3, min_support: float = 0.05, k: int = 3) -> DataFrame:
    """MIN18: itemsets of one size above a support, mapped to groups, top k each."""
    chosen = itemsets.where((F.col("size") == size) & (F.col("support") > min_support))
    return top_contained_per_group(chosen, groups, group_key, k)
