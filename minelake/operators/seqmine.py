"""Sequential pattern mining (MIN3-MIN7, JON10, JON11).

``prefixspan`` is Spark ML's distributed PrefixSpan: the default engine.

``gsp_compat`` reproduces the level-wise miner of the reference, whose join
is non-standard (sequence extension when ``p1[:-1] == p2[1:]``, appending
``p2[-1]``; itemset extension only when that fails). Both engines count
support with the same containment test, so every compat pattern is a
frequent pattern, and PrefixSpan finds all of those. The compat levels are
therefore computed on pattern tables only: level k+1 is the set of
PrefixSpan patterns with k+1 items that the compat join can build from
level k. Whether a pattern q can be built is decided from q itself with
semi-joins on array keys:

* q = (s1..sn, t) by sequence extension needs p1 = (s1..sn) in level k and
  some other p2 in level k with p2[1:] = (s1..s(n-1)) and p2[-1] = t; for
  n = 1 that is "t is another level-k single-itemset pattern", for n >= 2 it
  forces t = s(n-1) and asks for any p2 with that tail other than p1;
* q = (s1..s(n-1), S), n >= 2, by itemset extension needs two distinct
  x, y in S with (s1..s(n-1), S - {x}) and (s1..s(n-1), S - {y}) in level k
  (for one of the two orders the sequence extension test fails, so the
  itemset extension fires).

No candidate pairs are enumerated and the data are scanned only by
PrefixSpan. ``pattern_support`` (MIN3/MIN4) counts any given patterns by walking one
trie of them along every distinct sequence.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast, shared_table


def _key(c: Column) -> Column:
    """Canonical text key of an array<array<string>> pattern."""
    return F.array_join(F.transform(c, lambda s: F.array_join(s, "\u0002")), "\u0001")


def pattern_text(c: str | Column, arrow: str = " → ") -> Column:
    """FN9: ``{a, b} → {c}``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda s: F.concat(F.lit("{"), F.array_join(s, ", "), F.lit("}"))),
                        arrow)


def contains_pattern(sequence: Column, pattern: Column) -> Column:
    """MIN3: greedy subsequence containment of itemsets, as an ``aggregate`` fold.

    State = index of the next pattern itemset; each sequence itemset can
    advance it by one when it holds that pattern itemset. An empty pattern
    matches everything.
    """
    n = F.size(pattern)
    idx = F.aggregate(
        sequence, F.lit(0),
        lambda acc, s: F.when((acc < n) & (F.size(F.array_except(F.element_at(pattern, acc + 1), s)) == 0),
                              acc + 1).otherwise(acc))
    return (n == 0) | (idx == n)


def prefixspan(sequences: DataFrame, seq_col: str = "sequence", min_support: float = 0.1,
               max_len: int = 5, max_local_proj_db_size: int = 32_000_000) -> DataFrame:
    """MIN6/MIN7 (default engine): (pattern, freq, support, level, n_itemsets).

    ``level`` counts items (an itemset extension also adds one), as in the
    reference; ``n_itemsets`` counts itemsets.
    """
    # counted once and scanned once a level: kept until the patterns are written
    data = (sequences.select(F.transform(F.col(seq_col), lambda s: F.array_sort(F.array_distinct(s)))
                             .alias("sequence"))).persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    if n == 0:
        data.unpersist()
        return sequences.sparkSession.createDataFrame(
            [], "pattern array<array<string>>, freq long, support double, level int, n_itemsets int")
    ps = PrefixSpan(minSupport=min_support, maxPatternLength=max_len,
                    maxLocalProjDBSize=max_local_proj_db_size, sequenceCol="sequence")
    # the result is an uncached RDD-backed frame; checkpoint the (small)
    # pattern table once so later joins do not mine again
    from ..session import cut_lineage

    res = cut_lineage(ps.findFrequentSequentialPatterns(data))
    data.unpersist()
    return (res.select(F.transform("sequence", lambda s: F.array_sort(s)).alias("pattern"),
                       F.col("freq").cast("long").alias("freq"))
            .withColumn("support", F.col("freq") / F.lit(float(n)))
            .where(F.col("support") >= F.lit(min_support))
            .withColumn("level", F.aggregate("pattern", F.lit(0), lambda a, s: a + F.size(s)))
            .withColumn("n_itemsets", F.size("pattern")))


#: most items of a sequence whose subsequences are listed
SHORT = 12


def short_patterns(sequences: DataFrame, by: str, seq_col: str = "sequence", min_support: float = 0.1, max_len: int = 5, weight: str | None = None) -> DataFrame:
    """``by`` and the columns of ``prefixspan``: frequent patterns of every group, one pass for all.

    For sequences of at most ``SHORT`` single-item itemsets. Equal sequences of a group
    are counted first (partial aggregates), so what follows grows with the
    distinct sequences: each lists its distinct subsequences once (position masks, fewer
    than 2**SHORT), which are added up by group and pattern. ``weight``: how many sequences a
    row stands for.
    """
    counted = sequences.groupBy(by, F.flatten(seq_col).alias("_items")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c"))
    totals = counted.groupBy(by).agg(F.sum("_c").alias("_n"))
    masks = F.sequence(F.lit(1), (F.lit(2) ** F.size("_items") - 1).cast("int"))
    wanted = F.filter(masks, lambda m: F.bit_count(m) <= max_len)
    listed = F.array_distinct(F.transform(wanted, lambda m: F.filter("_items", lambda _x, i: F.getbit(m, i) == 1)))
    pats = (counted.where(F.size("_items") > 0).select(by, "_c", F.explode(listed).alias("_p"))
            .groupBy(by, "_p").agg(F.sum("_c").alias("freq")))
    support = F.col("freq") / F.col("_n").cast("double")
    return (pats.join(F.broadcast(totals), by).withColumn("support", support).where(F.col("support") >= min_support)
            .select(by, F.transform("_p", lambda x: F.array(x)).alias("pattern"), "freq", "support",
                    F.size("_p").alias("level"), F.size("_p").alias("n_itemsets")))


def _compat_next(level_k: DataFrame, cand: DataFrame) -> DataFrame:
    """Level k+1 of the compat miner from level k and the (k+1)-item patterns."""
    lk = level_k.select("pattern").withColumn("_pk", _key(F.col("pattern")))
    keys = bounded_broadcast(lk.select("_pk"))
    c = cand.withColumn("_n", F.size("pattern")).withColumn("_qk", _key(F.col("pattern")))

    # --- sequence extension
    c = c.withColumn("_p1k", _key(F.slice("pattern", 1, F.size("pattern") - 1)))
    has_p1 = c.join(keys.withColumnRenamed("_pk", "_p1k"), "_p1k", "left_semi")
    # n = 1 (q has two itemsets): t is another single-itemset level-k pattern
    single = has_p1.where(F.col("_n") == 2).withColumn(
        "_tk", _key(F.array(F.element_at("pattern", -1))))
    single = single.where(F.col("_tk") != F.col("_p1k")).join(
        keys.withColumnRenamed("_pk", "_tk"), "_tk", "left_semi")
    # n >= 2: last itemset repeats s(n-1); some other p2 has tail (s1..s(n-1))
    multi = has_p1.where((F.col("_n") >= 3) &
                         (F.element_at("pattern", -1) == F.element_at("pattern", F.col("_n") - 2)))
    tails = (lk.where(F.size("pattern") >= 2)
             .select(_key(F.slice("pattern", 2, F.size("pattern") - 1)).alias("_tail"), "_pk"))
    tail_counts = tails.groupBy("_tail").agg(F.count(F.lit(1)).alias("_m"))
    multi = (multi.withColumn("_tail", _key(F.slice("pattern", 1, F.col("_n") - 2)))
             .join(tail_counts, "_tail")
             # p1's own tail is (s2..sn); it only counts against us if equal
             .withColumn("_self", (_key(F.slice("pattern", 2, F.col("_n") - 2)) == F.col("_tail")).cast("int"))
             .where(F.col("_m") - F.col("_self") >= 1))
    seq_ext = single.select("pattern").union(multi.select("pattern"))

    # --- itemset extension (q has >= 2 itemsets, last itemset >= 2 items)
    last = F.element_at("pattern", -1)
    ie = c.where((F.col("_n") >= 2) & (F.size(last) >= 2))
    ie = ie.select("pattern", "_qk", F.explode(last).alias("_x"))
    ie = ie.withColumn("_sub", F.concat(F.slice("pattern", 1, F.size("pattern") - 1),
                                        F.array(F.array_remove(F.element_at("pattern", -1), F.col("_x")))))
    ie = ie.withColumn("_subk", _key(F.col("_sub"))).join(keys.withColumnRenamed("_pk", "_subk"), "_subk",
                                                           "left_semi")
    ok = ie.groupBy("_qk").agg(F.countDistinct("_x").alias("_hits")).where(F.col("_hits") >= 2)
    item_ext = c.join(ok, "_qk", "left_semi").select("pattern")

    both = seq_ext.union(item_ext).withColumn("_qk", _key(F.col("pattern")))
    return cand.withColumn("_qk", _key(F.col("pattern"))).join(
        both.select("_qk").distinct(), "_qk", "left_semi").drop("_qk")


def gsp_compat(sequences: DataFrame, seq_col: str = "sequence", min_support: float = 0.1,
               max_len: int = 5) -> DataFrame:
    """MIN5/MIN6 compat engine: the reference's level-wise result, same columns
    as ``prefixspan``. Level 1 = frequent items; level 2 = frequent <a, b>
    with a != b (every ordered pair of frequent items is a candidate there);
    higher levels as described in the module docstring.
    """
    from ..session import cut_lineage

    allp = prefixspan(sequences, seq_col, min_support, max_len)
    lvl1 = allp.where(F.col("level") == 1)
    lvl2 = allp.where((F.col("level") == 2) & (F.col("n_itemsets") == 2) &
                      (F.element_at("pattern", 1) != F.element_at("pattern", 2)))
    levels = [lvl1, lvl2] if max_len >= 2 else [lvl1]
    current = lvl2
    for k in range(2, max_len):
        cand = allp.where(F.col("level") == k + 1)
        nxt = _compat_next(current, cand)
        if nxt.limit(1).count() == 0:
            break
        nxt = cut_lineage(nxt)
        levels.append(nxt)
        current = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


#: bytes of pattern text in one trie (a pass over the sequences each)
TRIE_BYTES = 16 << 20


def _walk(trie):
    """Adds up, per pattern, the weights of the sequences that hold it.

    A node is (pattern numbers that end here, children by the first item of their itemset). A
    sequence walks the trie once: the earliest end of a prefix serves all patterns under it."""
    def run(batches):
        import pyarrow as pa

        held: dict[int, int] = {}
        for batch in batches:
            for sequence, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sets = [frozenset(s or ()) for s in sequence or ()]
                places: dict[str, list[int]] = {}
                for i, s in enumerate(sets):
                    for x in s:
                        places.setdefault(x, []).append(i)
                todo = [(trie.value, 0)]
                while todo:
                    (ends, children), at = todo.pop()
                    for e in ends:
                        held[e] = held.get(e, 0) + weight
                    if at < len(sets):  # an empty itemset is held by any
                        todo += [(child, at + 1) for _, child in children.get(None, ())]
                    for first in children.keys() & places.keys() if len(children) < len(places) else [x for x in places if x in children]:
                        for items, child in children[first]:
                            for i in places[first]:
                                if i >= at and items <= sets[i]:
                                    todo.append((child, i + 1))
                                    break
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["_p", "freq"])
    return run


def _trie(patterns) -> tuple:
    """The root of (number, pattern) rows; an empty itemset in a pattern is held by any."""
    root: tuple = ([], {})
    nodes = {(): root}
    for number, pattern in patterns:
        path: tuple = ()
        for s in pattern:
            items = frozenset(s)
            step = path + (items,)
            if step not in nodes:
                nodes[step] = ([], {})
                nodes[path][1].setdefault(min(items, default=None), []).append((items, nodes[step]))
            path = step
        nodes[path][0].append(number)
    return root


def pattern_support(sequences: DataFrame, patterns: DataFrame, seq_col: str = "sequence",
                    pattern_col: str = "pattern", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """MIN3/MIN4/JON10: support of each given pattern, by greedy containment.

    Equal sequences are counted first (partial aggregates). All patterns form one trie, which
    is broadcast and walked once per distinct sequence; a task sends one count per pattern it
    met. Patterns of more than ``trie_bytes`` of text make several tries, a pass each, so what is
    broadcast is bounded. Null and empty sequences hold the empty pattern alone and count as rows.
    """
    spark = sequences.sparkSession
    distinct = shared_table(sequences.groupBy(F.col(seq_col).alias("_seq")).agg(F.count(F.lit(1)).alias("_c")), "sequences")
    n = distinct.agg(F.sum("_c")).first()[0] or 0
    numbered = shared_table(patterns.select(F.col(pattern_col).alias("pattern")).distinct().withColumn("_p", F.monotonically_increasing_id()), "patterns")
    size = numbered.agg(F.sum(F.length(_key(F.col("pattern"))) + 16)).first()[0] or 0
    parts = -(-size // trie_bytes)
    counts = None
    for k in range(parts):
        some = numbered.where(F.pmod(F.xxhash64(_key(F.col("pattern"))), F.lit(parts)) == k)
        trie = spark.sparkContext.broadcast(_trie([(r["_p"], r["pattern"]) for r in some.collect()]))
        part = distinct.mapInArrow(_walk(trie), "_p long, freq long").groupBy("_p").agg(F.sum("freq").alias("freq"))
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "_p long, freq long")
    return (numbered.join(counts, "_p", "left").select("pattern", F.coalesce("freq", F.lit(0)).cast("long").alias("freq"))
            .withColumn("support", F.col("freq") / F.lit(float(max(n, 1)))))
