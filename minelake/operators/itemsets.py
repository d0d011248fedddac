"""Frequent itemsets and association rules (MIN1, MIN2, MIN8, FN15, AGG6-8, SRT1-2).

Mining is Spark ML's parallel FP-growth, which knows no longest itemset; where one is given and the
baskets are short, the itemsets of every distinct basket are counted instead. Rules are built for every
antecedent/consequent split (FPGrowth's own rules only have one-item
consequents): each itemset expands into its 2^k-2 splits with one
higher-order ``filter`` per side, and the two part supports come from
equi-joins on the sorted item arrays.
"""

from __future__ import annotations

from math import comb

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast, shared_table
from ..plans.parallel import spread


#: itemsets to list a basket, on average and at most; beyond, FP-growth
LISTED, LISTED_MOST = 64, 100_000


def _short_itemsets(data: DataFrame, n: int, min_support: float, max_size: int) -> DataFrame | None:
    """``mine_itemsets`` of ``n`` short baskets, or None where they hold too many itemsets.

    Equal baskets are counted first and rare items leave them (an itemset is at most as frequent as
    its items), then each basket left lists its itemsets of at most ``max_size`` items once."""
    counted = shared_table(data.groupBy(F.sort_array("items").alias("items")).agg(F.count(F.lit(1)).alias("_c")), "counted")
    if counted.where(F.exists("items", lambda x: x.isNull())).limit(1).count():
        return None  # a null is an item of its own to FP-growth
    often = (counted.select(F.explode("items").alias("_x"), "_c").groupBy("_x").agg(F.sum("_c").alias("_f"))
             .where(F.col("_f") / F.lit(float(n)) >= F.lit(min_support)).select("_x").collect())
    kept = counted.select(F.filter("items", lambda x: x.isin([r["_x"] for r in often])).alias("items"), "_c").where(F.size("items") > 0)
    sizes = {r["m"]: (r["count"], sum(comb(r["m"], k) for k in range(1, max_size + 1))) for r in kept.groupBy(F.size("items").alias("m")).count().collect()}
    if any(each > LISTED_MOST for _, each in sizes.values()) or sum(b * each for b, each in sizes.values()) > LISTED * n:
        return None
    none = F.array(F.array().cast(data.schema["items"].dataType))
    sets = F.aggregate("items", none, lambda acc, x: F.concat(acc, F.transform(F.filter(acc, lambda s: F.size(s) < max_size), lambda s: F.concat(s, F.array(x)))))
    listed = spread(kept).select(F.explode(sets).alias("items"), "_c").where(F.size("items") > 0)
    res = listed.groupBy("items").agg(F.sum("_c").alias("freq")).withColumn("support", F.col("freq") / F.lit(float(n)))
    return shared_table(res.where(F.col("support") >= F.lit(min_support)).select("items", F.size("items").alias("size"), "freq", "support"), "itemsets")


def mine_itemsets(baskets: DataFrame, items_col: str = "items", min_support: float = 0.01,
                  max_size: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """MIN2: frequent itemsets ``(items sorted, size, freq, support)``.

    Support is ``freq / n``; the float threshold is applied again after
    mining, since FP-growth cuts on ``ceil(min_support * n)``.
    """
    # written once: the count and every pass of FP-growth would build the baskets again
    data = shared_table(baskets.select(F.array_distinct(F.col(items_col)).alias("items")).where(F.size("items") > 0), "baskets")
    n = data.count()
    if n == 0:
        schema = "items array<string>, size int, freq long, support double"
        return baskets.sparkSession.createDataFrame([], schema)
    if max_size is not None and (short := _short_itemsets(data, n, min_support, max_size)) is not None:
        return short
    data = spread(data)  # the written baskets may be few files
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(data)
    # freqItemsets is rebuilt from an uncached RDD on every action; the mined
    # table is small, so it is checkpointed once to the shared folder.
    from ..session import cut_lineage

    res = (cut_lineage(model.freqItemsets)
           .select(F.sort_array("items").alias("items"), F.col("freq").cast("long").alias("freq"))
           .withColumn("size", F.size("items"))
           .withColumn("support", F.col("freq") / F.lit(float(n)))
           .where(F.col("support") >= F.lit(min_support)))
    if max_size is not None:
        res = res.where(F.col("size") <= max_size)
    return res.select("items", "size", "freq", "support")


def itemset_sizes(itemsets: DataFrame) -> DataFrame:
    """AGG6: number of itemsets per size."""
    return itemsets.groupBy("size").agg(F.count(F.lit(1)).alias("n_itemsets"))


def top_itemsets(itemsets: DataFrame, size: int | None, n: int,
                 min_support: float | None = None, strict: bool = True) -> DataFrame:
    """SRT1/FLT2: top ``n`` itemsets of one size by support (ties: items asc)."""
    res = itemsets
    if size is not None:
        res = res.where(F.col("size") == size)
    if min_support is not None:
        res = res.where(F.col("support") > min_support if strict else F.col("support") >= min_support)
    return res.orderBy(F.desc("support"), F.array_join("items", ",")).limit(n)


# ----------------------------------------------------------------------------- rules

RULE_METRICS = ("support", "confidence", "lift", "leverage", "conviction",
                "zhangs_metric", "kulczynski")


def _rule_metrics(s: Column, sa: Column, sc: Column) -> dict[str, Column]:
    conf = s / sa
    lev = s - sa * sc
    denom = F.greatest(s * (1 - sa), sa * (sc - s))
    return {
        "confidence": conf,
        "lift": conf / sc,
        "leverage": lev,
        # conf == 1 -> +inf, as in the reference
        "conviction": F.when(conf >= 1.0, F.lit(float("inf"))).otherwise((1 - sc) / (1 - conf)),
        "zhangs_metric": F.when(denom == 0, F.lit(0.0)).otherwise(lev / denom),
        "kulczynski": 0.5 * (s / sa + s / sc),
    }


def association_rules(itemsets: DataFrame, metric: str = "confidence",
                      min_threshold: float = 0.5, max_size: int | None = None) -> DataFrame:
    """MIN8: rules A -> C for every split of every frequent itemset.

    Output: antecedents, consequents (sorted arrays), antecedent_support,
    consequent_support and the FN15 metrics; kept where ``metric >= t``.
    """
    if metric not in RULE_METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {RULE_METRICS}")
    base = itemsets.select("items", "support")
    full = base.where(F.size("items") >= 2)
    if max_size is not None:
        full = full.where(F.size("items") <= max_size)
    masks = F.sequence(F.lit(1), F.expr("shiftleft(1L, size(items)) - 2"))
    splits = (full.select("items", "support", F.explode(masks).alias("mask"))
              .select(F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("antecedents"),
                      F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("consequents"),
                      "support"))
    # Sub-itemsets of a frequent set are frequent, so both joins always hit.
    lookup = bounded_broadcast(base)
    sa = lookup.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    sc = lookup.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    rules = splits.join(sa, "antecedents").join(sc, "consequents")
    m = _rule_metrics(F.col("support"), F.col("antecedent_support"), F.col("consequent_support"))
    rules = rules.select("antecedents", "consequents", "antecedent_support", "consequent_support",
                         "support", *[v.alias(k) for k, v in m.items()])
    return rules.where(F.col(metric) >= F.lit(min_threshold))


def top_rules(rules: DataFrame, by: str = "lift", n: int = 10) -> DataFrame:
    """SRT2: top ``n`` rules by one metric (ties: antecedents, consequents)."""
    return rules.orderBy(F.desc(by), F.array_join("antecedents", ","),
                         F.array_join("consequents", ",")).limit(n)


def rule_summary(rules: DataFrame, lift_threshold: float = 1.5) -> DataFrame:
    """AGG7/FLT4: rule count, mean confidence, mean lift, rules above a lift."""
    return rules.agg(F.count(F.lit(1)).alias("n_rules"),
                     F.avg("confidence").alias("avg_confidence"),
                     F.avg("lift").alias("avg_lift"),
                     F.count_if(F.col("lift") > lift_threshold).alias("n_high_lift"))


def itemset_join(itemsets: DataFrame, items_col: str = "items") -> DataFrame:
    """SET6/JON11: unions of two itemsets that differ in one item each (their symmetric
    difference has two items), distinct, sorted.

    Such sets are equal without one item, so each set is keyed by itself with one item
    removed, once for every item: an equi-join in which every matching pair is a
    result, instead of a test of all pairs.
    """
    sets = itemsets.select(F.array_sort(F.array_distinct(items_col)).alias("_s")).where(F.size("_s") > 0).distinct()
    keyed = sets.select(F.explode("_s").alias("_x"), "_s").select("_x", F.array_remove("_s", F.col("_x")).alias("_key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    joined = a.join(b, (F.col("a._key") == F.col("b._key")) & (F.col("a._x") < F.col("b._x")))
    return joined.select(F.array_sort(F.concat("a._key", F.array("a._x", "b._x"))).alias(items_col)).distinct()
