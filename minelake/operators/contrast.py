"""Class-contrast analysis of sequential patterns (MIN9-MIN12, MIN21, SET2,
SET3, JON6, JON7, FN14, AGG15-AGG18, SRT3, SRT4).

Sequences of a few single items are mined for all classes in one pass, others with one
miner run per class label (the class count is tiny and known); the comparison is one ``full_outer`` join on the pattern key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .seqmine import SHORT, _key, gsp_compat, pattern_text, prefixspan, short_patterns


def mine_by_class(sequences: DataFrame, label_col: str, classes: Sequence[str],
                  seq_col: str = "sequence", min_support: float = 0.1, max_len: int = 5,
                  engine: str = "prefixspan", longest: int | None = None, weight: str | None = None) -> DataFrame:
    """MIN9: patterns per class, with a ``class`` column; supports are within-class.

    ``longest``: the sequences have single-item itemsets and at most so many of them; their
    patterns are then counted for all classes in one pass (``seqmine.short_patterns``), and
    a row may stand for ``weight`` sequences."""
    if longest is not None and longest <= SHORT and engine == "prefixspan":
        some = sequences.where(F.col(label_col).isin(list(classes))).select(F.col(label_col).alias("class"), seq_col, *([weight] if weight else []))
        return short_patterns(some, "class", seq_col, min_support, max_len, weight)
    if weight:
        raise ValueError("only short sequences of single items take a weight")
    miner = prefixspan if engine == "prefixspan" else gsp_compat
    parts = []
    for c in classes:
        sub = sequences.where(F.col(label_col) == F.lit(c))
        parts.append(miner(sub, seq_col, min_support, max_len).withColumn("class", F.lit(c)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_totals(sequences: DataFrame, label_col: str, classes: Sequence[str]) -> DataFrame:
    """AGG18/AGG17: total sequences, per-class counts and mean length, one pass."""
    return sequences.agg(F.count(F.lit(1)).alias("total_sequences"),
                         *[F.count_if(F.col(label_col) == F.lit(c)).alias(f"n_{c}") for c in classes],
                         F.avg(F.size("sequence")).alias("avg_sequence_length"))


def compare_classes(patterns: DataFrame, class_a: str, class_b: str,
                    lift_threshold: float = 1.5) -> DataFrame:
    """MIN10/JON6/JON7/FN14: one row per pattern of either class.

    ``status`` is common / unique_<a> / unique_<b>; common patterns carry both
    lifts and ``discriminative_for`` (a if lift_a > t, else b if lift_b > t,
    else neutral). Neutral patterns stay in, as in the reference.
    """
    a = patterns.where(F.col("class") == class_a).select(
        _key(F.col("pattern")).alias("_pk"), F.col("pattern").alias("_pa"),
        F.col("support").alias("support_a"), F.col("freq").alias("freq_a"))
    b = patterns.where(F.col("class") == class_b).select(
        _key(F.col("pattern")).alias("_pk"), F.col("pattern").alias("_pb"),
        F.col("support").alias("support_b"), F.col("freq").alias("freq_b"))
    j = a.join(b, "_pk", "full_outer")
    lift_a = F.col("support_a") / F.col("support_b")
    lift_b = F.col("support_b") / F.col("support_a")
    common = F.col("support_a").isNotNull() & F.col("support_b").isNotNull()
    status = (F.when(common, F.lit("common"))
              .when(F.col("support_a").isNotNull(), F.lit(f"unique_{class_a}"))
              .otherwise(F.lit(f"unique_{class_b}")))
    disc = (F.when(~common, F.lit(None))
            .when(lift_a > lift_threshold, F.lit(class_a))
            .when(lift_b > lift_threshold, F.lit(class_b))
            .otherwise(F.lit("neutral")))
    return j.select(F.coalesce("_pa", "_pb").alias("pattern"), "support_a", "support_b",
                    "freq_a", "freq_b", status.alias("status"),
                    F.when(common, lift_a).alias("lift_a"), F.when(common, lift_b).alias("lift_b"),
                    disc.alias("discriminative_for"))


def top_discriminative(comparison: DataFrame, n: int = 10) -> DataFrame:
    """SRT4: common patterns by max(lift_a, lift_b) desc (ties: pattern text)."""
    return (comparison.where(F.col("status") == "common")
            .orderBy(F.desc(F.greatest("lift_a", "lift_b")), pattern_text("pattern"))
            .limit(n))


def top_unique(comparison: DataFrame, cls: str, n: int = 10, support_col: str = "support_a") -> DataFrame:
    """SRT3/SRT4: patterns unique to one class by support desc (ties: text)."""
    return (comparison.where(F.col("status") == f"unique_{cls}")
            .orderBy(F.desc(support_col), pattern_text("pattern")).limit(n))


def interpretations(comparison: DataFrame, class_a: str, class_b: str,
                    n_disc: int = 5, n_unique: int = 3) -> DataFrame:
    """MIN11: sentences for the top discriminative (neutral dropped after the
    cut to ``n_disc``) and the top unique patterns of each class."""
    disc = top_discriminative(comparison, n_disc).where(F.col("discriminative_for") != "neutral")
    lift = F.when(F.col("discriminative_for") == class_a, F.col("lift_a")).otherwise(F.col("lift_b"))
    d = disc.select(pattern_text("pattern").alias("pattern"),
                    F.format_string("Pattern strongly associated with %s cases (lift: %.2f)",
                                    F.col("discriminative_for"), F.round(lift, 2)).alias("interpretation"),
                    F.lit("discriminative").alias("type"))
    parts = [d]
    for cls, sup in ((class_a, "support_a"), (class_b, "support_b")):
        u = top_unique(comparison, cls, n_unique, sup)
        parts.append(u.select(pattern_text("pattern").alias("pattern"),
                              F.format_string(f"Pattern unique to {cls} cases (support: %.3f)",
                                              F.round(sup, 3)).alias("interpretation"),
                              F.lit(f"unique_{cls}").alias("type")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_importance(patterns: DataFrame, k: int = 10) -> DataFrame:
    """AGG15: per class, sum of pattern support per feature (text before the
    first '_' of each item), top ``k`` by score (ties: feature asc).

    Scores are summed doubles, so ranks compare them at 9 decimals: an exact
    tie must not be decided by summation order."""
    items = patterns.select("class", "support", F.explode(F.flatten("pattern")).alias("item"))
    scores = (items.groupBy("class", F.substring_index("item", "_", 1).alias("feature"))
              .agg(F.sum("support").alias("score")))
    w = Window.partitionBy("class").orderBy(F.desc(F.round("score", 9)), "feature")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pattern_summary(patterns: DataFrame) -> DataFrame:
    """AGG16: count, mean/max/min support per class."""
    return patterns.groupBy("class").agg(F.count(F.lit(1)).alias("n_patterns"),
                                         F.avg("support").alias("avg_support"),
                                         F.max("support").alias("max_support"),
                                         F.min("support").alias("min_support"))


def four_way(patterns: DataFrame, class_a: str, class_b: str, min_difference: int = 5) -> DataFrame:
    """SET3: unique to a / unique to b / dominant in a / dominant in b by
    absolute counts (difference >= ``min_difference``); other patterns drop."""
    cmp = compare_classes(patterns, class_a, class_b)
    diff = F.col("freq_a") - F.col("freq_b")
    cat = (F.when(F.col("status") == f"unique_{class_a}", F.lit(f"{class_a}_unique"))
           .when(F.col("status") == f"unique_{class_b}", F.lit(f"{class_b}_unique"))
           .when(diff >= min_difference, F.lit(f"{class_a}_dominant"))
           .when(-diff >= min_difference, F.lit(f"{class_b}_dominant")))
    return cmp.withColumn("category", cat).where(F.col("category").isNotNull())


def analyze(sequences: DataFrame, label_col: str, class_a: str, class_b: str,
            min_support: float = 0.1, max_len: int = 5, engine: str = "prefixspan", longest: int | None = None) -> dict[str, DataFrame]:
    """MIN12: the full analysis as named DataFrames (lazy except the mining)."""
    pats = mine_by_class(sequences, label_col, [class_a, class_b], min_support=min_support,
                         max_len=max_len, engine=engine, longest=longest)
    cmp = compare_classes(pats, class_a, class_b)
    return {
        "class_patterns": pats,
        "comparison": cmp,
        "discriminative_top10": top_discriminative(cmp, 10),
        f"unique_{class_a}_top10": top_unique(cmp, class_a, 10, "support_a"),
        f"unique_{class_b}_top10": top_unique(cmp, class_b, 10, "support_b"),
        "feature_importance": feature_importance(pats, 10),
        "pattern_summary": pattern_summary(pats),
        "totals": class_totals(sequences, label_col, [class_a, class_b]),
        "interpretations": interpretations(cmp, class_a, class_b),
    }


def strategy_summary(per_strategy: dict[str, DataFrame], label_col: str) -> DataFrame:
    """MIN21: sequences and patterns per (strategy, class); ``per_strategy``
    maps a strategy name to its per-class pattern table joined with nothing
    else — each entry holds ``class`` rows from ``mine_by_class``."""
    parts = [df.groupBy("class").agg(F.count(F.lit(1)).alias("n_patterns")).withColumn("strategy", F.lit(k))
             for k, df in per_strategy.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
