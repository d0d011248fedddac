"""Feature selection (AGG19, FE13-FE15, JON8, JON9, SET1).

The data-sized work is one aggregate computing every pairwise Pearson r; the
greedy redundancy pass then walks the p x p result (p = number of features),
which is metadata-sized.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG19: (f1, f2, r) for every ordered pair, diagonal included.

    ``F.corr`` drops a pair's rows where either side is null, like pandas.
    """
    cols = list(cols)
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}_{j}")
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    row = df.agg(*aggs).first() if aggs else None
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = 1.0
            else:
                r = row[f"{min(i, j)}_{max(i, j)}"]
            rows.append((a, b, r))
    return df.sparkSession.createDataFrame(rows, "f1 string, f2 string, r double")


def pairs_over(corr: DataFrame, threshold: float) -> DataFrame:
    """FE15 input: distinct pairs with |r| above the threshold."""
    return corr.where((F.col("f1") < F.col("f2")) & (F.abs("r") > threshold))


def combine_scores(a: DataFrame, b: DataFrame, method: str = "sum",
                   key: str = "feature", score: str = "score") -> DataFrame:
    """FE13/JON8/SET1: full outer join of two score tables, missing -> 0,
    combined by sum, mean or max."""
    j = (a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key, "full_outer")
         .fillna(0.0, subset=["_a", "_b"]))
    comb = {"sum": F.col("_a") + F.col("_b"), "mean": (F.col("_a") + F.col("_b")) / 2,
            "max": F.greatest("_a", "_b")}[method]
    return j.select(key, F.col("_a").alias("score_a"), F.col("_b").alias("score_b"), comb.alias("score"))


def match_columns(scores: DataFrame, columns: Sequence[str], key: str = "feature",
                  score: str = "score") -> DataFrame:
    """JON9: base feature -> every column whose lowercase name contains it;
    a column reached by several features keeps the highest score.

    A name contains a feature where the feature is one of its substrings, so each column
    name (schema-sized) gives its substrings and the match is an equi-join.
    """
    names = scores.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    low = F.lower("column")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), F.length(low)), lambda i: F.transform(
        F.sequence(F.lit(1), F.length(low) - i + 1), lambda n: F.substring(low, i, n))))
    parted = names.where(F.length("column") > 0).select("column", F.explode(F.array_distinct(parts)).alias("_part"))
    wanted = scores.select(F.lower(F.col(key)).alias("_part"), F.col(score).alias("score"))
    return parted.join(bounded_broadcast(wanted), "_part").groupBy("column").agg(F.max("score").alias("score"))


def greedy_select(spark: SparkSession, scores: Sequence[tuple[str, float]], corr: dict[tuple[str, str], float],
                  threshold: float = 0.9, top_n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """FE14: walk features by score (desc, then name); drop one whose |r| with
    an already kept feature exceeds the threshold; stop at ``top_n`` kept.

    Returns (selected(feature, score, rank), removed(feature, score, correlated_with, r)).
    """
    kept: list[tuple[str, float]] = []
    removed = []
    for f, s in sorted(scores, key=lambda x: (-x[1], x[0])):
        if top_n is not None and len(kept) >= top_n:
            break
        hit = None
        for k, _ in kept:
            r = corr.get((f, k), corr.get((k, f)))
            if r is not None and abs(r) > threshold:
                hit = (k, r)
                break
        if hit:
            removed.append((f, float(s), hit[0], float(hit[1])))
        else:
            kept.append((f, s))
    sel = spark.createDataFrame([(f, float(s), i + 1) for i, (f, s) in enumerate(kept)],
                                "feature string, score double, rank int")
    rem = spark.createDataFrame(removed, "feature string, score double, correlated_with string, r double")
    return sel, rem


def correlated_groups(features: Sequence[str], pairs: DataFrame) -> DataFrame:
    """FE15: greedy groups over the pairs (f1, f2) above the threshold: in feature
    order, the first feature left leads a group of its neighbours that are left.
    Features without such a neighbour are in no group."""
    near: dict[str, set[str]] = {f: set() for f in features}
    for r in pairs.select("f1", "f2").collect():
        near[r[0]].add(r[1])
        near[r[1]].add(r[0])
    left, rows = list(features), []
    while left:
        leader = left.pop(0)
        joined = near[leader].intersection(left)
        left = [f for f in left if f not in joined]
        if joined:
            rows.append((leader, sorted(joined | {leader})))
    return pairs.sparkSession.createDataFrame(rows, "leader string, members array<string>")
