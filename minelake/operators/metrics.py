"""Classification metrics as aggregates (AGG20-AGG24, WIN5, FN20, ML1).

All metrics are conditional counts with partial aggregation. The exact AUC
groups by distinct score first (so a hot score is one row) and then takes a
running sum over the sorted distinct scores with the range-partitioned
prefix sum, never a single global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast, shared_table
from ..plans.prefix import ordered_index, prefix_sum


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the reference's zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def confusion(df: DataFrame, label: str, pred: str, labels: Sequence) -> DataFrame:
    """AGG20: counts for every (label, predicted) pair over ``labels``, zeros kept.

    Built with ``pivot`` on the known label list (no cross join), then
    unpivoted to long rows.
    """
    labels = list(labels)
    grid = df.groupBy(F.col(label).alias("label")).pivot(pred, labels).count()
    # every listed label gets a row, also when it never occurs as a true label
    all_labels = df.sparkSession.createDataFrame([(l,) for l in labels], grid.select("label").schema)
    grid = all_labels.join(grid, "label", "left").fillna(0)
    long = grid.unpivot("label", [str(l) for l in labels], "predicted", "n")
    return long.withColumn("n", F.col("n").cast("long"))


def binary_prf(df: DataFrame, label: str, pred: str, positive) -> DataFrame:
    """AGG21: TP/FP/FN/TN, precision, recall, F1 for one positive label."""
    y = F.col(label) == F.lit(positive)
    p = F.col(pred) == F.lit(positive)
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    return (c.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
            .withColumn("accuracy", _div0(F.col("tp") + F.col("tn"),
                                          F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))))


def auc_exact(df: DataFrame, label: str, score: str, positive) -> DataFrame:
    """AGG22/WIN5: exact ROC-AUC (average ranks for ties); null with one class.

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s)/2) / (P*N).
    """
    y = F.col(label) == F.lit(positive)
    per = (df.where(F.col(score).isNotNull())
           .groupBy(F.col(score).cast("double").alias("s"))
           .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))
    run = prefix_sum(per, [], ["s"], "neg", "neg_below", inclusive=False)
    tot = run.agg(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
                  F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return tot.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                             F.col("u") / (F.col("P").cast("double") * F.col("N"))).alias("auc"),
                      F.col("P").cast("long").alias("n_pos"), F.col("N").cast("long").alias("n_neg"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """AGG23: per-class precision/recall/F1/support plus accuracy, macro and
    weighted averages (sklearn's report rows)."""
    # the rows are read once: everything follows from their k x k counts
    pairs = shared_table(df.groupBy(F.col(label).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n")), "pairs")
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("t").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("t") == F.col("p"), F.col("n")).alias("tp")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(None).cast("long").alias("tp")))).alias("v"))
    per = both.groupBy("v.cls").agg(F.sum("v.support").alias("support"), F.sum("v.predicted").alias("predicted"), F.coalesce(F.sum("v.tp"), F.lit(0)).alias("tp"))
    per = (per.withColumn("precision", _div0(F.col("tp"), F.col("predicted")))
           .withColumn("recall", _div0(F.col("tp"), F.col("support"))))
    per = per.withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall")))
    rows = per.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), _div0(F.col("tp"), F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("row"), _div0(F.col("wp"), F.col("n")).alias("precision"),
                          _div0(F.col("wr"), F.col("n")).alias("recall"), _div0(F.col("wf"), F.col("n")).alias("f1"),
                          F.col("n").cast("long").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def rank_of_true(scores: Column, classes: Sequence[str], true_label: Column) -> Column:
    """Position (1-based) of the true class when classes are sorted by score
    desc, ties by class name; ``scores`` is an array aligned with ``classes``."""
    names = F.array(*[F.lit(c) for c in classes])
    pairs = F.arrays_zip(scores.alias("score"), names.alias("cls"))
    ranked = F.array_sort(F.transform(pairs, lambda p: F.struct(
        (F.lit(0.0) - p["score"].cast("double") + F.lit(0.0)).alias("neg"), p["cls"].alias("cls"))))
    return F.array_position(F.transform(ranked, lambda s: s["cls"]), true_label)


def topk_accuracy(df: DataFrame, scores: str, classes: Sequence[str], label: str,
                  ks: Sequence[int] = (1, 3)) -> DataFrame:
    """AGG24: share of rows whose true class ranks within k."""
    r = df.withColumn("_rank", rank_of_true(F.col(scores), classes, F.col(label)).cast("int"))
    return r.agg(*[F.avg(F.when((F.col("_rank") >= 1) & (F.col("_rank") <= k), 1.0).otherwise(0.0))
                   .alias(f"top{k}_accuracy") for k in ks], F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """FN20: balanced weight n / (k * n_c) per class (window over k rows)."""
    from pyspark.sql import Window

    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()
    return counts.withColumn("weight", F.sum("n_c").over(everything) /
                             (F.count(F.lit(1)).over(everything) * F.col("n_c")))


def with_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row (k rows, size-checked)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(bounded_broadcast(w), label)


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, order: Column | None = None, out: str = "split") -> DataFrame:
    """ML1: per class, the rows with the lowest hash positions go to test.

    Positions come from ``ordered_index`` (range-partitioned, exact), so a
    class holding most rows is still split over many tasks. Test size per
    class = round(test_fraction * n_c).
    """
    key = order if order is not None else F.xxhash64(F.col(id_col), F.lit(seed))
    d = df.withColumn("_ord", key)
    idx = ordered_index(d, [label], ["_ord", id_col], "_pos")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    res = idx.join(bounded_broadcast(counts), label)
    n_test = F.round(F.col("_n") * F.lit(test_fraction))
    return res.withColumn(out, F.when(F.col("_pos") <= n_test, F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_ord", "_pos", "_n")
