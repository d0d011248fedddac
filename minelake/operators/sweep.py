"""Parameter sweeps over the class-contrast pipeline (MIN14-MIN17, AGG17).

Work sharing replaces re-mining wherever the result is provably equal:

* support sweep (MIN15): mine once at the lowest threshold; every higher
  threshold is a filter of that result (support is anti-monotone), and all
  thresholds are counted in one aggregate over the comparison table;
* a row may stand for ``weight`` equal rows, so that a sweep can run on counted bins;
* ranking sweep (MIN16): ``top_k`` above ``max_sequence_length`` does not
  change the sequences (S9), so configs are grouped by their effective length
  and each distinct sequence set is mined once.

Each config's outcome is one tidy row; failures are kept as rows too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contrast import compare_classes, mine_by_class

SWEEP_SCHEMA = "sweep string, config_order int, strategy string, n_bins int, min_support double, " \
               "ranking_method string, top_k int, metric string, value double, error string"


def analysis_counts(sequences: DataFrame, label_col: str, class_a: str, class_b: str,
                    min_support: float, max_len: int, cap: int = 10, longest: int | None = None, weight: str | None = None) -> dict[str, float]:
    """One full analysis reduced to its summary counts (full and capped at 10)."""
    pats = mine_by_class(sequences, label_col, [class_a, class_b], min_support=min_support, max_len=max_len, longest=longest, weight=weight)
    cmp = compare_classes(pats, class_a, class_b)
    row = cmp.agg(F.count_if(F.col("status") == "common").alias("common"),
                  F.count_if(F.col("status") == f"unique_{class_a}").alias("ua"),
                  F.count_if(F.col("status") == f"unique_{class_b}").alias("ub"),
                  F.count_if(F.col("support_a").isNotNull()).alias("ta"),
                  F.count_if(F.col("support_b").isNotNull()).alias("tb")).first()
    size, n = F.size("sequence"), F.col(weight) if weight else F.lit(1)
    avg_len = sequences.agg(F.try_divide(F.sum(size * n), F.sum(n))).first()[0]
    return {"total_patterns_a": row["ta"], "total_patterns_b": row["tb"],
            "common_patterns": row["common"], "discriminative_top10": min(row["common"], cap),
            "unique_a": row["ua"], "unique_b": row["ub"],
            "unique_a_top10": min(row["ua"], cap), "unique_b_top10": min(row["ub"], cap),
            "avg_sequence_length": float(avg_len) if avg_len is not None else 0.0}


def support_sweep(sequences: DataFrame, label_col: str, class_a: str, class_b: str,
                  thresholds: Sequence[float] = (0.05, 0.1, 0.15, 0.2, 0.25),
                  max_len: int = 5, cap: int = 10, longest: int | None = None, weight: str | None = None) -> DataFrame:
    """MIN15: counts per support threshold from one mining run at the lowest."""
    t0 = min(thresholds)
    pats = mine_by_class(sequences, label_col, [class_a, class_b], min_support=t0, max_len=max_len, longest=longest, weight=weight)
    cmp = compare_classes(pats, class_a, class_b)
    sa, sb = F.col("support_a"), F.col("support_b")
    aggs = []
    for i, t in enumerate(thresholds):
        ina, inb = sa >= t, sb >= t
        ina = F.coalesce(ina, F.lit(False))
        inb = F.coalesce(inb, F.lit(False))
        aggs += [F.count_if(ina).alias(f"ta_{i}"), F.count_if(inb).alias(f"tb_{i}"),
                 F.count_if(ina & inb).alias(f"c_{i}"), F.count_if(ina & ~inb).alias(f"ua_{i}"),
                 F.count_if(inb & ~ina).alias(f"ub_{i}")]
    row = cmp.agg(*aggs).first()
    rows = []
    for i, t in enumerate(thresholds):
        vals = {"total_patterns_a": row[f"ta_{i}"], "total_patterns_b": row[f"tb_{i}"],
                "common_patterns": row[f"c_{i}"], "discriminative_top10": min(row[f"c_{i}"], cap),
                "unique_a": row[f"ua_{i}"], "unique_b": row[f"ub_{i}"],
                "unique_a_top10": min(row[f"ua_{i}"], cap), "unique_b_top10": min(row[f"ub_{i}"], cap)}
        for m, v in vals.items():
            rows.append(("support", i, "quantile", 3, float(t), "mutual_info", None, m, float(v), None))
    return sequences.sparkSession.createDataFrame(rows, SWEEP_SCHEMA)


def config_sweep(spark: SparkSession, name: str, configs: Sequence[dict],
                 build: Callable[[dict], DataFrame], label_col: str, class_a: str, class_b: str,
                 share_key: Callable[[dict], tuple] | None = None, longest: int | None = None, weight: str | None = None) -> DataFrame:
    """MIN14/MIN16: run the pipeline per config; configs with the same
    ``share_key`` reuse one result. Input errors become rows with ``error`` set."""
    cache: dict[tuple, dict | str] = {}
    rows = []
    for order, cfg in enumerate(configs):
        key = share_key(cfg) if share_key else tuple(sorted(cfg.items()))
        if key not in cache:
            try:
                seqs = build(cfg)
                cache[key] = analysis_counts(seqs, label_col, class_a, class_b,
                                             cfg.get("min_support", 0.1), cfg.get("max_len", 5), longest=longest, weight=weight)
            except ValueError as e:  # an input error is a result row; any other failure is raised
                cache[key] = f"{type(e).__name__}: {e}"
        res = cache[key]
        base = (name, order, cfg.get("strategy", "quantile"), cfg.get("n_bins", 3),
                float(cfg.get("min_support", 0.1)), cfg.get("ranking_method", "mutual_info"),
                cfg.get("top_k", 10))
        if isinstance(res, str):
            rows.append(base + ("error", None, res))
        else:
            for m, v in res.items():
                rows.append(base + (m, float(v), None))
    return spark.createDataFrame(rows, SWEEP_SCHEMA)


# Score of a config in each sweep (MIN17), as sums of tidy metrics.
SCORE_METRICS = {
    "bins": ["unique_a_top10", "unique_b_top10", "discriminative_top10"],
    "support": ["discriminative_top10"],
    "ranking": ["discriminative_top10", "unique_a_top10", "unique_b_top10"],
}


def best_configuration(sweeps: DataFrame) -> DataFrame:
    """MIN17: per sweep, the first config with the strictly largest positive score."""
    from pyspark.sql import Window

    parts = []
    for sweep, metrics in SCORE_METRICS.items():
        s = (sweeps.where((F.col("sweep") == sweep) & F.col("metric").isin(*metrics))
             .groupBy("sweep", "config_order", "strategy", "n_bins", "min_support", "ranking_method", "top_k")
             .agg(F.sum("value").alias("score")))
        parts.append(s)
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    w = Window.partitionBy("sweep").orderBy(F.desc("score"), "config_order")
    best = scored.where(F.col("score") > 0).withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    rationale = (F.when(F.col("sweep") == "bins",
                        F.format_string("Best binning strategy: %s with %d bins", "strategy", "n_bins"))
                 .when(F.col("sweep") == "support",
                       F.format_string("Best support threshold: %s", F.col("min_support").cast("string")))
                 .otherwise(F.format_string("Best ranking method: %s with top %d features",
                                            "ranking_method", "top_k")))
    return best.drop("_r").withColumn("rationale", rationale)
