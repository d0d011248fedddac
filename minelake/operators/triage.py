"""Triage result tables (TX8, FN17): the per-turn composition of item
extraction, session state, model prediction, precaution lookup and follow-up
suggestions, for a whole table of conversation turns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import models as ML
from .session import fold_sessions
from .suggest import suggest


def findings_line(items: str | F.Column, top_class: F.Column, top_prob: F.Column) -> F.Column:
    """FN17: 'Detected symptoms: a, b.' plus the top prediction with a percent."""
    col = F.col(items) if isinstance(items, str) else items
    base = F.when(F.size(col) == 0, F.lit("No symptoms detected.")).otherwise(
        F.concat(F.lit("Detected symptoms: "), F.array_join(col, ", "), F.lit(".")))
    pred = F.format_string(" \nTop predicted disease: %s (%d%% confidence).", top_class,
                           F.round(top_prob * 100).cast("int"))
    return F.when(top_class.isNotNull(), F.concat(base, pred)).otherwise(base)


def disease_triage(turns: DataFrame, keys: Sequence[str], order: str, model: PipelineModel,
                   classes: Sequence[str], vocabulary: Sequence[str], precautions: DataFrame,
                   records: DataFrame, top_k: int = 5) -> DataFrame:
    """TX8: one row per turn with action, items, predictions, precautions and
    follow-up suggestions.

    ``turns``: keys, order, ``items`` (feature names). ``precautions``: (key,
    values) from ``sources.io.precaution_mapping``. ``records``: suggestion
    records (items, support, group, rec_order).
    """
    keys = list(keys)
    folded = fold_sessions(turns, keys, order)
    tid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys + [order]])
    folded = folded.withColumn("_tid", tid)

    # predictions for turns that predict
    to_pred = folded.where(F.col("action") == "predict").select("_tid", F.col("items_used").alias("_items"))
    vec = ML.binary_vectors(to_pred, "_items", vocabulary)
    pred = ML.predict_topk(model, vec, classes, top_k).select(
        "_tid", "reason", "predictions", F.col("predictions")[0]["disease"].alias("top_class"),
        F.col("predictions")[0]["probability"].alias("top_probability"))
    from ..sources.io import lookup_values

    pred = lookup_values(pred, "top_class", precautions, "precautions")
    pred = pred.withColumn("precautions", F.when(F.col("top_class").isNull(), F.array().cast("array<string>"))
                           .otherwise(F.col("precautions")))

    # follow-ups for turns that ask
    asks = folded.where(F.col("action") == "ask").select("_tid", F.col(("items")).alias("_known"))
    sug = suggest(asks, "_tid", "_known", records)
    sug = sug.groupBy("_tid").agg(F.array_sort(F.collect_list(F.struct("rank", "candidate", "support")))
                                  .alias("followups"))

    out = folded.join(pred, "_tid", "left").join(sug, "_tid", "left")
    shown = F.coalesce(F.col("items_used"), F.col(("items")))
    return (out.withColumn("findings", findings_line(shown, F.col("top_class"), F.col("top_probability")))
            .withColumn("confidence", F.coalesce(F.col("top_probability"), F.lit(0.3)))
            .drop("_tid"))
