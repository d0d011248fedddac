"""Tumour result table (TX9): extraction, prediction, fallback, insights and confidence of a whole
table of texts, every result inside its row.

The forest is a row expression (``models.forest_probabilities``), so rows that hold all of its features
and rows that go to the rule are not split and joined again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from . import models as ML
from . import text as TX


def characteristics(text: Column) -> Column:
    """TX1/TX4/FN19: sorted standard characteristics of a text."""
    terms = F.coalesce(TX.lexicon_terms(text, LX.CHARACTERISTIC_CATEGORIES), F.array().cast("array<string>"))
    return F.sort_array(TX.standardise_characteristics(terms))  # no term is null


def tumour_results(texts: DataFrame, text_col: str, model=None, features: Sequence[str] = (), classes: Sequence[str] = (),
                   malignant: str = "M", cuts: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """The columns of ``texts`` and a result per row.

    ``measurements`` (map), ``characteristics`` (sorted array), ``method`` (model, heuristic), ``predicted_class``
    (Malignant, Benign), ``probability`` of that class, ``confidence`` (data completeness or the probability, the
    greater), ``primary_findings`` (a sentence), ``recommendations`` (the explanation, then the insights),
    ``risk_factors`` and ``analysis_type``. ``model`` (a fitted forest over ``features``, its labels
    ``classes`` in index order, ``cuts`` the edges if it sees bins) predicts where a text has every feature, by canonical name; else, and
    without a model, the logistic rule does. Null and empty texts have no measurement and go to the rule.
    """
    t = TX.add_measurements(texts, text_col, "_ml_raw").withColumn("characteristics", characteristics(F.col(text_col)))
    t = t.withColumn("measurements", TX.standardise_measurements(F.col("_ml_raw")))
    _p, rule_label, rule_probability = TX.heuristic_score(F.col("measurements"))
    if model is not None:
        t = t.withColumn("_ml_x", ML.map_to_features(F.col("_ml_raw"), features, TX.canonical_key))
        t = ML.add_forest_probabilities(t, model, "_ml_x", "_ml_probs", "_ml_known", cuts)
        best = F.array_max("_ml_probs")
        label = F.get(F.array(*[F.lit("Malignant" if c == malignant else "Benign") for c in classes]), F.array_position("_ml_probs", best).cast("int") - 1)
        known = F.col("_ml_known")
        method, label, probability = F.when(known, "model").otherwise("heuristic"), F.when(known, label).otherwise(rule_label), F.when(known, best).otherwise(rule_probability)
    else:
        method, label, probability = F.lit("heuristic"), rule_label, rule_probability
    t = t.withColumn("method", method).withColumn("predicted_class", label).withColumn("probability", probability)
    insights, risk = TX.risk_insights(F.col("measurements"), F.col("characteristics"))
    # its own column: formatting is the dearest step here and both sentences use it
    t = t.withColumn("_ml_percent", F.format_string("%.0f%%", F.col("probability") * 100))
    # counted by a lambda on purpose: it keeps this step out of whole-stage code, whose single method would be too long to be compiled
    n_m, n_c, percent = F.cardinality("measurements"), F.size(F.filter("characteristics", lambda c: c.isNotNull())), F.col("_ml_percent")
    findings = F.concat(F.lit("Analyzed "), n_m.cast("string"), F.lit(" measurements and "), n_c.cast("string"), F.lit(" characteristics → predicted class "),
                        "predicted_class", F.lit(" ("), percent, F.lit(" probability)"))
    explanation = F.concat(F.lit("Prediction summary: "), "predicted_class", F.lit(" ("), percent,
                           F.lit(" probability). LLM explanation unavailable because the language model is not configured."))
    out = (t.withColumn("confidence", TX.completeness_confidence(n_m, n_c, F.col("probability"))).withColumn("primary_findings", findings)
           .withColumn("recommendations", F.concat(F.array(explanation), insights)).withColumn("risk_factors", risk).withColumn("analysis_type", F.lit("breast_cancer")))
    return out.drop("_ml_raw", "_ml_x", "_ml_probs", "_ml_known", "_ml_percent")
