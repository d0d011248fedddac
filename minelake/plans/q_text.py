"""Catalogue: text extraction, routing, risk rules and session state.

Texts: ``documents`` and ``conversations``. The driver tables hold no
``name: number`` text, so measurement extraction is checked by round trip:
lineitem values are rendered to text (TX10), extracted again, and must come
back equal to the source columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..operators import session as SS
from ..operators import text as TX
from ..operators import tumour as TU
from . import q_sequences as QS
from .joins import shared_table
from .registry import query, r6, read

# Test parameters: a lexicon of common words (with multi-word terms) that the
# invented prose of ``documents`` actually holds, and a tag lexicon with
# synonyms for the FN19-style standardisation.
TEXT_LEXICON = {
    "en_function": ["the", "of the", "and", "with", "from", "that", "this"],
    "de_function": ["der", "die", "und", "von"],
    "fr_function": ["le", "la", "les", "et", "des"],
    "es_function": ["que", "el", "y"],
    "phrases": ["in the", "on the", "to the", "de la"],
}
TAG_LEXICON = {"conjunction": ["and", "und", "et", "y"], "article": ["the", "der", "die", "le", "la", "el"]}
TAG_SYNONYMS = {"und": "and", "et": "and", "y": "and", "der": "the", "die": "the", "le": "the",
                "la": "the", "el": "the"}
SESSION_LEXICON = {"de": ["der", "die", "und"], "en": ["the", "of", "and"],
                   "es": ["que", "el", "y"], "fr": ["le", "les", "et"]}

_B = r"[^\p{L}\p{N}_]"


def _lex_values(categories: dict[str, list[str]]) -> str:
    rows = ", ".join(f"('{c}', '{t}')" for c, ts in categories.items() for t in ts)
    return f"(VALUES {rows}) AS lex(category, term)"


def _ww(text_sql: str, term_sql: str) -> str:
    return f"regexp_matches({text_sql}, '(^|{_B})' || {term_sql} || '($|{_B})')"


@query("lexicon_hits", f"""
SELECT DISTINCT d.doc_id, lex.category, lex.term FROM documents d
JOIN {_lex_values(TEXT_LEXICON)} ON {_ww('lower(d.text)', 'lex.term')}""")
def lexicon_hits(spark: SparkSession, sf: str) -> DataFrame:
    """TX1: whole-word lexicon terms (incl. two-word terms) per document."""
    return TX.lexicon_hits(read(spark, sf, "documents"), "doc_id", "text", TEXT_LEXICON)


_TAG_MAP = ", ".join(f"('{k}', '{v}')" for k, v in TAG_SYNONYMS.items())


@query("category_tags", f"""
WITH h AS (SELECT DISTINCT d.doc_id, lex.term FROM documents d
           JOIN {_lex_values(TAG_LEXICON)} ON {_ww('lower(d.text)', 'lex.term')}),
s AS (SELECT DISTINCT doc_id, coalesce(m.v, h.term) AS tag FROM h LEFT JOIN (VALUES {_TAG_MAP}) AS m(k, v) ON m.k = h.term)
SELECT doc_id, string_agg(tag, ',' ORDER BY tag) AS tags, CAST(count(*) AS INTEGER) AS n_tags FROM s GROUP BY doc_id""")
def category_tags(spark: SparkSession, sf: str) -> DataFrame:
    """TX4 + FN19: tagged terms per document, standardised and distinct."""
    hits = TX.lexicon_hits(read(spark, sf, "documents"), "doc_id", "text", TAG_LEXICON)
    per = hits.groupBy("doc_id").agg(F.collect_list("term").alias("terms"))
    tags = F.array_sort(TX.standardise_characteristics(F.col("terms"), TAG_SYNONYMS))
    return per.select("doc_id", F.array_join(tags, ",").alias("tags"), F.size(tags).alias("n_tags"))


# ------------------------------------------------------------------ measurements (round trip)

_MEASURE_SRC = [("radius_mean", "l_quantity", "radius mean {}"),
                ("texture_mean", "l_extendedprice", "texture_mean: {}"),
                ("concave_points_se", "l_discount", "concave points_se={}"),
                ("area_worst", "l_tax", "area worst {}")]


def rendered_measurements(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    parts = [F.concat(F.lit(fmt.split("{}")[0]), F.col(src).cast("string")) for _k, src, fmt in _MEASURE_SRC]
    return li.select(*QS.KEYS, F.concat_ws("; ", *parts).alias("text"))


_UNPIVOT_MEASURES = " UNION ALL ".join(
    f"SELECT {QS._KEYS}, '{k}' AS key, round({src}, 6) AS value FROM lineitem"
    for k, src, _f in _MEASURE_SRC)


@query("measure_roundtrip", _UNPIVOT_MEASURES)
def measure_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """TX10 -> TX3: rendered lineitem values extracted back (must equal the source)."""
    r = rendered_measurements(spark, sf)
    m = TX.add_measurements(r, "text", "m", fallback=False).select(*QS.KEYS, "m")
    # explode_outer: no inferred size(m) > 0 filter below the repartition
    return (m.select(*QS.KEYS, F.explode_outer("m").alias("key", "value")).where(F.col("key").isNotNull())
            .select(*QS.KEYS, "key", r6("value").alias("value")))


@query("kv_fallback", f"""
SELECT {QS._KEYS}, 'quantity' AS name, round(l_quantity, 6) AS value FROM lineitem
UNION ALL SELECT {QS._KEYS}, 'extended_price', round(l_extendedprice, 6) FROM lineitem
UNION ALL SELECT {QS._KEYS}, 'rate', round(l_discount, 6) FROM lineitem""")
def kv_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """TX5: 'quantity: 1.0, extended-price = 2.0, disc rate 0.05' -> pairs
    (separated pairs plus the spaced fallback, which keeps one word)."""
    from .parallel import spread

    li = spread(read(spark, sf, "lineitem"))
    text = F.concat(F.lit("quantity: "), F.col("l_quantity").cast("string"),
                    F.lit(", extended-price = "), F.col("l_extendedprice").cast("string"),
                    F.lit(", disc rate "), F.col("l_discount").cast("string"))
    m = TX.add_measurements(li.select(*QS.KEYS, text.alias("text")), "text", "m")
    return (m.select(*QS.KEYS, F.explode_outer("m").alias("name", "value")).where(F.col("name").isNotNull())
            .select(*QS.KEYS, "name", r6("value").alias("value")))


@query("canonical_keys", r"""
WITH v AS (SELECT DISTINCT p_name AS raw FROM part UNION SELECT DISTINCT p_type FROM part
           UNION SELECT DISTINCT p_brand FROM part)
SELECT raw, regexp_replace(lower(raw), '[^a-z0-9]', '', 'g') AS canonical FROM v""")
def canonical_keys(spark: SparkSession, sf: str) -> DataFrame:
    """FN6: canonical keys of the part vocabulary."""
    part = read(spark, sf, "part")
    v = (part.select(F.col("p_name").alias("raw")).union(part.select("p_type"))
         .union(part.select("p_brand")).distinct())
    return v.select("raw", TX.canonical_key(F.col("raw")).alias("canonical"))


@query("coerce_values", r"""
SELECT event_id, props, TRY_CAST(regexp_extract(props, '-?\d+(?:\.\d+)?', 0) AS DOUBLE) AS value FROM events""")
def coerce_values(spark: SparkSession, sf: str) -> DataFrame:
    """FN7: first signed number in a text value."""
    ev = read(spark, sf, "events")
    return ev.select("event_id", "props", TX.coerce_value(F.col("props")).alias("value"))


_SYMPTOM_ALT = "|".join(re.escape(t) for ts in LX.SYMPTOM_CATEGORIES.values() for t in ts)


def _contains_any(words) -> str:
    return " OR ".join(f"contains(lower(text), '{w}')" for w in words)


@query("route_messages", f"""
SELECT conv_id, turn, CASE
  WHEN {_contains_any(LX.DISEASE_INDICATORS)} OR regexp_matches(lower(text), '(^|{_B})({_SYMPTOM_ALT})($|{_B})') THEN 'disease'
  WHEN {_contains_any(LX.CANCER_KEYWORDS)} OR regexp_matches(lower(text), '{LX.MEASUREMENT_UNIT_PATTERN}') THEN 'tumour'
  ELSE 'unknown' END AS route
FROM conversations""")
def route_messages(spark: SparkSession, sf: str) -> DataFrame:
    """TX6: which tool takes each conversation turn."""
    c = read(spark, sf, "conversations")
    return c.select("conv_id", "turn", TX.route(F.col("text")).alias("route"))


# ------------------------------------------------------------------ tumour rules

def tumour_texts(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    chars = F.when(F.col("l_linestatus") == "O", F.lit("irregular spiculated mass")) \
        .otherwise(F.lit("smooth circumscribed cystic lesion"))
    text = F.concat_ws("; ",
                       F.concat(F.lit("tumor radius "), (F.col("l_quantity") / 2.5).cast("string")),
                       F.concat(F.lit("area "), (F.col("l_extendedprice") / 100).cast("string")),
                       F.concat(F.lit("compactness "), (F.col("l_discount") * 2).cast("string")),
                       F.concat(F.lit("concavity "), (F.col("l_tax") * 2).cast("string")),
                       chars)
    return li.select(*QS.KEYS, text.alias("text"))


def tumour_analysis(spark: SparkSession, sf: str) -> DataFrame:
    """TX9 pieces: measurements, characteristics, insights, risk, heuristic."""
    t = TX.add_measurements(tumour_texts(spark, sf), "text", "m", standardise=True)
    j = t.withColumn("chars", TU.characteristics(F.col("text")))
    insights, risk = TX.risk_insights(F.col("m"), F.col("chars"))
    p, label, prob = TX.heuristic_score(F.col("m"))
    conf = TX.completeness_confidence(F.cardinality("m"), F.size("chars"), prob)
    return j.select(*QS.KEYS, "m", "chars", insights.alias("insights"), risk.alias("risk_factors"),
                    p.alias("p_malignant"), label.alias("label"), prob.alias("probability"),
                    conf.alias("confidence"))


_TUMOUR_BASE = f"""
WITH s AS (SELECT {QS._KEYS}, l_quantity / 2.5 AS radius, l_extendedprice / 100 AS area,
                  l_discount * 2 AS compactness, l_tax * 2 AS concavity, l_linestatus = 'O' AS o FROM lineitem),
c AS (SELECT *, CASE WHEN o THEN ['irregular', 'mass', 'spiculated'] ELSE ['circumscribed', 'cystic', 'mass', 'smooth'] END AS chars,
             (compactness IS NOT NULL)::INT + (concavity IS NOT NULL)::INT AS n_tex,
             4 AS n_m FROM s),
r AS (SELECT *, (radius > 12)::INT + (compactness > 0.12)::INT + (concavity > 0.08)::INT
                + CASE WHEN list_contains(chars, 'irregular') OR list_contains(chars, 'spiculated') THEN 2 ELSE 0 END AS risk,
             radius + area + compactness + concavity AS total FROM c)
"""


@query("risk_flags", _TUMOUR_BASE + f"""
SELECT {QS._KEYS}, CAST(risk AS INTEGER) AS risk_factors, array_to_string(list_filter([
  'Received ' || n_m || ' quantitative measurements for analysis',
  CASE WHEN radius > 15 THEN 'Large tumor size detected - requires immediate attention'
       WHEN radius > 10 THEN 'Moderate tumor size - monitor closely' ELSE 'Small tumor size detected' END,
  'Texture analysis includes ' || n_tex || ' parameters',
  CASE WHEN compactness > 0.15 THEN 'High compactness value detected - may indicate irregular tumor shape' END,
  CASE WHEN concavity > 0.1 THEN 'High concavity value detected - possible malignant characteristics' END,
  CASE WHEN area > 1000 THEN 'Large tumor area detected - comprehensive evaluation recommended'
       WHEN area < 200 THEN 'Small tumor area - may be early stage or benign' END,
  'Identified ' || len(chars) || ' tumor characteristics',
  CASE WHEN o THEN 'Irregular texture patterns may suggest closer evaluation'
       ELSE 'Smooth texture patterns are often associated with benign lesions' END,
  CASE WHEN NOT o THEN 'Cystic characteristics suggest fluid-filled lesion - often benign' END,
  CASE WHEN o THEN 'Irregular border characteristics require immediate evaluation'
       ELSE 'Well-circumscribed borders often indicate benign lesions' END,
  CASE WHEN risk >= 3 THEN 'Multiple concerning features identified - immediate comprehensive evaluation recommended'
       WHEN risk >= 1 THEN 'Some concerning features present - follow-up evaluation advised' END,
  'All findings require professional radiological and clinical correlation',
  'This AI analysis supports but does not replace expert medical evaluation'], lambda x: x IS NOT NULL), ' | ') AS insights
FROM r""")
def risk_flags(spark: SparkSession, sf: str) -> DataFrame:
    """TX7: insight list and risk-factor count from extracted values and tags."""
    a = tumour_analysis(spark, sf)
    return a.select(*QS.KEYS, F.col("risk_factors").cast("int").alias("risk_factors"),
                    F.array_join("insights", " | ").alias("insights"))


@query("heuristic_score", _TUMOUR_BASE + f"""
, h AS (SELECT *, greatest(0.05, least(0.95, 1.0 / (1.0 + exp(-0.02 * (total - 15.0))))) AS p FROM r)
SELECT {QS._KEYS}, round(p, 6) AS p_malignant, CASE WHEN p >= 0.5 THEN 'Malignant' ELSE 'Benign' END AS label,
       round(CASE WHEN p >= 0.5 THEN p ELSE 1 - p END, 6) AS probability,
       round(greatest(least(0.95, (n_m + len(chars)) * 0.1 + 0.4), CASE WHEN p >= 0.5 THEN p ELSE 1 - p END), 6) AS confidence
FROM h""")
def heuristic_score(spark: SparkSession, sf: str) -> DataFrame:
    """FN12/FN13: logistic fallback score, label and confidence."""
    a = tumour_analysis(spark, sf)
    return a.select(*QS.KEYS, r6("p_malignant").alias("p_malignant"), "label",
                    r6("probability").alias("probability"), r6("confidence").alias("confidence"))


_PERCENT = "printf('%.0f%%', 100 * probability)"


@query("tumour_table", _TUMOUR_BASE + f""",
h AS (SELECT *, greatest(0.05, least(0.95, 1.0 / (1.0 + exp(-0.02 * (total - 15.0))))) AS p FROM r),
l AS (SELECT *, CASE WHEN p >= 0.5 THEN 'Malignant' ELSE 'Benign' END AS predicted_class, CASE WHEN p >= 0.5 THEN p ELSE 1 - p END AS probability FROM h)
SELECT {QS._KEYS}, 'breast_cancer' AS analysis_type, 'heuristic' AS method, predicted_class, round(probability, 6) AS probability,
       round(greatest(least(0.95, (n_m + len(chars)) * 0.1 + 0.4), probability), 6) AS confidence,
       'Analyzed ' || n_m || ' measurements and ' || len(chars) || ' characteristics → predicted class ' || predicted_class || ' (' || {_PERCENT} || ' probability)' AS primary_findings,
       'Prediction summary: ' || predicted_class || ' (' || {_PERCENT} || ' probability). LLM explanation unavailable because the language model is not configured.' AS explanation,
       CAST(n_m AS INTEGER) AS n_measurements, round(radius, 6) AS radius, round(area, 6) AS area, array_to_string(chars, ',') AS characteristics,
       CAST(risk AS INTEGER) AS risk_factors FROM l""")
def tumour_table(spark: SparkSession, sf: str) -> DataFrame:
    """TX9: the tumour result of every text in one row, without a fitted model (every row by rule)."""
    t = TU.tumour_results(tumour_texts(spark, sf), "text")
    return t.select(*QS.KEYS, "analysis_type", "method", "predicted_class", r6("probability").alias("probability"), r6("confidence").alias("confidence"),
                    "primary_findings", F.element_at("recommendations", 1).alias("explanation"), F.size("measurements").alias("n_measurements"),
                    r6(F.element_at("measurements", F.lit("radius"))).alias("radius"), r6(F.element_at("measurements", F.lit("area"))).alias("area"),
                    F.array_join("characteristics", ",").alias("characteristics"), F.col("risk_factors").cast("int").alias("risk_factors"))


# ------------------------------------------------------------------ two passes, aliases, standard terms

@query("two_pass_extraction", f"""
SELECT {QS._KEYS}, round(CASE WHEN l_linenumber = 1 THEN l_quantity / 2.5 ELSE l_quantity END, 6) AS radius, round(l_extendedprice / 100, 6) AS area,
       round(l_tax, 6) AS texture, CAST(3 AS INTEGER) AS n_measurements,
       CASE WHEN l_linestatus = 'O' THEN 'circumscribed,cystic,irregular,mass,smooth' ELSE 'circumscribed,cystic,mass,smooth' END AS characteristics FROM lineitem""")
def two_pass_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """SET5: a report text and a structured note per row, extracted apart; terms are united, and a
    measurement of the note overrides that of the report."""
    li = read(spark, sf, "lineitem")
    report = F.concat(F.lit("tumor radius "), (F.col("l_quantity") / 2.5).cast("string"), F.lit("; area "), (F.col("l_extendedprice") / 100).cast("string"),
                      F.lit("; smooth circumscribed cystic lesion"))
    note = F.concat_ws("; ", F.when(F.col("l_linenumber") != 1, F.concat(F.lit("radius: "), F.col("l_quantity").cast("string"))),
                       F.concat(F.lit("texture = "), F.col("l_tax").cast("string")), F.when(F.col("l_linestatus") == "O", F.lit("irregular mass")))
    t = TX.add_measurements(li.select(*QS.KEYS, report.alias("report"), note.alias("note")), "report", "m1")
    t = TX.add_measurements(t, "note", "m2").withColumn("m", TX.override_measurements(F.col("m1"), F.col("m2")))
    terms = [TX.lexicon_terms(F.col(c), LX.CHARACTERISTIC_CATEGORIES) for c in ("report", "note")]
    chars = F.array_sort(TX.standardise_characteristics(TX.union_terms(*terms)))
    value = lambda k: r6(F.element_at("m", F.lit(k))).alias(k)
    return t.select(*QS.KEYS, value("radius"), value("area"), value("texture"), F.size("m").alias("n_measurements"), F.array_join(chars, ",").alias("characteristics"))


@query("measurement_aliases", f"""
SELECT {QS._KEYS}, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 3 = 0 THEN round(l_quantity, 6) WHEN l_linenumber % 3 = 1 THEN round(l_extendedprice / 2, 6)
         ELSE round(l_quantity / 4, 6) END AS radius,
       round(CASE WHEN l_linenumber = 7 THEN l_discount ELSE l_tax END, 6) AS perimeter, CASE WHEN l_linenumber <> 7 THEN round(l_tax, 6) END AS fractal_dimension FROM lineitem""")
def measurement_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """FN18: size, diameter, fractal and (in texts of free pairs) circumference become radius,
    fractal_dimension and perimeter; size beats diameter beats radius."""
    li = read(spark, sf, "lineitem")
    third = F.col("l_linenumber") % 3

    def named(name, c, when=None):
        text = F.concat(F.lit(f"{name}: "), c.cast("string"))
        return text if when is None else F.when(when, text)

    rule = F.concat_ws("; ", named("size", F.col("l_quantity"), third == 0), named("diameter", F.col("l_extendedprice"), third != 2),
                       named("radius", F.col("l_quantity") / 4), named("perimeter", F.col("l_tax")), named("fractal", F.col("l_tax")))
    text = F.when(F.col("l_linenumber") == 7, named("circumference", F.col("l_discount"))).otherwise(rule)
    t = TX.add_measurements(li.select(*QS.KEYS, text.alias("text")), "text", "m", standardise=True)
    return t.select(*QS.KEYS, *[r6(F.element_at("m", F.lit(k))).alias(k) for k in ("radius", "perimeter", "fractal_dimension")])


@query("standard_terms", f"""
WITH h AS (SELECT DISTINCT d.doc_id, lex.term FROM documents d JOIN {_lex_values(TAG_LEXICON)} ON {_ww('lower(d.text)', 'lex.term')})
SELECT DISTINCT doc_id, coalesce(m.v, h.term) AS item FROM h LEFT JOIN (VALUES {_TAG_MAP}) AS m(k, v) ON m.k = h.term""")
def standard_terms(spark: SparkSession, sf: str) -> DataFrame:
    """TX2: extracted terms through the synonym table, lower case, distinct per document."""
    hits = TX.lexicon_hits(read(spark, sf, "documents"), "doc_id", "text", TAG_LEXICON)
    return TX.standardise_terms(hits, "doc_id", synonyms=TAG_SYNONYMS)


# ------------------------------------------------------------------ session state

def user_turn_items(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with their items (feature-name form, sorted distinct); turns
    without a hit keep an empty list."""
    conv = read(spark, sf, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
    keyed = conv.withColumn("_tid", F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    hits = TX.lexicon_hits(keyed, "_tid", "text", SESSION_LEXICON)
    items = TX.feature_items(hits, "_tid").groupBy("_tid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return (keyed.join(items, "_tid", "left")
            .select("conv_id", "turn", F.coalesce("items", F.array().cast("array<string>")).alias("items")))


_SESSION_SQL = f"""
WITH RECURSIVE u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
h AS (SELECT DISTINCT u.conv_id, u.turn, lex.term FROM u JOIN {_lex_values(SESSION_LEXICON)} ON {_ww('lower(u.text)', 'lex.term')}),
t0 AS (SELECT u.conv_id, u.turn, coalesce(list_sort(list(h.term) FILTER (WHERE h.term IS NOT NULL)), []) AS items
       FROM u LEFT JOIN h ON h.conv_id = u.conv_id AND h.turn = u.turn GROUP BY u.conv_id, u.turn),
t AS (SELECT *, len(items) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx FROM t0),
r AS (SELECT conv_id, idx, false AS waiting_before, n < 5 AS waiting_after FROM t WHERE idx = 1
      UNION ALL
      SELECT t.conv_id, t.idx, r.waiting_after, (NOT r.waiting_after) AND t.n < 5
      FROM r JOIN t ON t.conv_id = r.conv_id AND t.idx = r.idx + 1)
SELECT t.conv_id, t.turn, CAST(t.n AS INTEGER) AS n_items, r.waiting_before,
       CASE WHEN r.waiting_before OR t.n >= 5 THEN 'predict' ELSE 'ask' END AS action,
       CASE WHEN r.waiting_before THEN array_to_string(list_sort(list_distinct(list_concat(coalesce(p.items, []), t.items))), ',')
            WHEN t.n >= 5 THEN array_to_string(t.items, ',') END AS items_used,
       CASE WHEN NOT r.waiting_before AND t.n < 5 THEN CAST(greatest(3, 5 - t.n + 2) AS INTEGER) END AS followup_limit
FROM t JOIN r ON r.conv_id = t.conv_id AND r.idx = t.idx
LEFT JOIN t p ON p.conv_id = t.conv_id AND p.idx = t.idx - 1"""


@query("session_fold", _SESSION_SQL)
def session_fold(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 batch: ask-once follow-up state over user turns, per conversation."""
    f = SS.fold_sessions(user_turn_items(spark, sf), ["conv_id"], "turn")
    return f.select("conv_id", "turn", F.col("n_items").cast("int").alias("n_items"), "waiting_before", "action",
                    F.array_join(F.array_sort("items_used"), ",").alias("items_used"), "followup_limit")


@query("session_stream", _SESSION_SQL)
def session_stream(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 stream: the same turns, delivered in three ranges of turn numbers, through
    one running ``transformWithStateInPandas`` query; equals the fold."""
    from ..streaming.session_stream import run_file_stream

    turns = user_turn_items(spark, sf)
    out = run_file_stream(spark, turns)
    return out.select("conv_id", "turn", "n_items", "waiting_before", "action",
                      F.array_join(F.array_sort("items_used"), ",").alias("items_used"), "followup_limit")


# ------------------------------------------------------------------ triage (TX8)

def _doc_markers(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: language and its distinct session-lexicon words."""
    docs = read(spark, sf, "documents").select("doc_id", "lang", "text")
    hits = TX.lexicon_hits(docs, "doc_id", "text", SESSION_LEXICON)
    items = TX.feature_items(hits, "doc_id").groupBy("doc_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return docs.select("doc_id", "lang").join(items, "doc_id", "left").select(
        "doc_id", "lang", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _lang_precautions(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup stand-in derived from the data: per language, its four most
    frequent longer words (the 'precautions' of that class)."""
    from pyspark.sql import Window

    from ..sources import io as IO

    docs = read(spark, sf, "documents").select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
    counts = docs.where(F.length("w") >= 6).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    top = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= 4)
    wide = top.groupBy("lang").pivot("r", [1, 2, 3, 4]).agg(F.first("w"))
    wide = wide.select("lang", *[F.col(str(i)).alias(f"P{i}") for i in range(1, 5)])
    return IO.precaution_mapping(wide, "lang", [f"P{i}" for i in range(1, 5)])


@query("triage_disease")
def triage_disease(spark: SparkSession, sf: str) -> DataFrame:
    """TX8/FN17: per user turn: action, items, top-3 prediction, precautions of
    the top class, follow-up suggestions, findings line (rows-only)."""
    from ..operators import itemsets as I
    from ..operators import models as ML
    from ..operators import triage as TR

    # written once: the forest, FP-growth and the containment pass would each read all texts again
    markers = shared_table(_doc_markers(spark, sf), "markers")
    vocab = sorted({w for ws in SESSION_LEXICON.values() for w in ws})
    model, classes = ML.fit_multiclass(ML.binary_vectors(markers, "items", vocab), "features", "lang", n_trees=20)
    its = I.mine_itemsets(markers.select("items"), min_support=0.05)
    # records: itemsets of two or more words, tagged with the language where
    # they are most frequent (one grouped pass over doc x itemset matches)
    from ..operators.containment import contained_pairs

    multi = its.where(F.col("size") >= 2)
    by_lang = (contained_pairs(multi, markers.select(F.col("doc_id"), F.col("items").alias("basket"), "lang"),
                               "doc_id", group_items="basket")
               .join(markers.select("doc_id", "lang"), "doc_id")
               .groupBy("items", "support", "lang").agg(F.count(F.lit(1)).alias("n")))
    from pyspark.sql import Window

    w = Window.partitionBy(F.array_join("items", ",")).orderBy(F.desc("n"), "lang")
    from .prefix import ordered_index

    recs = (by_lang.withColumn("r", F.row_number().over(w)).where(F.col("r") == 1)
            .withColumn("_neg", -F.col("support")).withColumn("_txt", F.array_join("items", ",")))
    recs = ordered_index(recs, [], ["_neg", "_txt"], "rec_order").select(
        "items", "support", F.col("lang").alias("group"), "rec_order")
    t = TR.disease_triage(user_turn_items(spark, sf), ["conv_id"], "turn", model, classes, vocab,
                          _lang_precautions(spark, sf), recs, top_k=3)
    return t.select("conv_id", "turn", "action", F.array_join(F.coalesce("items_used", "items"), ",").alias("items"),
                    "reason", "top_class", F.round("top_probability", 4).alias("top_probability"),
                    F.array_join("precautions", ";").alias("precautions"),
                    F.array_join(F.transform("followups", lambda s: s["candidate"]), ",").alias("followups"),
                    "findings", F.round("confidence", 4).alias("confidence"))
