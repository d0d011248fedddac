"""Catalogue: classification metrics.

Binary stand-in: ``labels.quality`` (1 = positive) with a score from the
document length, n_chars / (n_chars + 1000), predicted positive at >= 0.5.
Multi-class stand-in: a document's language predicted from counts of a few
function words per language (scores per class, arg-max, top-k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from .registry import query, r6, read

# Test parameters: function words that score each language.
LANG_MARKERS = {
    "de": ["der", "die", "und"],
    "en": ["the", "of", "and"],
    "es": ["que", "el", "y"],
    "fr": ["le", "les", "et"],
}
LANGS = sorted(LANG_MARKERS)


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    lab = read(spark, sf, "labels").select("doc_id", "quality")
    docs = read(spark, sf, "documents").select("doc_id", "n_chars")
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    return (lab.join(docs, "doc_id")
            .select("doc_id", F.col("quality").alias("label"), score.alias("score"),
                    F.when(score >= 0.5, 1).otherwise(0).alias("pred")))


_BIN = """WITH sl AS (SELECT l.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 1000.0) AS score,
       CASE WHEN d.n_chars / (d.n_chars + 1000.0) >= 0.5 THEN 1 ELSE 0 END AS pred
       FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
"""


@query("confusion", _BIN + """, lv AS (SELECT * FROM (VALUES (0), (1)) AS v(x))
SELECT a.x AS label, b.x AS predicted, CAST(count(sl.doc_id) AS BIGINT) AS n
FROM lv a JOIN lv b ON TRUE LEFT JOIN sl ON sl.label = a.x AND sl.pred = b.x GROUP BY 1, 2""")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    """AGG20: 2x2 confusion counts, zeros kept."""
    c = M.confusion(scored_labels(spark, sf), "label", "pred", [0, 1])
    return c.select(F.col("label").cast("int").alias("label"), F.col("predicted").cast("int").alias("predicted"), "n")


@query("prf", _BIN + """, c AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
  count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp, count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn,
  count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn FROM sl),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM c)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1,
       round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM m""")
def prf(spark: SparkSession, sf: str) -> DataFrame:
    """AGG21: precision, recall, F1 for the positive label (0 when undefined)."""
    m = M.binary_prf(scored_labels(spark, sf), "label", "pred", 1)
    return m.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query("auc_exact", _BIN + """, rk AS (SELECT label, rank() OVER (ORDER BY score) AS r0,
    count(*) OVER (PARTITION BY score) AS ties FROM sl),
ar AS (SELECT label, r0 + (ties - 1) / 2.0 AS r FROM rk),
s AS (SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N,
             sum(r) FILTER (WHERE label = 1) AS rsum FROM ar)
SELECT CASE WHEN P > 0 AND N > 0 THEN round((rsum - P * (P + 1) / 2.0) / (P * N), 6) END AS auc,
       CAST(P AS BIGINT) AS n_pos, CAST(N AS BIGINT) AS n_neg FROM s""")
def auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    """AGG22/WIN5: exact AUC (SQL side: Mann-Whitney with average ranks)."""
    a = M.auc_exact(scored_labels(spark, sf), "label", "score", 1)
    return a.select(r6("auc").alias("auc"), "n_pos", "n_neg")


def lang_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "lang", "text")
    toks = F.split(F.lower("text"), r"[^\p{L}]+")
    def count_of(words):
        return F.size(F.filter(toks, lambda t: t.isin(*words))).cast("double")

    scores = F.array(*[count_of(LANG_MARKERS[l]) for l in LANGS])
    with_scores = docs.select("doc_id", "lang", scores.alias("scores"))
    ranked = F.array_sort(F.transform(F.arrays_zip(F.col("scores").alias("s"),
                                                   F.array(*[F.lit(l) for l in LANGS]).alias("c")),
                                      lambda p: F.struct((F.lit(0.0) - p["s"] + F.lit(0.0)).alias("neg"),
                                                         p["c"].alias("c"))))
    return with_scores.withColumn("pred", F.element_at(ranked, 1)["c"])


_LANG_SCORES = " UNION ALL ".join(
    f"SELECT doc_id, lang, '{l}' AS cls, len(list_filter(toks, lambda x: x IN ({', '.join(repr(w) for w in ws)}))) AS score FROM t"
    for l, ws in sorted(LANG_MARKERS.items()))
_LANG = f"""WITH t AS (SELECT doc_id, lang, regexp_split_to_array(lower(text), '[^\\p{{L}}]+') AS toks FROM documents),
ls AS ({_LANG_SCORES}),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS rk FROM ls),
pr AS (SELECT doc_id, lang AS label, max(CASE WHEN rk = 1 THEN cls END) AS pred,
              max(CASE WHEN cls = lang THEN rk END) AS true_rank FROM rk GROUP BY 1, 2)
"""


@query("class_report", _LANG + """,
tn AS (SELECT label AS cls, count(*) AS support FROM pr GROUP BY 1),
pn AS (SELECT pred AS cls, count(*) AS predicted FROM pr GROUP BY 1),
tp AS (SELECT label AS cls, count(*) AS tp FROM pr WHERE label = pred GROUP BY 1),
per AS (SELECT coalesce(tn.cls, pn.cls) AS cls, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
               coalesce(tp.tp, 0) AS tp FROM tn FULL OUTER JOIN pn ON tn.cls = pn.cls LEFT JOIN tp ON tp.cls = coalesce(tn.cls, pn.cls)),
pm AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM per),
pf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pm),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(p) AS mp, avg(r) AS mr, avg(f) AS mf,
               sum(p * support) AS wp, sum(r * support) AS wr, sum(f * support) AS wf FROM pf)
SELECT cls AS "row", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(tp / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM tot""")
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    """AGG23: per-language report rows plus accuracy / macro / weighted."""
    r = M.class_report(lang_scores(spark, sf), "lang", "pred")
    return r.select("row", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("topk_accuracy", _LANG + """
SELECT round(avg(CASE WHEN true_rank <= 1 THEN 1.0 ELSE 0.0 END), 6) AS top1_accuracy,
       round(avg(CASE WHEN true_rank <= 3 THEN 1.0 ELSE 0.0 END), 6) AS top3_accuracy,
       CAST(count(*) AS BIGINT) AS n FROM pr""")
def topk_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """AGG24: accuracy and top-3 accuracy of the language scores."""
    t = M.topk_accuracy(lang_scores(spark, sf), "scores", LANGS, "lang", (1, 3))
    return t.select(r6("top1_accuracy").alias("top1_accuracy"), r6("top3_accuracy").alias("top3_accuracy"), "n")


@query("class_weights", """
SELECT quality, CAST(count(*) AS BIGINT) AS n_c,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM labels GROUP BY quality""")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """FN20: balanced class weights n / (k * n_c)."""
    w = M.class_weights(read(spark, sf, "labels"), "quality")
    return w.select("quality", F.col("n_c").cast("long").alias("n_c"), r6("weight").alias("weight"))


@query("strat_split_counts", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
SELECT quality, 'test' AS split, CAST(round(n * 0.2) AS BIGINT) AS n FROM c
UNION ALL SELECT quality, 'train', CAST(n - round(n * 0.2) AS BIGINT) FROM c""")
def strat_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ML1: stratified 80/20 split by hash order; rows per (class, split)."""
    s = M.stratified_split(read(spark, sf, "labels"), "quality", "doc_id", 0.2, seed=42)
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


@query("strat_split_members", """
SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
                                  <= round(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'test' ELSE 'train' END AS split FROM labels""")
def strat_split_members(spark: SparkSession, sf: str) -> DataFrame:
    """ML1: which rows of a stratified 80/20 split, in md5 order, are held out."""
    s = M.stratified_split(read(spark, sf, "labels"), "quality", "doc_id", 0.2, order=F.md5(F.col("doc_id").cast("string").cast("binary")))
    return s.select("doc_id", "quality", "split")
