"""Catalogue: feature selection and forest models.

Selection runs on the lineitem numeric columns with the class feature scores
of ``q_patterns``. Models train on the lineitem feature table (classes A/R)
and on documents (language from binary word vectors); model outputs are
rows-only checks, selection tables are SQL-checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contrast as CT
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import rank as RK
from ..operators import select as SL
from ..operators import tumour as TU
from . import q_metrics as QM
from . import q_patterns as QP
from . import q_sequences as QS
from .joins import shared_table
from .registry import query, r6, read

NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CORR_THRESHOLD = 0.3
REDUNDANCY_THRESHOLD = 0.9

ORDER_FEATS = ["n_lines", "total_quantity", "total_price", "avg_discount", "o_totalprice"]


def order_features(spark: SparkSession, sf: str) -> DataFrame:
    """Per-order numeric features derived from lineitem (correlated by nature)."""
    li = read(spark, sf, "lineitem")
    agg = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                                      F.sum("l_quantity").alias("total_quantity"),
                                      F.sum("l_extendedprice").alias("total_price"),
                                      F.avg("l_discount").alias("avg_discount"))
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return agg.join(orders, agg.l_orderkey == orders.o_orderkey).drop("o_orderkey")


_OF = """WITH of AS (SELECT count(*)::DOUBLE AS n_lines, sum(l_quantity) AS total_quantity,
       sum(l_extendedprice) AS total_price, avg(l_discount) AS avg_discount, any_value(o.o_totalprice) AS o_totalprice
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY l.l_orderkey)
"""
_PAIRS = [(a, b) for a in ORDER_FEATS for b in ORDER_FEATS]
_CORR_SQL = _OF + "SELECT f1, f2, round(r, 6) AS r FROM (" + " UNION ALL ".join(
    (f"SELECT '{a}' AS f1, '{b}' AS f2, 1.0 AS r" if a == b else
     f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}, {b}) AS r FROM of")
    for a, b in _PAIRS) + ")"


@query("corr_long", _CORR_SQL)
def corr_long(spark: SparkSession, sf: str) -> DataFrame:
    """AGG19: Pearson matrix of per-order features, long form."""
    c = SL.correlation_long(order_features(spark, sf), ORDER_FEATS)
    return c.select("f1", "f2", r6("r").alias("r"))


@query("corr_pairs_over_threshold", _CORR_SQL + f" WHERE f1 < f2 AND abs(r) > {CORR_THRESHOLD}")
def corr_pairs_over_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """FE15 input: distinct feature pairs with |r| > 0.3."""
    c = SL.pairs_over(SL.correlation_long(order_features(spark, sf), ORDER_FEATS), CORR_THRESHOLD)
    return c.select("f1", "f2", r6("r").alias("r"))


def _psi_sql(n: str) -> str:
    x = f"({n}::DOUBLE + 6.0)"
    steps = " + ".join(f"1.0 / ({n}::DOUBLE + {i}.0)" for i in range(6))
    return f"(ln({x}) - 1.0 / (2.0 * {x}) - 1.0 / (12.0 * {x} ** 2) + 1.0 / (120.0 * {x} ** 4) - 1.0 / (252.0 * {x} ** 6) - ({steps}))"


KNN = 3
_KNN_SPANS = ", ".join(f"greatest({f'x - lag(x, {j}) OVER c' if j else '0.0'}, {f'lead(x, {KNN - j}) OVER c - x' if j < KNN else '0.0'}) + "
                       f"0 * ({f'lag(x, {j}) OVER c' if j else '0.0'} + {f'lead(x, {KNN - j}) OVER c' if j < KNN else '0.0'})" for j in range(KNN + 1))


KNN_FEATS = ["total_quantity", "total_price", "avg_discount", "o_totalprice"]


@query("rank_mutual_info_knn", f"""{_OF.rstrip()}, lx AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, n_lines >= 4 AS cls, round({f}, 6) AS x FROM of" for f in KNN_FEATS)}),
d AS (SELECT *, list_min(list_filter([{_KNN_SPANS}], lambda s: s IS NOT NULL)) AS r, count(*) OVER (PARTITION BY feature, cls) AS n_c,
        count(*) OVER (PARTITION BY feature, cls, x) AS same FROM lx WINDOW c AS (PARTITION BY feature, cls ORDER BY x)),
e AS (SELECT *, r * (1.0 - 1e-10) AS inside FROM d),
m AS (SELECT *, count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN inside PRECEDING AND inside FOLLOWING) AS m FROM e)
SELECT feature, round(greatest(0.0, {_psi_sql('count(*)')} + avg(CASE WHEN r > 0 THEN {_psi_sql(KNN)} ELSE {_psi_sql('(same - 1)')} END)
       - avg({_psi_sql('n_c')}) - avg({_psi_sql('m')})), 6) AS score FROM m GROUP BY feature""")
def rank_mutual_info_knn(spark: SparkSession, sf: str) -> DataFrame:
    """FE6: nearest-neighbour mutual information of the per-order features and the class of large orders."""
    of = order_features(spark, sf).select((F.col("n_lines") >= 4).alias("large"), *[F.round(f, 6).alias(f) for f in KNN_FEATS])
    return RK.mutual_info_knn(of, KNN_FEATS, "large", KNN).select("feature", r6("score").alias("score"))


GROUP_THRESHOLD = 0.7
_FEATURE_ROWS = ", ".join(f"({i}, '{f}')" for i, f in enumerate(ORDER_FEATS))


@query("corr_groups", "WITH RECURSIVE " + _OF.removeprefix("WITH ").rstrip() + f""",
c AS ({_CORR_SQL.removeprefix(_OF)}),
ft AS (SELECT * FROM (VALUES {_FEATURE_ROWS}) AS v(i, feature)),
nb AS (SELECT ft.i, ft.feature, list(c.f2 ORDER BY c.f2) FILTER (WHERE c.f2 <> ft.feature AND abs(c.r) > {GROUP_THRESHOLD}) AS near
       FROM ft JOIN c ON c.f1 = ft.feature GROUP BY 1, 2),
g AS (SELECT 0 AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS leader, CAST([] AS VARCHAR[]) AS found
      UNION ALL
      SELECT g.i + 1,
             CASE WHEN list_contains(g.taken, nb.feature) THEN g.taken ELSE list_concat(g.taken, list_append(coalesce(nb.near, []), nb.feature)) END,
             CASE WHEN list_contains(g.taken, nb.feature) THEN NULL ELSE nb.feature END,
             list_filter(coalesce(nb.near, []), lambda x: NOT list_contains(g.taken, x))
      FROM g JOIN nb ON nb.i = g.i)
SELECT leader, array_to_string(list_sort(list_append(found, leader)), ',') AS members
FROM g WHERE leader IS NOT NULL AND len(found) > 0""")
def corr_groups(spark: SparkSession, sf: str) -> DataFrame:
    """FE15: greedy groups of features correlated above 0.7."""
    pairs = SL.pairs_over(SL.correlation_long(order_features(spark, sf), ORDER_FEATS), GROUP_THRESHOLD)
    return SL.correlated_groups(ORDER_FEATS, pairs).select("leader", F.array_join("members", ",").alias("members"))


def class_feature_scores(spark: SparkSession, sf: str):
    fi = CT.feature_importance(QP.class_pattern_table(spark, sf), 10)
    a = fi.where(F.col("class") == QP.CLASS_A).select("feature", "score")
    b = fi.where(F.col("class") == QP.CLASS_B).select("feature", "score")
    return a, b


_COMBINED = QP._CLASS_BASE + """,
fi AS (SELECT class, split_part(unnest(string_split(replace(replace(pattern, '{', ''), '}', ''), ' → ')), '_', 1) AS feature,
              support FROM pats),
fs AS (SELECT class, feature, sum(support) AS score FROM fi GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY round(score, 9) DESC, feature) AS rk FROM fs) WHERE rk <= 10),
comb AS (SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.score, 0) + coalesce(b.score, 0) AS score
         FROM (SELECT * FROM top WHERE class = 'A') a FULL OUTER JOIN (SELECT * FROM top WHERE class = 'R') b
         ON a.feature = b.feature),
cols AS (SELECT * FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) AS c(col))
SELECT col AS "column", round(max(score), 6) AS score FROM cols JOIN comb ON contains(lower(col), lower(feature))
GROUP BY col"""


def _combined(spark: SparkSession, sf: str, method: str) -> DataFrame:
    a, b = class_feature_scores(spark, sf)
    return SL.match_columns(SL.combine_scores(a, b, method), NUM_COLS).select("column", r6("score").alias("score"))


@query("combined_scores", _COMBINED)
def combined_scores(spark: SparkSession, sf: str) -> DataFrame:
    """FE13/JON8/JON9: class scores combined (sum), matched to columns."""
    return _combined(spark, sf, "sum")


_SUM = "coalesce(a.score, 0) + coalesce(b.score, 0) AS score"


@query("combined_scores_mean", _COMBINED.replace(_SUM, "(coalesce(a.score, 0) + coalesce(b.score, 0)) / 2 AS score"))
def combined_scores_mean(spark: SparkSession, sf: str) -> DataFrame:
    """FE13: class scores combined by their mean."""
    return _combined(spark, sf, "mean")


@query("combined_scores_max", _COMBINED.replace(_SUM, "greatest(coalesce(a.score, 0), coalesce(b.score, 0)) AS score"))
def combined_scores_max(spark: SparkSession, sf: str) -> DataFrame:
    """FE13: class scores combined by the greater one."""
    return _combined(spark, sf, "max")


@query("select_features")
def select_features(spark: SparkSession, sf: str) -> DataFrame:
    """FE14: greedy redundancy filter over the combined scores (rows-only);
    selected and removed features in one table."""
    a, b = class_feature_scores(spark, sf)
    matched = SL.match_columns(SL.combine_scores(a, b, "sum"), NUM_COLS)
    scores = [(r["column"], r["score"]) for r in matched.collect()]
    corr = {(r["f1"], r["f2"]): r["r"] for r in
            SL.correlation_long(read(spark, sf, "lineitem"), NUM_COLS).collect()}
    sel, rem = SL.greedy_select(spark, scores, corr, REDUNDANCY_THRESHOLD, top_n=4)
    return (sel.select("feature", "score", F.lit("selected").alias("status"), F.lit(None).cast("string").alias("correlated_with"))
            .unionByName(rem.select("feature", "score", F.lit("removed").alias("status"), "correlated_with")))


SELECT_THRESHOLD = 0.7


@query("select_order_features", "WITH RECURSIVE " + _OF.removeprefix("WITH ").rstrip() + f""",
c AS ({_CORR_SQL.removeprefix(_OF)}),
sc AS (SELECT f1 AS feature, abs(r) AS score, row_number() OVER (ORDER BY abs(r) DESC, f1) AS i FROM c WHERE f2 = 'total_price'),
g AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS hit
      UNION ALL
      SELECT sc.i, CASE WHEN h.hit IS NULL THEN list_append(g.kept, sc.feature) ELSE g.kept END, sc.feature, sc.score, h.hit
      FROM g JOIN sc ON sc.i = g.i + 1
      LEFT JOIN LATERAL (SELECT min_by(f2, list_position(g.kept, f2)) AS hit FROM c WHERE c.f1 = sc.feature AND list_contains(g.kept, c.f2) AND abs(c.r) > {SELECT_THRESHOLD}) h ON TRUE)
SELECT feature, round(score, 6) AS score, CASE WHEN hit IS NULL THEN 'selected' ELSE 'removed' END AS status, hit AS correlated_with FROM g WHERE feature IS NOT NULL""")
def select_order_features(spark: SparkSession, sf: str) -> DataFrame:
    """FE14: greedy redundancy filter of the per-order features, scored by |r| with the total price."""
    corr = SL.correlation_long(order_features(spark, sf), ORDER_FEATS).withColumn("r", r6("r")).collect()
    scores = [(r["f1"], abs(r["r"])) for r in corr if r["f2"] == "total_price"]
    sel, rem = SL.greedy_select(spark, scores, {(r["f1"], r["f2"]): r["r"] for r in corr}, SELECT_THRESHOLD)
    return (sel.select("feature", r6("score").alias("score"), F.lit("selected").alias("status"), F.lit(None).cast("string").alias("correlated_with"))
            .unionByName(rem.select("feature", r6("score").alias("score"), F.lit("removed").alias("status"), "correlated_with")))


# ------------------------------------------------------------------ models

MODEL_FEATURES = QS.FEATS


def _train_table(spark: SparkSession, sf: str) -> DataFrame:
    ft = QS.feature_table(spark, sf)
    return ft.withColumn("row_id", F.xxhash64(*[F.col(k) for k in QS.KEYS])).drop(*QS.KEYS)


def _grid(spark: SparkSession, sf: str):
    data = _train_table(spark, sf)
    split = M.stratified_split(data, "label", "row_id", 0.2, seed=42)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    model, results, classes = ML.grid_search(train, MODEL_FEATURES, "label", "row_id", QP.CLASS_A,
                                             n_estimators=(10, 20), max_depth=(4, 8), min_samples_split=(2,),
                                             folds=3, parallelism=4)
    return model, results, classes, train, test


@query("rf_grid")
def rf_grid(spark: SparkSession, sf: str) -> DataFrame:
    """ML2/ML3/AGG25: forest grid search with balanced weights and stratified
    folds; mean/std F1 of the positive class per grid point (rows-only)."""
    _m, results, _c, _tr, _te = _grid(spark, sf)
    return ML.top_results(results, 5)


@query("rf_importance")
def rf_importance(spark: SparkSession, sf: str) -> DataFrame:
    """SRT8: importances of the refit best forest (rows-only)."""
    model, _r, _c, _tr, _te = _grid(spark, sf)
    return ML.feature_importances(model, MODEL_FEATURES)


@query("rf_evaluate")
def rf_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """ML4/ML5/ML6: precision/recall/F1/AUC of the best forest on train and test."""
    model, _r, classes, train, test = _grid(spark, sf)
    parts = []
    for name, d in (("train", train), ("test", test)):
        p = ML.predict(model, d, MODEL_FEATURES, classes)
        p = shared_table(p.select("label", "predicted", F.element_at(ML.vector_to_array("probability"), classes.index(QP.CLASS_A) + 1).alias("p_pos")), "scored")
        prf = M.binary_prf(p, "label", "predicted", QP.CLASS_A)
        auc = M.auc_exact(p, "label", "p_pos", QP.CLASS_A).select("auc")
        # both sides are single-row aggregates; join them on a constant key
        parts.append(prf.withColumn("_k", F.lit(1)).join(auc.withColumn("_k", F.lit(1)), "_k")
                     .drop("_k").withColumn("split", F.lit(name)))
    return parts[0].unionByName(parts[1])


def _doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "lang", "text")
    return docs.select("doc_id", "lang", F.split(F.lower("text"), r"[^\p{L}]+").alias("toks"))


@query("disease_topk")
def disease_topk(spark: SparkSession, sf: str) -> DataFrame:
    """ML7/ML8/ML9/SRT6: 600 trees on binary word vectors, in 20 groups with class weights balanced
    in each group's bootstrap; top-3 classes with probabilities and a reason code for held-out
    rows (rows-only)."""
    vocab = sorted({w for ws in QM.LANG_MARKERS.values() for w in ws})
    vec = ML.binary_vectors(_doc_tokens(spark, sf), "toks", vocab)
    split = M.stratified_split(vec, "lang", "doc_id", 0.2, seed=42)
    model, classes = ML.fit_multiclass(split.where(F.col("split") == "train"), "features", "lang", n_trees=600, groups=20, id_col="doc_id")
    pred = ML.predict_topk(model, split.where(F.col("split") == "test"), classes, k=3)
    top = F.transform("predictions", lambda s: F.format_string("%s:%.3f", s["disease"], s["probability"]))
    return pred.select("doc_id", "lang", "reason", F.array_join(top, ",").alias("top3"))


_MARKER_WORDS = sorted({w for ws in QM.LANG_MARKERS.values() for w in ws})


@query("disease_reasons", f"""
WITH t AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x IN ({", ".join(repr(w) for w in _MARKER_WORDS)}))) AS found FROM documents)
SELECT doc_id, array_to_string(list_sort(found), ',') AS recognised, CASE WHEN len(found) = 0 THEN 'no_recognized_symptoms' ELSE 'ok' END AS reason,
       'model_not_ready' AS reason_without_model FROM t""")
def disease_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """ML8/ML9: the recognised items of every text and its reason code, with and without a fitted model."""
    vec = ML.binary_vectors(_doc_tokens(spark, sf), "toks", _MARKER_WORDS)
    none = ML.predict_topk(None, vec, [], 3).where("predictions IS NULL")
    return none.select("doc_id", F.array_join(F.array_sort("recognised"), ",").alias("recognised"), ML.reason_code(F.col("recognised")).alias("reason"),
                       F.col("reason").alias("reason_without_model"))


@query("model_summary")
def model_summary(spark: SparkSession, sf: str) -> DataFrame:
    """ML6: parameters, cross-validation, train and test scores, confusion, report and importances of
    the best forest, one long table (rows-only)."""
    model, results, classes, train, test = _grid(spark, sf)
    return ML.model_summary(model, results, train, test, MODEL_FEATURES, "label", QP.CLASS_A, classes)


@query("tumour_predict")
def tumour_predict(spark: SparkSession, sf: str) -> DataFrame:
    """ML10/ML11/TX9: rendered measurement texts -> model when every model
    feature is present (canonical keys), heuristic otherwise (rows-only)."""
    feats = ["radius_mean", "texture_mean", "concave_points_se", "area_worst"]
    src = dict(zip(feats, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
    li = read(spark, sf, "lineitem")
    # only the training needs a class: A and R rows; every row is scored
    train = li.where(F.col("l_returnflag").isin("A", "R")).select(
        *[F.col(v).alias(k) for k, v in src.items()],
        F.when(F.col("l_returnflag") == "A", "M").otherwise("B").alias("diagnosis"),
        F.xxhash64(*[F.col(k) for k in QS.KEYS]).alias("row_id"))
    model, _res, classes = ML.grid_search(train, feats, "diagnosis", "row_id", "M", n_estimators=(10,),
                                          max_depth=(5,), min_samples_split=(2,), folds=2, parallelism=2)
    # texts: the area value is left out on line 1, which sends those rows to the heuristic
    text = F.concat_ws("; ", F.concat(F.lit("radius mean "), F.col("l_quantity").cast("string")),
                       F.concat(F.lit("texture_mean: "), F.col("l_extendedprice").cast("string")),
                       F.concat(F.lit("concave points_se="), F.col("l_discount").cast("string")),
                       F.when(F.col("l_linenumber") != 1, F.concat(F.lit("area worst "), F.col("l_tax").cast("string"))))
    t = TU.tumour_results(li.select(*QS.KEYS, text.alias("text")), "text", model.stages[-1], feats, classes, cuts=ML.bin_cuts(model))
    return t.select(*QS.KEYS, "method", F.col("predicted_class").alias("label"), "probability", "confidence", "primary_findings",
                    F.array_join("recommendations", " | ").alias("recommendations"), F.to_json("measurements").alias("measurements"),
                    F.array_join("characteristics", ",").alias("characteristics"))
