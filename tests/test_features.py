"""Forests in groups and as row expressions, the tumour table, triage lines, the trie, itemset joins,
two extraction passes, suggestions, nearest-neighbour mutual information, sessions with late turns."""

import math
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from minelake.functions import lexicons as LX
from minelake.operators import baskets as B
from minelake.operators import contrast as CT
from minelake.operators import itemsets as I
from minelake.operators import models as ML
from minelake.operators import rank as RK
from minelake.operators import seqmine as SM
from minelake.operators import suggest as SG
from minelake.operators import text as TX
from minelake.operators import triage as TR
from minelake.operators import tumour as TU
from minelake.sources import io as IO


def _points(spark, n=240):
    rows = [(k, float(k % 17), float((k * 7) % 23), "M" if k % 17 + (k * 7) % 23 > 20 else "B") for k in range(n)]
    return spark.createDataFrame(rows, "id long, radius_mean double, texture_mean double, y string")


def test_forest_expression_equals_the_model(spark):
    df = _points(spark)
    feats = ["radius_mean", "texture_mean"]
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(df)
    model, classes = ML.fit_multiclass(vec, "features", "y", n_trees=7)
    forest = model.stages[-1]
    both = forest.transform(vec).select(ML.vector_to_array("probability").alias("a"), ML.forest_probabilities(forest, F.array(*feats)).alias("b")).collect()
    assert classes == ["B", "M"] and all(math.isclose(x, y, abs_tol=1e-9) for r in both for x, y in zip(r.a, r.b, strict=True))


def test_grouped_forest(spark):
    df = _points(spark)
    vec = VectorAssembler(inputCols=["radius_mean", "texture_mean"], outputCol="features").transform(df)
    model, classes = ML.fit_multiclass(vec, "features", "y", n_trees=12, groups=4, id_col="id")
    out = model.transform(vec)
    assert model.n_trees == 12 and classes == ["B", "M"]
    rows = out.select("y", "prediction", ML.vector_to_array("probability").alias("p")).collect()
    assert all(math.isclose(sum(r.p), 1.0, abs_tol=1e-9) and r.p[int(r.prediction)] == max(r.p) for r in rows)
    assert sum(classes[int(r.prediction)] == r.y for r in rows) > 200
    draws = vec.select(ML.poisson_weight("id", 0, 1).alias("d")).collect()
    assert 0.7 < sum(r.d for r in draws) / len(draws) < 1.3 and max(r.d for r in draws) >= 3
    with pytest.raises(ValueError):
        ML.fit_multiclass(vec, "features", "y", n_trees=10, groups=3, id_col="id")


def test_prediction_without_a_model(spark):
    df = ML.binary_vectors(spark.createDataFrame([(1, ["a", "b"]), (2, ["z"]), (3, [])], "id int, items array<string>"), "items", ["a", "b"])
    out = {r.id: (r.reason, r.predictions, r.recognised) for r in ML.predict_topk(None, df, [], 3).collect()}
    assert out == {1: ("model_not_ready", None, ["a", "b"]), 2: ("model_not_ready", None, []), 3: ("model_not_ready", None, [])}
    codes = {r.id: r.c for r in df.select("id", ML.reason_code(F.col("recognised")).alias("c")).collect()}
    assert codes == {1: "ok", 2: "no_recognized_symptoms", 3: "no_recognized_symptoms"}


def test_positive_label_and_own_metric(spark):
    df = _points(spark)
    assert ML.choose_positive(df, "y") == "M" and ML.choose_positive(df, "y", "Q") == "B"
    with pytest.raises(ValueError, match="two classes"):
        ML.choose_positive(df.where("y = 'M'"), "y")
    with pytest.raises(ValueError, match="more than"):
        ML.choose_positive(df.withColumn("y", F.col("id").cast("string")), "y")
    seen = []

    def share_right(scored):
        seen.append(1)
        return scored.agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0]

    model, results, classes = ML.grid_search(df, ["radius_mean", "texture_mean"], "y", "id", "M", n_estimators=(3,), max_depth=(2, None),
                                             min_samples_split=(2,), folds=2, metric=share_right, parallelism=1)
    rows = results.collect()
    assert len(seen) == 4 and len(rows) == 2 and all(0.5 < r.mean_score <= 1 for r in rows)
    summary = ML.model_summary(model, results, df, df, ["radius_mean", "texture_mean"], "y", "M", classes).collect()
    sections = Counter(r.section for r in summary)
    assert sections["parameters"] == 4 and sections["confusion"] == 4 and sections["importance"] == 2 and {"train", "test", "report", "cross_validation"} <= set(sections)


def test_tumour_table_model_rule_and_empty_texts(spark):
    df = _points(spark)
    feats = ["radius_mean", "texture_mean"]
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(df)
    model, classes = ML.fit_multiclass(vec, "features", "y", n_trees=5)
    texts = spark.createDataFrame([(1, "radius mean 16; texture_mean: 22; spiculated mass"), (2, "radius 4, smooth"), (3, ""), (4, None), (5, "nothing here")],
                                  "id int, text string").withColumn("probability", F.lit("x")).withColumnRenamed("probability", "extra")
    rows = {r.id: r for r in TU.tumour_results(texts, "text", model.stages[-1], feats, classes).collect()}
    assert rows[1].method == "model" and rows[1].predicted_class == "Malignant" and rows[1].extra == "x"
    assert rows[1].primary_findings.startswith("Analyzed 2 measurements and 2 characteristics") and rows[1].recommendations[0].startswith("Prediction summary: Malignant (")
    assert rows[2].method == "heuristic" and rows[2].measurements == {"radius": 4.0} and rows[2].characteristics == ["smooth"]
    for k in (3, 4, 5):
        assert rows[k].method == "heuristic" and rows[k].predicted_class == "Benign" and rows[k].measurements == {}
    assert all(r.confidence >= r.probability for r in rows.values())
    assert TU.tumour_results(texts.where("1 = 0"), "text").count() == 0


def test_findings_line(spark):
    df = spark.createDataFrame([(["a", "b"], "flu", 0.456), ([], None, None), (["a"], None, None)], "items array<string>, top string, p double")
    got = [r[0] for r in df.select(TR.findings_line("items", F.col("top"), F.col("p"))).collect()]
    assert got == ["Detected symptoms: a, b. \nTop predicted disease: flu (46% confidence).", "No symptoms detected.", "Detected symptoms: a."]


def test_triage_of_turns(spark):
    train = spark.createDataFrame([(["a", "b"], "flu")] * 20 + [(["c", "d"], "cold")] * 20, "items array<string>, y string")
    model, classes = ML.fit_multiclass(ML.binary_vectors(train, "items", ["a", "b", "c", "d"]), "features", "y", n_trees=9)
    turns = spark.createDataFrame([(1, 1, ["a"]), (1, 2, ["b"]), (2, 1, ["c", "d", "a", "b", "e"]), (3, 1, []), (3, 2, [])], "conv long, turn long, items array<string>")
    precautions = spark.createDataFrame([("flu", ["rest"]), ("cold", ["tea"])], "key string, values array<string>")
    records = spark.createDataFrame([(["a", "x_y"], 0.5, "flu", 1), (["a", "b", "z"], 0.4, "flu", 2)], "items array<string>, support double, group string, rec_order long")
    out = {(r.conv, r.turn): r for r in TR.disease_triage(turns, ["conv"], "turn", model, classes, ["a", "b", "c", "d"], precautions, records, 2).collect()}
    assert [out[k].action for k in sorted(out)] == ["ask", "predict", "predict", "ask", "predict"]
    assert out[1, 2].top_class == "flu" and out[1, 2].precautions == ["rest"] and out[1, 2].findings.startswith("Detected symptoms: a, b.")
    assert [f.candidate for f in out[1, 1].followups] == ["x_y", "b", "z"] and out[3, 2].reason == "no_recognized_symptoms" and out[3, 1].findings == "No symptoms detected."


def test_trie_support_equals_the_fold(spark):
    seqs = [[["a"], ["b", "c"], ["a"]], [["b"], ["a", "c"]], [], None, [["a", "b", "c"]], [["c"], ["c"], ["b"]]] * 5 + [[["a"]]]
    pats = [[["a"]], [["a"], ["a"]], [["b"], ["a"]], [["b", "c"], ["a"]], [["c"], ["c"], ["b"]], [["z"]], [], [["a"], []], [[], ["b"]]]
    df = spark.createDataFrame([(s,) for s in seqs], "sequence array<array<string>>")
    patterns = spark.createDataFrame([(p,) for p in pats + pats[:2]], "pattern array<array<string>>")
    cond = F.coalesce(SM.contains_pattern(F.coalesce("sequence", F.array().cast("array<array<string>>")), F.col("pattern")), F.lit(False))
    want = {str(r.pattern): r.n for r in df.join(patterns.distinct()).groupBy("pattern").agg(F.count_if(cond).alias("n")).collect()}
    for size in (1 << 20, 20):  # one trie, several tries
        got = SM.pattern_support(df, patterns, trie_bytes=size).collect()
        assert {str(r.pattern): r.freq for r in got} == want and len(got) == len(pats)
        assert all(math.isclose(r.support, r.freq / len(seqs)) for r in got)
    assert SM.pattern_support(df.where("1 = 0"), patterns).agg(F.sum("freq")).first()[0] == 0
    assert SM.pattern_support(df, patterns.where("1 = 0")).count() == 0


def test_itemset_join(spark):
    sets = [("a", "b"), ("a", "c"), ("b", "d"), ("x", "y"), ("a",), ("b",), ("a", "b", "c"), ("a", "b", "d"), ("b", "a")]
    got = {tuple(r.items) for r in I.itemset_join(spark.createDataFrame([(list(s),) for s in sets] + [([],)], "items array<string>")).collect()}
    uniq = {frozenset(s) for s in sets}
    assert got == {tuple(sorted(p | q)) for p, q in combinations(uniq, 2) if len(p) == len(q) and len(p ^ q) == 2}


def test_two_passes(spark):
    df = spark.createDataFrame([(["b", "a"], ["a", "c"], {"x": 1.0, "y": 2.0}, {"y": 3.0, "z": None}), (None, ["q"], None, {"k": 1.0}), ([], None, {"k": 2.0}, None)],
                               "t1 array<string>, t2 array<string>, m1 map<string,double>, m2 map<string,double>")
    rows = df.select(TX.union_terms(F.col("t1"), F.col("t2")).alias("t"), TX.override_measurements(F.col("m1"), F.col("m2")).alias("m")).collect()
    assert [r.t for r in rows] == [["a", "b", "c"], ["q"], []]
    assert [r.m for r in rows] == [{"x": 1.0, "y": 3.0, "z": None}, {"k": 1.0}, {"k": 2.0}]


def test_suggestions_against_plain_python(spark):
    records = [(sorted({f"i{(k * 3) % 7}", f"i{(k * 5 + 1) % 7}", f"i{k % 4}"}), 0.1 * (k % 5), f"g{k}", k) for k in range(25)]
    known = {1: ["i1", "i2"], 2: ["i0"], 3: [], 4: ["none"], 5: [f"i{k}" for k in range(7)], None: ["i3"]}
    want = []
    for q, have in known.items():
        best = {}
        for items, support, group, order in records:
            if set(items) & set(have):
                for c in set(items) - set(have):
                    found = ((-support, order), (group, items))
                    best[c] = min(best.get(c, found), found)
        ranked = sorted(best.items(), key=lambda x: (x[1][0][0], x[0]))[:max(3, 5 - len(have) + 2)]
        want += [(q, i + 1, c, g, tuple(x for x in items if x in have)) for i, (c, (_, (g, items))) in enumerate(ranked)]
    queries = spark.createDataFrame([(q, h) for q, h in known.items()], "q int, known array<string>")
    rec = spark.createDataFrame(records, "items array<string>, support double, group string, rec_order long")
    got = SG.suggest(queries.where("q IS NOT NULL"), "q", "known", rec).collect()
    assert Counter((r.q, r.rank, r.candidate, r.group, tuple(r.trigger)) for r in got) == Counter(w for w in want if w[0] is not None)


def _psi(n):
    return sum(1 / k for k in range(1, n)) - 0.5772156649015329


def test_nearest_neighbour_information(spark):
    rows = [(k, float((k * 37) % 101) / 7, float(k % 3), "a" if (k * 37) % 101 > 40 else "b") for k in range(150)] + [(900, 1.0, 2.0, "alone"), (901, None, float("nan"), "a")]
    df = spark.createDataFrame(rows, "id int, x double, tied double, y string")
    for c, at in (("x", 1), ("tied", 2)):
        pts = [(r[at], r[3]) for r in rows if r[at] is not None and r[at] == r[at]]
        per = Counter(y for _, y in pts)
        pts = [p for p in pts if per[p[1]] > 1]
        k_sum = c_sum = m_sum = 0.0
        for i, (v, y) in enumerate(pts):
            others = sorted(abs(v - w) for j, (w, z) in enumerate(pts) if j != i and z == y)
            near = min(3, len(others))
            r = others[near - 1]
            m = sum(abs(v - w) < r * (1 - 1e-12) for w, _ in pts) if r else sum(w == v for w, _ in pts)
            k_sum, c_sum, m_sum = k_sum + _psi(near if r else sum(d == 0 for d in others)), c_sum + _psi(per[y]), m_sum + _psi(m)
        n = len(pts)
        want = max(0.0, _psi(n) + (k_sum - c_sum - m_sum) / n)
        for bucket in (100_000, 10):
            got = {r.feature: r.score for r in RK.mutual_info_knn(df, ["x", "tied"], "y", 3, bucket_rows=bucket).collect()}
            assert math.isclose(got[c], want, abs_tol=1e-8), c
    assert RK.mutual_info_knn(df.where("1 = 0"), ["x"], "y").count() == 0


def test_late_and_repeated_turns_of_a_running_stream(spark):
    from minelake.streaming.session_stream import TURNS, SessionJob

    job = SessionJob(spark)
    job.deliver(spark.createDataFrame([(1, 3, ["a"]), (1, 1, ["b"]), (2, 1, ["a"] * 5), (1, 3, ["again"]), (3, None, ["x"])], TURNS))
    job.deliver(spark.createDataFrame([(1, 2, ["late"]), (1, 3, ["a"]), (1, 4, None), (2, 2, [])], TURNS))
    rows = Counter((r.conv_id, r.turn, r.action) for r in job.finish().collect())
    assert rows == Counter([(1, 1, "ask"), (1, 3, "predict"), (1, 3, "late"), (1, 2, "late"), (1, 3, "late"), (1, 4, "ask"),
                            (2, 1, "predict"), (2, 2, "ask"), (3, None, "late")])


def test_small_helpers(spark):
    df = spark.createDataFrame([("x", "y", 1, "z")], "Symptom_1 string, symptom_2 string, other int, Late_Symptom string")
    assert B.item_columns(df) == ["Symptom_1", "symptom_2", "Late_Symptom"]
    with pytest.warns(UserWarning, match="Only 3 transactions"):
        B.warn_if_few(spark.createDataFrame([(3,)], "n_baskets long"))
    sets = IO.read_itemsets(spark.createDataFrame([(["A b", "c-d"], None, " g "), (["one"], 0.5, None), (["", "x"], 1.0, "h")],
                                                  "itemset array<string>, support double, disease string"))
    assert [tuple(r) for r in sets.collect()] == [(["a_b", "c_d"], 0.0, "g")]
    text = spark.range(1).select(TX.render_prompt([("radius", F.lit(1.5)), ("area", F.lit(None).cast("double"))]).alias("t"), TX.extract_with_fallback(F.lit("dose: 3")).alias("m"))
    assert text.first().t == "radius 1.5" and text.first().m == {"dose": 3.0}
    seqs = spark.createDataFrame([("A", [["p"], ["q"]])] * 4 + [("B", [["q"]])] * 4, "y string, sequence array<array<string>>")
    tables = CT.analyze(seqs, "y", "A", "B", min_support=0.5, longest=2)
    assert tables["class_patterns"].count() == 4 and {r.status for r in tables["comparison"].collect()} == {"common", "unique_A"}
    assert tables["totals"].first().total_sequences == 8 and tables["unique_A_top10"].count() == 2


def test_spread_asks_the_operators_not_the_names(spark):
    from minelake.plans.parallel import spread

    df = spark.range(10, numPartitions=1).withColumn("JoinSort", F.lit("Window"))
    assert spread(df, 3).rdd.getNumPartitions() == 3 and spread(df, 1) is df
    grouped = df.groupBy("JoinSort").count()
    assert spread(grouped, 3) is grouped
    shares = {r.v: (r.n, r.share) for r in B.value_distribution(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string"), "v").collect()}
    assert shares == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}


def test_characteristics_of_odd_texts_without_comparing_lambdas(spark):
    texts = ["Spiculated MASS, soft tissue; soft-tissue; well-defined", "non-cancerous lesion", "tumor tumor growth mass", "massive finery dense_x x-smooth",
             "ill-defined  fluid-filled fluid filled", "smooth\nrough\tcystic", "éfine finé ﬁne fine2 2fine", "KIRREGULAR irregular", "", " ", "nothing here", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:3])], "id int, text string")
    every = sorted(t for ts in LX.CHARACTERISTIC_CATEGORIES.values() for t in ts)

    def found(text):
        hits = [t for t in every if re.search(rf"(?<!\w){t}(?!\w)", (text or "").lower())]
        return hits, sorted({LX.CHARACTERISTIC_SYNONYMS.get(t, t) for t in hits})

    out = df.select("id", "text", TX.lexicon_terms(F.col("text"), LX.CHARACTERISTIC_CATEGORIES).alias("terms"), TU.characteristics(F.col("text")).alias("chars"))
    for r in out.collect():
        terms, chars = found(r.text)
        assert r.terms == (None if r.text is None else terms) and r.chars == chars, r
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort(" not in plan and "sort_array(" in plan
    tags = spark.createDataFrame([([" Tumor", None, "lesion", "FINE", "odd "],), ([],), (None,)], "terms array<string>")
    assert [r[0] for r in tags.select(TX.standardise_characteristics(F.col("terms"))).collect()] == [["mass", None, "smooth", "odd"], [], None]


def test_insights_of_odd_rows_in_code_that_is_compiled(spark):
    rows = [({"radius": 16.0, "area": 1200.0, "compactness": 0.2, "concavity": 0.2}, ["irregular", "mass"]), ({"x": 1.0}, []), ({}, ["benign", "dense"]),
            ({}, []), (None, []), ([], None), (None, None), (None, ["smooth"]), ({"radius": None}, None)]
    rows = [(i, m or ({} if m == [] else m), c) for i, (m, c) in enumerate(rows)]
    df = spark.createDataFrame(rows + rows[:2], "id int, m map<string,double>, chars array<string>")
    insights, risk = TX.risk_insights(F.col("m"), F.col("chars"))
    out = df.select("id", insights.alias("insights"), risk.alias("risk"))
    got = {r.id: (r.insights, r.risk) for r in out.collect()}
    tail = ["All findings require professional radiological and clinical correlation", "This AI analysis supports but does not replace expert medical evaluation"]
    assert got[0][1] == 5 and len(got[0][0]) == 12 and got[0][0][-2:] == tail and got[0][0][0] == "Received 4 quantitative measurements for analysis"
    assert got[1] == (["Received 1 quantitative measurements for analysis", *tail], 0)
    assert got[2][0][:3] == ["Identified 2 tumor characteristics", "Benign characteristics noted - continue monitoring", "Dense tissue characteristics noted - may affect imaging sensitivity"]
    assert got[3] == (["Please provide tumor measurements or characteristics for detailed analysis."], 0)
    assert [got[k] for k in (4, 5, 6)] == [(["", *tail], 0)] * 3
    assert got[7][0][0] == "Identified 1 tumor characteristics" and got[8] == (["Received 1 quantitative measurements for analysis", *tail], 0)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", df.select(insights.alias("insights"))._jdf.queryExecution().explainString(mode))
    # the JVM never compiles a method of more than 8000 bytes
    assert sizes and max(map(int, sizes)) <= 8000
