"""Plans and partitions that must not grow with the table: offsets of prefix sums, rows a task reads in a
forest fit, and steps that are evaluated once."""

import pytest
from pyspark.sql import functions as F

from minelake.functions import lexicons as LX
from minelake.operators import bins as BN
from minelake.operators import itemsets as I
from minelake.operators import models as ML
from minelake.operators import suggest as SG
from minelake.operators import text as TX
from minelake.plans import q_sequences as QS
from minelake.plans import q_text as QT
from minelake.plans.prefix import ordered_index

SF = "/root/testdata/sf0.001"


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_offsets_are_broadcast_beside_a_large_table(spark):
    """The rows are not shuffled a second time by the few (partition, key) of the offsets."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        df = spark.range(50_000).select("id", (F.col("id") % 2).alias("k"), F.xxhash64("id").alias("h"))
        out = ordered_index(df, ["k"], ["h", "id"], "idx")
        plan = _final_plan(out)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        row = out.groupBy("k").agg(F.max("idx").alias("m"), F.countDistinct("idx").alias("n")).collect()
        assert sorted((r["k"], r["m"], r["n"]) for r in row) == [(0, 25_000, 25_000), (1, 25_000, 25_000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_grid_search_bounds_the_rows_of_a_partition(spark, monkeypatch):
    """Partitions of a fit follow the rows of the table, not the session's shuffle partitions."""
    sizes, fit = [], ML.RandomForestClassifier.fit

    def spied(self, dataset, params=None):
        sizes.append(dataset.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        return fit(self, dataset, params)

    monkeypatch.setattr(ML, "PARTITION_ROWS", 50, raising=False)
    monkeypatch.setattr(ML.RandomForestClassifier, "fit", spied)
    df = spark.range(1000).select(F.col("id").alias("rid"), (F.col("id") % 7).cast("double").alias("x"),
                                  F.when(F.col("id") % 7 > 3, "M").otherwise("B").alias("y"))
    model, res, classes = ML.grid_search(df, ["x"], "y", "rid", "M", n_estimators=(2, 3), max_depth=(2,), min_samples_split=(2,), folds=2)
    assert len(sizes) == 5 and max(map(max, sizes)) <= 100
    assert [sum(s) for s in sizes] == [500] * 4 + [1000]
    assert classes == ["B", "M"] and [r["mean_score"] for r in res.collect()] == pytest.approx([1.0, 1.0])
    assert ML.predict(model, df, ["x"], classes).where("predicted <> y").count() == 0


def _counted(spark, column, kind):
    """A pass-through of ``column`` that counts the rows it is evaluated for."""
    seen = spark.sparkContext.accumulator(0)

    def through(x):
        seen.add(1)
        return x

    return seen, F.udf(through, kind).asNondeterministic()(column)


def test_baskets_are_built_once_for_mining(spark):
    rows = [(["a", "b"],)] * 30 + [(["b", "c"],)] * 10
    seen, items = _counted(spark, F.col("items"), "array<string>")
    its = I.mine_itemsets(spark.createDataFrame(rows, "items array<string>").select(items.alias("items")), min_support=0.5)
    assert sorted((tuple(r["items"]), r["freq"]) for r in its.collect()) == [(("a",), 30), (("a", "b"), 30), (("b",), 40)]
    assert seen.value == 40


def test_short_baskets_list_their_itemsets(spark, monkeypatch):
    """No FP-trees of all baskets where the wanted itemsets are small; long baskets still grow them."""
    fits, fit = [], I.FPGrowth.fit
    monkeypatch.setattr(I.FPGrowth, "fit", lambda self, df: fits.append(1) or fit(self, df))
    rows = [([f"i{j}" for j in range(8) if (i * 37 + 11) >> j & 1] + ["i0", f"rare{i}"],) for i in range(300)] + [([],), (None,)]
    df = spark.createDataFrame(rows, "items array<string>")

    def mined(df, **more):
        return sorted((tuple(r["items"]), r["size"], r["freq"], r["support"]) for r in I.mine_itemsets(df, min_support=0.05, **more).collect())

    every = mined(df)
    assert len(fits) == 1
    for k in (1, 2, 3):
        assert mined(df, max_size=k) == [r for r in every if r[1] <= k] and len(fits) == 1
    assert mined(df.where("size(items) > 100"), max_size=2) == [] and len(fits) == 1
    for name, most in (("LISTED", 3), ("LISTED_MOST", 20)):
        with monkeypatch.context() as m:
            m.setattr(I, name, most)
            assert mined(df, max_size=3) == [r for r in every if r[1] <= 3]
    assert len(fits) == 3
    null = spark.createDataFrame([(["a", None],)] * 3 + [(["a"],)], "items array<string>")
    assert I.mine_itemsets(null, min_support=0.5, max_size=2).count() == 3


def test_suggestions_are_searched_once_per_set(spark, monkeypatch):
    written, share = {}, SG.shared_table

    def spied(df, name):
        written[name] = share(df, name)
        return written[name]

    monkeypatch.setattr(SG, "shared_table", spied)
    queries = spark.range(200).select("id", F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("a"))).alias("known"))
    records = spark.createDataFrame([(["a", "c"], 0.5, "g1", 1), (["b", "c", "d"], 0.4, "g2", 2)], "items array<string>, support double, group string, rec_order long")
    got = SG.suggest(queries, "id", "known", records)
    assert written["sets"].count() == 1
    assert got.count() == 400 and got.groupBy("rank", "candidate", "group").count().orderBy("rank").collect() == [(1, "c", "g1", 200), (2, "d", "g2", 200)]


def test_triage_reads_the_texts_for_markers_once(spark, monkeypatch):
    build, seen = QT._doc_markers, []

    def spied(spark, sf):
        df = build(spark, sf)
        count, items = _counted(spark, F.col("items"), "array<string>")
        seen.append((count, df.count()))
        return df.withColumn("items", items)

    monkeypatch.setattr(QT, "_doc_markers", spied)
    assert QT.triage_disease(spark, SF).count() > 0
    assert [count.value for count, _ in seen] == [n for _, n in seen]


def test_sweeps_fit_once_and_count_rows_once(spark, monkeypatch):
    """All edges of a sweep come from one quantile search, and its sequences from counted bins."""
    kinds = [("uniform", 3), ("quantile", 3), ("quantile", 5), ("kmeans", 5)]
    ft = QS.feature_table(spark, SF)
    want = {k: BN.fit_bins(ft, QS.FEATS, k[1], k[0]) for k in kinds}
    calls, search = [], BN.exact_quantiles
    monkeypatch.setattr(BN, "exact_quantiles", lambda *a, **k: calls.append(1) or search(*a, **k))
    assert BN.fit_many(ft, QS.FEATS, kinds) == want and len(calls) == 1
    counted = QS.counted_bins(spark, SF, [("quantile", 3)])["quantile", 3]
    for method, plain in (("mutual_info", QS.global_sequences), ("zscore", QS.row_sequences)):
        seqs = QS.counted_sequences(counted, 3, method)
        got = {(r["label"], str(r["sequence"])): r["n"] for r in seqs.groupBy("label", "sequence").agg(F.sum("n").alias("n")).collect()}
        assert got == {(r["label"], str(r["sequence"])): r["count"] for r in plain(spark, SF).groupBy("label", "sequence").count().collect()}
    assert counted.count() <= 2 * 3 ** 4


def test_all_fits_of_a_sweep_read_the_rows_twice(spark, monkeypatch):
    """One pass finds the edges of all strategies and bins, one counts the rows for all of them."""
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = [("A" if i % 3 else "R", i % 50 + 1.0, odd[i % 97] if i % 97 < len(odd) else (i * 7919) % 1009 / 7, 0.05, None) for i in range(2000)]
    plain = spark.createDataFrame(rows, "label string, " + ", ".join(f"{c} double" for c in QS.FEATS)).cache()
    seen, label = _counted(spark, F.col("label"), "string")
    kinds = [(s, n) for s in ("uniform", "quantile", "kmeans") for n in (3, 5)]
    monkeypatch.setattr(QS, "feature_table", lambda *a: plain.withColumn("label", label))
    fit, passes, counts = BN.sorted_values, [], []
    monkeypatch.setattr(BN, "sorted_values", lambda *a: passes.append(1) or fit(*a))
    monkeypatch.setattr(BN, "_finite_ends", lambda *a: counts.append(1))
    counted = QS.counted_bins(spark, SF, kinds)
    monkeypatch.undo()
    assert seen.value == plain.count() and len(passes) == 1 and not counts
    for s, n in kinds:
        want = BN.apply_bins(plain, BN.fit_bins(plain, QS.FEATS, n, s)).groupBy("label", *QS.FEATS).count().collect()
        assert counted[s, n].schema.names == ["label", *QS.FEATS, "n"]
        assert sorted(map(str, map(tuple, counted[s, n].collect()))) == sorted(map(str, map(tuple, want)))


def test_quantiles_of_written_values(spark):
    """Ranks that share a cell, fall on single values, on ends, and among infinities and NaN."""
    rows = [(float(i * i % 5003), float(i % 3), None, [float("-inf"), float("inf"), float("nan"), 1.5, None][i % 5], 1e300 if i == 7 else i / 8) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").cache()
    cols, probs = ["a", "b", "c", "d", "e"], [0, 1e-4, 1 / 7, 0.2, 0.25, 0.5, 0.50003, 2 / 3, 0.9999, 1]
    held = BN.sorted_values(df, cols, 16)
    assert str(BN.exact_quantiles(df.where("false"), cols, probs, held=held)) == str(BN.exact_quantiles(df, cols, probs))


def test_lexicon_terms_that_overlap_share_a_start_or_touch_marks(spark):
    rows = [("soft tissue mass, non-cancerous",), ("Mass-mass masses _mass mass_",), ("",), (None,), ("\x03 fluid-filled\tsoft  tissue soft tissue",)]
    df = spark.createDataFrame(rows, "t string").select(TX.lexicon_terms(F.col("t"), LX.CHARACTERISTIC_CATEGORIES).alias("x"))
    assert [r["x"] for r in df.collect()] == [["cancerous", "mass", "non-cancerous", "soft tissue"], ["mass"], [], None, ["fluid-filled", "soft tissue"]]


def test_measurements_read_a_pair_by_one_regex(spark):
    """Name and value regexes do not run again on every pair, and the rule grammar only where a name occurs."""
    df = spark.createDataFrame([("\x03a: 1, b 2, b = 3, b 4, c d 5, c: 6\x02",), ("radius  mean: 2; radius_mean 3; Fractal se 4",)], "t string")
    out = TX.add_measurements(df, "t", "m")
    assert [dict(r["m"]) for r in out.collect()] == [{"a": 1.0, "b": 3.0, "c": 6.0, "d": 5.0}, {"radius_mean": 3.0, "fractal_dimension_se": 4.0}]
    plan = df.select(TX.kv_fallback(F.col("t")).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 1


def _mixed_rows(spark, n):
    """Two classes by x and y; a constant and a column with null and NaN."""
    u = lambda k: (F.abs(F.xxhash64("id", F.lit(k))) % 100_000).cast("double") / 100_000
    df = spark.range(n).select(F.col("id").alias("rid"), F.floor(u(1) * 12).cast("double").alias("x"), u(2).alias("y"), F.lit(1.5).alias("same"),
                               F.when(F.col("id") % 53 == 0, float("nan")).when(F.col("id") % 50 > 0, u(3)).alias("odd"), u(4).alias("_u"))
    return df.withColumn("c", F.when((F.col("x") / 12 + F.col("y") > 1) == (F.col("_u") < 0.93), "M").otherwise("B")).drop("_u")


def test_grid_search_fits_counted_cells(spark, monkeypatch):
    """The rows a fit reads do not grow with the table; scores and predictions are those of row-wise fits."""
    feats, n = ["x", "y", "same", "odd"], 3000
    df = _mixed_rows(spark, n).localCheckpoint()
    kinds = dict(n_estimators=(1, 4), max_depth=(5,), min_samples_split=(9,), folds=2)
    _, want, _ = ML.grid_search(df, feats, "c", "rid", "M", **kinds)
    monkeypatch.setattr(ML, "COUNTED_FROM", 1, raising=False)
    sizes, fit = [], ML.RandomForestClassifier.fit
    with monkeypatch.context() as m:
        m.setattr(ML.RandomForestClassifier, "fit", lambda self, rows, params=None: sizes.append(rows.count()) or fit(self, rows, params))
        few, _, _ = ML.grid_search(df, ["x"], "c", "rid", "M", n_estimators=(2, 3), max_depth=(2,), min_samples_split=(2,), folds=2)
    # three trees a fold serve both forests, and a cell is one of 12 values and a class
    assert len(sizes) == 6 + len(few.stages[-1].trees) == 6 + few.stages[-1].getNumTrees and max(sizes) <= 24
    monkeypatch.setattr(ML, "CELL_SHARE", 0, raising=False)
    model, got, classes = ML.grid_search(df, feats, "c", "rid", "M", **kinds)
    assert got.count() == 2
    for a, b in zip(want.orderBy("n_estimators").collect(), got.orderBy("n_estimators").collect(), strict=True):
        assert a[:3] == b[:3] and a["mean_score"] == pytest.approx(b["mean_score"], abs=0.05)
    p = ML.predict(model, df, feats, classes)
    assert p.columns[:6] == df.columns and not [c for c in p.columns if "__" in c]
    assert p.count() == n and p.where("predicted = c").count() > 0.85 * n
    # the row expression compares values, the model bins
    probs = ML.forest_probabilities(model.stages[-1], F.array(*feats), ML.bin_cuts(model))
    both = p.where("odd IS NOT NULL AND NOT isnan(odd)").select(ML.vector_to_array("probability").alias("m"), probs.alias("e")).collect()
    assert len(both) > 0.9 * n and all(r["m"] == pytest.approx(r["e"]) for r in both)


def test_bootstraps_of_cells_are_those_of_their_rows(spark):
    """A tree draws a cell as often as its rows together, and only a cell of few rows can be left out."""
    rows = spark.range(20_000).select((F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("c"), F.lit(1.0).alias("weight"), F.lit(0).alias("fold"))
    imputer = ML.Imputer(inputCols=["x"], outputCols=["x__filled"], strategy="median")
    counted = ML.CountedRows(rows, ["x"], ML.StringIndexer(inputCol="c", outputCol="label_idx").fit(rows), imputer, ML.RandomForestClassifier(seed=7), [], 20_000)
    draws = [r["draws"] for r in counted._drawn(*counted.every, trees=50, n_cells=10).collect()]
    assert counted.worthwhile and len(draws) == 10 and draws == [r["draws"] for r in counted._drawn(*counted.every, trees=50, n_cells=10).collect()]
    every = [d for one in draws for d in one]
    mean = sum(every) / 500
    assert mean == pytest.approx(2000, abs=10) and sum((d - mean) ** 2 for d in every) / 500 == pytest.approx(2000, rel=0.3)


def test_split_points_are_those_of_a_forest(spark):
    rows = [(float(i * i % 211), float(i % 9), 3.0, 0.0 if i % 100 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("fold", F.lit(0))
    for i, held in enumerate(ML.value_counts(df, ["a", "b", "c", "d"])):
        values = sorted(r[i] for r in rows)
        assert sorted(held[0].elements()) == values
        cuts = ML.split_points(sorted(held[0].items()))
        sides = {sum(v <= t for t in cuts) for v in values}
        assert len(cuts) == len(sides) - 1 <= 31 and len(sides) == min(32, len(set(values)))
    assert ML.split_points([(float("-inf"), 1), (0.0, 1), (5e-324, 1), (float("inf"), 2)]) == [float("-inf"), 0.0, 5e-324]
    many = ML.value_counts(spark.range(20_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("fold")), ["x"])
    assert sorted(many[0]) == [0, 1] and all(900 < len(v) <= 1001 for v in many[0].values())
    t = ML.split_points(sorted((k, n) for k, n in (many[0][0] + many[0][1]).items() if k is not None))
    assert len(t) == 31 and all(abs(x - 625 * (j + 1)) < 60 for j, x in enumerate(t))


def test_forest_as_bits_of_words_equals_the_model(spark, monkeypatch):
    """Scores in stages that compile, with no lambda over the nodes of a tree; large forests are still walked."""
    df = _mixed_rows(spark, 600).where("odd IS NOT NULL AND NOT isnan(odd)")
    feats = ["x", "y", "odd"]
    vec = ML.VectorAssembler(inputCols=feats, outputCol="features").transform(df)
    model, _ = ML.fit_multiclass(vec, "features", "c", n_trees=7)
    forest = model.stages[-1]
    scored = forest.transform(vec).select(F.array(*feats).alias("a"), ML.vector_to_array("probability").alias("want"))
    walked = ML.forest_probabilities
    for walks in (0, 1):
        with monkeypatch.context() as m:
            calls = []
            m.setattr(ML, "forest_probabilities", lambda *a: calls.append(1) or walked(*a))
            m.setattr(ML, "LEAF_TREES", 6 if walks else 7, raising=False)
            rows = ML.add_forest_probabilities(scored, forest, "a", "p", "known").collect()
        assert len(calls) == walks and len(rows) > 500 and all(r["known"] and r["p"] == pytest.approx(r["want"]) for r in rows)
    gap = spark.createDataFrame([([1.0, None, 2.0],), ([1.0, 0.5, float("nan")],), (None,)], "a array<double>")
    assert [r["known"] for r in ML.add_forest_probabilities(gap, forest, "a", "p", "known").collect()] == [False, True, None]


def test_features_of_a_map_with_equal_and_odd_keys(spark):
    maps = [(["radius-mean", "Radius Mean", "area_se"], [1.0, 2.0, None]), (["radius_mean", "x\u0001radius mean", "\u0001", "areaSE"], [4.0, 5.0, 6.0, 7.0]),
            ([], []), (None, None), (["äradius mean"], [8.0])]
    m = F.map_from_arrays("k", "v")
    df = spark.createDataFrame(maps, "k array<string>, v array<double>").select(ML.map_to_features(m, ["radius_mean", "area_se"], TX.canonical_key).alias("x"))
    assert [r["x"] for r in df.collect()] == [[2.0, None], [4.0, 7.0], [None, None], [None, None], [8.0, None]]
