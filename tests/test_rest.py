"""H6 session, H7 routing, H8 measurements, H9 metrics, H10 heuristic score,
H11 redundancy filter, lookups, prefix sums, quantiles, IO round trips."""

import math
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from minelake.operators import metrics as M
from minelake.operators import select as SL
from minelake.operators import session as SS
from minelake.operators import text as TX
from minelake.operators.quantiles import exact_quantiles
from minelake.plans.prefix import ordered_index, prefix_sum
from minelake.sources import io as IO

H6 = [(1, 1, ["a", "b"]), (1, 2, ["b", "c"]), (1, 3, ["d"]), (1, 4, []), (1, 5, ["a", "b", "c", "d", "e"])]


def _h6(spark):
    return spark.createDataFrame(H6, "conv_id long, turn long, items array<string>")


def _check_h6(rows):
    got = {r["turn"]: (r["action"], sorted(r["items_used"]) if r["items_used"] is not None else None,
                       r["followup_limit"]) for r in rows}
    assert got == {1: ("ask", None, 5), 2: ("predict", ["a", "b", "c"], None), 3: ("ask", None, 6),
                   4: ("predict", ["d"], None), 5: ("predict", ["a", "b", "c", "d", "e"], None)}


def test_h6_session_fold(spark):
    _check_h6(SS.fold_sessions(_h6(spark), ["conv_id"], "turn").collect())


def test_h6_session_stream(spark):
    from minelake.streaming.session_stream import run_file_stream

    d = tempfile.mkdtemp(prefix="minelake-stream-")
    out = run_file_stream(spark, _h6(spark), run_dir=os.path.join(d, "run"))
    _check_h6(out.collect())


def test_h7_routing(spark):
    df = spark.createDataFrame([("I will wait",), ("tumor radius 12 mm",), ("hello",)], "t string")
    assert [r[0] for r in df.select(TX.route(F.col("t"))).collect()] == ["disease", "tumour", "unknown"]


def test_h8_measurements(spark):
    df = spark.createDataFrame([("radius_mean: 18.34, concave points_se=0.017, diameter 10",),
                                ("radius mean 16.72",), ("fractal_dimension_mean: 0.07",)], "t string")
    m = df.select(TX.standardise_measurements(TX.extract_measurements(F.col("t"))).alias("m")).collect()
    assert dict(m[0]["m"]) == {"radius_mean": 18.34, "concave_points_se": 0.017, "radius": 5.0}
    assert dict(m[1]["m"]) == {"radius_mean": 16.72}
    assert dict(m[2]["m"]) == {"fractal_dimension_mean": 0.07}


def test_kv_fallback(spark):
    df = spark.createDataFrame([("radius_mean: 18.34, texture_mean:16.48, perimeter mean 120.5, area 1001.0",)],
                               "t string")
    m = dict(df.select(TX.kv_fallback(F.col("t"))).first()[0])
    assert m == {"radius_mean": 18.34, "texture_mean": 16.48, "perimeter_mean": 120.5, "area": 1001.0}


def test_h9_metrics(spark):
    rows = [("M", "M", 0.9), ("M", "M", 0.8), ("M", "B", 0.4), ("B", "B", 0.3), ("B", "M", 0.7)]
    df = spark.createDataFrame(rows, "y string, p string, s double")
    r = M.binary_prf(df, "y", "p", "M").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 1)
    assert round(r["precision"], 4) == round(r["recall"], 4) == round(r["f1"], 4) == 0.6667
    assert round(M.auc_exact(df, "y", "s", "M").first()["auc"], 4) == 0.8333
    assert M.auc_exact(df.where(F.col("y") == "M"), "y", "s", "M").first()["auc"] is None


def test_h10_heuristic(spark):
    df = spark.createDataFrame([({"a": 15.0},), ({"a": 0.0},), ({"a": 1000.0},)], "m map<string,double>")
    p, label, prob = TX.heuristic_score(F.col("m"))
    got = [(r[0], round(r[1], 6)) for r in df.select(label, prob).collect()]
    assert got == [("Malignant", 0.5), ("Benign", 0.574443), ("Malignant", 0.95)]


def test_h11_redundancy(spark):
    corr = {("p", "q"): 0.95, ("p", "r"): 0.1, ("q", "r"): 0.0}
    sel, rem = SL.greedy_select(spark, [("p", 3.0), ("q", 2.0), ("r", 1.0)], corr, 0.9)
    assert [r["feature"] for r in sel.orderBy("rank").collect()] == ["p", "r"]
    assert [(r["feature"], r["correlated_with"]) for r in rem.collect()] == [("q", "p")]


def test_precaution_last_wins(spark):
    df = spark.createDataFrame([(" Flu ", "rest", " ", "water", None, 1), ("flu", "sleep", None, None, None, 2),
                                ("Cold  Sore", "ice", "", None, None, 3)],
                               "Disease string, P1 string, P2 string, P3 string, P4 string, o int")
    m = {r["key"]: r["values"] for r in IO.precaution_mapping(df, "Disease", ["P1", "P2", "P3", "P4"], "o").collect()}
    assert m == {"flu": ["sleep"], "cold sore": ["ice"]}
    preds = spark.createDataFrame([("FLU",), ("unknown",)], "d string")
    got = {r["d"]: r["values"] for r in IO.lookup_values(preds, "d", IO.precaution_mapping(
        df, "Disease", ["P1", "P2", "P3", "P4"], "o")).collect()}
    assert got == {"FLU": ["sleep"], "unknown": []}


def test_prefix_sums_with_hot_key(spark):
    df = spark.range(0, 5000).select((F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 3)).alias("k"),
                                     F.col("id"), (F.col("id") % 7).cast("double").alias("v"))
    a = prefix_sum(ordered_index(df, ["k"], ["id"], "idx", num_partitions=6), ["k"], ["id"], "v", "run",
                   inclusive=False, num_partitions=6)
    w = Window.partitionBy("k").orderBy("id")
    b = df.select("id", F.row_number().over(w).alias("idx2"),
                  F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("run2"))
    j = a.join(b, "id")
    assert j.count() == 5000
    assert j.where((F.col("idx") != F.col("idx2")) | (F.abs(F.col("run") - F.col("run2")) > 1e-9)).count() == 0


def test_quantile_refinement_equals_exact(spark):
    df = spark.range(0, 20000).select(((F.col("id") * 7919) % 10007 / 3.0).alias("x"),
                                      F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("y"),
                                      (F.col("id") % 2).cast("double").alias("two"), F.lit(7).alias("one"))
    probs = [0, 0.1, 1 / 3, 0.4999, 0.5, 2 / 3, 0.99, 1]
    cols = ["x", "y", "two", "one"]
    want = df.agg(*[F.percentile(c, F.array(*map(F.lit, probs))).alias(c) for c in cols]).first()
    for options in ({}, {"accuracy": 50, "cells": 25, "read_rows": 30}):
        got = exact_quantiles(df, cols, probs, **options)
        for c in cols:
            assert all(math.isclose(u, v, rel_tol=0, abs_tol=1e-9) for u, v in zip(got[c], want[c], strict=True))
    assert exact_quantiles(df.where("1 = 0"), ["x"], [0.5]) == {"x": [None]}


def test_bracket_that_misses_its_rank_widens(spark):
    from minelake.operators import quantiles as Q

    df = spark.range(0, 1000).select(F.col("id").cast("double").alias("x"))
    wanted = {(0, 700): (10.0, 20.0), (0, 5): (300.0, 400.0), (0, 15): (10.0, 20.0)}
    assert Q._ranked(df, wanted, [F.col("x")], {0: (0.0, 999.0)}, 50, 20, 30) == {(0, 700): 700.0, (0, 5): 5.0, (0, 15): 15.0}


def test_stratified_split_counts(spark):
    df = spark.range(0, 1000).select("id", F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("y"))
    s = {(r["y"], r["split"]): r["count"] for r in M.stratified_split(df, "y", "id", 0.2).groupBy("y", "split").count().collect()}
    assert s == {("a", "test"): 160, ("a", "train"): 640, ("b", "test"): 40, ("b", "train"): 160}


def test_io_round_trip(spark):
    d = tempfile.mkdtemp(prefix="minelake-io-")
    df = spark.createDataFrame([(["a", "b"], 0.5, "x"), (["c", "d", "e"], None, "y"), (["z"], 0.9, "y")],
                               "itemset array<string>, support double, disease string")
    IO.write_table(df, os.path.join(d, "p"), partition_by=["disease"])
    back = spark.read.parquet(os.path.join(d, "p"))
    assert back.count() == 3
    IO.write_table(df, os.path.join(d, "c"), fmt="csv")
    csv = IO.read_csv(spark, os.path.join(d, "c"), "itemset string, support double, disease string")
    assert sorted(r["itemset"] for r in csv.collect()) == ["a,b", "c,d,e", "z"]
    its = IO.read_itemsets(back)
    assert sorted((tuple(r["items"]), r["support"]) for r in its.collect()) == [(("a", "b"), 0.5), (("c", "d", "e"), 0.0)]


def test_model_save_load(spark):
    from minelake.operators import models as ML

    rows = [(i, float(i % 7), float((i * 3) % 5), "M" if i % 7 > 3 else "B") for i in range(200)]
    df = spark.createDataFrame(rows, "rid long, f1 double, f2 double, y string")
    model, res, classes = ML.grid_search(df, ["f1", "f2"], "y", "rid", "M", n_estimators=(5,), max_depth=(3,),
                                         min_samples_split=(2,), folds=2, parallelism=1)
    assert res.count() == 1 and classes == ["B", "M"]
    d = tempfile.mkdtemp(prefix="minelake-model-")
    IO.save_model(model, d, ["f1", "f2"], {"f1": 0.9})
    m2, feats = IO.load_model(d, ["f1", "f2"])
    assert feats == ["f1", "f2"]
    with pytest.raises(ValueError):
        IO.load_model(d, ["f2", "f1"])
    p = ML.predict(m2, df, feats, classes)
    assert p.where(F.col("predicted") == F.col("y")).count() > 150


def test_measurement_last_match_wins(spark):
    df = spark.createDataFrame([("radius 1.5; area 3; radius 2.5",), ("size 4, diameter 10, radius 1",)], "t string")
    m = [dict(r[0]) for r in df.select(TX.standardise_measurements(TX.extract_measurements(F.col("t")))).collect()]
    assert m[0] == {"radius": 2.5, "area": 3.0}
    assert m[1] == {"radius": 4.0}  # size beats diameter beats radius (name order)


def test_containment_by_masks(spark):
    from minelake.operators import containment as C

    rows = [(g, sorted({f"i{(g * 7 + j * 3) % 150:03d}" for j in range(2 + g % 90)})) for g in range(60)] + [(60, []), (61, ["zz"]), (None, ["i000", "i003"])]
    groups = spark.createDataFrame(rows, "gid int, items array<string>")
    its = {tuple(sorted({f"i{(i * 5 + j * 3) % 150:03d}" for j in range(1 + i % 4)})): 1.0 / (1 + i % 17) for i in range(400)}
    itemsets = spark.createDataFrame([(list(k), v) for k, v in its.items()], "items array<string>, support double")
    held = {g: sorted((-v, ",".join(k)) for k, v in its.items() if set(k) <= set(x)) for g, x in rows}
    pairs = C.contained_pairs(itemsets, groups, "gid")
    assert Counter((r["gid"], ",".join(r["items"])) for r in pairs.collect()) == Counter((g, t) for g, hs in held.items() for _, t in hs)
    assert {r["gid"]: r["n_itemsets"] for r in C.contained_counts(itemsets, groups, "gid").collect()} == {g: len(hs) for g, hs in held.items()}
    want = sorted((str(g), t, i + 1) for g, hs in held.items() for i, (_, t) in enumerate(hs[:3]))
    for options in ({}, {"chunk": 40, "batch": 4}, {"chunk": 7, "batch": 64}):  # one chunk, and groups that go on to later ones
        top = C.top_contained_per_group(itemsets, groups, "gid", 3, **options)
        assert sorted((str(r["gid"]), ",".join(r["items"]), r["rank"]) for r in top.collect()) == want
    none = itemsets.where("1 = 0")
    assert C.contained_pairs(none, groups, "gid").count() == 0 and C.top_contained_per_group(none, groups, "gid").count() == 0
    assert {r["n_itemsets"] for r in C.contained_counts(none, groups, "gid").collect()} == {0}
    assert C.top_contained_per_group(itemsets, groups.where("1 = 0"), "gid").count() == 0


def test_tumour_rules_read_every_row(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    rows = [(1, 1, 7, 7, 40.0, 900.0, 0.05, 0.02, "N", "O"), (1, 2, 7, 7, 3.0, 100.0, 0.01, 0.06, "A", "F"),
            (2, 1, 7, 7, 30.0, 150000.0, 0.1, 0.08, "N", "F"), (2, 1, 7, 7, 20.0, 30000.0, 0.07, 0.0, "R", "O"),
            (2, 1, 7, 7, 20.0, 30000.0, 0.07, 0.0, "R", "O")]
    d = tempfile.mkdtemp(prefix="minelake-tumour-")
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
                          ).coalesce(1).write.parquet(os.path.join(d, "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{d}/lineitem.parquet/*.parquet'")
    for name in ("risk_flags", "heuristic_score"):
        got = entry.queries()[name](spark, d)
        every = entry.oracle_sql()[name]
        key = lambda rs: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rs)
        cols = ", ".join(got.columns)
        assert key(got.collect()) == key(con.execute(f"SELECT {cols} FROM ({every})").fetchall())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_tumour_predict_scores_every_row(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    want = spark.read.parquet(f"{sf}/lineitem.parquet").select(*keys)
    got = entry.queries()["tumour_predict"](spark, sf).select(*keys)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_kv_fallback_attached_units(spark):
    cases = [("lesion size: 12.5mm", {"lesion_size": 12.5}), ("density: 0.25g", {"density": 0.25}), ("dose: 1.5e3", {"dose": 1.5}),
             ("lesion size: 12mm", {"lesion_size": 12.0}), ("lesion size=3cm", {"lesion_size": 3.0}), ("shift = -.5mm", {"shift": -0.5}),
             ("radius mean 12.5mm", {"radius_mean": 12.5}), ("area_worst 7cm", {"area_worst": 7.0}), ("lesion size 12.5mm", {}),
             ("dose 1.5e3", {}), ("lesion size 12mm", {}), ("lesion size 12.5 mm", {"size": 12.5}), ("depth 4.25, width 3.", {"depth": 4.25, "width": 3.0}),
             ("lesion size: 12mm 40 area 10", {"lesion_size": 12.0, "area": 10.0}), ("density: 0.25g, depth: 2", {"density": 0.25, "depth": 2.0})]
    df = spark.createDataFrame([(i, t) for i, (t, _m) in enumerate(cases)], "i int, t string")
    got = {r["i"]: dict(r["m"]) for r in df.select("i", TX.kv_fallback(F.col("t")).alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [m for _t, m in cases]


def test_quantiles_of_non_finite_values(spark):
    x = F.when(F.col("id") % 50 == 0, float("inf")).when(F.col("id") % 50 == 1, float("-inf")).when(F.col("id") % 50 == 2, float("nan"))
    df = spark.range(0, 2000).select(x.otherwise(F.col("id") / 7).alias("x"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("y"),
                                     F.lit(None).cast("double").alias("z"))
    probs = [0, 0.013, 0.1, 1 / 3, 0.5, 0.77, 0.96, 0.99, 1]
    want = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, probs))).alias(c) for c in "xyz"]).first()
    same = lambda a, b: a == b or (a is not None and math.isnan(a) and math.isnan(b))
    for options in ({}, {"accuracy": 50, "cells": 25, "read_rows": 30}):
        got = exact_quantiles(df, ["x", "y", "z"], probs, **options)
        for c in "xyz":
            assert all(same(u, v) for u, v in zip(got[c], want[c] or [None] * len(probs), strict=True))


def brute_lloyd(values, n_bins):
    """Plain Lloyd from the equal-width centres: nearest centre, ties to the smaller."""
    low, high = min(values), max(values)
    step = (high - low) / n_bins
    edges = [low + k * step for k in range(n_bins)] + [high]
    centres = [(a + b) / 2 for a, b in zip(edges[:-1], edges[1:], strict=True)]
    mean = sum(values) / len(values)
    limit = 1e-4 * sum((v - mean) ** 2 for v in values) / len(values)
    for _ in range(300):
        groups = [[] for _ in centres]
        for v in values:
            groups[min(range(n_bins), key=lambda j: (abs(v - centres[j]), j))].append(v)
        new = [sum(g) / len(g) if g else c for g, c in zip(groups, centres, strict=True)]
        shift = sum((a - b) ** 2 for a, b in zip(new, centres, strict=True))
        centres = new
        if shift <= limit:
            break
    return sorted(centres)


def test_kmeans_bins_against_plain_lloyd(spark):
    from minelake.operators import bins as BN
    from minelake.operators.lloyd1d import lloyd_1d

    rows = [(k, float((k * k * 37) % 1009) / 8, 2.0 ** (k % 20), None if k % 5 else float(k % 3)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    for n in (3, 5):
        edges = BN.fit_kmeans(df, ["a", "b", "c"], n)
        for i, c in enumerate(["a", "b", "c"], 1):
            values = [r[i] for r in rows if r[i] is not None]
            centres = brute_lloyd(values, n)
            mids = [(x + y) / 2 for x, y in zip(centres[:-1], centres[1:], strict=True)]
            want = BN._drop_close([min(values), *[round(m, 9) for m in mids], max(values)])
            assert all(math.isclose(x, y, abs_tol=1e-6) for x, y in zip(edges[c], want, strict=True))
    # the cells only save reading: few and many give the same centres
    start = {"a": [10.0, 60.0, 110.0]}
    few, many = (lloyd_1d(df, ["a"], start, cells=k)["a"] for k in (2, 500))
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(few, many, strict=True))


def test_bins_of_empty_and_non_finite_columns(spark):
    from minelake.operators import bins as BN

    rows = [(float(k), None, float("inf") if k == 3 else float("-inf") if k == 4 else float("nan") if k == 5 else float(k), 7.0) for k in range(12)]
    df = spark.createDataFrame(rows, "x double, none double, odd double, same double")
    cols = ["x", "none", "odd", "same"]
    for strategy in ("uniform", "quantile", "kmeans"):
        edges = BN.fit_bins(df, cols, 3, strategy)
        assert edges["none"] == [] and BN.fit_bins(df.where("1 = 0"), cols, 3, strategy) == {c: [] for c in cols}
        out = BN.apply_bins(df, edges, "_bin").collect()
        assert {r["none_bin"] for r in out} == {None} and {r["same_bin"] for r in out} == {0}
        assert [r["x_bin"] for r in sorted(out, key=lambda r: r["x"])] == [0] * 4 + [1] * 4 + [2] * 4
        odd = {k: r["odd_bin"] for k, r in enumerate(sorted(out, key=lambda r: r["x"]))}
        assert odd[4] == 0 and odd[3] == odd[5] == len(edges["odd"]) - 2
        if strategy != "quantile":  # fitted on the finite values
            assert edges["odd"][0] == 0 and edges["odd"][-1] == 11


def test_short_patterns_equal_prefixspan(spark):
    from minelake.operators import contrast as CT

    rows = [(("a", "b")[k % 2], [[x] for x in ("p", "q", "r", "p", "s")[k % 3:2 + k % 4]]) for k in range(200)] + [("a", []), (None, [["p"]]), ("c", [["p"]])]
    df = spark.createDataFrame(rows, "y string, sequence array<array<string>>")
    key = lambda d: sorted((r["class"], str(r["pattern"]), r["freq"], round(r["support"], 9), r["level"], r["n_itemsets"]) for r in d.collect())
    for support, length in ((0.05, 5), (0.2, 2)):
        want = CT.mine_by_class(df, "y", ["a", "b"], min_support=support, max_len=length)
        got = CT.mine_by_class(df, "y", ["a", "b"], min_support=support, max_len=length, longest=5)
        assert key(got) == key(want) and got.count() > 3
    assert CT.mine_by_class(df.where("1 = 0"), "y", ["a"], longest=5).count() == 0
