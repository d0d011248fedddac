"""H1 term cleaning, H2 itemsets and rules (FIXTURES.md)."""

import math

from pyspark.sql import functions as F

from minelake.functions.terms import clean_term, feature_name, normalise_term
from minelake.operators import baskets as B
from minelake.operators import itemsets as I


def test_h1_cleaning(spark):
    rows = [(" dischromic _patches",), ("Belly_Pain",), ("stomach_ache",), ("Foo-Bar_x",), (None,)]
    df = spark.createDataFrame(rows, "raw string")
    out = df.select(clean_term("raw").alias("c"), normalise_term("raw").alias("n"),
                    feature_name("raw").alias("f")).collect()
    assert [tuple(r) for r in out] == [
        ("dischromic  patches", "dischromic patches", "dischromic_patches"),
        ("Belly Pain", "abdominal pain", "abdominal_pain"),
        ("stomach ache", "stomach pain", "stomach_pain"),
        ("Foo-Bar x", "Foo-Bar x", "foo_bar_x"),
        ("", "", ""),
    ]


def test_unpivot_and_baskets(spark):
    df = spark.createDataFrame([("d1", "itch", "fever", None), ("d1", "chill", " ", "itch"), ("d2", "b", "a", "b")],
                               "Disease string, Symptom_1 string, Symptom_2 string, Symptom_3 string")
    cols = B.item_columns(df)
    assert cols == ["Symptom_1", "Symptom_2", "Symptom_3"]
    long = B.unpivot_items(df, "Disease", cols)
    g = {r["Disease"]: r["items"] for r in B.group_baskets(long, "Disease").collect()}
    assert g == {"d1": ["chills", "high fever", "itching"], "d2": ["a", "b"]}


def _baskets(spark):
    return spark.createDataFrame([(["a", "b", "c"],), (["a", "b", "c"],), (["a", "b"],), (["c"],)], "items array<string>")


def test_h2_itemsets(spark):
    its = {",".join(r["items"]): r["support"] for r in I.mine_itemsets(_baskets(spark), min_support=0.25).collect()}
    assert its == {"a": 0.75, "b": 0.75, "c": 0.75, "a,b": 0.75, "a,c": 0.5, "b,c": 0.5, "a,b,c": 0.5}


def test_h2_rules(spark):
    its = I.mine_itemsets(_baskets(spark), min_support=0.25)
    rules = I.association_rules(its, "confidence", 0.0)
    got = {(",".join(r["antecedents"]), ",".join(r["consequents"])): r for r in rules.collect()}
    r = got[("a", "b,c")]
    assert (round(r["support"], 4), round(r["confidence"], 4), round(r["lift"], 4), round(r["leverage"], 4),
            round(r["conviction"], 4), round(r["zhangs_metric"], 4), round(r["kulczynski"], 4)) == \
        (0.5, 0.6667, 1.3333, 0.125, 1.5, 1.0, 0.8333)
    r = got[("a", "b")]
    assert r["confidence"] == 1.0 and math.isinf(r["conviction"]) and round(r["lift"], 4) == 1.3333
    r = got[("c", "a")]
    assert (round(r["lift"], 4), round(r["leverage"], 4), round(r["conviction"], 4),
            round(r["zhangs_metric"], 4)) == (0.8889, -0.0625, 0.75, -0.3333)
    # every split of the triple is there (multi-item consequents)
    assert sum(1 for k in got if sorted((k[0] + "," + k[1]).split(",")) == ["a", "b", "c"]) == 6
