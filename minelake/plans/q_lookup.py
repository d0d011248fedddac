"""Catalogue: lookups (precautions, hygiene anti-joins) and follow-up suggestions.

Lookup stand-in: nation names play the disease names. The "descriptions"
table is ``nation``; the "precautions" table is built from the suppliers
(their first four names per nation), keyed by the nation name written in
varying case and spacing, misspelt for some nations, with a second, later row
for some nations (the later row wins). Predictions to look up: each customer's nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.terms import normalise_disease
from ..operators import suggest as SG
from ..sources import io as IO
from . import q_containment as QC
from .registry import joined, query, r6, read


def precaution_table(spark: SparkSession, sf: str) -> DataFrame:
    """Wide (Disease, Precaution_1..4, row_order) table derived from supplier."""
    first = Window.partitionBy("s_nationkey").orderBy("s_suppkey")  # four rows a nation leave each map task
    sup = read(spark, sf, "supplier").withColumn("k", F.row_number().over(first)).where("k <= 4")
    nat = read(spark, sf, "nation")
    names = (sup.groupBy("s_nationkey")
             .agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("s")))
    j = names.join(nat, names.s_nationkey == nat.n_nationkey)
    key = (F.when(F.col("n_nationkey") % 7 == 6, F.concat(F.col("n_name"), F.lit(" x")))
           .when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit(" "), F.upper("n_name"), F.lit("  ")))
           .when(F.col("n_nationkey") % 3 == 1, F.lower("n_name")).otherwise(F.col("n_name")))
    base = j.select(key.alias("Disease"), *[F.try_element_at("s", F.lit(i))["s_name"].alias(f"Precaution_{i}") for i in range(1, 5)],
                    (F.col("n_nationkey") * 10).alias("row_order"), "n_nationkey")
    # a later duplicate row for every fifth nation: precautions in reverse order
    dup = (j.where(F.col("n_nationkey") % 5 == 0)
           .select(F.col("n_name").alias("Disease"),
                   *[F.try_element_at("s", F.lit(5 - i))["s_name"].alias(f"Precaution_{i}") for i in range(1, 5)],
                   (F.col("n_nationkey") * 10 + 1).alias("row_order"), "n_nationkey"))
    return base.unionByName(dup)


_PREC_SQL = r"""
WITH s AS (SELECT s_nationkey, list(s_name ORDER BY s_suppkey) AS names FROM supplier GROUP BY 1),
j AS (SELECT * FROM s JOIN nation n ON n.n_nationkey = s.s_nationkey),
pt AS (SELECT CASE WHEN n_nationkey % 7 = 6 THEN n_name || ' x' WHEN n_nationkey % 3 = 0 THEN ' ' || upper(n_name) || '  '
                   WHEN n_nationkey % 3 = 1 THEN lower(n_name) ELSE n_name END AS disease,
              [names[1], names[2], names[3], names[4]] AS vals, n_nationkey * 10 AS row_order FROM j
       UNION ALL
       SELECT n_name, [names[4], names[3], names[2], names[1]], n_nationkey * 10 + 1 FROM j WHERE n_nationkey % 5 = 0),
pm0 AS (SELECT regexp_replace(lower(regexp_replace(disease, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') AS key,
               list_filter(list_transform(vals, lambda x: coalesce(regexp_replace(x, '^\s+|\s+$', '', 'g'), '')), lambda x: x <> '') AS vals,
               row_order FROM pt),
pm AS (SELECT key, arg_max(vals, row_order) AS vals FROM pm0 GROUP BY key)
"""


@query("precaution_join", _PREC_SQL + r"""
SELECT c.c_custkey, n.n_name AS disease, array_to_string(coalesce(pm.vals, []), ';') AS precautions,
       CAST(len(coalesce(pm.vals, [])) AS INTEGER) AS n_precautions
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN pm ON pm.key = regexp_replace(lower(regexp_replace(n.n_name, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g')""")
def precaution_join(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4 + JON3: precautions for each customer's nation; missing -> empty."""
    mapping = IO.precaution_mapping(precaution_table(spark, sf), "Disease",
                                    [f"Precaution_{i}" for i in range(1, 5)], order_col="row_order")
    cust = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nat = read(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("disease"))
    preds = cust.join(nat, cust.c_nationkey == nat.n_nationkey).select("c_custkey", "disease")
    res = IO.lookup_values(preds, "disease", mapping, "precautions")
    return res.select("c_custkey", "disease", F.array_join("precautions", ";").alias("precautions"),
                      F.size("precautions").alias("n_precautions"))


@query("lookup_antijoin", _PREC_SQL + r"""
, d AS (SELECT DISTINCT regexp_replace(lower(regexp_replace(n_name, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') AS key FROM nation)
SELECT key, 'descriptions_only' AS side FROM d WHERE key NOT IN (SELECT key FROM pm)
UNION ALL SELECT key, 'precautions_only' FROM pm WHERE key NOT IN (SELECT key FROM d)""")
def lookup_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    """H12 hygiene: normalised keys present in one lookup but not the other."""
    mapping = IO.precaution_mapping(precaution_table(spark, sf), "Disease",
                                    [f"Precaution_{i}" for i in range(1, 5)], order_col="row_order")
    desc = read(spark, sf, "nation").select(normalise_disease(F.col("n_name")).alias("key")).distinct()
    a = desc.join(mapping.select("key"), "key", "left_anti").withColumn("side", F.lit("descriptions_only"))
    b = mapping.select("key").join(desc, "key", "left_anti").withColumn("side", F.lit("precautions_only"))
    return a.unionByName(b)


# ------------------------------------------------------------------ suggestions

def suggestion_records(spark: SparkSession, sf: str) -> DataFrame:
    """MIN18 export (top-3 brand triples per customer) as suggestion records;
    record order = export order (customer, then support desc, items)."""
    exp = QC.C.export_group_itemsets(QC.brand_itemsets(spark, sf), QC.customer_profiles(spark, sf), "custkey",
                                     size=3, min_support=QC.EXPORT_MIN_SUPPORT, k=3)
    return exp.select("items", "support", F.col("custkey").cast("string").alias("group"),
                      (F.col("custkey") * 10 + F.col("rank")).alias("rec_order"))


@query("followup_suggestions", QC._BASE + f""",
ex AS (SELECT items, i1, i2, i3, support, custkey, row_number() OVER (PARTITION BY custkey ORDER BY support DESC, items) AS rk
       FROM pairs p JOIN tri USING (items, support) WHERE support > {QC.EXPORT_MIN_SUPPORT}),
rec0 AS (SELECT items, i1, i2, i3, support, custkey, custkey * 10 + rk AS rec_order FROM ex WHERE rk <= 3),
rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY items ORDER BY support DESC, rec_order) AS r FROM rec0) WHERE r = 1),
ri AS (SELECT items, support, custkey, rec_order, unnest([i1, i2, i3]) AS item, [i1, i2, i3] AS arr FROM rec),
q AS (SELECT DISTINCT l.l_orderkey AS qid, p.p_brand AS item FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
qn AS (SELECT qid, count(*) AS n_known FROM q GROUP BY qid),
pr AS (SELECT DISTINCT q.qid, ri.rec_order FROM q JOIN ri ON ri.item = q.item),
cand AS (SELECT pr.qid, ri.support, ri.custkey, ri.rec_order, ri.item AS candidate
         FROM pr JOIN ri ON ri.rec_order = pr.rec_order
         WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.qid = pr.qid AND q.item = ri.item)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, candidate ORDER BY support DESC, rec_order) AS r FROM cand) WHERE r = 1),
trig AS (SELECT pr.qid, pr.rec_order, string_agg(ri.item, ',' ORDER BY ri.item) AS trigger
         FROM pr JOIN ri ON ri.rec_order = pr.rec_order JOIN q ON q.qid = pr.qid AND q.item = ri.item GROUP BY 1, 2),
rk AS (SELECT best.*, qn.n_known, row_number() OVER (PARTITION BY best.qid ORDER BY support DESC, candidate) AS rank
       FROM best JOIN qn USING (qid))
SELECT rk.qid AS basket_id, CAST(rank AS INTEGER) AS rank, candidate, replace(candidate, '_', ' ') AS display_name, round(support, 6) AS support,
       CAST(custkey AS VARCHAR) AS "group", trig.trigger
FROM rk JOIN trig ON trig.qid = rk.qid AND trig.rec_order = rk.rec_order
WHERE rank <= greatest(3, 5 - n_known + 2)""")
def followup_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    """MIN13/JON12/WIN4/SRT7: suggestions for every order's brand set from the
    per-customer brand triples."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = read(spark, sf, "part").select("p_partkey", "p_brand")
    queries = (li.join(part, li.l_partkey == part.p_partkey)
               .groupBy(F.col("l_orderkey").alias("basket_id"))
               .agg(F.sort_array(F.collect_set("p_brand")).alias("known")))
    s = SG.suggest(queries, "basket_id", "known", suggestion_records(spark, sf))
    return s.select("basket_id", F.col("rank").cast("int").alias("rank"), "candidate", "display_name", r6("support").alias("support"),
                    "group", F.array_join(F.array_sort("trigger"), ",").alias("trigger"))
