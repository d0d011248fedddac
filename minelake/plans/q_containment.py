"""Catalogue: itemset -> group containment reports.

Itemsets: brand triples mined from order baskets. Groups: customers, whose
basket is every brand they bought (partial coverage, so counts vary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import baskets as B
from ..operators import containment as C
from ..operators import itemsets as I
from .joins import shared_table
from .registry import joined, query, r6, read

BRAND_MIN_SUPPORT = 0.001
EXPORT_MIN_SUPPORT = 0.002


def _brand_long(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = read(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand")


def brand_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    long = _brand_long(spark, sf).select(F.col("l_orderkey").alias("basket_id"),
                                         F.col("p_brand").alias("item"))
    return I.mine_itemsets(B.group_baskets(long, "basket_id"), min_support=BRAND_MIN_SUPPORT,
                           max_size=3)


def customer_profiles(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    long = _brand_long(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return B.group_baskets(long.select(F.col("o_custkey").alias("custkey"), F.col("p_brand").alias("item")),
                           "custkey")


_BASE = f"""
WITH ob AS (SELECT DISTINCT l.l_orderkey AS bid, p.p_brand AS item
            FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT count(DISTINCT bid) AS n FROM ob),
tri AS (SELECT a.item || ',' || b.item || ',' || c.item AS items, a.item AS i1, b.item AS i2, c.item AS i3,
               count(*) / (SELECT n FROM n) AS support
        FROM ob a JOIN ob b ON a.bid = b.bid AND a.item < b.item JOIN ob c ON c.bid = a.bid AND b.item < c.item
        GROUP BY a.item, b.item, c.item HAVING count(*) / (SELECT n FROM n) >= {BRAND_MIN_SUPPORT}),
cp AS (SELECT DISTINCT o.o_custkey AS custkey, p.p_brand AS item
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey),
pairs AS (SELECT t.items, t.support, x.custkey FROM tri t
          JOIN cp x ON x.item = t.i1 JOIN cp y ON y.custkey = x.custkey AND y.item = t.i2
          JOIN cp z ON z.custkey = x.custkey AND z.item = t.i3),
top10 AS (SELECT items FROM tri ORDER BY support DESC, items LIMIT 10),
top20 AS (SELECT items FROM tri ORDER BY support DESC, items LIMIT 20),
cov AS (SELECT c.custkey, CAST(count(p.items) AS BIGINT) AS n_itemsets
        FROM (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) c
        LEFT JOIN (SELECT * FROM pairs WHERE items IN (SELECT items FROM top20)) p ON p.custkey = c.custkey
        GROUP BY c.custkey)
"""


def _top(its: DataFrame, n: int) -> DataFrame:
    return I.top_itemsets(its, 3, n)


@query("itemset_groups", _BASE + """
SELECT items, round(support, 6) AS support, custkey FROM pairs WHERE items IN (SELECT items FROM top10)
""")
def itemset_groups(spark: SparkSession, sf: str) -> DataFrame:
    """JON4: customers holding each of the top-10 brand triples."""
    pairs = C.contained_pairs(_top(brand_itemsets(spark, sf), 10), customer_profiles(spark, sf), "custkey")
    return pairs.select(joined("items").alias("items"), r6("support").alias("support"), "custkey")


def _coverage(spark: SparkSession, sf: str) -> DataFrame:
    return C.contained_counts(_top(brand_itemsets(spark, sf), 20), customer_profiles(spark, sf), "custkey")


@query("coverage_counts", _BASE + "SELECT custkey, n_itemsets FROM cov")
def coverage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """AGG9: how many of the top-20 triples each customer holds (zeros kept)."""
    return _coverage(spark, sf)


@query("coverage_summary", _BASE + """
SELECT CAST(count(*) FILTER (WHERE n_itemsets >= 5) AS BIGINT) AS n_groups_ge_5,
       CAST(max(n_itemsets) AS BIGINT) AS max_itemsets, round(avg(n_itemsets), 6) AS avg_itemsets FROM cov
""")
def coverage_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG10/MIN20: groups with >= 5 of the top-20, and the spread."""
    return C.groups_with_at_least(_coverage(spark, sf), 5).withColumn("avg_itemsets", r6("avg_itemsets"))


@query("presence_matrix", _BASE + """,
topg AS (SELECT custkey FROM cov ORDER BY n_itemsets DESC, custkey LIMIT 10)
SELECT t.items AS itemset, CAST(g.custkey AS VARCHAR) AS custkey,
       CAST(CASE WHEN p.custkey IS NULL THEN 0 ELSE 1 END AS INTEGER) AS present
FROM top10 t JOIN topg g ON TRUE
LEFT JOIN pairs p ON p.items = t.items AND p.custkey = g.custkey
""")
def presence_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """JON5: top-10 triples x top-10 customers by coverage, pivoted, as long rows."""
    top20 = shared_table(_top(brand_itemsets(spark, sf), 20), "top-itemsets")
    pairs = shared_table(C.contained_pairs(top20, customer_profiles(spark, sf), "custkey").select("custkey", "items"), "pairs")
    most = pairs.groupBy("custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "custkey").limit(10).collect()
    top_groups, top10 = [r["custkey"] for r in most], _top(top20, 10)
    grid = C.presence_matrix(pairs, top10, "custkey", top_groups)
    long = C.pivot_to_long(grid, "itemset", "present", "custkey")
    return long.select("itemset", "custkey", F.col("present").cast("int").alias("present"))


@query("top3_per_group", _BASE + f"""
SELECT items, round(support, 6) AS support, custkey, CAST(rank AS INTEGER) AS rank FROM (
  SELECT p.*, row_number() OVER (PARTITION BY custkey ORDER BY support DESC, items) AS rank
  FROM pairs p WHERE support > {EXPORT_MIN_SUPPORT}) WHERE rank <= 3
""")
def top3_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """MIN18/WIN1: triples above a support, mapped to customers, top 3 each."""
    out = C.export_group_itemsets(brand_itemsets(spark, sf), customer_profiles(spark, sf), "custkey",
                                  size=3, min_support=EXPORT_MIN_SUPPORT, k=3)
    return out.select(joined("items").alias("items"), r6("support").alias("support"), "custkey",
                      F.col("rank").cast("int").alias("rank"))


@query("itemsets_per_group_top15", _BASE + f"""
SELECT custkey, CAST(count(*) AS BIGINT) AS n_itemsets FROM pairs WHERE support > {EXPORT_MIN_SUPPORT}
GROUP BY custkey ORDER BY n_itemsets DESC, custkey LIMIT 15
""")
def itemsets_per_group_top15(spark: SparkSession, sf: str) -> DataFrame:
    """AGG11: itemsets per group before the top-3 cut, top 15 groups."""
    its = brand_itemsets(spark, sf).where((F.col("size") == 3) & (F.col("support") > EXPORT_MIN_SUPPORT))
    counts = C.contained_counts(its, customer_profiles(spark, sf), "custkey")
    return counts.where("n_itemsets > 0").orderBy(F.desc("n_itemsets"), "custkey").limit(15)


@query("group_report_top10", _BASE + """,
nb AS (SELECT custkey, count(*) AS n_items FROM cp GROUP BY 1),
lead AS (SELECT custkey, n_itemsets, row_number() OVER (ORDER BY n_itemsets DESC, custkey) AS group_rank FROM cov),
det AS (SELECT custkey, items, support, row_number() OVER (PARTITION BY custkey ORDER BY support DESC, items) AS rank
        FROM pairs WHERE items IN (SELECT items FROM top20))
SELECT CAST(group_rank AS INTEGER) AS group_rank, lead.custkey, n_itemsets, CAST(n_items AS BIGINT) AS n_items,
       CAST(rank AS INTEGER) AS rank, items, round(support, 6) AS support
FROM lead JOIN nb ON nb.custkey = lead.custkey LEFT JOIN det ON det.custkey = lead.custkey AND rank <= 3
WHERE group_rank <= 10""")
def group_report_top10(spark: SparkSession, sf: str) -> DataFrame:
    """MIN19/WIN2: the ten customers holding most of the top-20 triples, the size of
    their baskets and their three best triples."""
    profiles = shared_table(customer_profiles(spark, sf), "profiles")
    top20 = shared_table(_top(brand_itemsets(spark, sf), 20), "top-itemsets")
    counts = C.contained_counts(top20, profiles, "custkey")
    sizes = profiles.select("custkey", F.size("items").cast("long").alias("n_items"))
    ten = shared_table(counts.orderBy(F.desc("n_itemsets"), "custkey").limit(10), "ten")
    pairs = C.contained_pairs(top20, profiles.join(F.broadcast(ten.select("custkey")), "custkey"), "custkey")
    pairs = pairs.select("custkey", joined("items").alias("items"), "support")
    ten = ten.withColumn("group_rank", F.row_number().over(Window.orderBy(F.desc("n_itemsets"), "custkey")))
    best = Window.partitionBy("custkey").orderBy(F.desc("support"), "items")
    detail = pairs.withColumn("rank", F.row_number().over(best)).where("rank <= 3")
    return (ten.join(sizes, "custkey").join(detail, "custkey", "left")
            .select(F.col("group_rank").cast("int").alias("group_rank"), "custkey", "n_itemsets", "n_items",
                    F.col("rank").cast("int").alias("rank"), "items", r6("support").alias("support")))


JOIN_MIN_SUPPORT = 0.015


@query("itemset_join", _BASE + f""",
pr AS (SELECT a.item AS i, b.item AS j FROM ob a JOIN ob b ON a.bid = b.bid AND a.item < b.item
       GROUP BY 1, 2 HAVING count(*) / (SELECT n FROM n) >= {JOIN_MIN_SUPPORT}),
un AS (SELECT DISTINCT list_sort(list_distinct([x.i, x.j, y.i, y.j])) AS s FROM pr x JOIN pr y ON (x.i, x.j) < (y.i, y.j) WHERE len(list_distinct([x.i, x.j, y.i, y.j])) = 3)
SELECT array_to_string(s, ',') AS items FROM un""")
def itemset_join(spark: SparkSession, sf: str) -> DataFrame:
    """SET6/JON11: unions of two frequent brand pairs that differ in one brand each."""
    its = brand_itemsets(spark, sf)
    pairs = its.where((F.col("size") == 2) & (F.col("support") >= JOIN_MIN_SUPPORT))
    return I.itemset_join(pairs).select(joined("items").alias("items"))
