"""Catalogue: term cleaning, baskets, itemsets and rules on the driver tables.

Stand-ins (the reference's own data is absent): a part's name/type/brand
are its "symptom" columns; an order is a row basket of part types; a
supplier is a group basket of brands; lineitem numerics are the numeric
feature table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import clean_term, feature_name, feature_name_aliased, normalise_term
from ..operators import baskets as B
from ..operators import itemsets as I
from .registry import joined, query, r6, read

# Test parameters: a synonym map and an alias map over the part vocabulary.
# 'promo' -> 'economy' is one hop only (it does not go on to 'standard').
PART_SYNONYMS = {
    "economy": "standard",
    "promo": "economy",
    "red widget": "widget",
    "small widget": "widget",
    "hot plate": "stove",
}
PART_ALIASES = {
    "brand_1": "brand_one",
    "widget": "gadget",
    "old_rod": "rod",
}
ITEMSET_MIN_SUPPORT = 0.01


def _sql_map(mapping: dict[str, str], alias: str = "t") -> str:
    rows = ", ".join(f"('{a}', '{b}')" for a, b in mapping.items())
    return f"(VALUES {rows}) AS {alias}(k, v)"


# ------------------------------------------------------------------ shared SQL

_SQL_WS = r"'^\s+|\s+$'"


def _sql_clean(x: str) -> str:
    return f"coalesce(replace(regexp_replace({x}, {_SQL_WS}, '', 'g'), '_', ' '), '')"


def _sql_feature(x: str) -> str:
    y = f"replace(lower(regexp_replace({x}, {_SQL_WS}, '', 'g')), '-', ' ')"
    y = f"regexp_replace({y}, '[^a-z0-9\\s]', ' ', 'g')"
    y = f"regexp_replace({y}, '\\s+', '_', 'g')"
    return f"regexp_replace({y}, '^_+|_+$', '', 'g')"


_RAW_TERM = ("CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') "
             "ELSE '  ' || upper(p_name) || ' ' END")


def _raw_terms(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    raw = (F.when(F.col("p_size") % 3 == 0, F.col("p_name"))
           .when(F.col("p_size") % 3 == 1, F.replace("p_name", F.lit(" "), F.lit("_")))
           .otherwise(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))))
    return part.select("p_partkey", raw.alias("raw"))


# ------------------------------------------------------------------ clean group

_CLEAN_SQL = f"""
WITH r AS (SELECT p_partkey, {_RAW_TERM} AS raw FROM part),
c AS (SELECT p_partkey, raw, {_sql_clean('raw')} AS cleaned FROM r),
n AS (SELECT c.*, CASE WHEN cleaned = '' THEN '' ELSE coalesce(t.v, cleaned) END AS normalised
      FROM c LEFT JOIN {_sql_map(PART_SYNONYMS)} ON t.k = lower(c.cleaned))
SELECT p_partkey, raw, cleaned, normalised, {_sql_feature('normalised')} AS feature_name FROM n
"""


@query("clean_terms", _CLEAN_SQL)
def clean_terms(spark: SparkSession, sf: str) -> DataFrame:
    """FN1-FN3 on raw part terms."""
    r = _raw_terms(spark, sf)
    return r.select("p_partkey", "raw", clean_term("raw").alias("cleaned"),
                    normalise_term("raw", PART_SYNONYMS).alias("normalised"),
                    feature_name("raw", PART_SYNONYMS).alias("feature_name"))


_SYN_SQL = f"""
WITH terms AS (SELECT p_name AS raw FROM part UNION ALL SELECT p_type FROM part),
c AS (SELECT {_sql_clean('raw')} AS cleaned FROM terms)
SELECT lower(cleaned) AS raw_lower,
       CASE WHEN cleaned = '' THEN '' ELSE coalesce(t.v, cleaned) END AS normalised,
       (t.v IS NOT NULL) AS mapped, CAST(count(*) AS BIGINT) AS n_terms
FROM c LEFT JOIN {_sql_map(PART_SYNONYMS)} ON t.k = lower(c.cleaned)
GROUP BY 1, 2, 3
"""


@query("synonym_map", _SYN_SQL)
def synonym_map(spark: SparkSession, sf: str) -> DataFrame:
    """JON1 applied over the name and type vocabularies, with hit counts."""
    part = read(spark, sf, "part")
    terms = part.select(F.col("p_name").alias("raw")).unionAll(part.select("p_type"))
    from ..functions.terms import map_literal

    cleaned = clean_term("raw")
    hit = F.element_at(map_literal(PART_SYNONYMS), F.lower(cleaned))
    return (terms.select(F.lower(cleaned).alias("raw_lower"),
                         normalise_term("raw", PART_SYNONYMS).alias("normalised"),
                         hit.isNotNull().alias("mapped"))
            .groupBy("raw_lower", "normalised", "mapped")
            .agg(F.count(F.lit(1)).alias("n_terms")))


_FEAT_SQL = f"""
WITH v AS (SELECT DISTINCT p_name AS raw FROM part UNION SELECT DISTINCT p_type FROM part
           UNION SELECT DISTINCT p_brand FROM part),
n AS (SELECT raw, CASE WHEN {_sql_clean('raw')} = '' THEN '' ELSE coalesce(t.v, {_sql_clean('raw')}) END AS normalised
      FROM v LEFT JOIN {_sql_map(PART_SYNONYMS)} ON t.k = lower({_sql_clean('raw')})),
f AS (SELECT raw, {_sql_feature('normalised')} AS feature_name FROM n)
SELECT raw, feature_name, coalesce(a.v, feature_name) AS aliased
FROM f LEFT JOIN {_sql_map(PART_ALIASES, "a")} ON a.k = f.feature_name
"""


@query("feature_names", _FEAT_SQL)
def feature_names(spark: SparkSession, sf: str) -> DataFrame:
    """FN3/FN4 on the distinct part vocabulary."""
    part = read(spark, sf, "part")
    v = (part.select(F.col("p_name").alias("raw"))
         .union(part.select("p_type")).union(part.select("p_brand")).distinct())
    return v.select("raw", feature_name("raw", PART_SYNONYMS).alias("feature_name"),
                    feature_name_aliased("raw", PART_SYNONYMS, PART_ALIASES).alias("aliased"))


_UNPIVOT_SQL = f"""
WITH l AS (SELECT p_partkey, 1 AS slot, p_name AS raw FROM part UNION ALL
           SELECT p_partkey, 2, p_type FROM part UNION ALL SELECT p_partkey, 3, p_brand FROM part),
n AS (SELECT p_partkey, slot, CASE WHEN {_sql_clean('raw')} = '' THEN '' ELSE coalesce(t.v, {_sql_clean('raw')}) END AS item
      FROM l LEFT JOIN {_sql_map(PART_SYNONYMS)} ON t.k = lower({_sql_clean('raw')}))
SELECT p_partkey, CAST(slot AS INTEGER) AS slot, item FROM n WHERE item IS NOT NULL AND item <> ''
"""


@query("unpivot_items", _UNPIVOT_SQL)
def unpivot_items(spark: SparkSession, sf: str) -> DataFrame:
    """Wide part rows -> long normalised items (stack, no shuffle)."""
    part = read(spark, sf, "part")
    return B.unpivot_items(part, "p_partkey", ["p_name", "p_type", "p_brand"], PART_SYNONYMS)


# ------------------------------------------------------------------ baskets

def order_type_items(spark: SparkSession, sf: str) -> DataFrame:
    """Long (basket_id=order, slot=line number, item=part type)."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = read(spark, sf, "part").select("p_partkey", "p_type")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.col("l_orderkey").alias("basket_id"), F.col("l_linenumber").alias("slot"),
                    F.col("p_type").alias("item")))


def order_type_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return B.group_baskets(order_type_items(spark, sf), "basket_id")


_ORDER_B = ("b AS (SELECT l.l_orderkey AS bid, list_sort(list_distinct(list(p.p_type))) AS items "
            "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1)")


_GROUP_SQL = """
SELECT l.l_suppkey AS basket_id, string_agg(DISTINCT p.p_brand, ',' ORDER BY p.p_brand) AS items,
       CAST(count(DISTINCT p.p_brand) AS INTEGER) AS n_items
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
"""


@query("group_baskets", _GROUP_SQL)
def group_baskets(spark: SparkSession, sf: str) -> DataFrame:
    """AGG1: supplier -> sorted distinct brands."""
    li = read(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    part = read(spark, sf, "part").select("p_partkey", "p_brand")
    long = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_suppkey").alias("basket_id"), F.col("p_brand").alias("item"))
    b = B.group_baskets(long, "basket_id")
    return b.select("basket_id", joined("items").alias("items"), F.size("items").alias("n_items"))


_ROW_SQL = """
WITH f AS (SELECT l.l_orderkey AS bid, p.p_type AS item, min(l.l_linenumber) AS first_ln
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2)
SELECT bid AS basket_id, string_agg(item, ',' ORDER BY first_ln, item) AS items,
       CAST(count(*) AS INTEGER) AS n_items
FROM f GROUP BY 1
"""


@query("row_baskets", _ROW_SQL)
def row_baskets(spark: SparkSession, sf: str) -> DataFrame:
    """AGG2: order -> types in line order, first occurrence kept."""
    b = B.row_baskets(order_type_items(spark, sf), "basket_id", "slot")
    return b.select("basket_id", joined("items").alias("items"), F.size("items").alias("n_items"))


_STATS_SQL = f"""
WITH {_ORDER_B}
SELECT CAST(count(*) AS BIGINT) AS n_baskets, CAST(sum(len(items)) AS BIGINT) AS total_items,
       round(avg(len(items)), 6) AS avg_items, count(*) < 10 AS below_min_transactions FROM b
"""


@query("basket_stats", _STATS_SQL)
def basket_stats(spark: SparkSession, sf: str) -> DataFrame:
    """AGG4/AGG5 over order baskets."""
    s = B.basket_stats(order_type_baskets(spark, sf))
    return s.select("n_baskets", "total_items", r6("avg_items").alias("avg_items"),
                    "below_min_transactions")


_DIST_SQL = """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM lineitem GROUP BY 1
"""


@query("value_distribution", _DIST_SQL)
def value_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """AGG13: class distribution with shares."""
    d = B.value_distribution(read(spark, sf, "lineitem"), "l_returnflag")
    return d.select("l_returnflag", "n", r6("share").alias("share"))


_NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_MISS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, "
    f"round(median({c}), 6) AS median FROM lineitem" for c in _NUM_COLS)


@query("missing_median_fill", _MISS_SQL)
def missing_median_fill(spark: SparkSession, sf: str) -> DataFrame:
    """AGG14: missing counts and exact medians of the numeric columns."""
    m = B.missing_and_median(read(spark, sf, "lineitem"), _NUM_COLS)
    return m.select("column", "n_missing", r6("median").alias("median"))


# ------------------------------------------------------------------ itemsets

_SUBSETS = f"""
WITH {_ORDER_B},
n AS (SELECT count(*) AS n FROM b),
s AS (SELECT items, unnest(range(1, (1 << len(items)))) AS m FROM b),
sub AS (SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS sub FROM s),
f AS (SELECT sub, count(*) AS freq FROM sub GROUP BY sub),
its AS (SELECT array_to_string(sub, ',') AS items, CAST(len(sub) AS INTEGER) AS size,
               CAST(freq AS BIGINT) AS freq, freq / (SELECT n FROM n) AS support
        FROM f WHERE freq / (SELECT n FROM n) >= {ITEMSET_MIN_SUPPORT})
"""


def order_itemsets(spark: SparkSession, sf: str, max_size: int | None = None) -> DataFrame:
    return I.mine_itemsets(order_type_baskets(spark, sf), min_support=ITEMSET_MIN_SUPPORT,
                           max_size=max_size)


def _fmt_itemsets(df: DataFrame) -> DataFrame:
    return df.select(joined("items").alias("items"), "size", "freq", r6("support").alias("support"))


def _k_query(k: int):
    sql = _SUBSETS + f"SELECT items, size, freq, round(support, 6) AS support FROM its WHERE size = {k}"

    @query(f"itemsets_k{k}", sql)
    def _q(spark: SparkSession, sf: str) -> DataFrame:
        return _fmt_itemsets(order_itemsets(spark, sf).where(F.col("size") == k))

    _q.__doc__ = f"MIN2: frequent itemsets of size {k} (FP-growth)."
    return _q


for _k in (1, 2, 3):
    _k_query(_k)


@query("itemset_sizes", _SUBSETS + "SELECT size, CAST(count(*) AS BIGINT) AS n_itemsets FROM its GROUP BY 1")
def itemset_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """AGG6: itemset count per size."""
    return I.itemset_sizes(order_itemsets(spark, sf))


@query("top_triples", _SUBSETS + "SELECT items, size, freq, round(support, 6) AS support FROM its "
       "WHERE size = 3 ORDER BY support DESC, items LIMIT 10")
def top_triples(spark: SparkSession, sf: str) -> DataFrame:
    """SRT1: top-10 size-3 itemsets by support (the flagship)."""
    return _fmt_itemsets(I.top_itemsets(order_itemsets(spark, sf), 3, 10))


# ------------------------------------------------------------------ rules

RULE_MIN_CONFIDENCE = 0.5

HIGH_LIFT = 1.5
_RULES_BASE = _SUBSETS + f""",
splits AS (
  SELECT list_filter(s2, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS ante,
         list_filter(s2, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS cons, support
  FROM (SELECT string_split(items, ',') AS s2, support, unnest(range(1, (1 << size) - 1)) AS m
        FROM its WHERE size >= 2)
),
r AS (
  SELECT array_to_string(ante, ',') AS antecedents, array_to_string(cons, ',') AS consequents,
         a.support AS sa, c.support AS sc, splits.support AS s
  FROM splits JOIN its a ON a.items = array_to_string(ante, ',')
              JOIN its c ON c.items = array_to_string(cons, ',')
),
m AS (
  SELECT antecedents, consequents, sa, sc, s, s / sa AS conf, s - sa * sc AS lev,
         greatest(s * (1 - sa), sa * (sc - s)) AS zden FROM r
),
rules AS (
  SELECT antecedents, consequents, round(sa, 6) AS antecedent_support, round(sc, 6) AS consequent_support,
         round(s, 6) AS support, round(conf, 6) AS confidence, round(conf / sc, 6) AS lift,
         round(lev, 6) AS leverage,
         CASE WHEN conf >= 1 THEN CAST('inf' AS DOUBLE) ELSE round((1 - sc) / (1 - conf), 6) END AS conviction,
         CASE WHEN zden = 0 THEN 0.0 ELSE round(lev / zden, 6) END AS zhangs_metric,
         round(0.5 * (s / sa + s / sc), 6) AS kulczynski,
         conf / sc AS lift_raw, conf AS conf_raw
  FROM m WHERE conf >= {RULE_MIN_CONFIDENCE}
)
"""

_RULE_COLS = ("antecedents, consequents, antecedent_support, consequent_support, support, "
              "confidence, lift, leverage, conviction, zhangs_metric, kulczynski")


def order_rules(spark: SparkSession, sf: str) -> DataFrame:
    its = order_itemsets(spark, sf)
    return I.association_rules(its, "confidence", RULE_MIN_CONFIDENCE)


def _fmt_rules(df: DataFrame) -> DataFrame:
    return df.select(joined("antecedents").alias("antecedents"),
                     joined("consequents").alias("consequents"),
                     *[r6(c).alias(c) for c in ("antecedent_support", "consequent_support", "support",
                                                "confidence", "lift", "leverage", "conviction",
                                                "zhangs_metric", "kulczynski")])


@query("rules_all_metrics", _RULES_BASE + f"SELECT {_RULE_COLS} FROM rules")
def rules_all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """MIN8 + FN15: every split of itemsets up to size 3, confidence >= 0.5."""
    return _fmt_rules(order_rules(spark, sf))


@query("rules_top_lift", _RULES_BASE + f"SELECT {_RULE_COLS} FROM rules "
       "ORDER BY lift_raw DESC, antecedents, consequents LIMIT 10")
def rules_top_lift(spark: SparkSession, sf: str) -> DataFrame:
    """SRT2: top-10 rules by lift."""
    return _fmt_rules(I.top_rules(order_rules(spark, sf), "lift", 10))


@query("rules_top_confidence", _RULES_BASE + f"SELECT {_RULE_COLS} FROM rules "
       "ORDER BY conf_raw DESC, antecedents, consequents LIMIT 10")
def rules_top_confidence(spark: SparkSession, sf: str) -> DataFrame:
    """SRT2: top-10 rules by confidence."""
    return _fmt_rules(I.top_rules(order_rules(spark, sf), "confidence", 10))


@query("rule_summary", _RULES_BASE + """
SELECT CAST(count(*) AS BIGINT) AS n_rules, round(avg(confidence_raw), 6) AS avg_confidence,
       round(avg(lift_raw), 6) AS avg_lift, CAST(count(*) FILTER (WHERE lift_raw > 1.5) AS BIGINT) AS n_high_lift
FROM (SELECT r.*, s / sa AS confidence_raw, (s / sa) / sc AS lift_raw FROM r WHERE s / sa >= 0.5)
""")
def rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG7: rule count, mean confidence and lift, rules with lift > 1.5."""
    s = I.rule_summary(order_rules(spark, sf))
    return s.select("n_rules", r6("avg_confidence").alias("avg_confidence"),
                    r6("avg_lift").alias("avg_lift"), "n_high_lift")


@query("findings_summary", _RULES_BASE + f""",
b2 AS (SELECT * FROM b)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM b2) AS n_baskets,
       (SELECT CAST(sum(len(items)) AS BIGINT) FROM b2) AS total_items,
       (SELECT CAST(count(DISTINCT i) AS BIGINT) FROM (SELECT unnest(items) AS i FROM b2)) AS n_distinct_items,
       (SELECT CAST(count(*) AS BIGINT) FROM its) AS n_itemsets,
       (SELECT round(avg(support), 6) FROM its WHERE size = 3) AS avg_support_size3,
       (SELECT CAST(count(*) AS BIGINT) FROM rules) AS n_rules,
       (SELECT round(avg(lift_raw), 6) FROM rules) AS avg_lift,
       (SELECT round(avg(conf), 6) FROM (SELECT conf FROM m WHERE conf >= {RULE_MIN_CONFIDENCE})) AS avg_confidence,
       (SELECT CAST(count(*) AS BIGINT) FROM rules WHERE lift_raw > {HIGH_LIFT}) AS n_high_lift,
       (SELECT items FROM its WHERE size = 3 ORDER BY support DESC, items LIMIT 1) AS top_triple,
       (SELECT freq FROM its WHERE size = 3 ORDER BY support DESC, items LIMIT 1) AS n_with_top_triple
""")
def findings_summary(spark: SparkSession, sf: str) -> DataFrame:
    """MIN20/AGG4/AGG8/AGG12: one-row summary of baskets, itemsets and rules."""
    baskets = order_type_baskets(spark, sf)
    its = order_itemsets(spark, sf)
    rules = order_rules(spark, sf)
    b = baskets.agg(F.count(F.lit(1)).alias("n_baskets"),
                    F.sum(F.size("items")).cast("long").alias("total_items"))
    u = baskets.select(F.explode("items").alias("i")).agg(F.countDistinct("i").alias("n_distinct_items"))
    i = its.agg(F.count(F.lit(1)).alias("n_itemsets"),
                r6(F.avg(F.when(F.col("size") == 3, F.col("support")))).alias("avg_support_size3"))
    r = rules.agg(F.count(F.lit(1)).alias("n_rules"), r6(F.avg("lift")).alias("avg_lift"),
                  r6(F.avg("confidence")).alias("avg_confidence"), F.count_if(F.col("lift") > HIGH_LIFT).alias("n_high_lift"))
    t = _fmt_itemsets(I.top_itemsets(its, 3, 1)).select(F.col("items").alias("top_triple"), F.col("freq").alias("n_with_top_triple"))
    # the other one-row aggregates enter as scalar subqueries (no join at all)
    return b.select("n_baskets", "total_items",
                    u.select("n_distinct_items").scalar().alias("n_distinct_items"),
                    i.select("n_itemsets").scalar().alias("n_itemsets"),
                    i.select("avg_support_size3").scalar().alias("avg_support_size3"),
                    r.select("n_rules").scalar().alias("n_rules"),
                    r.select("avg_lift").scalar().alias("avg_lift"),
                    r.select("avg_confidence").scalar().alias("avg_confidence"),
                    r.select("n_high_lift").scalar().alias("n_high_lift"),
                    t.select("top_triple").scalar().alias("top_triple"),
                    t.select("n_with_top_triple").scalar().alias("n_with_top_triple"))
