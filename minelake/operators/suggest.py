"""Follow-up suggestions from frequent itemsets (MIN13, JON12, FLT7, WIN4, SRT7).

For a whole table of queries (each a set of known items). The best record
for a candidate c of a query is the best record (highest support, then the
earliest record) that holds c and at least one known item k. That equals
the best, over the known items k, of the best record holding both k and c.
So the records are first pre-aggregated into a pair table
``(k, c) -> best record`` whose size is bounded by the item vocabulary
squared, independent of how many records or queries there are; each query's
known items then equi-join that table (broadcast when size-checked), and
only per-(query, candidate) winners and the per-query top ``limit`` remain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..plans.joins import bounded_broadcast, shared_table


def followup_limit(n_known: Column, threshold: int = LX.MIN_ITEMS_FOR_CONFIDENCE) -> Column:
    """SRT7: max(3, threshold - n + 2)."""
    return F.greatest(F.lit(3), F.lit(threshold) - n_known + 2)


def pair_table(records: DataFrame) -> DataFrame:
    """(k, c) -> ``best``: the record holding both (support desc, rec_order asc), as an
    order key (-support, rec_order)."""
    recs = records.select(F.array_distinct("items").alias("items"), F.struct((-F.col("support")).alias("neg"), "rec_order").alias("key"))
    pairs = (recs.select("*", F.explode("items").alias("k"))
             .select("key", "k", F.explode("items").alias("c")).where(F.col("k") != F.col("c")))
    return pairs.groupBy("k", "c").agg(F.min("key").alias("best"))


def suggest(queries: DataFrame, query_key: str, known_col: str, records: DataFrame,
            limit: Column | int | None = None) -> DataFrame:
    """Top suggestions per query: (query, rank, candidate, display_name,
    support, group, trigger). ``records``: (items, support, group, rec_order), rec_order unique;
    ``limit`` defaults to the follow-up rule on the number of known items.

    What is suggested depends on the set of known items alone, so queries are first reduced to
    their distinct sets. Every step of the search is an aggregate within a set (the least
    order key per candidate, 16 bytes a pair, then one sorted list per set, cut to its limit), and
    records come back by their order number for the winners alone. One join by the set
    gives its list to every query that has it.
    """
    recs = shared_table(records.select("items", "support", "group", "rec_order"), "records")
    table = bounded_broadcast(pair_table(recs))
    known = F.array_sort(F.array_distinct(F.col(known_col)))
    asked = shared_table(queries.select(F.col(query_key).alias("_q"), known.alias("_known")), "queries")
    q = shared_table(asked.select("_known").distinct().withColumn("_s", F.monotonically_increasing_id()), "sets")
    lim = followup_limit(F.size("_known")) if limit is None else (F.lit(limit) if isinstance(limit, int) else limit)
    pairs = q.select("_s", F.explode("_known").alias("k")).join(table, "k").groupBy("_s", "c").agg(F.min("best").alias("best"))
    order = F.struct(F.col("best.neg").alias("neg"), "c", F.col("best.rec_order").alias("rec_order"))
    lists = pairs.groupBy("_s").agg(F.array_sort(F.collect_list(order)).alias("cands"))
    found = q.join(lists, "_s").select("_s", "_known", lim.alias("_lim"), F.filter("cands", lambda s: ~F.array_contains(F.col("_known"), s["c"])).alias("cands"))
    top = found.select("_s", "_known", F.posexplode(F.expr("slice(cands, 1, _lim)")).alias("_at", "_c"))
    named = recs.select("rec_order", "support", "group", "items")
    won = top.select("_s", "_known", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_c.c").alias("c"), F.col("_c.rec_order").alias("rec_order")).join(named, "rec_order")
    row = F.struct("rank", "c", "support", "group", F.filter("items", lambda x: F.array_contains(F.col("_known"), x)).alias("trigger"))
    best = bounded_broadcast(won.groupBy("_known").agg(F.collect_list(row).alias("_rows")))
    out = asked.join(best, "_known").select("_q", F.explode("_rows").alias("_r")).select("_q", "_r.*")
    return out.select(F.col("_q").alias(query_key), "rank", F.col("c").alias("candidate"),
                      F.replace("c", F.lit("_"), F.lit(" ")).alias("display_name"),
                      "support", "group", "trigger")
