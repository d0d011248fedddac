"""Mixing sources to target weights by capped water-filling (built-ins only).

Sizes are words. The mix is as large as all sources together; a source's share
follows its weight, but it stops at ``max_epochs`` times its own size and the
excess goes to the others by weight until none is above its stop. Sorted by
(stop / weight) the clamped sources are a prefix, so the fixed point comes from
running sums over the source table (one row per source) instead of a loop.

A source that takes f = target / size epochs takes every document floor(f) times.
The remaining fraction is sampled: documents are ordered by a seeded hash bin,
those before the cut are taken once more, and those in the cut's bin give a
fractional repetition (their leading words), so a source lands on its target to
within a word a document of one bin. Bins are pre-aggregated per source: a source
with a third of all rows is never gathered. Reruns give the same mix.

Null text has size 0; null source is a source of its own and sorts last. Weights
go to sources in code point order, cycling. Null or repeated doc_ids: a row's draw
depends on its doc_id alone. A mix without words takes nothing. Extra columns are
ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minelake.llm.common import written

WEIGHTS, MAX_EPOCHS, BINS, SEED = (5, 2, 1), 3, 4096, 17

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def draw(seed: int, bins: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(bins))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    per = per.withColumn("k", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("stop", F.col("source_size") * float(max_epochs))
    up = Window.orderBy(F.col("stop") / F.col("w"), "k")
    before, onward = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("w").over(onward))
    free = F.min(F.when(F.col("stop") >= F.col("w") * F.col("level"), F.struct(F.col("stop") / F.col("w"), "k", "level"))).over(Window.partitionBy())
    return per.select("source", "source_size", F.least("stop", F.coalesce(F.col("w") * free["level"], F.col("stop"))).alias("target"))


def _plan(sizes: DataFrame, weights, max_epochs, bins: int, seed: int) -> DataFrame:
    """Per source: source_size, target, whole repetitions, the cut's bin and its part."""
    goal = targets(sizes, weights, max_epochs)
    hist = sizes.groupBy("source", draw(seed, bins).alias("bin")).agg(F.sum("size").alias("words"))
    hist = hist.withColumnRenamed("source", "s")
    up = Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most `bins` rows a source
    hist = hist.withColumn("before", F.coalesce(F.sum("words").over(up), F.lit(0)))
    goal = (goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .withColumn("whole", F.floor("epochs"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    cut = (hist.join(goal.select(F.col("source").alias("s2"), "rest"), F.col("s").eqNullSafe(F.col("s2")))
           .where("before <= rest AND before + words > rest")
           .groupBy("s").agg(F.min(F.struct("bin", ((F.col("rest") - F.col("before")) / F.col("words")).alias("part"))).alias("cut")))
    return (goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("source").alias("plan_source"), "source_size", "target", "whole",
                    F.coalesce("cut.bin", F.lit(-1)).alias("cut_bin"), F.coalesce("cut.part", F.lit(0.0)).alias("part")))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, bins: int = BINS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken per row."""
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    plan = written(_plan(sizes, weights, max_epochs, bins, seed), "mix")
    extra = (F.when(F.col("bin") < F.col("cut_bin"), F.col("size"))
             .when(F.col("bin") == F.col("cut_bin"), F.floor(F.col("size") * F.col("part"))).otherwise(F.lit(0)))
    return (sizes.withColumn("bin", draw(seed, bins)).join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left")
            .select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, bins: int = BINS, seed: int = SEED) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row per repetition; a fractional
    repetition holds the leading words of its text, joined by one space. Rows travel
    as one struct beside the working columns, so no column name can clash."""
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    plan = written(_plan(sizes, weights, max_epochs, bins, seed), "mix")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), word_count(F.col("text")).alias("size"),
                       draw(seed, bins).alias("bin"), F.col("source").alias("row_source"))
    rows = rows.join(plan, F.col("row_source").eqNullSafe(F.col("plan_source")), "left")
    again = (F.col("bin") < F.col("cut_bin")).cast("int")
    part = F.when(F.col("bin") == F.col("cut_bin"), F.floor(F.col("size") * F.col("part"))).otherwise(F.lit(0)).cast("int")
    kinds = F.concat(F.array_repeat(F.lit(-1), (F.col("whole") + again).cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    whole = F.col("row.text")
    text = F.when(F.col("words") < 0, whole).otherwise(F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(_WORD), F.lit(0)), 1, F.greatest("words", F.lit(1))), " "))
    rows = rows.select("row", F.explode(kinds).alias("words")).select("row", "words", text.alias("text"))
    made = {"text": F.col("text"), "n_chars": F.when(F.col("words") < 0, F.col("row")["n_chars"]).otherwise(F.length("text").cast("long"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return rows.select(*[made.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
