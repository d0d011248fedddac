"""Queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minelake.llm.centroid_clusters import centroid_clusters
from minelake.llm.chat_format import format_chats, read_back
from minelake.llm.common import read, ship
from minelake.llm.decontaminate import benchmark_hits
from minelake.llm.fingerprints import fingerprints
from minelake.llm.language_id import predict, train
from minelake.llm.license_scan import license_scan, oracle_sql
from minelake.llm.minhash_dedup import near_duplicates
from minelake.llm.mixing import mix
from minelake.llm.periodic_runs import periodic_runs
from minelake.llm.substring_dedup import substring_dedup
from minelake.llm.token_counts import token_counts
from minelake.llm.token_store import write_tokens
from minelake.llm.toxicity import fit as fit_toxicity
from minelake.llm.toxicity import toxicity

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = (run, sql)
        return run
    return deco


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    return substring_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def held_out():
    """crc32 of the doc_id as text, modulo 3, is 1."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])


@query("op3_token_store")
def op3(spark, sf_dir):
    store = write_tokens(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 1)
    return store.fetch(store.catalogue).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_mixing")
def op4(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents"))


@query("op5_fingerprints")
def op5(spark, sf_dir):
    return fingerprints(read(spark, sf_dir, "documents"))


@query("op6_chat_format")
def op6(spark, sf_dir):
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_chats(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", "n_turns", F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       "formatted_chars", "n_attachments", "extra_tokens")


@query("op7_decontaminate")
def op7(spark, sf_dir):
    hits = benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op9_license_scan", oracle_sql())
def op9(spark, sf_dir):
    return license_scan(read(spark, sf_dir, "documents"))


@query("op10_near_dedup")
def op10(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) % 10 is 0, the words from a on repeat the p words there."""
    id_hash = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", id_hash.alias("h"), F.floor(id_hash / 10).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w")))
    rows = rows.withColumn("a", (F.col("g") % F.col("n")).cast("int")).withColumn("times", (3 + F.col("g") % 8).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / F.col("times"))).cast("int"))
    again = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.col("times"))), 1, F.col("n") - F.col("a"))
    edited = F.array_join(F.concat(F.slice("w", 1, F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    found = periodic_runs(planted_periods(read(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("minus"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("best", longest)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
                        (-F.col("best.minus")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.minus")).alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_centroid_clusters")
def op12(spark, sf_dir):
    return centroid_clusters(read(spark, sf_dir, "embeddings"))


def tested():
    """crc32 of the doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op13_toxicity")
def op13(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read(spark, sf_dir, "labels").where(~tested()))
    seen = F.transform("evidence", lambda e: F.concat_ws(":", e["doc_id"], e["label"], F.round(e["similarity"], 6)))
    return toxicity(docs, model).select("doc_id", tested().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                                        F.array_join(seen, ",").alias("evidence"))
