"""Corpus pipeline: from raw documents to indexed token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of their docs. Stages keep rows whole; their decisions are:

* language: drops a document without a letter (or null text), and one whose best
  language scores under ``LEAST_SCORE``;
* near_dedup: keeps the smallest doc_id of each near-duplicate group (null doc_ids
  stay; rows that repeat a doc_id share its fate);
* decontaminate: drops documents with a window of a benchmark item;
* mix: repeats and samples documents to the target weights of their sources;
* token_ids: writes and indexes the token ids and returns what it reads back, a row
  per document repetition: doc_id, occurrence, start, n_tokens, ids_crc32.

Empty docs pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minelake.llm.common import read, ship, written
from minelake.llm.decontaminate import clean_documents
from minelake.llm.language_id import predict, train
from minelake.llm.minhash_dedup import near_duplicates
from minelake.llm.mixing import mixed_documents
from minelake.llm.queries import held_out, tokenizer
from minelake.llm.token_store import write_tokens

LEAST_SCORE = 0.34


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # the row travels as one struct: no column name can clash with the working ones
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    scored = predict(rows, train(docs.where(~held_out())), ["doc"])
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    store = write_tokens(docs, tokenizer("word_bpe_49k.json"), 1)
    return store.fetch(store.catalogue)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("token_ids", token_ids)]

#: kernels, MinHash and tokenizers are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
