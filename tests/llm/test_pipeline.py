"""Each stage takes effect on what the one before kept, whole and in the columns of documents."""

import corpus_pipeline as pipeline
from minelake.llm.common import written
from minelake.llm.decontaminate import benchmark_hits
from minelake.llm.minhash_dedup import near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        if name != "token_ids":
            assert docs.columns == columns
        if name == "language":
            assert docs.count() == before.count()  # every text has letters here
        if name == "near_dedup":
            kept = {r.doc_id for r in near_duplicates(before).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == kept and docs.count() < before.count()
        if name == "decontaminate":
            bad = benchmark_hits(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count()
            assert docs.count() == before.count() - bad and bad > 0
        if name == "token_ids":
            rows = sorted(docs.collect(), key=lambda r: r.start)
            assert len(rows) == before.count()
            assert [r.start for r in rows[1:]] == [r.start + r.n_tokens for r in rows[:-1]]


def test_edge_rows_and_empty_docs(spark, docs, none):
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for table in (docs, docs.where("1 = 0")):
        for name, stage in pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.count() >= 0
            assert name == "token_ids" or out.columns == table.columns


def test_extra_columns_of_any_name_come_back(spark, docs):
    """Names that stages use for themselves, as extra columns of documents."""
    from pyspark.sql import functions as F

    names = ["score", "lang_pred", "target", "part", "whole", "source_size", "cut_bin", "mix_size", "mix_bin", "contaminated", "row", "words", "size", "bin",
             "hits", "bad_id", "component_id", "kept", "plan_source", "row_source", "doc", "a name"]
    table = docs.select("doc_id", "text", "lang", "source", "n_chars", "t", "keys", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns, name
        rows = out.select(*[F.col(f"`{n}`") for n in names]).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(range(len(names)))], name
    assert pipeline.STAGES[-1][1](spark, table, SF).count() == table.count()
