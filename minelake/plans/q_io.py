"""Catalogue: sources and sinks. Each query writes a whole table (or what is derived
from it) to a new folder under the shared checkpoint folder and returns what it reads back.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from . import q_itemsets as QI
from .registry import joined, query, r6, read


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("io_parquet", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders""")
def io_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2: a table partitioned by a column, read back."""
    path = _folder(spark, "orders")
    IO.write_table(read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), path,
                   partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


@query("io_csv", """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def io_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1/SNK1: CSV with a header, read back with its schema declared."""
    path = _folder(spark, "customer")
    IO.write_table(read(spark, sf, "customer"), path, fmt="csv")
    return IO.read_csv(spark, path, schema="c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@query("io_feature_loader", """SELECT l_returnflag AS diagnosis, l_linenumber::INTEGER AS line, l_quantity, l_extendedprice,
       coalesce(nullif(l_discount, 0), (SELECT median(nullif(l_discount, 0)) FROM lineitem)) AS discount FROM lineitem""")
def io_feature_loader(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2/SRC3/PRJ2/PRJ3/PRJ5: ids, texts and all-null columns go, nulls take the
    column's median, every row stays."""
    raw = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.lit(None).cast("double").alias("Unnamed: 32"), F.lit(None).cast("double").alias("empty"),
        F.col("l_returnflag").alias("diagnosis"), F.col("l_linestatus").alias("status"), F.col("l_linenumber").cast("int").alias("line"),
        "l_quantity", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("discount"))
    return IO.cleaning_loader(raw)


@query("io_itemsets", QI._SUBSETS + "SELECT lower(items) AS items, round(support, 6) AS support FROM its WHERE size >= 2")
def io_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1/SRC6: mined itemsets as CSV, read back with items in feature form, sets under two items dropped."""
    path = _folder(spark, "itemsets")
    IO.write_table(QI.order_itemsets(spark, sf).select("items", "support"), path, fmt="csv")
    back = IO.read_csv(spark, path, schema="items string, support double")
    sets = IO.read_itemsets(back.select(F.split("items", ",").alias("itemset"), "support", F.lit(None).cast("string").alias("disease")))
    return sets.select(joined("items").alias("items"), r6("support").alias("support"))


@query("io_report", """SELECT l_returnflag || ' ' || l_linestatus || ': ' || count(*) || ' rows' AS line
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def io_report(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3: a summary as ordered text lines, read back."""
    path = _folder(spark, "report")
    n = read(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").count()
    IO.write_report(n.select("l_returnflag", "l_linestatus",
                             F.format_string("%s %s: %d rows", "l_returnflag", "l_linestatus", "count").alias("line")),
                    path, ["l_returnflag", "l_linestatus"])
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("io_model", """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM lineitem""")
def io_model(spark: SparkSession, sf: str) -> DataFrame:
    """SNK4/SRC7: a model saved and loaded predicts every row alike."""
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    data = read(spark, sf, "lineitem").select(*feats, (F.col("l_returnflag") == "A").cast("double").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             DecisionTreeClassifier(maxDepth=3, seed=42)]).fit(data)
    path = _folder(spark, "model")
    IO.save_model(model, path, feats)
    loaded, _ = IO.load_model(path, feats)
    first = model.transform(data).select(*feats, "label", F.col("prediction").alias("before"))
    both = loaded.transform(first)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") != F.col("prediction")).alias("n_different"))
