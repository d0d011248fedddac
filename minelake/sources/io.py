"""Sources and sinks (SRC1-SRC4, SRC6, SRC7, SNK1-SNK4).

Reads declare their schema where one is known (no inference pass over the
data); writes are plain Spark writers to caller-given paths, which on a
cluster are shared storage.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.terms import feature_name, normalise_disease, strip_ws
from ..operators.baskets import drop_all_null_columns, fill_median, numeric_columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """SRC1: CSV with header; explicit schema preferred, inference only on request."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def feature_label_frame(df: DataFrame, target: str = "diagnosis") -> DataFrame:
    """SRC2: require the target, drop ``id`` and ``Unnamed:*``, keep numeric
    features; returns one frame (target + features) so rows stay aligned."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    drop = [c for c in df.columns if c == "id" or c.startswith("Unnamed:")]
    rest = df.drop(*drop)
    feats = numeric_columns(rest, exclude=[target])
    if not feats:
        raise ValueError("no numeric feature columns")
    return rest.select(target, *feats)


def cleaning_loader(df: DataFrame, target: str = "diagnosis") -> DataFrame:
    """SRC3: drop all-null columns, fill numeric nulls with exact medians."""
    d = drop_all_null_columns(df)
    d = feature_label_frame(d, target)
    feats = [c for c in d.columns if c != target]
    return fill_median(d, feats)


def precaution_mapping(df: DataFrame, key_col: str, value_cols: Sequence[str],
                       order_col: str | None = None) -> DataFrame:
    """SRC4: normalised key -> non-empty stripped values; for duplicate keys
    the last row (by ``order_col``, else input order) wins."""
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    vals = F.filter(F.array(*[F.coalesce(strip_ws(F.col(c)), F.lit("")) for c in value_cols]),
                    lambda x: x != "")
    rows = df.where(F.col(key_col).isNotNull() & (strip_ws(F.col(key_col)) != "")).select(
        normalise_disease(F.col(key_col)).alias("key"), vals.alias("values"), order.alias("_ord"))
    return rows.groupBy("key").agg(F.max_by("values", "_ord").alias("values"))


def lookup_values(df: DataFrame, name_col: str, mapping: DataFrame, out: str = "values") -> DataFrame:
    """JON3: left join on the normalised name; missing -> empty list."""
    m = mapping.select(F.col("key").alias("_lk"), F.col("values").alias(out))
    from ..plans.joins import bounded_broadcast

    j = df.join(bounded_broadcast(m), normalise_disease(F.col(name_col)) == F.col("_lk"), "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>"))).drop("_lk")


def read_itemsets(df: DataFrame, items_col: str = "itemset", support_col: str = "support",
                  group_col: str = "disease", max_records: int | None = None) -> DataFrame:
    """SRC6: normalise items to feature names, drop sets under 2 items, null
    support -> 0; ``max_records`` keeps the first records by (support desc,
    items) when the caller wants the reference's cache cap."""
    items = F.filter(F.transform(F.col(items_col), lambda s: feature_name(s)), lambda s: s != "")
    out = df.select(items.alias("items"), F.coalesce(F.col(support_col).cast("double"), F.lit(0.0)).alias("support"),
                    F.coalesce(strip_ws(F.col(group_col).cast("string")), F.lit("")).alias("group"))
    out = out.where(F.size("items") >= 2)
    if max_records is not None:
        out = out.orderBy(F.desc("support"), F.array_join("items", ",")).limit(max_records)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """SNK1/SNK2: parquet (optionally partitioned) or CSV with arrays joined."""
    if fmt == "csv":
        cols = [F.array_join(F.col(f.name), ",").alias(f.name) if isinstance(f.dataType, T.ArrayType)
                else F.col(f.name) for f in df.schema.fields]
        df = df.select(*cols)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    getattr(w.option("header", True) if fmt == "csv" else w, fmt)(path)


def write_report(lines: DataFrame, path: str, order_cols: Sequence[str], text_col: str = "line") -> None:
    """SNK3: an ordered text report (one file; the report is a bounded
    summary, not the data)."""
    lines.orderBy(*order_cols).select(text_col).coalesce(1).write.mode("overwrite").text(path)


def save_model(model, path: str, features: Sequence[str], metrics: Mapping[str, float] | None = None) -> None:
    """SNK4: the fitted pipeline, its feature list and a metrics row."""
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    meta = {"features": list(features)}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "meta"))
    if metrics:
        spark.createDataFrame([tuple(float(v) for v in metrics.values())],
                              ", ".join(f"`{k}` double" for k in metrics)).write.mode("overwrite").parquet(
            os.path.join(path, "metrics"))


def load_model(path: str, required_features: Sequence[str] | None = None):
    """SRC7: load the pipeline and check its stored feature list."""
    from pyspark.ml import PipelineModel

    spark = SparkSession.getActiveSession()
    model = PipelineModel.load(os.path.join(path, "model"))
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    feats = meta.get("features")
    if not isinstance(feats, list) or not feats:
        raise ValueError("stored model has no feature list")
    if required_features is not None and list(required_features) != feats:
        raise ValueError(f"feature mismatch: stored {feats}, required {list(required_features)}")
    return model, feats
