"""Join helpers: a derived side is computed once, and its bytes decide."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: evaluated a single time,
    and kept when executors are lost."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as a shared table, so that its bytes decide.

    The planner then knows its size: it broadcasts the side below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond it
    (with AQE skew splitting). The side is evaluated a single time.
    """
    return shared_table(df, "side")
