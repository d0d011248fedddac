"""Registry of catalogue queries: name -> (Spark builder, oracle SQL or None).

Builders take ``(spark, sf_dir)`` and return a DataFrame over the driver's
parquet tables; the oracle SQL is plain ANSI SQL over the same tables (run by
DuckDB in the checks). Output rules shared by both sides: sets leave as
sorted comma-joined strings, floats are rounded to 6 places, counts are
bigint, every computed column carries an explicit alias.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query; ``sql=None`` marks a rows-only check."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def r6(c: Column | str) -> Column:
    """Round a double to 6 places (the compare precision)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6)


def joined(c: Column | str, sep: str = ",") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col, sep)
