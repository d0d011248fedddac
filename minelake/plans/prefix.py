"""Exact running sums and positions that stay distributed under key skew.

A window ``partitionBy(key).orderBy(...)`` puts every row of a key into one
task; one hot key then holds a third of the data in a single sort. Here the
rows are range-partitioned on (key, order) instead, so a hot key spreads over
many partitions. Each partition computes local running values; a small table
of per-(partition, key) totals gives every chunk its offset, and one join on
(partition, key) adds it back. The result equals the single-window answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import bounded_broadcast, shared_table

_PID = "_ml_pid"
_LOCAL = "_ml_local"
_TOTAL = "_ml_total"
_OFF = "_ml_off"


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _with_offsets(local: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the offset of their chunk, a row per chunk: broadcast where it is small, so that
    the rows are not shuffled again by the few (partition, key)."""
    offsets = bounded_broadcast(offsets.select(*[F.col(c).alias("_o_" + c) for c in [_PID, *keys]], _OFF))
    cond = [local[c].eqNullSafe(offsets["_o_" + c]) for c in [_PID, *keys]]
    return local.join(offsets, cond).drop(*["_o_" + c for c in [_PID, *keys]])


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               value: Column | str, out: str, inclusive: bool = True,
               num_partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` within ``keys`` in ``order`` (a total order).

    ``inclusive=False`` gives the sum over strictly earlier rows.
    """
    keys, order = list(keys), list(order)
    val = F.col(value) if isinstance(value, str) else value
    n = num_partitions or _num_partitions(df)
    ranged = (df.withColumn("_ml_val", val)
                .repartitionByRange(n, *[F.col(c) for c in keys + order])
                .withColumn(_PID, F.spark_partition_id()))
    w = (Window.partitionBy(_PID, *keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Written so that both branches below see one range partitioning: a second
    # evaluation would sample its own bounds and give other partition ids.
    local = shared_table(ranged.withColumn(_LOCAL, F.sum("_ml_val").over(w)), "prefix")
    chunks = local.groupBy(_PID, *keys).agg(F.sum("_ml_val").alias(_TOTAL))
    w_off = (Window.partitionBy(*keys).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = chunks.withColumn(_OFF, F.coalesce(F.sum(_TOTAL).over(w_off), F.lit(0)))
    res = _with_offsets(local, offsets, keys)
    running = F.col(_LOCAL) + F.col(_OFF)
    if not inclusive:
        running = running - F.col("_ml_val")
    return res.withColumn(out, running).drop(_PID, _LOCAL, _OFF, "_ml_val")


def ordered_index(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row within ``keys`` under a total ``order``.

    A chunk's rows lie together in their sorted partition, so the running row number of the partition, less its
    first in the chunk, is the local position: unlike a window it needs no second shuffle of the rows."""
    keys, order = list(keys), list(order)
    n = num_partitions or _num_partitions(df)
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in keys + order]).sortWithinPartitions(*keys, *order)
                .withColumn(_PID, F.spark_partition_id()).withColumn(_LOCAL, F.monotonically_increasing_id()))
    local = shared_table(ranged, "prefix")
    chunks = local.groupBy(_PID, *keys).agg(F.count(F.lit(1)).alias(_TOTAL), F.min(_LOCAL).alias("_ml_first"))
    w_off = (Window.partitionBy(*keys).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum(_TOTAL).over(w_off), F.lit(0)) - F.col("_ml_first") + 1
    return _with_offsets(local, chunks.withColumn(_OFF, before), keys).withColumn(out, (F.col(_LOCAL) + F.col(_OFF)).cast("long")).drop(_PID, _LOCAL, _OFF)
