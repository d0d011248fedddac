"""ST1 as a Structured Streaming job: session state kept per key.

``transformWithStateInPandas`` keys the stream by session and keeps one value state, (pending
items, waiting, last turn), in the RocksDB state store; it emits one row per turn. The
per-key work is one session's turns of one micro-batch.

Order. Inside a micro-batch a session's turns are sorted by turn number before the state
machine runs, so arrival order within a batch does not matter. Across batches a session
moves on: a turn whose number is not above the last one taken, be it late or repeated (in
another batch or the same), changes nothing and gives a row with action ``late``. A turn
without a number is late too.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions import lexicons as LX
from ..session import ensure_checkpoint_dir

OUTPUT_SCHEMA = ("conv_id long, turn long, n_items int, waiting_before boolean, action string, "
                 "items_used array<string>, followup_limit int")
STATE_SCHEMA = "pending array<string>, waiting boolean, last long"
TURNS = "conv_id long, turn long, items array<string>"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_processor(threshold: int) -> StatefulProcessor:
    columns, state_schema = [f.split()[0] for f in OUTPUT_SCHEMA.split(", ")], STATE_SCHEMA

    # a class of its own here travels to the workers by value
    class Sessions(StatefulProcessor):
        def init(self, handle):
            self.state = handle.getValueState("session", state_schema)

        def handleInputRows(self, key, rows, timerValues):
            pending, waiting, last = [], False, None
            if self.state.exists():
                kept = self.state.get()
                pending, waiting, last = list(kept[0] if kept[0] is not None else []), bool(kept[1]), kept[2]
            turns = pd.concat(list(rows)).sort_values("turn", kind="stable", na_position="last")
            out = []
            for turn, items in zip(turns["turn"], turns["items"], strict=True):
                items = list(items) if items is not None else []
                n, number = len(items), None if pd.isna(turn) else int(turn)
                if number is None or last is not None and number <= last:
                    out.append((key[0], number, n, waiting, "late", None, None))
                    continue
                last = number
                if waiting:
                    out.append((key[0], number, n, True, "predict", list(dict.fromkeys(pending + items)), None))
                    pending, waiting = [], False
                elif n < threshold:
                    out.append((key[0], number, n, False, "ask", None, max(3, threshold - n + 2)))
                    pending, waiting = items, True
                else:
                    out.append((key[0], number, n, False, "predict", items, None))
            if last is not None:
                self.state.update((pending, waiting, last))
            made = pd.DataFrame(out, columns=columns)
            yield made.astype({"turn": "Int64", "followup_limit": "Int32"})

        def close(self):
            pass

    return Sessions()


def session_stream(stream: DataFrame, key: str = "conv_id",
                   threshold: int = LX.MIN_ITEMS_FOR_CONFIDENCE) -> DataFrame:
    """Streaming DataFrame of per-turn session decisions."""
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=session_processor(threshold), outputStructType=OUTPUT_SCHEMA, outputMode="append", timeMode="None")


class SessionJob:
    """One running session query over a folder of deliveries under the shared checkpoint folder.

    ``deliver`` is one distributed write into the input folder; ``finish`` waits for all of it,
    stops the query and returns what its sink wrote."""

    def __init__(self, spark: SparkSession, threshold: int = LX.MIN_ITEMS_FOR_CONFIDENCE, run_dir: str | None = None):
        base = run_dir or os.path.join(ensure_checkpoint_dir(spark), f"session-stream-{uuid.uuid4().hex}")
        self.spark, (self.src, self.out, self.chk) = spark, (os.path.join(base, p) for p in ("in", "out", "chk"))
        spark.createDataFrame([], TURNS).write.parquet(self.src)
        old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
        try:  # the query keeps the provider it starts with
            self.query = (session_stream(spark.readStream.schema(TURNS).parquet(self.src), threshold=threshold)
                          .writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.chk)
                          .outputMode("append").trigger(processingTime="0 seconds").start())
        finally:
            if old is None:
                spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
            else:
                spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)

    def deliver(self, turns: DataFrame) -> None:
        turns.select("conv_id", "turn", "items").write.mode("append").parquet(self.src)
        self.query.processAllAvailable()

    def finish(self) -> DataFrame:
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()
        return self.spark.read.schema(OUTPUT_SCHEMA).parquet(self.out)


def run_file_stream(spark: SparkSession, turns: DataFrame, run_dir: str | None = None, arrivals: int = 3,
                    threshold: int = LX.MIN_ITEMS_FOR_CONFIDENCE) -> DataFrame:
    """Feed ``turns`` (conv_id, turn, items) through one running query in ``arrivals`` deliveries and
    return what the sink wrote.

    The turns are written once; a delivery is the range of turn numbers that follows the last
    one's, so the state store carries every session from one delivery to the next.
    """
    from ..plans.joins import shared_table

    rows = shared_table(turns.select("conv_id", "turn", "items"), "turns")
    lo, hi = rows.agg(F.min("turn"), F.max("turn")).first()
    span = 0 if lo is None else hi - lo + 1
    job = SessionJob(spark, threshold, run_dir)
    try:
        for k in range(arrivals):
            part = F.floor((F.col("turn") - F.lit(lo)) * arrivals / F.lit(span)) if span else F.lit(0)
            job.deliver(rows.where(F.coalesce(part, F.lit(arrivals - 1)) == k))
    except Exception:
        job.query.stop()
        raise
    return job.finish()
