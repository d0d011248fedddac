"""Chat-session state over turns (ST1, SET4) as a batch job.

Per session the reference keeps (pending items, waiting flag): a turn that is
not waiting and has fewer than ``threshold`` items asks for more and stores
them; the next turn always merges, predicts and clears. Because a waiting
turn always clears, the state resets after every turn with enough items, and
inside a run of short turns the flag alternates. So with

    run  = number of "big" turns (>= threshold items) strictly before a turn
    pos  = position of the turn inside its (session, run) group

a turn is waiting exactly when ``pos`` is even, and its pending items are
those of the turn just before it. Both ``run`` and ``pos`` come from the
range-partitioned prefix sums, so even a session holding a third of all
turns is spread over many tasks; no per-session list is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..plans.prefix import ordered_index, prefix_sum


def fold_sessions(turns: DataFrame, keys: Sequence[str], order: str, items: str = "items",
                  threshold: int = LX.MIN_ITEMS_FOR_CONFIDENCE) -> DataFrame:
    """ST1: one output row per turn.

    Columns added: ``n_items`` (own items), ``waiting_before``, ``action``
    ('ask' or 'predict'), ``items_used`` (items a prediction uses; null for
    'ask'), ``pending_after`` and ``followup_limit`` (max(3, threshold-n+2)
    for 'ask' turns).
    """
    keys = list(keys)
    t = turns.withColumn("n_items", F.size(F.coalesce(F.col(items), F.array().cast("array<string>"))))
    t = t.withColumn("_big", (F.col("n_items") >= threshold).cast("long"))
    t = ordered_index(t, keys, [order], "_idx")
    t = prefix_sum(t, keys, [order], "_big", "_run", inclusive=False)
    t = ordered_index(t, keys + ["_run"], [order], "_pos")
    prev = t.select(*[F.col(k).alias("_p_" + k) for k in keys], (F.col("_idx") + 1).alias("_p_idx"),
                    F.col(items).alias("_prev_items"))
    cond = [t[k].eqNullSafe(prev["_p_" + k]) for k in keys] + [t["_idx"] == prev["_p_idx"]]
    j = t.join(prev, cond, "left").drop(*["_p_" + k for k in keys], "_p_idx")
    waiting = (F.col("_pos") % 2) == 0
    merged = F.array_distinct(F.concat(F.coalesce("_prev_items", F.array().cast("array<string>")),
                                       F.coalesce(F.col(items), F.array().cast("array<string>"))))
    action = F.when(waiting | (F.col("_big") == 1), F.lit("predict")).otherwise(F.lit("ask"))
    used = F.when(waiting, merged).when(F.col("_big") == 1, F.col(items))
    limit = F.when(action == "ask", F.greatest(F.lit(3), F.lit(threshold) - F.col("n_items") + 2))
    pending_after = F.when(action == "ask", F.col(items))
    return (j.withColumn("waiting_before", waiting).withColumn("action", action)
            .withColumn("items_used", used).withColumn("followup_limit", limit.cast("int"))
            .withColumn("pending_after", pending_after)
            .drop("_big", "_idx", "_run", "_pos", "_prev_items"))
