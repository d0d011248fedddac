"""Keep CPU-heavy row work spread over the cluster.

A scan of a file that is one row group is one partition; a row-wise step that
is expensive per row (regex extraction over whole texts, an explode that fans
out into candidate pairs) would then run in one task. ``spread`` adds a
round-robin repartition only for a bare scan with fewer partitions than the
cluster has cores. It never runs any part of the plan: an input with a shuffle
of its own already has the session's partitions and is returned as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_SHUFFLES = {"Aggregate", "Join", "Sort", "Window", "Distinct", "Repartition", "RepartitionByExpression", "RebalancePartitions", "Deduplicate"}


def _nodes(plan) -> set[str]:
    """The operators of a logical plan, by name."""
    children = plan.children()
    return {plan.nodeName()}.union(*(_nodes(children.apply(i)) for i in range(children.size())))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    if _nodes(df._jdf.queryExecution().analyzed()) & _SHUFFLES:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
