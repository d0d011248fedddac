"""Exact one-dimensional k-means per column (FE3).

Lloyd's iteration from given start centres, deterministic: a value belongs to the nearest
centre (a tie to the smaller one), a centre moves to the mean of its values, an empty one stays. It
stops when the squared shifts of a column's centres add up to at most ``TOLERANCE`` times the
column's variance, or after ``ROUNDS``.

Sorted values make a round cheap: a cluster is the values between two midpoints, so
only counts and sums below each midpoint are needed.

* One pass groups the values, ``groupBy(column, value).count()``, and writes them range-partitioned
  and sorted by (column, value); another reduces them to ``CELLS`` equal-width cells a
  column with count, sum, least and greatest value. The cells are what the driver holds.
* A round answers every midpoint from whole cells plus the part of the one cell it
  cuts. That part is one aggregate for all midpoints of all columns and of all fits that run
  together, whose range filters reach the sorted files, so a round reads some row groups, not the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import shared_table
from .quantiles import finite

CELLS = 1024
ROUNDS, TOLERANCE = 300, 1e-4
#: decimals of a midpoint (sums of doubles may differ beyond, by the order of tasks)
DECIMALS = 9


class Held(NamedTuple):
    """What every fit over some columns reads: their written values, totals and cells (keyed by the column's
    number), and how many values are -Infinity, Infinity and NaN."""
    values: DataFrame
    stats: dict
    cells: dict[int, list]
    odd: dict[int, tuple[int, int, int]]


def midpoints(centres: Sequence[float]) -> list[float]:
    return [round((a + b) / 2, DECIMALS) for a, b in zip(centres[:-1], centres[1:], strict=True)]


def _cells(values: DataFrame, ends: dict[int, tuple[float, float]], cells: int) -> dict[int, list]:
    """Per column, its non-empty cells in order: (count, sum, least, greatest)."""
    table = F.lit(None).cast("int")
    for c, (low, high) in ends.items():
        width = (high - low) / cells or 1.0
        table = F.when(F.col("c") == c, F.least(F.lit(cells - 1), F.floor((F.col("x") - low) / width)).cast("int")).otherwise(table)
    rows = (values.withColumn("cell", table).groupBy("c", "cell")
            .agg(F.sum("n").alias("n"), F.sum(F.col("x") * F.col("n")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).collect())
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["c"], r["low"])):
        out.setdefault(r["c"], []).append((r["n"], r["s"], r["low"], r["high"]))
    return out


def _below(values: DataFrame, cells: dict[int, list], cuts: dict[tuple[int, int], list[float]]) -> dict[tuple[int, int], list[tuple[int, float]]]:
    """(count, sum) of the values up to each cut of each (fit, column)."""
    out: dict[tuple[int, int], list] = {key: [] for key in cuts}
    asked = []
    for key, ms in cuts.items():
        for m in ms:
            n = s = 0
            for count, total, low, high in cells[key[1]]:
                if high <= m:
                    n, s = n + count, s + total
                elif low <= m:
                    asked.append((key, len(out[key]), low, m))
            out[key].append((n, s))
    if asked:
        parts = [(F.col("c") == c) & (F.col("x") >= low) & (F.col("x") <= m) for (_, c), _, low, m in asked]
        some = parts[0]
        for p in parts[1:]:
            some = some | p
        # a row is dealt to the cuts it lies below: two aggregates for any number of cuts
        cut = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("c"), F.lit(low).alias("low"), F.lit(m).alias("m"))
                                  for i, ((_, c), _, low, m) in enumerate(asked)]))
        met = values.where(some).select("c", "x", "n", cut.alias("_a")).where("c = _a.c AND x >= _a.low AND x <= _a.m")
        for r in met.groupBy("_a.i").agg(F.sum("n").alias("n"), F.sum(F.col("x") * F.col("n")).alias("s")).collect():
            key, k, _, _ = asked[r["i"]]
            n, s = out[key][k]
            out[key][k] = (n + r["n"], s + r["s"])
    return out


def sorted_values(df: DataFrame, cols: Sequence[str], cells: int = CELLS) -> Held:
    """One pass over ``df``; the rest follows from its distinct values."""
    xs = [F.col(c).cast("double") for c in cols]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), x.alias("x")) for i, x in enumerate(xs)])).alias("v"))
    counts = long.select("v.c", "v.x").where(F.col("x").isNotNull()).groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
    every = shared_table(counts.repartitionByRange("c", "x").sortWithinPartitions("c", "x"), "values")
    number = finite(F.col("x")).isNotNull()
    odd = {(r["c"], str(r["x"])): r["n"] for r in every.where(~number).collect()}
    values = every.where(number)
    stats = {r["c"]: r for r in values.groupBy("c").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n").alias("n"), F.sum(F.col("x") * F.col("n")).alias("s"),
        F.sum(F.col("x") * F.col("x") * F.col("n")).alias("q")).collect()}
    return Held(values, stats, _cells(values, {c: (r["low"], r["high"]) for c, r in stats.items()}, cells),
                {i: tuple(odd.get((i, k), 0) for k in ("-inf", "inf", "nan")) for i in range(len(cols))})


def lloyd_1d(df: DataFrame, cols: Sequence[str], starts: dict[str, list[float]], cells: int = CELLS,
             rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> dict[str, list[float]]:
    """Final centres of every column of ``starts`` (ascending), over its finite values."""
    cols = [c for c in cols if c in starts]
    return lloyd_fits(cols, [starts], sorted_values(df, cols, cells), rounds, tolerance)[0] if cols else {}


def lloyd_fits(cols: Sequence[str], fits: Sequence[Mapping[str, list[float]]], held: Held,
               rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> list[dict[str, list[float]]]:
    """``lloyd_1d`` from several starts over ``held``, the ``sorted_values`` of ``cols``: a round serves all fits that still move."""
    values, stats, table, _ = held
    centres = {(j, i): [float(v) for v in starts[c]] for j, starts in enumerate(fits) for i, c in enumerate(cols) if c in starts and i in stats}
    limit = {c: tolerance * max(0.0, r["q"] / r["n"] - (r["s"] / r["n"]) ** 2) for c, r in stats.items()}
    moving = set(centres)
    for _ in range(rounds):
        below = _below(values, table, {key: midpoints(centres[key]) for key in moving})
        for key in list(moving):
            c = key[1]
            upto = [(0, 0.0), *below[key], (stats[c]["n"], stats[c]["s"])]
            new = [(b[1] - a[1]) / (b[0] - a[0]) if b[0] > a[0] else old
                   for a, b, old in zip(upto[:-1], upto[1:], centres[key], strict=True)]
            shift = sum((a - b) ** 2 for a, b in zip(new, centres[key], strict=True))
            centres[key] = new
            if shift <= limit[c]:
                moving.discard(key)
        if not moving:
            break
    return [{c: sorted(centres[j, i]) for i, c in enumerate(cols) if (j, i) in centres} for j in range(len(fits))]
