"""Exact quantiles (linear interpolation, like ``percentile_cont``) at any size.

Spark's exact ``percentile`` keeps a value->count map per group, so a global quantile
of a column with many values ends in one task that holds the column. Here no
value is shuffled but a few near the wanted ranks:

1. one scan counts the values of every column and builds a mergeable quantile sketch
   (``percentile_approx``), which brackets each wanted rank between two values;
2. one scan counts, for all brackets of all columns, the values below a bracket, at its
   lower end and inside it, so that every rank is known to lie at an end or inside;
3. brackets whose inside is small enough are read (a filter on the value and a grouped count),
   larger ones are sketched again, inside themselves. An inside is some 0.1 % of its
   bracket's rows, so even 10**12 rows take three rounds.

Where the distinct values are written and cut into cells already (``lloyd1d.sorted_values``), the
cells are the brackets: their counts name the cell of each wanted rank, and running counts inside those cells
give its value.

A bracket that does not hold its rank (the sketch's error is a bound in theory) widens to the
whole column. -Infinity, Infinity and NaN are counted apart and ordered as in
``percentile`` (NaN is the largest). The driver gets the sketches' grid and at most
``READ_ROWS`` distinct values a bracket.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import prefix_sum

#: sketch accuracy (rank error 1 / ACCURACY), its grid, and what a bracket may hold to be read
ACCURACY, GRID, READ_ROWS = 10_000, 1_000, 100_000


def _interpolated(position: float, at: dict[int, float]) -> float:
    """As ``percentile``: no arithmetic where both neighbours are one value."""
    lower, higher = math.floor(position), math.ceil(position)
    a, b = at[lower], at[higher]
    if lower == higher or a == b or (math.isnan(a) and math.isnan(b)):
        return a
    return (higher - position) * a + (position - lower) * b


def finite(x: Column) -> Column:
    """``x`` where it is a finite number, else null."""
    return F.when(~F.isnan(x) & (x > float("-inf")) & (x < float("inf")), x)


def _bracket(grid: Sequence[float], rank: int, n: int, accuracy: int) -> tuple[float, float]:
    """Grid values around ``rank`` of n sorted values, twice the sketch's error allowed for."""
    cells, slack = len(grid) - 1, 2 / accuracy
    low = max(0, math.floor((rank / n - slack) * cells))
    high = min(cells, math.ceil(((rank + 1) / n + slack) * cells))
    return grid[low], grid[high]


def _grids(df: DataFrame, xs: Sequence[Column], accuracy: int, cells: int) -> list[list[float]]:
    probs = F.array(*[F.lit(k / cells) for k in range(cells + 1)])
    row = df.agg(*[F.percentile_approx(x, probs, F.lit(accuracy)).alias(f"g_{i}") for i, x in enumerate(xs)]).first()
    return [row[f"g_{i}"] for i in range(len(xs))]


def _ranked(df: DataFrame, wanted: dict[tuple[int, int], tuple[float, float, int, int]], xs: Sequence[Column], ends: dict[int, tuple[float, float]],
            accuracy: int, cells: int, read_rows: int) -> dict[tuple[int, int], float]:
    """Value at each (column, rank); ``wanted`` gives its bracket (low, high)."""
    found: dict[tuple[int, int], float] = {}
    while wanted:
        brackets = sorted({(c, *b) for (c, _), b in wanted.items()})
        aggs = []
        for j, (c, low, high) in enumerate(brackets):
            x = xs[c]
            aggs += [F.count_if(x < low).alias(f"b_{j}"), F.count_if(x == low).alias(f"l_{j}"),
                     F.count_if((x > low) & (x < high)).alias(f"i_{j}"), F.count_if(x == high).alias(f"h_{j}")]
        row = df.agg(*aggs).first()
        inside: dict[int, list[int]] = {}
        again: dict[tuple[int, int], tuple[float, float]] = {}
        for (c, r), (low, high) in wanted.items():
            j = bisect_left(brackets, (c, low, high))
            first = row[f"b_{j}"]
            mid = first + row[f"l_{j}"]
            last = mid + row[f"i_{j}"]
            if r < first or r >= last + row[f"h_{j}"] * (high > low):
                if first <= r < mid:
                    found[c, r] = low
                else:
                    again[c, r] = ends[c]
            elif r < mid:
                found[c, r] = low
            elif r >= last:
                found[c, r] = high
            else:
                inside.setdefault(j, []).append(r)
        small = [j for j in inside if row[f"i_{j}"] <= read_rows]
        large = [j for j in inside if row[f"i_{j}"] > read_rows]
        if small:
            cells_of = [F.when((xs[c] > low) & (xs[c] < high), F.struct(F.lit(j).alias("j"), xs[c].alias("x"))) for j in small for c, low, high in [brackets[j]]]
            values = df.select(F.explode(F.filter(F.array(*cells_of), lambda v: v.isNotNull())).alias("v"))
            held: dict[int, list] = {}
            for v in values.groupBy("v.j", "v.x").agg(F.count(F.lit(1)).alias("n")).collect():
                held.setdefault(v["j"], []).append((v["x"], v["n"]))
            for j in small:
                upto = row[f"b_{j}"] + row[f"l_{j}"]
                ranks = sorted(inside[j], reverse=True)
                for x, n in sorted(held[j]):
                    upto += n
                    while ranks and ranks[-1] < upto:
                        found[brackets[j][0], ranks.pop()] = x
        if large:
            some = [F.when((xs[c] > low) & (xs[c] < high), xs[c]) for j in large for c, low, high in [brackets[j]]]
            for j, grid in zip(large, _grids(df, some, accuracy, cells), strict=True):
                for r in inside[j]:
                    again[brackets[j][0], r] = _bracket(grid, r - row[f"b_{j}"] - row[f"l_{j}"], row[f"i_{j}"], accuracy)
        wanted = again
    return found


def _counted(df: DataFrame, xs: Sequence[Column], fs: Sequence[Column], accuracy: int, cells: int):
    """Per column its values, finite values, infinities, ends and sketch, in one scan."""
    grid_probs = F.array(*[F.lit(k / cells) for k in range(cells + 1)])
    aggs = []
    for i, (x, f) in enumerate(zip(xs, fs, strict=True)):
        aggs += [F.count(x).alias(f"n_{i}"), F.count(f).alias(f"f_{i}"), F.count_if(x == float("-inf")).alias(f"m_{i}"), F.count_if(x == float("inf")).alias(f"p_{i}"),
                 F.min(f).alias(f"mn_{i}"), F.max(f).alias(f"mx_{i}"), F.percentile_approx(f, grid_probs, F.lit(accuracy)).alias(f"g_{i}")]
    return df.agg(*aggs).first()


def _held_ranks(held, wanted: Sequence[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """Value at each (column, rank) from the written distinct values and their cells."""
    found: dict[tuple[int, int], float] = {}
    asked: dict[int, dict[int, list[int]]] = {}
    before = {c: [0, *accumulate(cell[0] for cell in cells)] for c, cells in held.cells.items()}
    for c, r in wanted:
        k = bisect_right(before[c], r) - 1
        _, _, low, high = held.cells[c][k]
        if low == high:
            found[c, r] = low
        else:
            asked.setdefault(c, {}).setdefault(k, []).append(r)
    if not asked:
        return found
    # ranks among the rows of the asked cells, which are read in order
    ranks: dict[int, dict[int, int]] = {}
    some, hit = F.lit(False), F.lit(False)
    for c, cells in asked.items():
        read, ranks[c] = 0, {}
        for k in sorted(cells):
            n, _, low, high = held.cells[c][k]
            ranks[c] |= {r - before[c][k] + read: r for r in cells[k]}
            read += n
            some = some | ((F.col("c") == c) & (F.col("x") >= low) & (F.col("x") <= high))
        places = F.array(*[F.lit(p).cast("long") for p in ranks[c]])
        hit = hit | ((F.col("c") == c) & F.exists(places, lambda p: (p >= F.col("upto") - F.col("n")) & (p < F.col("upto"))))
    for row in prefix_sum(held.values.where(some), ["c"], ["x"], "n", "upto").where(hit).collect():
        found |= {(row["c"], r): row["x"] for p, r in ranks[row["c"]].items() if row["upto"] - row["n"] <= p < row["upto"]}
    return found


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    accuracy: int = ACCURACY, cells: int = GRID, read_rows: int = READ_ROWS, held=None) -> dict[str, list]:
    """Exact linear-interpolated quantiles of each column, nulls ignored.

    ``held``: ``lloyd1d.sorted_values`` of the same columns, if written already; then no row is read again.
    Returns ``{col: [q(p) for p in probs]}``; all-null columns and empty tables give ``None``.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    xs = [F.col(c).cast("double") for c in cols]
    fs = [finite(x) for x in xs]
    if held:
        row = {}
        for i in range(len(cols)):
            r, (minus, plus, nan) = held.stats.get(i), held.odd[i]
            nf = r["n"] if r else 0
            row |= {f"n_{i}": nf + minus + plus + nan, f"f_{i}": nf, f"m_{i}": minus, f"p_{i}": plus, f"mn_{i}": r and r["low"], f"mx_{i}": r and r["high"]}
    else:
        row = _counted(df, xs, fs, accuracy, cells)
    places, wanted, ends = [], {}, {}
    at: list[dict[int, float]] = [{} for _ in cols]
    for i in range(len(cols)):
        n, nf, minus, plus = (row[f"{k}_{i}"] for k in "nfmp")
        places.append([(n - 1) * p for p in probs] if n else [])
        ends[i] = (row[f"mn_{i}"], row[f"mx_{i}"])
        for r in {r for h in places[i] for r in (math.floor(h), math.ceil(h))}:
            k = r - minus
            if k < 0:
                at[i][r] = float("-inf")
            elif k >= nf:
                at[i][r] = float("inf") if k < nf + plus else float("nan")
            elif k in (0, nf - 1):
                at[i][r] = ends[i][k > 0]
            else:
                wanted[i, k] = None if held else _bracket(row[f"g_{i}"], k, nf, accuracy)
    ranked = _held_ranks(held, list(wanted)) if held else _ranked(df, wanted, fs, ends, accuracy, cells, read_rows)
    for (i, k), x in ranked.items():
        at[i][k + row[f"m_{i}"]] = x
    return {c: [_interpolated(h, at[i]) for h in places[i]] or [None] * len(probs) for i, c in enumerate(cols)}
