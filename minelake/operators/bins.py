"""Discretisation (FE1-FE5, FN10): fit edges with one aggregate, apply as a
projection.

Fitting needs only per-feature statistics (min/max, exact quantiles, or an
exact 1-D k-means), so the driver holds ``n_features x (n_bins+1)`` numbers. The
transform is a column expression (a sum of ``x >= edge`` tests), so it fuses
into whole-stage codegen with no shuffle.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import shared_table
from .lloyd1d import lloyd_1d, lloyd_fits, midpoints, sorted_values
from .quantiles import exact_quantiles, finite

EDGE_EPS = 1e-8


def bin_labels(n_bins: int) -> list[str]:
    """FN10: low/medium/high for three bins, else bin_0..bin_{n-1}."""
    return ["low", "medium", "high"] if n_bins == 3 else [f"bin_{i}" for i in range(n_bins)]


def _drop_close(edges: list[float]) -> list[float]:
    """Remove edges closer than 1e-8 to the previous kept one."""
    out: list[float] = []
    for e in edges:
        if not out or e - out[-1] > EDGE_EPS:
            out.append(e)
    return out


def _finite_ends(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest finite value of every column that has one."""
    xs = [finite(F.col(c).cast("double")) for c in cols]
    row = df.agg(*[F.min(x).alias(f"mn_{i}") for i, x in enumerate(xs)], *[F.max(x).alias(f"mx_{i}") for i, x in enumerate(xs)]).first()
    return {c: (row[f"mn_{i}"], row[f"mx_{i}"]) for i, c in enumerate(cols) if row[f"mn_{i}"] is not None}


def _equal_width(low: float, high: float, n_bins: int) -> list[float]:
    step = (high - low) / n_bins
    return [low + k * step for k in range(n_bins)] + [high]


def fit_uniform(df: DataFrame, cols: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    """FE1: equal-width edges from one min/max aggregate over the finite values.

    A constant column gets one bin, a column without a finite value no edges."""
    ends = _finite_ends(df, cols)
    return {c: (_equal_width(*ends[c], n_bins) if ends[c][0] < ends[c][1] else list(ends[c])) if c in ends else [] for c in cols}


def _kept_edges(c: str, edges: list[float], n_bins: int) -> list[float]:
    kept = _drop_close(edges)
    if len(kept) - 1 != n_bins:
        warnings.warn(f"bins whose width is too small in feature {c} are removed; "
                      f"{len(kept) - 1} bins remain", UserWarning, stacklevel=3)
    return kept


def fit_quantile(df: DataFrame, cols: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    """FE2: exact quantile edges (linear), near-duplicate edges dropped.

    Infinities and NaN count as ordered values; an all-null column has no edges."""
    probs = [k / n_bins for k in range(n_bins + 1)]
    q = exact_quantiles(df, cols, probs)
    return {c: _kept_edges(c, [float(v) for v in q[c]], n_bins) if q[c][0] is not None else [] for c in cols}


def fit_kmeans(df: DataFrame, cols: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    """FE3: 1-D k-means per feature over its finite values, started at the centres of the
    equal-width bins; edges are the midpoints of the sorted centres, near-duplicates
    dropped. A column without a finite value has no edges."""
    ends = _finite_ends(df, cols)
    return _kmeans_edges(cols, n_bins, ends, lloyd_1d(df, cols, _kmeans_starts(cols, n_bins, ends)))


def _kmeans_starts(cols: Sequence[str], n_bins: int, ends: Mapping[str, tuple[float, float]]) -> dict[str, list[float]]:
    starts = {}
    for c in (c for c in cols if c in ends):
        low, high = ends[c]
        e = _equal_width(low, high, n_bins)
        starts[c] = [(a + b) / 2 for a, b in zip(e[:-1], e[1:], strict=True)]
    return starts


def _kmeans_edges(cols: Sequence[str], n_bins: int, ends: Mapping[str, tuple[float, float]], centres: Mapping[str, list[float]]) -> dict[str, list[float]]:
    return {c: _kept_edges(c, [ends[c][0], *midpoints(centres[c]), ends[c][1]], n_bins) if c in ends else [] for c in cols}


def fit_bins(df: DataFrame, cols: Sequence[str], n_bins: int = 3,
             strategy: str = "quantile") -> dict[str, list[float]]:
    if strategy == "uniform":
        return fit_uniform(df, cols, n_bins)
    if strategy == "quantile":
        return fit_quantile(df, cols, n_bins)
    if strategy == "kmeans":
        return fit_kmeans(df, cols, n_bins)
    raise ValueError(f"unknown strategy {strategy!r}")


def fit_many(df: DataFrame, cols: Sequence[str], configs: Sequence[tuple[str, int]]) -> dict[tuple[str, int], dict[str, list[float]]]:
    """``fit_bins`` of several (strategy, n_bins) with the passes of one: all quantiles are one search, the
    least and greatest values one aggregate, and the k-means fits share their rounds. Where there is a k-means,
    its sorted distinct values serve the others too, and the rows are read once."""
    cols, out = list(cols), {}
    by = {s: sorted({n for t, n in configs if t == s}) for s, _ in configs}
    unknown = set(by) - {"uniform", "quantile", "kmeans"}
    if unknown:
        raise ValueError(f"unknown strategy {min(unknown)!r}")
    held = sorted_values(df, cols) if cols and "kmeans" in by else None
    if "quantile" in by:
        probs = {n: [k / n for k in range(n + 1)] for n in by["quantile"]}
        every = sorted({p for ps in probs.values() for p in ps})
        q = {c: dict(zip(every, vs, strict=True)) for c, vs in exact_quantiles(df, cols, every, held=held).items()}
        for n, ps in probs.items():
            out["quantile", n] = {c: _kept_edges(c, [float(q[c][p]) for p in ps], n) if q[c][0.0] is not None else [] for c in cols}
    if held:
        ends = {c: (held.stats[i]["low"], held.stats[i]["high"]) for i, c in enumerate(cols) if i in held.stats}
    else:
        ends = _finite_ends(df, cols) if cols and "uniform" in by else {}
    for n in by.get("uniform", ()):
        out["uniform", n] = {c: (_equal_width(*ends[c], n) if ends[c][0] < ends[c][1] else list(ends[c])) if c in ends else [] for c in cols}
    if "kmeans" in by:
        centres = lloyd_fits(cols, [_kmeans_starts(cols, n, ends) for n in by["kmeans"]], held) if held else [{} for _ in by["kmeans"]]
        for n, found in zip(by["kmeans"], centres, strict=True):
            out["kmeans", n] = _kmeans_edges(cols, n, ends, found)
    return out


def bin_expr(x: Column, edges: Sequence[float]) -> Column:
    """FE4: ordinal bin; an interior edge belongs to the upper bin; outside
    values clamp to the first/last bin (NaN is above all numbers); null stays null,
    and without edges (a column without values) every bin is null."""
    if not edges:
        return F.lit(None).cast("int")
    inner = list(edges[1:-1])
    if not inner:
        return F.when(x.isNotNull(), F.lit(0))
    acc = sum((F.when(x >= F.lit(float(e)), F.lit(1)).otherwise(F.lit(0)) for e in inner[1:]),
              F.when(x >= F.lit(float(inner[0])), F.lit(1)).otherwise(F.lit(0)))
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(acc.cast("int"))


def apply_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "") -> DataFrame:
    """FE4: replace (or add with ``suffix``) each feature by its bin ordinal."""
    out = df
    for c, e in edges.items():
        out = out.withColumn(c + suffix, bin_expr(F.col(c), e))
    return out


def _cell_expr(x: Column, edges: Sequence[float]) -> Column:
    """How many of the ascending ``edges`` are at most ``x``, by bisection (NaN is above all numbers, null stays null)."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(x >= F.lit(edges[mid]), between(mid + 1, high)).otherwise(between(low, mid))

    return F.when(x.isNotNull(), between(0, len(edges)))


def count_bins(df: DataFrame, by: Sequence[str], cols: Sequence[str], fits: Mapping[tuple, Mapping[str, Sequence[float]]]) -> dict[tuple, DataFrame]:
    """Per fit (its edges by column): (``by``, bins, ``n``), the distinct rows of ``apply_bins`` with their count, written.

    The rows are read once: they are counted by the cells between the edges of all fits together, and
    every bin is a union of such cells."""
    inner = {c: sorted({float(e) for edges in fits.values() for e in edges[c][1:-1]}) for c in cols}
    cells = shared_table(df.select(*by, *[_cell_expr(F.col(c), inner[c]).alias(c) for c in cols])
                         .groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("n")), "cells")
    out = {}
    for key, edges in fits.items():
        # the bin of each cell: the fit's inner edges up to the cell's lower end
        bins = {c: F.array(F.lit(0), *[F.lit(sum(e <= start for e in edges[c][1:-1])) for start in inner[c]]) for c in cols if edges[c]}
        binned = [(F.get(bins[c], F.col(c)) if c in bins else F.lit(None).cast("int")).alias(c) for c in cols]
        out[key] = shared_table(cells.select(*by, *binned, "n")
                                .groupBy(*by, *cols).agg(F.sum("n").alias("n")), "bins")
    return out


def label_expr(bin_col: Column, n_bins: int) -> Column:
    """FE5/FN10: ordinal -> label."""
    labels = F.array(*[F.lit(s) for s in bin_labels(n_bins)])
    return F.element_at(labels, bin_col + 1)


def apply_labels(df: DataFrame, edges: Mapping[str, Sequence[float]], n_bins: int,
                 suffix: str = "") -> DataFrame:
    out = df
    for c, e in edges.items():
        out = out.withColumn(c + suffix, label_expr(bin_expr(F.col(c), e), n_bins))
    return out
