"""Baskets from wide or long records (PRJ1, FLT1, AGG1-AGG5, AGG12-AGG14).

Wide rows (key + N item columns) become long (key, slot, item) rows with one
``stack`` projection: no shuffle. Group baskets are one ``groupBy`` with a
partial ``collect_set`` per map task, so a hot key only ships its distinct
items, never all of its rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicons
from ..functions.terms import normalise_term
from ..plans.joins import shared_table


def item_columns(df: DataFrame, marker: str = "Symptom") -> list[str]:
    """PRJ1: columns whose name contains ``marker`` or lowercase-starts with it."""
    low = marker.lower()
    return [c for c in df.columns if marker in c or c.lower().startswith(low)]


def unpivot_items(df: DataFrame, key: str | Sequence[str], item_cols: Sequence[str],
                  synonyms: Mapping[str, str] | Column | None = lexicons.SYMPTOM_SYNONYMS,
                  slot_col: str = "slot", item_col: str = "item") -> DataFrame:
    """Wide -> long with FN2 applied; empty and null items dropped (FLT1).

    ``slot`` is the 1-based position of the source column, which keeps the
    row's item order for row baskets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    pairs = ", ".join(f"{i + 1}, CAST(`{c}` AS STRING)" for i, c in enumerate(item_cols))
    long = df.select(*keys, F.expr(f"stack({len(item_cols)}, {pairs}) AS ({slot_col}, _raw)"))
    norm = normalise_term("_raw", synonyms) if synonyms is not None else F.col("_raw")
    out = long.withColumn(item_col, norm).drop("_raw")
    cond = F.col(item_col).isNotNull() & (F.col(item_col) != "")
    for k in keys:
        cond = cond & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    return out.where(cond)


def group_baskets(long: DataFrame, key: str | Sequence[str], item_col: str = "item",
                  out: str = "items") -> DataFrame:
    """AGG1/AGG3: one basket per key, sorted distinct items."""
    keys = [key] if isinstance(key, str) else list(key)
    return (long.groupBy(*keys)
                .agg(F.sort_array(F.collect_set(item_col)).alias(out))
                .where(F.size(out) > 0))


def row_baskets(long: DataFrame, key: str | Sequence[str], order_col: str = "slot",
                item_col: str = "item", out: str = "items",
                distinct: bool = True) -> DataFrame:
    """AGG2: one basket per row key, items in slot order.

    ``distinct=True`` keeps the first occurrence of each item, which the
    miners need (FPGrowth rejects duplicates). The group is one logical row,
    so it is bounded by the row width.
    """
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                F.col(item_col).alias("v"))))
    items = F.transform(agg, lambda s: s["v"])
    if distinct:
        items = F.array_distinct(items)
    return long.groupBy(*keys).agg(items.alias(out)).where(F.size(out) > 0)


def basket_stats(baskets: DataFrame, items_col: str = "items",
                 min_transactions: int = 10) -> DataFrame:
    """AGG4 + AGG5: count, total and mean items; flag below the minimum."""
    res = baskets.agg(
        F.count(F.lit(1)).alias("n_baskets"),
        F.coalesce(F.sum(F.size(items_col)), F.lit(0)).cast("long").alias("total_items"),
        F.avg(F.size(items_col)).alias("avg_items"),
    ).withColumn("below_min_transactions", F.col("n_baskets") < F.lit(min_transactions))
    return res


def warn_if_few(stats: DataFrame, min_transactions: int = 10) -> None:
    """AGG5 side effect: the reference warns when baskets are few."""
    row = stats.select("n_baskets").first()
    if row is not None and row[0] < min_transactions:
        warnings.warn(f"Only {row[0]} transactions found. Minimum recommended: "
                      f"{min_transactions}.", UserWarning, stacklevel=2)


def value_distribution(df: DataFrame, col: str, out_count: str = "n",
                       out_share: str = "share") -> DataFrame:
    """AGG13: counts and share per value. The counts are written once; their total is one number."""
    counts = shared_table(df.groupBy(col).agg(F.count(F.lit(1)).alias(out_count)), "values")
    total = counts.agg(F.sum(out_count)).first()[0]
    return counts.withColumn(out_share, F.col(out_count) / F.lit(total))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ5: names of numeric columns, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """PRJ2: one aggregate counts non-nulls per column; drop the empty ones."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def missing_and_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG14: per column, missing count and exact median (long form).

    Exact medians go through ``operators.quantiles.exact_quantiles`` which
    ranks grouped values instead of collecting a whole column.
    """
    from .quantiles import exact_quantiles

    miss = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    med = exact_quantiles(df, cols, [0.5])
    rows = [(c, int(miss[c]), med[c][0]) for c in cols]
    schema = "column string, n_missing long, median double"
    return df.sparkSession.createDataFrame(rows, schema)


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRC3 fill step: nulls -> exact column median (a projection, no shuffle)."""
    from .quantiles import exact_quantiles

    med = exact_quantiles(df, cols, [0.5])
    return df.fillna({c: med[c][0] for c in cols if med[c][0] is not None})
