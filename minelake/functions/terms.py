"""Term cleaning and normalisation as column expressions (FN1-FN5, FN16, JON1-2).

All functions return ``Column`` expressions built from Spark built-ins, so
they run inside whole-stage codegen. Fixed-size synonym maps become map
literals (no join at all); large user tables go through ``synonym_join``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicons

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A ``map<string,string>`` literal from a small fixed dict."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    parts: list[Column] = []
    for k, v in mapping.items():
        parts.extend([F.lit(k), F.lit(v)])
    return F.create_map(*parts)


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading and trailing whitespace (all kinds, like ``str.strip``)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def clean_term(c: ColumnOrName) -> Column:
    """FN1: null -> '', strip, then '_' -> ' ' (strip comes first)."""
    return F.coalesce(F.replace(strip_ws(c), F.lit("_"), F.lit(" ")), F.lit(""))


def lookup_one_hop(c: ColumnOrName, mapping: Mapping[str, str] | Column) -> Column:
    """JON1: look ``lower(c)`` up once; fall back to ``c`` with its case."""
    m = mapping if isinstance(mapping, Column) else map_literal(mapping)
    x = _col(c)
    return F.coalesce(F.element_at(m, F.lower(x)), x)


def normalise_term(c: ColumnOrName,
                   synonyms: Mapping[str, str] | Column = lexicons.SYMPTOM_SYNONYMS) -> Column:
    """FN2: clean, then one-hop synonym lookup on the lowercase text."""
    cleaned = clean_term(c)
    return F.when(cleaned == "", F.lit("")).otherwise(lookup_one_hop(cleaned, synonyms))


def feature_name(c: ColumnOrName,
                 synonyms: Mapping[str, str] | Column = lexicons.SYMPTOM_SYNONYMS) -> Column:
    """FN3: FN2, lower, '-' -> ' ', non [a-z0-9 space] -> ' ', space runs -> '_'."""
    x = F.lower(strip_ws(normalise_term(c, synonyms)))
    x = F.replace(x, F.lit("-"), F.lit(" "))
    x = F.regexp_replace(x, r"[^a-z0-9\s]", " ")
    x = F.regexp_replace(x, r"\s+", "_")
    return F.regexp_replace(x, r"^_+|_+$", "")


def feature_name_aliased(c: ColumnOrName,
                         synonyms: Mapping[str, str] | Column = lexicons.SYMPTOM_SYNONYMS,
                         aliases: Mapping[str, str] | Column = lexicons.FEATURE_ALIASES) -> Column:
    """FN4: FN3 then an exact alias lookup."""
    name = feature_name(c, synonyms)
    m = aliases if isinstance(aliases, Column) else map_literal(aliases)
    return F.coalesce(F.element_at(m, name), name)


def normalise_disease(c: ColumnOrName) -> Column:
    """FN5: strip, lower, collapse whitespace runs to one space."""
    return F.regexp_replace(F.lower(strip_ws(c)), r"\s+", " ")


def display_name(c: ColumnOrName) -> Column:
    """FN16: '_' -> ' '."""
    return F.replace(_col(c), F.lit("_"), F.lit(" "))


def synonym_join(df: DataFrame, term_col: str, synonyms: DataFrame,
                 raw_col: str = "raw", canonical_col: str = "canonical",
                 out: str = "normalised") -> DataFrame:
    """JON1 for a large synonym table: broadcast-checked left join + coalesce."""
    from ..plans.joins import bounded_broadcast

    syn = synonyms.select(F.col(raw_col).alias("_syn_raw"),
                          F.col(canonical_col).alias("_syn_canon"))
    cleaned = df.withColumn("_syn_clean", clean_term(term_col))
    joined = cleaned.join(bounded_broadcast(syn),
                          F.lower(F.col("_syn_clean")) == F.col("_syn_raw"), "left")
    return (joined.withColumn(out, F.when(F.col("_syn_clean") == "", F.lit(""))
                              .otherwise(F.coalesce("_syn_canon", "_syn_clean")))
            .drop("_syn_raw", "_syn_canon", "_syn_clean"))
