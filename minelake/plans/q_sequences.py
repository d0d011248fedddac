"""Catalogue: binning, feature ranking and sequence generation.

Numeric feature table: lineitem rows with return flag A or R (two classes),
features quantity/extendedprice/discount/tax (renamed so the text before
the first '_' of an item is the feature name, as the reference assumes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bins as BN
from ..operators import rank as RK
from .registry import query, r6, read

FEATURES = {"quantity": "l_quantity", "extendedprice": "l_extendedprice",
            "discount": "l_discount", "tax": "l_tax"}
FEATS = list(FEATURES)
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
N_BINS = 3
TOP_K = 10
MAX_LEN = 5
ZSCORE_K = 3
POSITIVE = "A"


def feature_table(spark: SparkSession, sf: str, every: bool = False) -> DataFrame:
    """The two classes A and R, or with ``every`` all rows (what needs no classes)."""
    li = read(spark, sf, "lineitem")
    return ((li if every else li.where(F.col("l_returnflag").isin("A", "R")))
            .select(*KEYS, *[F.col(v).alias(k) for k, v in FEATURES.items()],
                    F.col("l_returnflag").alias("label")))


def binned(spark: SparkSession, sf: str, strategy: str = "quantile", n_bins: int = N_BINS, every: bool = False):
    ft = feature_table(spark, sf, every)
    edges = BN.fit_bins(ft, FEATS, n_bins, strategy)
    return ft, edges, BN.apply_bins(ft, edges)


# ------------------------------------------------------------------ SQL pieces

_FT = ("ft AS MATERIALIZED (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey, l_suppkey, " +
       ", ".join(f"{v} AS {k}" for k, v in FEATURES.items()) +
       ", l_returnflag AS label FROM lineitem WHERE l_returnflag IN ('A', 'R'))")
_KEYS = ", ".join(KEYS)


def _equal_width_sql(n: int, low: str, high: str) -> str:
    return "[" + ", ".join(f"{low} + {k} * (({high} - {low}) / {n})" for k in range(n)) + f", {high}]"


def _kmeans_sql(n: int) -> str:
    """CTEs up to ``ed``: Lloyd's rounds on (value, count) groups as a recursive query."""
    long = " UNION ALL ".join(f"SELECT '{f}' AS f, {f}::DOUBLE AS x FROM ft WHERE isfinite({f}::DOUBLE)" for f in FEATS)
    mids = [f"round((cs[{j}] + cs[{j + 1}]) / 2, 9)" for j in range(1, n)]
    inside = [" AND ".join([f"x > {m}" for m in mids[max(0, j - 1):j]] + [f"x <= {m}" for m in mids[j:j + 1]]) or "TRUE" for j in range(n)]
    moved = ", ".join(f"coalesce(sum(x * n) FILTER (WHERE {w}) / sum(n) FILTER (WHERE {w}), cs[{j + 1}])" for j, w in enumerate(inside))
    starts = ", ".join(f"(w[{k}] + w[{k + 1}]) / 2" for k in range(1, n + 1))
    shift = " + ".join(f"pow(new[{j}] - cs[{j}], 2)" for j in range(1, n + 1))
    edges = ", ".join(f"round((cs[{j}] + cs[{j + 1}]) / 2, 9)" for j in range(1, n))
    return f"""g AS MATERIALIZED (SELECT f, x, count(*)::DOUBLE AS n FROM ({long}) GROUP BY ALL),
ks AS MATERIALIZED (SELECT f, min(x) AS low, max(x) AS high, {_equal_width_sql(n, 'min(x)', 'max(x)')} AS w,
  1e-4 * greatest(0, sum(x * x * n) / sum(n) - pow(sum(x * n) / sum(n), 2)) AS tol FROM g GROUP BY f),
st AS (SELECT f, 0 AS it, [{starts}] AS cs, 'inf'::DOUBLE AS shift, tol FROM ks UNION ALL
  SELECT f, it + 1, new, {shift}, tol FROM (
    SELECT st.f, it, tol, cs, [{moved}] AS new FROM st JOIN g ON g.f = st.f WHERE it < 300 AND shift > tol GROUP BY st.f, it, tol, cs)),
ke AS (SELECT f, [low, {edges}, high] AS e FROM (SELECT f, max_by(cs, it) AS cs FROM st GROUP BY f) JOIN ks USING (f)),
ed AS (SELECT {", ".join(f"(SELECT e FROM ke WHERE f = '{f}') AS e_{f}" for f in FEATS)})"""


def _edges_sql(strategy: str, n: int = N_BINS) -> str:
    if strategy == "kmeans":
        return _kmeans_sql(n)
    if strategy == "quantile":
        probs = ", ".join(["0", *(f"{k}/{n}" for k in range(1, n)), "1"])
        parts = ", ".join(f"quantile_cont({f}, [{probs}]) AS e_{f}" for f in FEATS)
    else:
        parts = ", ".join(f"{_equal_width_sql(n, f'min({f})', f'max({f})')} AS e_{f}" for f in FEATS)
    return f"ed AS (SELECT {parts} FROM ft)"


def _bins_sql(strategy: str, every: bool = False, n: int = N_BINS) -> str:
    ft = _FT.replace(" WHERE l_returnflag IN ('A', 'R')", "") if every else _FT
    # equal edges are one edge
    cols = ", ".join(f"CAST(len(list_filter(list_sort(list_distinct(e_{f}))[2:-2], lambda e: {f} >= e)) AS INTEGER) AS {f}" for f in FEATS)
    return f"WITH RECURSIVE {ft}, {_edges_sql(strategy, n)}, b AS MATERIALIZED (SELECT rid, {_KEYS}, label, {cols} FROM ft, ed)\n"


def _labels_sql(n: int) -> str:
    return "[" + ", ".join(f"'{x}'" for x in BN.bin_labels(n)) + "]"


_LABELS = _labels_sql(N_BINS)
_LONG = " UNION ALL ".join(
    f"SELECT rid, {_KEYS}, label, '{f}' AS feature, {f} AS bin FROM b" for f in FEATS)
_MI = f"""lb AS ({_LONG}),
j AS (SELECT feature, bin, label, CAST(count(*) AS DOUBLE) AS n_bc FROM lb GROUP BY ALL),
t AS (SELECT feature, sum(n_bc) AS n FROM j GROUP BY 1),
pb AS (SELECT feature, bin, sum(n_bc) AS n_b FROM j GROUP BY 1, 2),
pc AS (SELECT feature, label, sum(n_bc) AS n_c FROM j GROUP BY 1, 2),
mi AS (SELECT feature, sum(n_bc / n * ln(n_bc * n / (n_b * n_c))) AS score
       FROM j JOIN t USING (feature) JOIN pb USING (feature, bin) JOIN pc USING (feature, label) GROUP BY 1),
mir AS (SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) AS rnk FROM mi)"""

_ZSTATS = ", ".join(f"avg({f}::DOUBLE) AS m_{f}, avg({f}::DOUBLE * {f}::DOUBLE) AS q_{f}" for f in FEATS)
_ZSD = ", ".join(f"m_{f}, CASE WHEN q_{f} - m_{f} * m_{f} > 0 THEN sqrt(q_{f} - m_{f} * m_{f}) ELSE 1.0 END AS s_{f}"
                 for f in FEATS)
_ZLONG = " UNION ALL ".join(
    f"SELECT rid, {_KEYS}, label, '{f}' AS feature, {f} AS bin, abs(({f} - m_{f}) / s_{f}) AS z FROM b, zs" for f in FEATS)
_Z = f"""zs0 AS (SELECT {_ZSTATS} FROM b), zs AS (SELECT {_ZSD} FROM zs0),
zl AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY z DESC, feature) AS rn FROM ({_ZLONG}))"""


# ------------------------------------------------------------------ bins

@query("bins_uniform", _bins_sql("uniform", every=True) + f"SELECT {_KEYS}, {', '.join(FEATS)} FROM b")
def bins_uniform(spark: SparkSession, sf: str) -> DataFrame:
    """FE1/FE4: equal-width ordinal bins."""
    _ft, _e, b = binned(spark, sf, "uniform", every=True)
    return b.select(*KEYS, *FEATS)


@query("bins_quantile", _bins_sql("quantile", every=True) + f"SELECT {_KEYS}, {', '.join(FEATS)} FROM b")
def bins_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """FE2/FE4: exact-quantile ordinal bins."""
    _ft, _e, b = binned(spark, sf, "quantile", every=True)
    return b.select(*KEYS, *FEATS)


@query("bin_labels", _bins_sql("quantile", every=True) + f"SELECT {_KEYS}, " +
       ", ".join(f"{_LABELS}[{f} + 1] AS {f}" for f in FEATS) + " FROM b")
def bin_labels(spark: SparkSession, sf: str) -> DataFrame:
    """FE5/FN10: bin labels low/medium/high."""
    ft = feature_table(spark, sf, every=True)
    edges = BN.fit_bins(ft, FEATS, N_BINS, "quantile")
    return BN.apply_labels(ft, edges, N_BINS).select(*KEYS, *FEATS)


@query("bins_kmeans", _bins_sql("kmeans", every=True) + f"SELECT {_KEYS}, {', '.join(FEATS)} FROM b")
def bins_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    """FE3/FE4: exact 1-D k-means ordinal bins."""
    _ft, _e, b = binned(spark, sf, "kmeans", every=True)
    return b.select(*KEYS, *FEATS)


# ------------------------------------------------------------------ ranking

def mi_scores(spark: SparkSession, sf: str) -> DataFrame:
    _ft, _e, b = binned(spark, sf, every=True)
    return RK.mutual_info(b, FEATS, "label")


@query("rank_mutual_info", _bins_sql("quantile", every=True) + "," + _MI +
       "\nSELECT feature, round(score, 6) AS score, CAST(rnk AS INTEGER) AS rank FROM mir")
def rank_mutual_info(spark: SparkSession, sf: str) -> DataFrame:
    """FE6: plug-in mutual information per binned feature, ranked."""
    from pyspark.sql import Window

    mi = mi_scores(spark, sf)
    w = Window.orderBy(F.desc("score"), "feature")
    return mi.select("feature", r6("score").alias("score"), F.row_number().over(w).cast("int").alias("rank"))


@query("rank_correlation", _bins_sql("quantile", every=True) +
       "SELECT feature, round(score, 6) AS score FROM (" + " UNION ALL ".join(
           f"SELECT '{f}' AS feature, abs(corr({f}::DOUBLE, CASE WHEN label = '{POSITIVE}' THEN 1.0 ELSE 0.0 END)) AS score FROM b"
           for f in FEATS) + ")")
def rank_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """FE8: |corr(bin, class)| per feature (the documented 'correlation' method)."""
    _ft, _e, b = binned(spark, sf, every=True)
    return RK.correlation_scores(b, FEATS, "label", POSITIVE).select("feature", r6("score").alias("score"))


@query("rank_zscore_rows", _bins_sql("quantile", every=True) + "," + _Z +
       f"\nSELECT {_KEYS}, string_agg(feature, ',' ORDER BY rn) AS ranked FROM zl WHERE rn <= {ZSCORE_K} GROUP BY rid, {_KEYS}")
def rank_zscore_rows(spark: SparkSession, sf: str) -> DataFrame:
    """WIN3: per-row top features by |z| of the bin ordinals."""
    _ft, _e, b = binned(spark, sf, every=True)
    stats = RK.moments(b, FEATS)
    r = RK.top_features_per_row(b, stats, ZSCORE_K)
    return r.select(*KEYS, F.array_join("ranked", ",").alias("ranked"))


# ------------------------------------------------------------------ sequences

def labelled(spark: SparkSession, sf: str, strategy: str = "quantile", n_bins: int = N_BINS, every: bool = False):
    ft = feature_table(spark, sf, every)
    edges = BN.fit_bins(ft, FEATS, n_bins, strategy)
    return BN.apply_bins(ft, edges), BN.apply_labels(ft, edges, n_bins)


def global_sequences(spark: SparkSession, sf: str, top_k: int = TOP_K, max_len: int = MAX_LEN,
                     strategy: str = "quantile", n_bins: int = N_BINS, every: bool = False) -> DataFrame:
    """FE9 pipeline: fit bins, MI order on ordinals, sequences from labels."""
    b, lab = labelled(spark, sf, strategy, n_bins, every)
    order = RK.global_order(RK.mutual_info(b, FEATS, "label"), min(top_k, max_len))
    return RK.sequences_global(lab, order)


def row_sequences(spark: SparkSession, sf: str, top_k: int = TOP_K, max_len: int = MAX_LEN,
                  strategy: str = "quantile", n_bins: int = N_BINS, rank_on: str = "bins",
                  every: bool = False) -> DataFrame:
    """FE10 pipeline: per-row |z| order, sequences from labels, all in one row.

    ``rank_on='bins'`` ranks bin ordinals with the population std (S8);
    ``rank_on='raw'`` ranks raw values with the sample std (FE11, notebook).
    """
    ft, edges, b = binned(spark, sf, strategy, n_bins, every)
    raw = rank_on == "raw"
    stats = RK.moments(ft if raw else b, FEATS, sample=raw)
    rows = BN.apply_labels(BN.apply_bins(ft, edges, "_bin"), edges, n_bins, "_label")
    ranked = RK.top_features_per_row(rows, stats, min(top_k, max_len), suffix="" if raw else "_bin")
    return RK.sequences_per_row(ranked, FEATS, "ranked", suffix="_label")


def counted_bins(spark: SparkSession, sf: str, configs) -> dict[tuple[str, int], DataFrame]:
    """Per (strategy, n_bins): (label, bins, ``n``), the distinct binned rows with their count, written once.
    All edges come from one fit and all bins from one count; sequences, scores and patterns follow from these few rows."""
    ft = feature_table(spark, sf)
    return BN.count_bins(ft, ["label"], FEATS, BN.fit_many(ft, FEATS, configs))


def counted_sequences(b: DataFrame, n_bins: int, method: str = "mutual_info", top_k: int = TOP_K, max_len: int = MAX_LEN) -> DataFrame:
    """FE9 or (``zscore``) FE10 on counted bins: (label, n, sequence), as ``global_sequences`` and ``row_sequences``."""
    k = min(top_k, max_len)
    if method == "zscore":
        rows = b.select("label", "n", *[F.col(c).alias(c + "_bin") for c in FEATS], *[BN.label_expr(F.col(c), n_bins).alias(c + "_label") for c in FEATS])
        ranked = RK.top_features_per_row(rows, RK.moments(b, FEATS, weight="n"), k, suffix="_bin")
        return RK.sequences_per_row(ranked, FEATS, "ranked", suffix="_label")
    order = RK.global_order(RK.mutual_info(b, FEATS, "label", "n"), k)
    return RK.sequences_global(b.select("label", "n", *[BN.label_expr(F.col(c), n_bins).alias(c) for c in FEATS]), order)


def _lab_long(n: int = N_BINS) -> str:
    return " UNION ALL ".join(f"SELECT rid, {_KEYS}, label, '{f}' AS feature, {_labels_sql(n)}[{f} + 1] AS lab FROM b" for f in FEATS)


_LAB_LONG = _lab_long()


@query("seq_global", _bins_sql("quantile", every=True) + "," + _MI + f""",
ll AS ({_LAB_LONG})
SELECT {_KEYS}, label, string_agg(ll.feature || '_' || lab, ',' ORDER BY rnk) AS sequence
FROM ll JOIN mir USING (feature) WHERE rnk <= {min(TOP_K, MAX_LEN)} GROUP BY rid, {_KEYS}, label""")
def seq_global(spark: SparkSession, sf: str) -> DataFrame:
    """FE9: sequences in the global MI order (length = least(top_k, max_len))."""
    s = global_sequences(spark, sf, every=True)
    return s.select(*KEYS, "label", RK.sequence_text("sequence").alias("sequence"))


@query("seq_per_row", _bins_sql("quantile", every=True) + "," + _Z + f"""
SELECT {_KEYS}, label, string_agg(feature || '_' || {_LABELS}[bin + 1], ',' ORDER BY rn) AS sequence
FROM zl WHERE rn <= {min(TOP_K, MAX_LEN)} GROUP BY rid, {_KEYS}, label""")
def seq_per_row(spark: SparkSession, sf: str) -> DataFrame:
    """FE10: sequences in each row's own |z| order."""
    s = row_sequences(spark, sf, every=True)
    return s.select(*KEYS, "label", RK.sequence_text("sequence").alias("sequence"))


_RAW_STATS = ", ".join(f"avg({f}::DOUBLE) AS m_{f}, coalesce(nullif(stddev_samp({f}::DOUBLE), 0), 1.0) AS s_{f}" for f in FEATS)
_RAW_LONG = " UNION ALL ".join(
    f"SELECT b.rid, b.{_KEYS.replace(', ', ', b.')}, b.label, '{f}' AS feature, b.{f} AS bin, abs((ft.{f}::DOUBLE - m_{f}) / s_{f}) AS z "
    "FROM b JOIN ft USING (rid), rs" for f in FEATS)


@query("seq_per_row_raw", _bins_sql("quantile", every=True) + f""",
rs AS (SELECT {_RAW_STATS} FROM ft),
zl AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY z DESC, feature) AS rn FROM ({_RAW_LONG}))
SELECT {_KEYS}, label, string_agg(feature || '_' || {_LABELS}[bin + 1], ',' ORDER BY rn) AS sequence
FROM zl WHERE rn <= {min(TOP_K, MAX_LEN)} GROUP BY rid, {_KEYS}, label""")
def seq_per_row_raw(spark: SparkSession, sf: str) -> DataFrame:
    """FE11: sequences ordered by |z| of the raw values (sample std), labels
    from quantile bins."""
    s = row_sequences(spark, sf, rank_on="raw", every=True)
    return s.select(*KEYS, "label", RK.sequence_text("sequence").alias("sequence"))
