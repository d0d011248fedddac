"""Catalogue: sequential patterns, class contrast and sweeps.

Event sequences: one per (user, day), events ordered by (ts, event_id), one
event type per itemset; they hold repeats, which separates the compat
engine from PrefixSpan. Class sequences: the lineitem feature sequences of
``q_sequences`` (classes A and R). Patterns are mined to length 5; the oracle SQL
lists every distinct sequence's subsequences by position masks and counts them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contrast as CT
from ..operators import seqmine as SM
from ..operators import sweep as SW
from . import q_sequences as QS
from .registry import query, r6, read

EVENT_MIN_SUPPORT = 0.01
SUPPORT3_MIN_SUPPORT = 0.005
CLASS_MIN_SUPPORT = 0.05
MAX_LEN = 5
CLASS_A, CLASS_B = "A", "R"


def event_sequences(spark: SparkSession, sf: str) -> DataFrame:
    ev = read(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "ts", "event_id",
                                          "event_type")
    g = ev.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("evs"))
    return g.select("user_id", "day", F.transform("evs", lambda s: F.array(s["event_type"])).alias("sequence"))


def _fmt(df: DataFrame) -> DataFrame:
    return df.select(SM.pattern_text("pattern").alias("pattern"), "freq", r6("support").alias("support"),
                     F.col("level").cast("int").alias("level"), F.col("n_itemsets").cast("int").alias("n_itemsets"))


_EV = """ev AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type FROM events),
s AS (SELECT user_id, day, event_type, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS pos FROM ev),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, day FROM ev))"""


def _subsequences(source: str, by: str, rel: str) -> str:
    """CTE ``rel`` (by, pat, freq): the sequences of ``source`` (by, items) that hold
    each pattern of at most MAX_LEN items."""
    return f"""{rel}_d AS (SELECT {by}, items, count(*) AS c FROM {source} GROUP BY ALL),
{rel} AS (SELECT {by}, pat, sum(c) AS freq FROM (
  SELECT DISTINCT {by}, items, c, [items[i] for i in range(1, len(items) + 1) if (m >> (i - 1)) & 1 = 1] AS pat
  FROM (SELECT *, unnest(range(1, 1 << len(items))) AS m FROM {rel}_d) WHERE bit_count(m) <= {MAX_LEN}) GROUP BY {by}, pat)"""


def _braced(pat: str) -> str:
    return f"'{{' || array_to_string({pat}, '}} → {{') || '}}'"


_EV_FREQUENT = f"""WITH {_EV},
q AS (SELECT 0 AS one, list(event_type ORDER BY pos) AS items FROM s GROUP BY user_id, day),
{_subsequences('q', 'one', 'sub')},
f AS (SELECT pat, freq, freq / n AS support FROM sub, n WHERE freq / n >= {EVENT_MIN_SUPPORT})"""


def _ev_select(rel: str) -> str:
    return f"""
SELECT {_braced('pat')} AS pattern, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support,
       CAST(len(pat) AS INTEGER) AS level, CAST(len(pat) AS INTEGER) AS n_itemsets FROM {rel}"""


def _compat_sql(longest: int) -> str:
    """Level k + 1: two different level-k patterns, the first without its last item equal
    to the second without its first, joined where the result is frequent."""
    levels = ["l1 AS (SELECT * FROM f WHERE len(pat) = 1)"]
    for k in range(1, longest):
        levels.append(f"""l{k + 1} AS (SELECT * FROM f WHERE pat IN (
  SELECT list_append(x.pat, y.pat[{k}]) FROM l{k} x JOIN l{k} y ON x.pat[1:{k - 1}] = y.pat[2:{k}] AND x.pat <> y.pat))""")
    every = " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(1, longest + 1))
    return _EV_FREQUENT + "," + ",\n".join(levels) + f",\ng AS ({every})" + _ev_select("g")


@query("seq_patterns_prefixspan", _EV_FREQUENT + _ev_select("f"))
def seq_patterns_prefixspan(spark: SparkSession, sf: str) -> DataFrame:
    """MIN6/MIN7: PrefixSpan on user-day event sequences."""
    return _fmt(SM.prefixspan(event_sequences(spark, sf), min_support=EVENT_MIN_SUPPORT, max_len=MAX_LEN))


@query("seq_patterns_gsp_compat", _compat_sql(MAX_LEN))
def seq_patterns_gsp_compat(spark: SparkSession, sf: str) -> DataFrame:
    """MIN5/MIN6 compat engine: no <a, a> (S2)."""
    return _fmt(SM.gsp_compat(event_sequences(spark, sf), min_support=EVENT_MIN_SUPPORT, max_len=MAX_LEN))


@query("seq_patterns_gsp_compat_l4", _compat_sql(4))
def seq_patterns_gsp_compat_l4(spark: SparkSession, sf: str) -> DataFrame:
    """MIN5/MIN6 compat engine up to level 4."""
    return _fmt(SM.gsp_compat(event_sequences(spark, sf), min_support=EVENT_MIN_SUPPORT, max_len=4))


@query("pattern_support", f"""WITH {_EV},
p AS (SELECT '{{' || a.event_type || '}} → {{' || b.event_type || '}} → {{' || c.event_type || '}}' AS pattern,
             count(DISTINCT (a.user_id, a.day)) AS freq
      FROM s a JOIN s b ON a.user_id = b.user_id AND a.day = b.day AND a.pos < b.pos
               JOIN s c ON c.user_id = a.user_id AND c.day = a.day AND b.pos < c.pos
      GROUP BY a.event_type, b.event_type, c.event_type)
SELECT pattern, CAST(freq AS BIGINT) AS freq, round(freq / n, 6) AS support FROM p, n
WHERE freq / n >= {SUPPORT3_MIN_SUPPORT}""")
def pattern_support(spark: SparkSession, sf: str) -> DataFrame:
    """MIN3/MIN4/JON10: supports of three-event patterns by the containment fold.

    Candidates are PrefixSpan's three-item patterns; their support is counted
    again independently with the greedy fold.
    """
    seqs = event_sequences(spark, sf)
    cands = (SM.prefixspan(seqs, min_support=SUPPORT3_MIN_SUPPORT, max_len=3)
             .where((F.col("level") == 3) & (F.col("n_itemsets") == 3)).select("pattern"))
    sup = SM.pattern_support(seqs, cands)
    return sup.select(SM.pattern_text("pattern").alias("pattern"), "freq", r6("support").alias("support"))


# ------------------------------------------------------------------ contrast

def class_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return QS.global_sequences(spark, sf)


def class_pattern_table(spark: SparkSession, sf: str, min_support: float = CLASS_MIN_SUPPORT,
                        max_len: int = MAX_LEN) -> DataFrame:
    return CT.mine_by_class(class_sequences(spark, sf), "label", [CLASS_A, CLASS_B],
                            min_support=min_support, max_len=max_len, longest=len(QS.FEATS))


def _class_base(strategy: str = "quantile", n_bins: int = QS.N_BINS, min_support: float = CLASS_MIN_SUPPORT) -> str:
    return QS._bins_sql(strategy, n=n_bins) + "," + QS._MI + f""",
ll AS ({QS._lab_long(n_bins)}),
it AS (SELECT rid, label, list(ll.feature || '_' || lab ORDER BY rnk) AS items FROM ll JOIN mir USING (feature)
       WHERE rnk <= {min(QS.TOP_K, QS.MAX_LEN)} GROUP BY rid, label),
nc AS (SELECT label, count(*) AS n FROM ft GROUP BY label),
{_subsequences('it', 'label', 'cp')},
pats AS (SELECT cp.label AS class, {_braced('pat')} AS pattern, freq, freq / nc.n AS support, len(pat) AS level
         FROM cp JOIN nc ON nc.label = cp.label WHERE freq / nc.n >= {min_support}),
cla AS (SELECT * FROM pats WHERE class = '{CLASS_A}'), clb AS (SELECT * FROM pats WHERE class = '{CLASS_B}'),
cmp AS (
  SELECT coalesce(cla.pattern, clb.pattern) AS pattern, cla.support AS sa, clb.support AS sb,
         cla.freq AS fa, clb.freq AS fb,
         CASE WHEN cla.pattern IS NOT NULL AND clb.pattern IS NOT NULL THEN 'common'
              WHEN cla.pattern IS NOT NULL THEN 'unique_{CLASS_A}' ELSE 'unique_{CLASS_B}' END AS status
  FROM cla FULL OUTER JOIN clb ON cla.pattern = clb.pattern)
"""


_CLASS_BASE = _class_base()


def _fmt_class(df: DataFrame) -> DataFrame:
    return df.select("class", SM.pattern_text("pattern").alias("pattern"), "freq",
                     r6("support").alias("support"), F.col("level").cast("int").alias("level"))


@query("class_patterns", _CLASS_BASE + """
SELECT class, pattern, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support, CAST(level AS INTEGER) AS level
FROM pats""")
def class_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """MIN9: patterns mined per class (PrefixSpan, support 0.05)."""
    return _fmt_class(class_pattern_table(spark, sf))


@query("class_compare", _CLASS_BASE + f"""
SELECT pattern, round(sa, 6) AS support_a, round(sb, 6) AS support_b, status,
       CASE WHEN status = 'common' THEN round(sa / sb, 6) END AS lift_a,
       CASE WHEN status = 'common' THEN round(sb / sa, 6) END AS lift_b,
       CASE WHEN status <> 'common' THEN NULL WHEN sa / sb > 1.5 THEN '{CLASS_A}'
            WHEN sb / sa > 1.5 THEN '{CLASS_B}' ELSE 'neutral' END AS discriminative_for
FROM cmp""")
def class_compare(spark: SparkSession, sf: str) -> DataFrame:
    """MIN10: unique / common patterns with lifts and the 1.5 label."""
    c = CT.compare_classes(class_pattern_table(spark, sf), CLASS_A, CLASS_B)
    return c.select(SM.pattern_text("pattern").alias("pattern"), r6("support_a").alias("support_a"),
                    r6("support_b").alias("support_b"), "status", r6("lift_a").alias("lift_a"),
                    r6("lift_b").alias("lift_b"), "discriminative_for")


@query("discriminative_top10", _CLASS_BASE + """
SELECT pattern, round(sa, 6) AS support_a, round(sb, 6) AS support_b,
       round(greatest(sa / sb, sb / sa), 6) AS max_lift
FROM cmp WHERE status = 'common' ORDER BY greatest(sa / sb, sb / sa) DESC, pattern LIMIT 10""")
def discriminative_top10(spark: SparkSession, sf: str) -> DataFrame:
    """SRT4: top-10 common patterns by max(lift, inverse lift)."""
    c = CT.top_discriminative(CT.compare_classes(class_pattern_table(spark, sf), CLASS_A, CLASS_B), 10)
    return c.select(SM.pattern_text("pattern").alias("pattern"), r6("support_a").alias("support_a"),
                    r6("support_b").alias("support_b"),
                    r6(F.greatest("lift_a", "lift_b")).alias("max_lift"))


@query("contrast_four_way", _CLASS_BASE + f"""
SELECT pattern, CAST(fa AS BIGINT) AS freq_a, CAST(fb AS BIGINT) AS freq_b,
       CASE WHEN status = 'unique_{CLASS_A}' THEN '{CLASS_A}_unique' WHEN status = 'unique_{CLASS_B}' THEN '{CLASS_B}_unique'
            WHEN fa - fb >= 5 THEN '{CLASS_A}_dominant' ELSE '{CLASS_B}_dominant' END AS category
FROM cmp WHERE status <> 'common' OR fa - fb >= 5 OR fb - fa >= 5""")
def contrast_four_way(spark: SparkSession, sf: str) -> DataFrame:
    """SET3: unique / dominant by absolute counts (difference >= 5)."""
    c = CT.four_way(class_pattern_table(spark, sf), CLASS_A, CLASS_B, 5)
    return c.select(SM.pattern_text("pattern").alias("pattern"), "freq_a", "freq_b", "category")


@query("feature_importance", _CLASS_BASE + """,
fi AS (SELECT class, split_part(unnest(string_split(replace(replace(pattern, '{', ''), '}', ''), ' → ')), '_', 1) AS feature,
              support FROM pats),
fs AS (SELECT class, feature, sum(support) AS score FROM fi GROUP BY 1, 2)
SELECT class, feature, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY round(score, 9) DESC, feature) AS rank FROM fs) WHERE rank <= 10""")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """AGG15: support-weighted feature score per class, top 10."""
    fi = CT.feature_importance(class_pattern_table(spark, sf), 10)
    return fi.select("class", "feature", r6("score").alias("score"), F.col("rank").cast("int").alias("rank"))


@query("pattern_summary", _CLASS_BASE + """
SELECT class, CAST(count(*) AS BIGINT) AS n_patterns, round(avg(support), 6) AS avg_support,
       round(max(support), 6) AS max_support, round(min(support), 6) AS min_support FROM pats GROUP BY class""")
def pattern_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG16: pattern count and support spread per class."""
    s = CT.pattern_summary(class_pattern_table(spark, sf))
    return s.select("class", "n_patterns", r6("avg_support").alias("avg_support"),
                    r6("max_support").alias("max_support"), r6("min_support").alias("min_support"))


@query("interpretations", _CLASS_BASE + f""",
d AS (SELECT pattern, CASE WHEN sa / sb > 1.5 THEN '{CLASS_A}' WHEN sb / sa > 1.5 THEN '{CLASS_B}' ELSE 'neutral' END AS dfor,
             sa / sb AS la, sb / sa AS lb
      FROM cmp WHERE status = 'common' ORDER BY greatest(sa / sb, sb / sa) DESC, pattern LIMIT 5),
ua AS (SELECT pattern, sa FROM cmp WHERE status = 'unique_{CLASS_A}' ORDER BY sa DESC, pattern LIMIT 3),
ub AS (SELECT pattern, sb FROM cmp WHERE status = 'unique_{CLASS_B}' ORDER BY sb DESC, pattern LIMIT 3)
SELECT pattern, printf('Pattern strongly associated with %s cases (lift: %.2f)', dfor,
                       round(CASE WHEN dfor = '{CLASS_A}' THEN la ELSE lb END, 2)) AS interpretation,
       'discriminative' AS type FROM d WHERE dfor <> 'neutral'
UNION ALL SELECT pattern, printf('Pattern unique to {CLASS_A} cases (support: %.3f)', round(sa, 3)), 'unique_{CLASS_A}' FROM ua
UNION ALL SELECT pattern, printf('Pattern unique to {CLASS_B} cases (support: %.3f)', round(sb, 3)), 'unique_{CLASS_B}' FROM ub""")
def interpretations(spark: SparkSession, sf: str) -> DataFrame:
    """MIN11: readable sentences for the top contrasts."""
    c = CT.compare_classes(class_pattern_table(spark, sf), CLASS_A, CLASS_B)
    return CT.interpretations(c, CLASS_A, CLASS_B)


_LENGTH = " + ".join(f"({f} IS NOT NULL)::INT" for f in QS.FEATS)


@query("class_totals", QS._bins_sql("quantile") + f"""
SELECT CAST(count(*) AS BIGINT) AS total_sequences,
       CAST(count(*) FILTER (WHERE label = '{CLASS_A}') AS BIGINT) AS n_{CLASS_A},
       CAST(count(*) FILTER (WHERE label = '{CLASS_B}') AS BIGINT) AS n_{CLASS_B},
       round(avg((quantity IS NOT NULL)::INT + (extendedprice IS NOT NULL)::INT + (discount IS NOT NULL)::INT + (tax IS NOT NULL)::INT), 6) AS avg_sequence_length FROM b""")
def class_totals(spark: SparkSession, sf: str) -> DataFrame:
    """AGG18/AGG17: sequence totals per class and mean sequence length."""
    seqs = class_sequences(spark, sf)
    t = CT.class_totals(seqs, "label", [CLASS_A, CLASS_B])
    return t.select("total_sequences", f"n_{CLASS_A}", f"n_{CLASS_B}",
                    r6("avg_sequence_length").alias("avg_sequence_length"))


# ------------------------------------------------------------------ sweeps

SUPPORT_THRESHOLDS = (0.05, 0.1, 0.15, 0.2, 0.25)
_SWEEP_VALUES = ", ".join(f"({i}, {t})" for i, t in enumerate(SUPPORT_THRESHOLDS))


_SWEEP_SUPPORT_SQL = _CLASS_BASE + f""",
th AS (SELECT * FROM (VALUES {_SWEEP_VALUES}) AS v(config_order, t)),
c2 AS (SELECT th.config_order, th.t,
              count(*) FILTER (WHERE sa >= th.t) AS ta, count(*) FILTER (WHERE sb >= th.t) AS tb,
              count(*) FILTER (WHERE sa >= th.t AND sb >= th.t) AS c,
              count(*) FILTER (WHERE sa >= th.t AND (sb IS NULL OR sb < th.t)) AS ua,
              count(*) FILTER (WHERE sb >= th.t AND (sa IS NULL OR sa < th.t)) AS ub
       FROM th JOIN cmp ON TRUE GROUP BY 1, 2)
SELECT CAST(config_order AS INTEGER) AS config_order, t AS min_support, metric, CAST(value AS DOUBLE) AS value FROM c2
UNPIVOT (value FOR metric IN (ta AS 'total_patterns_a', tb AS 'total_patterns_b', c AS 'common_patterns',
                              ua AS 'unique_a', ub AS 'unique_b'))
UNION ALL SELECT CAST(config_order AS INTEGER), t, 'discriminative_top10', CAST(least(c, 10) AS DOUBLE) FROM c2
UNION ALL SELECT CAST(config_order AS INTEGER), t, 'unique_a_top10', CAST(least(ua, 10) AS DOUBLE) FROM c2
UNION ALL SELECT CAST(config_order AS INTEGER), t, 'unique_b_top10', CAST(least(ub, 10) AS DOUBLE) FROM c2"""


@query("sweep_support", _SWEEP_SUPPORT_SQL)
def sweep_support(spark: SparkSession, sf: str) -> DataFrame:
    """MIN15: support sweep, mined once at the lowest threshold."""
    s = SW.support_sweep(class_sequences(spark, sf), "label", CLASS_A, CLASS_B, SUPPORT_THRESHOLDS,
                         max_len=MAX_LEN)
    return s.select("config_order", "min_support", "metric", "value")


def _bins_configs():
    return [{"strategy": s, "n_bins": n, "min_support": 0.1, "max_len": 5}
            for s in ("uniform", "quantile", "kmeans") for n in (3, 5, 7)]


def _rank_configs():
    return [{"ranking_method": m, "top_k": k, "min_support": 0.1, "max_len": 5}
            for m in ("mutual_info", "zscore") for k in (5, 10, 15, 20)]


_BIN_KINDS = [(c["strategy"], c["n_bins"]) for c in _bins_configs()]
_BASE_KIND = ("quantile", QS.N_BINS)


def sweep_bins_table(spark: SparkSession, sf: str, counted=None) -> DataFrame:
    counted = counted or QS.counted_bins(spark, sf, _BIN_KINDS)
    return SW.config_sweep(
        spark, "bins", _bins_configs(),
        lambda c: QS.counted_sequences(counted[c["strategy"], c["n_bins"]], c["n_bins"]),
        "label", CLASS_A, CLASS_B, longest=len(QS.FEATS), weight="n")


def sweep_ranking_table(spark: SparkSession, sf: str, counted=None) -> DataFrame:
    counted = counted or QS.counted_bins(spark, sf, [_BASE_KIND])

    def build(c):
        return QS.counted_sequences(counted[_BASE_KIND], QS.N_BINS, c["ranking_method"], c["top_k"], c["max_len"])

    return SW.config_sweep(spark, "ranking", _rank_configs(), build, "label", CLASS_A, CLASS_B,
                           share_key=lambda c: (c["ranking_method"], min(c["top_k"], c["max_len"])), longest=len(QS.FEATS), weight="n")


_SWEEP_SUPPORT = 0.1


def _sweep_counts(method: str, rows: str) -> str:
    """CTE ``<method>_n``: summary counts of the sequences ``rows`` (label, items)."""
    return f"""{_subsequences(rows, 'label', method)},
{method}_p AS (SELECT label, pat, freq / n AS support FROM {method} JOIN nc USING (label) WHERE freq / n >= {_SWEEP_SUPPORT}),
{method}_c AS (SELECT a.pat IS NOT NULL AS ina, b.pat IS NOT NULL AS inb
  FROM (SELECT * FROM {method}_p WHERE label = '{CLASS_A}') a FULL OUTER JOIN (SELECT * FROM {method}_p WHERE label = '{CLASS_B}') b ON a.pat = b.pat),
{method}_n AS (SELECT '{method}' AS method, count(*) FILTER (WHERE ina) AS ta, count(*) FILTER (WHERE inb) AS tb,
  count(*) FILTER (WHERE ina AND inb) AS c, count(*) FILTER (WHERE ina AND NOT inb) AS ua, count(*) FILTER (WHERE inb AND NOT ina) AS ub,
  (SELECT avg(len(items)) FROM {rows}) AS avg_len FROM {method}_c)"""


_SWEEP_METRICS = {"total_patterns_a": "ta", "total_patterns_b": "tb", "common_patterns": "c", "discriminative_top10": "least(c, 10)",
                  "unique_a": "ua", "unique_b": "ub", "unique_a_top10": "least(ua, 10)", "unique_b_top10": "least(ub, 10)",
                  "avg_sequence_length": "avg_len"}
_SWEEP_LONG = " UNION ALL ".join(f"SELECT method, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM al" for m, e in _SWEEP_METRICS.items())
_SWEEP_CONFIGS = ", ".join(f"({4 * i + j}, '{m}', {k})" for i, m in enumerate(("mutual_info", "zscore")) for j, k in enumerate((5, 10, 15, 20)))


def _sweep_bins_sql(order: int, strategy: str, n_bins: int) -> str:
    return _class_base(strategy, n_bins, _SWEEP_SUPPORT) + f""",
{_sweep_counts('one', 'it')},
al AS (SELECT * FROM one_n),
lo AS ({_SWEEP_LONG})
SELECT 'bins' AS sweep, CAST({order} AS INTEGER) AS config_order, '{strategy}' AS strategy, CAST({n_bins} AS INTEGER) AS n_bins,
       CAST({_SWEEP_SUPPORT} AS DOUBLE) AS min_support, 'mutual_info' AS ranking_method, CAST(10 AS INTEGER) AS top_k, metric, value,
       CAST(NULL AS VARCHAR) AS error FROM lo"""


_SWEEP_BINS = " UNION ALL ".join(f"SELECT * FROM ({_sweep_bins_sql(i, c['strategy'], c['n_bins'])})" for i, c in enumerate(_bins_configs()))


@query("sweep_bins", _SWEEP_BINS)
def sweep_bins(spark: SparkSession, sf: str) -> DataFrame:
    """MIN14: 3 strategies x 3/5/7 bins."""
    return sweep_bins_table(spark, sf)


_SWEEP_RANKING = _CLASS_BASE + "," + QS._Z + f""",
zi AS (SELECT rid, label, list(feature || '_' || {QS._LABELS}[bin + 1] ORDER BY rn) AS items FROM zl
       WHERE rn <= {QS.MAX_LEN} GROUP BY rid, label),
{_sweep_counts('mutual_info', 'it')},
{_sweep_counts('zscore', 'zi')},
al AS (SELECT * FROM mutual_info_n UNION ALL SELECT * FROM zscore_n),
lo AS ({_SWEEP_LONG}),
cf AS (SELECT * FROM (VALUES {_SWEEP_CONFIGS}) AS v(config_order, method, top_k))
SELECT 'ranking' AS sweep, CAST(config_order AS INTEGER) AS config_order, 'quantile' AS strategy, CAST(3 AS INTEGER) AS n_bins,
       CAST({_SWEEP_SUPPORT} AS DOUBLE) AS min_support, method AS ranking_method, CAST(top_k AS INTEGER) AS top_k, metric, value,
       CAST(NULL AS VARCHAR) AS error
FROM cf JOIN lo USING (method)"""


@query("sweep_ranking", _SWEEP_RANKING)
def sweep_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """MIN16: 2 ranking methods x top-k 5/10/15/20, shared by effective length."""
    return sweep_ranking_table(spark, sf)


_BEST_CONFIG = f"""WITH every AS (
  SELECT 'support' AS sweep, config_order, 'quantile' AS strategy, 3 AS n_bins, min_support, 'mutual_info' AS ranking_method,
         CAST(NULL AS INTEGER) AS top_k, metric, value FROM ({_SWEEP_SUPPORT_SQL})
  UNION ALL SELECT * EXCLUDE (error) FROM ({_SWEEP_BINS})
  UNION ALL SELECT * EXCLUDE (error) FROM ({_SWEEP_RANKING})),
scored AS (SELECT * EXCLUDE (metric, value), sum(value) AS score FROM every
  WHERE metric = 'discriminative_top10' OR (sweep <> 'support' AND metric IN ('unique_a_top10', 'unique_b_top10')) GROUP BY ALL)
SELECT sweep, config_order, strategy, CAST(n_bins AS INTEGER) AS n_bins, min_support, ranking_method, top_k, score,
       CASE sweep WHEN 'bins' THEN printf('Best binning strategy: %s with %d bins', strategy, n_bins)
                  WHEN 'support' THEN 'Best support threshold: ' || CAST(min_support AS VARCHAR)
                  ELSE printf('Best ranking method: %s with top %d features', ranking_method, top_k) END AS rationale
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY sweep ORDER BY score DESC, config_order) = 1"""


@query("best_config", _BEST_CONFIG)
def best_config(spark: SparkSession, sf: str) -> DataFrame:
    """MIN17: best configuration per sweep with its rationale."""
    counted = QS.counted_bins(spark, sf, _BIN_KINDS)
    sup = SW.support_sweep(QS.counted_sequences(counted[_BASE_KIND], QS.N_BINS), "label", CLASS_A, CLASS_B, SUPPORT_THRESHOLDS,
                           max_len=MAX_LEN, longest=len(QS.FEATS), weight="n")
    allsw = sup.unionByName(sweep_bins_table(spark, sf, counted)).unionByName(sweep_ranking_table(spark, sf, counted))
    return SW.best_configuration(allsw)


@query("class_top_patterns", _CLASS_BASE + """
SELECT class, pattern, CAST(freq AS BIGINT) AS freq, CAST(rank AS INTEGER) AS rank FROM (
  SELECT class, pattern, freq, row_number() OVER (PARTITION BY class ORDER BY freq DESC, pattern) AS rank FROM pats)
WHERE rank <= 10""")
def class_top_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """MIN7/SRT9: top-10 patterns per class by absolute count (PrefixSpan)."""
    from pyspark.sql import Window

    p = class_pattern_table(spark, sf).withColumn("pattern", SM.pattern_text("pattern"))
    w = Window.partitionBy("class").orderBy(F.desc("freq"), "pattern")
    return (p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 10)
            .select("class", "pattern", "freq", F.col("rank").cast("int").alias("rank")))


STRATEGIES = ("uniform", "quantile", "kmeans")


@query("strategy_summary", " UNION ALL ".join(
    f"SELECT class, n_patterns, strategy FROM ({_class_base(st)} SELECT class, CAST(count(*) AS BIGINT) AS n_patterns, '{st}' AS strategy FROM pats GROUP BY class)"
    for st in STRATEGIES))
def strategy_summary(spark: SparkSession, sf: str) -> DataFrame:
    """MIN21: patterns per (binning strategy, class)."""
    per = {s: CT.mine_by_class(QS.global_sequences(spark, sf, strategy=s), "label", [CLASS_A, CLASS_B],
                               min_support=CLASS_MIN_SUPPORT, max_len=MAX_LEN, longest=len(QS.FEATS))
           for s in STRATEGIES}
    return CT.strategy_summary(per, "label")


@query("strategy_class_sequences", " UNION ALL ".join(
    f"(SELECT '{st}' AS strategy, label AS class, CAST(count(*) AS BIGINT) AS n_sequences, round(avg({_LENGTH}), 6) AS avg_length FROM ("
    f"{QS._bins_sql(st)} SELECT * FROM b) GROUP BY label)" for st in STRATEGIES))
def strategy_class_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """MIN21: sequences per (binning strategy, class) and their mean length."""
    parts = [QS.global_sequences(spark, sf, strategy=st).groupBy(F.col("label").alias("class"))
             .agg(F.count(F.lit(1)).alias("n_sequences"), r6(F.avg(F.size("sequence"))).alias("avg_length"))
             .select(F.lit(st).alias("strategy"), "class", "n_sequences", "avg_length") for st in STRATEGIES]
    return reduce(DataFrame.unionByName, parts)
