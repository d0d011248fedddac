"""Feature ranking and sequence generation (FE6-FE11, FN8, FN11, WIN3, SRT5).

Scores are aggregates with small outputs (feature x bin x class counts, or
per-feature moments). Per-row ranking sorts an array of (score, feature)
structs inside each row, so it needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast, shared_table
from ..plans.prefix import ordered_index, prefix_sum
from .quantiles import finite


def _long_bins(df: DataFrame, cols: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.select(F.col(label).alias("_cls"), (F.col(weight) if weight else F.lit(1)).alias("_w"),
                     F.expr(f"stack({len(cols)}, {pairs}) AS (feature, bin)")).where(F.col("bin").isNotNull())


def mutual_info(binned: DataFrame, cols: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """FE6: plug-in mutual information (nats) of each binned feature and the class.

    Differs from sklearn's k-NN estimate on purpose (deterministic, exact).
    ``weight``: how many rows a row stands for.
    """
    long = _long_bins(binned, cols, label, weight)
    joint = long.groupBy("feature", "bin", "_cls").agg(F.sum("_w").alias("n_bc"))
    tot = joint.groupBy("feature").agg(F.sum("n_bc").alias("n"))
    pb = joint.groupBy("feature", "bin").agg(F.sum("n_bc").alias("n_b"))
    pc = joint.groupBy("feature", "_cls").agg(F.sum("n_bc").alias("n_c"))
    j = joint.join(tot, "feature").join(pb, ["feature", "bin"]).join(pc, ["feature", "_cls"])
    term = (F.col("n_bc") / F.col("n")) * F.log(F.col("n_bc") * F.col("n") / (F.col("n_b") * F.col("n_c")))
    return j.groupBy("feature").agg(F.sum(term).alias("score"))


def digamma(n: Column) -> Column:
    """psi(n) of a positive number: six steps up, then the asymptotic series (error under 1e-10)."""
    x = n.cast("double") + 6.0
    steps = sum((1.0 / (n + float(i)) for i in range(1, 6)), 1.0 / n.cast("double"))
    return F.log(x) - 1.0 / (2.0 * x) - 1.0 / (12.0 * x ** 2) + 1.0 / (120.0 * x ** 4) - 1.0 / (252.0 * x ** 6) - steps


#: rows of a bucket of sorted neighbours
NEIGHBOUR_ROWS = 100_000
#: a radius is shrunk by this share, so that the neighbour that set it lies outside
INSIDE = 1e-10


def _neighbour_radius(long: DataFrame, k: int, bucket_rows: int) -> DataFrame:
    """Adds ``r``, the distance to the least(k, others)-th nearest row of the same feature and class, and
    ``near``, how many that are; rows alone in their class leave.

    Rows are numbered by value (range-partitioned, so a hot class is many tasks) and dealt
    into buckets of consecutive numbers; ``k`` rows on either side of a border are in both
    buckets, so a window over a bucket sees every neighbour.
    """
    keys = ["feature", "_cls"]
    rows = ordered_index(long, keys, ["x", "_id"], "_at")
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_c"))
    own = F.floor((F.col("_at") - 1) / bucket_rows).cast("long")
    place = (F.col("_at") - 1) % bucket_rows
    buckets = F.array_compact(F.array(own, F.when((place < k) & (own > 0), own - 1), F.when(place >= bucket_rows - k, own + 1)))
    dealt = rows.select("*", own.alias("_own"), F.explode(buckets).alias("_bucket"))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_at")
    back = [F.lit(0.0)] + [F.col("x") - F.lag("x", j).over(w) for j in range(1, k + 1)]
    ahead = [F.lit(0.0)] + [F.lead("x", j).over(w) - F.col("x") for j in range(1, k + 1)]
    dealt = dealt.select("*", F.array(*back).alias("_back"), F.array(*ahead).alias("_ahead")).where(F.col("_bucket") == F.col("_own"))
    per = bounded_broadcast(per.select(F.col("feature").alias("_pf"), F.col("_cls").alias("_pc"), "_n_c"))
    dealt = dealt.join(per, (F.col("feature") == F.col("_pf")) & (F.col("_cls") == F.col("_pc"))).drop("_pf", "_pc").where("_n_c > 1")
    many = F.least(F.lit(k), F.col("_n_c") - 1).cast("int")
    # the many-th nearest: j behind and the rest ahead, the least of the greater distances
    spans = F.transform(F.sequence(F.lit(0), many), lambda j: F.greatest(F.get("_back", j), F.get("_ahead", many - j)) +
                        F.when(F.get("_back", j).isNull() | F.get("_ahead", many - j).isNull(), F.lit(None).cast("double")).otherwise(0.0))
    return dealt.select("feature", "_cls", "_id", "x", "_n_c", many.alias("near"), F.array_min(F.array_compact(spans)).alias("r"))


def mutual_info_knn(df: DataFrame, cols: Sequence[str], label: str, k: int = 3, bucket_rows: int = NEIGHBOUR_ROWS) -> DataFrame:
    """FE6: nearest-neighbour estimate (nats) of the mutual information of each numeric feature and
    the class: psi(n) + mean psi(k_i) - mean psi(n_class) - mean psi(m_i), not below 0.

    ``r_i`` is the distance of row i to its k-th nearest row of the same class, ``m_i`` the rows of
    any class nearer than that, itself included. Where r_i is 0, ties decide: k_i are the other
    rows of the class with the value, m_i all rows with it. The usual implementation adds
    random noise to part ties; here the result is the same in every run. Rows alone in their
    class are left out, as are null and non-finite values; a feature without rows has no score.

    Counts within a radius come from one running sum over the sorted values and both ends of all
    radii (range-partitioned), so no row meets another one by one.
    """
    entries = [F.struct(F.lit(c).alias("feature"), finite(F.col(c).cast("double")).alias("x")) for c in cols]
    long = df.select(F.col(label).alias("_cls"), F.monotonically_increasing_id().alias("_id"), F.explode(F.array(*entries)).alias("_e"))
    long = shared_table(long.select("_cls", "_id", "_e.feature", "_e.x").where(F.col("x").isNotNull() & F.col("_cls").isNotNull()), "neighbours")
    rows = shared_table(_neighbour_radius(long, k, bucket_rows), "radius")
    inner = F.col("r") * (1.0 - INSIDE)
    # at equal values: lower ends, then the points, then upper ends
    ends = rows.select("feature", F.explode(F.array(
        F.struct((F.col("x") - inner).alias("v"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"), F.col("_id"), F.lit(-1).alias("sign")),
        F.struct((F.col("x") + inner).alias("v"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("n"), F.col("_id"), F.lit(1).alias("sign")))).alias("e"))
    kept = rows.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_id"))
    points = kept.select("feature", F.struct(F.col("x").alias("v"), F.lit(1).alias("kind"), "n", "_id", F.lit(0).alias("sign")).alias("e"))
    events = ends.unionByName(points).select("feature", "e.*")
    upto = prefix_sum(events, ["feature"], ["v", "kind", "_id"], "n", "_upto").where(F.col("sign") != 0)
    inside = upto.groupBy("feature", "_id").agg(F.sum(F.col("sign") * F.col("_upto")).alias("m"))
    ties = rows.groupBy("feature", "_cls", "x").agg(F.count(F.lit(1)).alias("same"))
    j = rows.join(inside, ["feature", "_id"]).join(ties, ["feature", "_cls", "x"])
    near = F.when(F.col("r") > 0, F.col("near")).otherwise(F.col("same") - 1)
    s = j.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(digamma(near)).alias("k"), F.avg(digamma(F.col("_n_c"))).alias("c"), F.avg(digamma(F.col("m"))).alias("m"))
    return s.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("k") - F.col("c") - F.col("m")).alias("score"))


def correlation_scores(binned: DataFrame, cols: Sequence[str], label: str, positive) -> DataFrame:
    """FE8: |Pearson r| of each feature with the 0/1 class (documented option)."""
    y = F.when(F.col(label) == F.lit(positive), 1.0).otherwise(0.0)
    row = binned.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in cols]).first()
    rows = [(c, abs(row[c]) if row[c] is not None else None) for c in cols]
    return binned.sparkSession.createDataFrame(rows, "feature string, score double")


def moments(df: DataFrame, cols: Sequence[str], sample: bool = False, weight: str | None = None) -> dict[str, tuple[float, float]]:
    """FE7: mean and standard deviation per column (zero std -> 1).

    Population std from exact moments (sqrt(E[x^2]-E[x]^2)) for ordinals;
    ``sample=True`` gives the sample std used on raw values. ``weight``: how many
    rows a row stands for (population std only).
    """
    if sample and weight:
        raise ValueError("the sample std takes no weight")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        mean = (lambda v, w=F.when(x.isNotNull(), F.col(weight)): F.try_divide(F.sum(v * w), F.sum(w))) if weight else F.avg
        aggs += [mean(x).alias(f"m_{i}"), mean(x * x).alias(f"q_{i}"),
                 F.stddev_samp(x).alias(f"s_{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        mu = row[f"m_{i}"]
        if sample:
            sd = row[f"s_{i}"]
        else:
            var = row[f"q_{i}"] - mu * mu
            sd = var ** 0.5 if var > 0 else 0.0
        out[c] = (mu, sd if sd else 1.0)
    return out


def zscore_expr(c: str, mu: float, sd: float) -> Column:
    """FN11: |(x - mu) / sd|."""
    return F.abs((F.col(c).cast("double") - F.lit(mu)) / F.lit(sd))


def top_features_per_row(df: DataFrame, stats: Mapping[str, tuple[float, float]], k: int,
                         out: str = "ranked", suffix: str = "") -> DataFrame:
    """WIN3: per row, the ``k`` features with the largest |z| (ties: name asc).

    One ``array_sort`` over (−score, name) structs inside the row; a feature's
    values are in the column of its name and ``suffix``.
    """
    entries = [F.struct((F.lit(0.0) - zscore_expr(c + suffix, mu, sd) + F.lit(0.0)).alias("neg"),
                        F.lit(c).alias("feature"))
               for c, (mu, sd) in stats.items()]
    ranked = F.slice(F.array_sort(F.array(*entries)), 1, k)
    return df.withColumn(out, F.transform(ranked, lambda s: s["feature"]))


def global_order(scores: DataFrame, k: int) -> list[str]:
    """SRT5: top ``k`` feature names by score (ties: name asc); tiny result."""
    rows = scores.orderBy(F.desc("score"), "feature").limit(k).collect()
    return [r["feature"] for r in rows]


def item_label(feature: Column | str, label: Column) -> Column:
    """FN8: ``feature_label`` item text."""
    f = F.lit(feature) if isinstance(feature, str) else feature
    return F.concat(f, F.lit("_"), label)


def sequences_global(labelled: DataFrame, order: Sequence[str], out: str = "sequence") -> DataFrame:
    """FE9: every row's sequence follows one global feature order.

    ``labelled`` holds the bin labels per feature; null labels are skipped.
    """
    items = [F.when(F.col(c).isNotNull(), F.array(item_label(c, F.col(c)))) for c in order]
    return labelled.withColumn(out, F.filter(F.array(*items), lambda x: x.isNotNull()))


def sequences_per_row(labelled: DataFrame, feature_cols: Sequence[str], ranked_col: str,
                      out: str = "sequence", suffix: str = "") -> DataFrame:
    """FE10: each row's own feature order (from ``top_features_per_row``).

    The label lookup is a map built from the row's own columns (feature name and
    ``suffix``), so nothing leaves the row.
    """
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in feature_cols]),
                          F.array(*[F.col(c + suffix) for c in feature_cols]))
    items = F.transform(F.col(ranked_col),
                        lambda f: F.when(F.element_at(m, f).isNotNull(),
                                         F.array(item_label(f, F.element_at(m, f)))))
    return labelled.withColumn(out, F.filter(items, lambda x: x.isNotNull()))


def sequence_text(c: str | Column, item_sep: str = ",", set_sep: str = " ") -> Column:
    """Sequence -> text: itemsets joined by ``item_sep`` in order."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda s: F.array_join(s, set_sep)), item_sep)
