"""Forest models (ML1-ML11, UD1, AGG25, SRT6, SRT8).

Spark ML end to end: ``VectorAssembler`` -> ``RandomForestClassifier`` with a
balanced ``weightCol``, a grid cross-validated on stratified folds (fold = position
within class mod k, from the distributed ``ordered_index``), and the F1 of the
positive label as the default score.

Documented approximations to the reference's sklearn forest: ``max_depth``
None maps to Spark's cap of 30; ``min_samples_split`` maps to
``minInstancesPerNode`` (ceil(split / 2)); per-bootstrap balanced weights
are balanced per group of trees (``fit_multiclass``) or once (the grid).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, CountVectorizerModel, Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import shared_table
from ..plans.prefix import ordered_index
from .metrics import auc_exact, binary_prf, class_report, confusion, with_weights
from .quantiles import ACCURACY, GRID
from .text import canonical_key

MAX_DEPTH_CAP = 30
#: rows of one partition of a training table (a fit keeps some 200 bytes a row), and rows that
#: all fits running at a time may keep
PARTITION_ROWS, KEPT_ROWS = 500_000, 20_000_000
#: rows from which a training table is counted by cell, the rows that a cell must stand for on average, cells of
#: a partition, and bins of a feature (as many as a Spark forest makes)
COUNTED_FROM, CELL_SHARE, PARTITION_CELLS, MAX_BINS = 5_000_000, 4, 50_000, 32
#: distinct values of a feature that are counted one by one; beyond, its quantiles stand for them
VALUES = 5_000
#: leaves of a tree and trees of a forest that are scored by bits of words
LEAVES, LEAF_TREES = 62, 40


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 3, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold id per row: position within its class (hash order) modulo k."""
    d = df.withColumn("_ord", F.xxhash64(F.col(id_col), F.lit(seed)))
    idx = ordered_index(d, [label], ["_ord", id_col], "_pos")
    return idx.withColumn(out, ((F.col("_pos") - 1) % k).cast("int")).drop("_ord", "_pos")


class CallableEvaluator(Evaluator):
    """UD1: a user metric ``fn(DataFrame) -> float`` as a Spark ``Evaluator``."""

    def __init__(self, fn, larger_better: bool = True):
        super().__init__()
        self._fn = fn
        self._larger = larger_better

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(self._fn(dataset))

    def isLargerBetter(self) -> bool:
        return self._larger


def scorer(name: str, positive_index: int):
    """ML3: F1 of the positive label, or any multi-class metric by name."""
    if name in ("f1", "f1_positive"):
        return MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction",
                                                 metricName="fMeasureByLabel", metricLabel=float(positive_index))
    if callable(name):
        return CallableEvaluator(name)
    return MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName=name)


def choose_positive(df: DataFrame, label: str, preferred: str = "M", max_classes: int = 3) -> str:
    """FLT8: binary-class check and positive label: ``preferred`` when
    present, else the first label in sorted order. Reads at most
    ``max_classes + 1`` distinct labels."""
    labels = sorted(r[0] for r in df.select(label).distinct().limit(max_classes + 1).collect())
    if len(labels) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label!r}")
    if len(labels) < 2:
        raise ValueError(f"need two classes in {label!r}, found {labels}")
    return preferred if preferred in labels else labels[0]


def _depth(d):
    return MAX_DEPTH_CAP if d is None else min(int(d), MAX_DEPTH_CAP)


def grid_search(df: DataFrame, features: Sequence[str], label: str, id_col: str, positive: str,
                n_estimators: Sequence[int] = (100, 200), max_depth: Sequence = (10, 20, None),
                min_samples_split: Sequence[int] = (2, 5), folds: int = 3, seed: int = 42,
                metric="f1", parallelism: int = 4):
    """ML2/AGG25: grid search with class weights and stratified folds; refit on all.

    Returns (best PipelineModel, results DataFrame with mean/std per grid point,
    label classes in index order).

    The rows are written once with weight and fold. Per fold the indexer, the medians and the
    vectors are made once for all grid points, in partitions of at most ``PARTITION_ROWS`` rows,
    whatever the size of the table; fits run side by side only as far as their rows stay
    below ``KEPT_ROWS``.

    A large table is counted first (``CountedRows``): a forest knows a row by the bins of its
    features, so rows of equal bins, class and weight are one cell, and the fits and scores of all grid points
    read the cells. The fitted stages then end in bins (``Bucketizer``), vectors and the forest.
    Where the cells are nearly as many as the rows, the rows themselves are fitted.
    """
    spark = df.sparkSession
    df = df.select(*features, label, id_col)
    per_class = shared_table(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "classes")
    positive = choose_positive(per_class, label, positive)
    counts = {r[label]: r["n"] for r in per_class.collect()}  # at most three, as just checked
    classes, n = sorted(counts), sum(counts.values())
    pos_idx = classes.index(positive)
    data = stratified_folds(with_weights(df, label, "weight"), label, id_col, folds, seed)
    data = shared_table(data.select(*features, label, "weight", "fold", F.xxhash64(id_col).alias("_deal")), "folds")
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
    # null and NaN features take the training median, so no row is lost in fitting or scoring
    filled = [f"{f}__filled" for f in features]
    imputer = Imputer(inputCols=list(features), outputCols=filled, strategy="median")
    assembler = VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error")
    rf = RandomForestClassifier(featuresCol="features", labelCol="label_idx", weightCol="weight", seed=seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(n_estimators))
            .addGrid(rf.maxDepth, [_depth(d) for d in max_depth])
            .addGrid(rf.minInstancesPerNode, [max(1, math.ceil(s / 2)) for s in min_samples_split])
            .build())
    parts = max(spark.sparkContext.defaultParallelism, -(-n // PARTITION_ROWS))
    evaluator = scorer(metric, pos_idx)

    def prepared(rows: DataFrame):
        prep = Pipeline(stages=[indexer, imputer, assembler]).fit(rows)
        dealt = prep.transform(rows).select("label_idx", "features", "weight", "_deal").repartition(parts, "_deal").drop("_deal")
        return prep, dealt.persist(StorageLevel.MEMORY_AND_DISK)

    scores: list[list[float]] = [[] for _ in grid]
    counted = CountedRows(data, features, indexer.fit(per_class), imputer, rf, grid, n) if n >= COUNTED_FROM else None
    if counted and counted.worthwhile:
        for fold in range(folds):
            for one, score in zip(scores, counted.scores(fold, evaluator, own_metric=callable(metric)), strict=True):
                one.append(score)
    else:
        with ThreadPool(max(1, min(parallelism, KEPT_ROWS // max(n, 1)))) as pool:
            for fold in range(folds):
                prep, train = prepared(data.where(F.col("fold") != fold))
                held = prep.transform(data.where(F.col("fold") == fold))
                found = pool.map(lambda params: evaluator.evaluate(rf.fit(train, params).transform(held)), grid, chunksize=1)
                train.unpersist()
                for one, score in zip(scores, found, strict=True):
                    one.append(score)
    means = [fmean(x) for x in scores]
    best = means.index((max if evaluator.isLargerBetter() else min)(means))
    if counted and counted.worthwhile:
        model = counted.refit(grid[best])
    else:
        prep, train = prepared(data)
        model = PipelineModel(stages=[*prep.stages, rf.fit(train, grid[best])])
        train.unpersist()
    rows = []
    for pm, m, one in zip(grid, means, scores, strict=True):
        p = {k.name: v for k, v in pm.items()}
        rows.append((int(p["numTrees"]), int(p["maxDepth"]), int(p["minInstancesPerNode"]), float(m), float(pstdev(one))))
    res = spark.createDataFrame(rows, "n_estimators int, max_depth int, min_instances_per_node int, "
                                      "mean_score double, std_score double")
    return model, res, classes


def split_points(counts: Sequence[tuple[float, float]], max_bins: int = MAX_BINS) -> list[float]:
    """Thresholds (``x <= t`` goes left) of a feature from its sorted (value, rows), chosen as a Spark
    forest does: between all values while these are few, else a stride of equal rows apart."""
    def between(a: float, b: float) -> float:
        middle = a / 2 + b / 2
        return middle if a <= middle < b else a

    pairs = list(zip(counts, counts[1:]))
    if len(counts) <= max_bins:
        return [between(a[0], b[0]) for a, b in pairs]
    stride = sum(n for _, n in counts) / max_bins
    out, target, upto = [], stride, counts[0][1]
    for a, b in pairs:
        before, upto = upto, upto + b[1]
        if abs(before - target) < abs(upto - target):
            out.append(between(a[0], b[0]))
            target += stride
    return out[:max_bins - 1]


def weighted_median(counts: Sequence[tuple[float, float]]) -> float:
    """The first of the sorted (value, rows) that half of the rows do not pass."""
    half, upto = sum(n for _, n in counts) / 2, 0.0
    for x, n in counts:
        upto += n
        if upto >= half:
            return x
    raise ValueError("a feature without any value has no median")


def value_counts(data: DataFrame, features: Sequence[str], folds: str = "fold") -> list[dict[int, Counter]]:
    """Per feature and fold the rows of every value (None: null or NaN).

    A feature of many values is given by its ``GRID`` quantiles in every fold, found over all rows, which
    share the fold's rows equally; the driver never holds more than ``VALUES`` or ``GRID`` values of a feature and fold."""
    xs = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    few = data.agg(*[F.approx_count_distinct(x).alias(f"d_{i}") for i, x in enumerate(xs)]).first()
    out: list[dict[int, Counter]] = [{} for _ in features]
    many = [i for i in range(len(xs)) if few[i] > VALUES]
    for i, x in enumerate(xs):
        if i not in many:
            for r in data.groupBy(F.col(folds).alias("fold"), x.alias("x")).agg(F.count(F.lit(1)).alias("n")).collect():
                out[i].setdefault(r["fold"], Counter())[r["x"]] = r["n"]
    if many:
        probs = F.array(*[F.lit((k + 0.5) / GRID) for k in range(GRID)])
        aggs = [a for i in many for a in (F.percentile_approx(xs[i], probs, F.lit(ACCURACY)).alias(f"g_{i}"), F.count(xs[i]).alias(f"n_{i}"))]
        for r in data.groupBy(F.col(folds).alias("fold")).agg(F.count(F.lit(1)).alias("n"), *aggs).collect():
            for i in many:
                held = Counter({None: r["n"] - r[f"n_{i}"]})
                for x in r[f"g_{i}"] or []:
                    held[x] += r[f"n_{i}"] / GRID
                out[i][r["fold"]] = held
    return out


class CountedRows:
    """The cross-validation of forests over counted rows.

    A forest sees of a row the bin of every feature, the class and the weight. Rows that share these are one
    cell of n rows, and a bootstrap draws a cell as often as its rows together: the sum of n Poisson(1)
    draws, which is Poisson(n). So each tree has its own bootstrap of all rows, and the work of a fit
    grows with the cells, at most ``MAX_BINS`` to the number of features for each class, not with the rows. Bins come from
    the values of all training rows of a fold, not from a sample.

    A tree is one Spark forest of a single tree over its own weights. Forests of the same depth and
    node size share their first trees (as with a fixed seed in the reference), so each is fitted once.
    """

    def __init__(self, data: DataFrame, features: Sequence[str], indexer, imputer: Imputer, rf: RandomForestClassifier, grid: Sequence[dict], n: int):
        self.data, self.features, self.indexer, self.imputer, self.rf, self.grid = data, list(features), indexer, imputer, rf, list(grid)
        self.seed = rf.getSeed()
        self.values = value_counts(data, features)
        self.every = self._cells(None)
        self.worthwhile = self.every[1].count() * CELL_SHARE <= n

    def _cells(self, fold: int | None):
        """The stages fitted without ``fold``, and the cells of all rows."""
        medians, splits = [], []
        for held in self.values:
            total = sum((c for k, c in held.items() if k != fold), Counter())
            missing = total.pop(None, 0)
            medians.append(weighted_median(sorted(total.items())))
            if missing:
                total[medians[-1]] += missing
            cuts = [math.nextafter(t, math.inf) for t in split_points(sorted(total.items()))]
            splits.append([-math.inf, *(cuts or [0.0]), math.inf])
        known = self.data.sparkSession.createDataFrame([tuple(medians)], ", ".join(f"`{f}` double" for f in self.features))
        prep = [self.indexer, self.imputer.fit(known.select(*[F.col(f).cast(self.data.schema[f].dataType) for f in self.features]))]
        bins = [f"{f}__bin" for f in self.features]
        buckets = Bucketizer(inputCols=[f"{f}__filled" for f in self.features], outputCols=bins, splitsArray=splits)
        assembler = VectorAssembler(inputCols=bins, outputCol="features", handleInvalid="error")
        held = F.lit(False) if fold is None else F.col("fold") == fold
        cells = buckets.transform(PipelineModel(stages=prep).transform(self.data)).groupBy(held.alias("held"), "label_idx", "weight", *bins).agg(F.count(F.lit(1)).alias("n"))
        return PipelineModel(stages=[*prep, buckets, assembler]), shared_table(cells, "cells")

    def _drawn(self, stages: PipelineModel, cells: DataFrame, trees: int, n_cells: int) -> DataFrame:
        """The training cells as vectors with their draws in every tree's bootstrap."""
        bins, seed = [f"{f}__bin" for f in self.features], self.seed
        keys = ["label_idx", "weight", *bins]

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
            for batch in batches:
                n = batch.column("n").to_numpy()
                draws = rng.poisson(n[:, None], (len(n), trees)).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, draws.size + 1, trees, dtype=np.int32)), pa.array(draws.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), lists], [*keys, "draws"])

        dealt = cells.where("NOT held").select(*keys, "n").repartition(-(-max(n_cells, 1) // PARTITION_CELLS), *keys).sortWithinPartitions(*keys)
        drawn = stages.stages[-1].transform(dealt.mapInArrow(draw, ", ".join(f"`{k}` double" for k in keys) + ", draws array<bigint>"))
        label = F.col("label_idx").alias("label_idx", metadata=nominal_labels(self.indexer.labels))
        return drawn.select(label, "features", "weight", "draws").persist(StorageLevel.MEMORY_AND_DISK)

    def _forests(self, stages: PipelineModel, cells: DataFrame, grid: Sequence[dict]) -> list[RandomForestClassificationModel]:
        """The forest of every grid point; each distinct tree is fitted once."""
        points = [{k.name: v for k, v in pm.items()} for pm in grid]
        # one tree alone sees all features, as in a Spark forest of one tree
        keys = [[(p["maxDepth"], p["minInstancesPerNode"], "all" if p["numTrees"] == 1 else "sqrt", t) for t in range(p["numTrees"])] for p in points]
        wanted = sorted({k for ks in keys for k in ks})
        n_cells = cells.where("NOT held").count()
        train = self._drawn(stages, cells, max(p["numTrees"] for p in points), n_cells)

        def fit(key):
            depth, least, strategy, t = key
            d = F.get("draws", F.lit(t))
            # a node's rows are counted by instance: as many instances of a cell as a node must have, no more
            copies = F.least(d, F.lit(least))
            rows = train.where(d > 0).select("label_idx", "features", (F.col("weight") * d / copies).alias("weight"), copies.alias("_copies"))
            if least > 1:
                rows = rows.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
            # every bin of the cells is a candidate: Spark looks for them in max(maxBins squared, 10,000) instances
            bins = max(MAX_BINS, math.isqrt(n_cells * least) + 1)
            one = self.rf.copy({self.rf.numTrees: 1, self.rf.maxDepth: depth, self.rf.minInstancesPerNode: least, self.rf.bootstrap: False,
                                self.rf.featureSubsetStrategy: strategy, self.rf.maxBins: bins, self.rf.seed: self.seed + t})
            return one.fit(rows.drop("_copies")).trees[0]

        cores = self.data.sparkSession.sparkContext.defaultParallelism
        with ThreadPool(max(1, min(16, cores, KEPT_ROWS // max(n_cells, 1)))) as pool:
            fitted = dict(zip(wanted, pool.map(fit, wanted, chunksize=1), strict=True))
        train.unpersist()
        return [self._joined([fitted[k] for k in ks], pm) for ks, pm in zip(keys, grid, strict=True)]

    def _joined(self, trees: Sequence, params: dict) -> RandomForestClassificationModel:
        """One forest of fitted trees."""
        sc = self.data.sparkSession.sparkContext
        java = sc._jvm.org.apache.spark.ml.classification
        array = sc._gateway.new_array(java.DecisionTreeClassificationModel, len(trees))
        for i, tree in enumerate(trees):
            array[i] = tree._java_obj
        uid = f"{self.rf.uid}_{len(trees)}"
        forest = RandomForestClassificationModel(java.RandomForestClassificationModel(uid, array, len(self.features), trees[0].numClasses))
        forest._set(featuresCol="features", labelCol="label_idx", **{k.name: v for k, v in params.items()})
        forest._transfer_params_to_java()
        return forest

    def scores(self, fold: int, evaluator, own_metric: bool) -> list[float]:
        """The score of every grid point on ``fold``, fitted on the others: a cell counts as its rows. A
        metric of the caller's own gets the rows."""
        stages, cells = self._cells(fold)
        forests = self._forests(stages, cells, self.grid)
        if own_metric:
            held = stages.transform(self.data.where(F.col("fold") == fold))
        else:
            held = stages.stages[-1].transform(cells.where("held")).persist(StorageLevel.MEMORY_AND_DISK)
            evaluator = evaluator.copy({evaluator.weightCol: "n"})
        found = [evaluator.evaluate(forest.transform(held)) for forest in forests]
        held.unpersist()
        return found

    def refit(self, params: dict) -> PipelineModel:
        stages, cells = self.every
        return PipelineModel(stages=[*stages.stages, *self._forests(stages, cells, [params])])


def bin_cuts(model: PipelineModel) -> list[list[float]] | None:
    """The inner bin edges of a pipeline whose forest sees bins, by feature; None where it sees values."""
    for stage in model.stages:
        if isinstance(stage, Bucketizer):
            return [list(s[1:-1]) for s in stage.getSplitsArray()]
    return None


def top_results(results: DataFrame, n: int = 5) -> DataFrame:
    """AGG25: best grid points by mean score."""
    return results.orderBy(F.desc("mean_score"), "n_estimators", "max_depth").limit(n)


def feature_importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """SRT8: (feature, importance) sorted descending."""
    from pyspark.sql import SparkSession

    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(sorted(zip(features, map(float, imp)), key=lambda x: (-x[1], x[0])),
                                 "feature string, importance double")


def check_columns(df: DataFrame, features: Sequence[str], allow_extra: bool = True) -> None:
    """PRJ4: the fitted features must all be present; with ``allow_extra=False``
    any other column is an error too (the reference's strict guard)."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    if not allow_extra:
        extra = [c for c in df.columns if c not in set(features)]
        if extra:
            raise ValueError(f"unexpected feature columns: {extra}")


def select_features(df: DataFrame, features: Sequence[str], allow_extra: bool = True) -> DataFrame:
    """PRJ4: fitted features in training order, after the column check."""
    check_columns(df, features, allow_extra)
    return df.select(*features)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """ML4/ML11: predicted label, probability vector and the probability of the
    predicted class."""
    check_columns(df, features)
    out = model.transform(df).drop(*[f"{f}__{kind}" for f in features for kind in ("filled", "bin")])
    labels = F.array(*[F.lit(c) for c in classes])
    probs = vector_to_array("probability")
    return (out.withColumn("predicted", F.element_at(labels, F.col("prediction").cast("int") + 1))
            .withColumn("probability_of_prediction", F.element_at(probs, F.col("prediction").cast("int") + 1)))


def top_k_classes(prob_col: Column, classes: Sequence[str], k: int) -> Column:
    """SRT6: top-k (class, probability) by probability desc, k clamped to [1, n]."""
    k = max(1, min(int(k), len(classes)))
    names = F.array(*[F.lit(c) for c in classes])
    zipped = F.arrays_zip(vector_to_array(prob_col).alias("p"), names.alias("c"))
    ranked = F.array_sort(F.transform(zipped, lambda z: F.struct((F.lit(0.0) - z["p"] + F.lit(0.0)).alias("neg"),
                                                                z["c"].alias("disease"),
                                                                z["p"].alias("probability"))))
    return F.slice(F.transform(ranked, lambda s: F.struct(s["disease"], s["probability"])), 1, k)


def binary_vectors(df: DataFrame, items_col: str, vocabulary: Sequence[str], out: str = "features") -> DataFrame:
    """ML8: binary vector over a fixed vocabulary, plus the recognised items."""
    cv = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=items_col, outputCol=out)
    cv.setBinary(True)
    vocab = F.array(*[F.lit(v) for v in vocabulary])
    res = cv.transform(df)
    return res.withColumn("recognised", F.array_distinct(F.filter(F.col(items_col),
                                                                  lambda x: F.array_contains(vocab, x))))


def poisson_weight(id_col: str, group: int, seed: int) -> Column:
    """How often a bootstrap draws the row: Poisson(1) from a hash of its id, the group and the seed."""
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit(group), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    p = total = math.exp(-1.0)
    out = F.when(u < total, 0)
    for k in range(1, 9):
        p /= k
        total += p
        out = out.when(u < total, k)
    return out.otherwise(9)


class GroupedForest:
    """Forests of equal size fitted on different bootstraps, one model: class probabilities
    are their mean, which is the vote of all their trees."""

    def __init__(self, models: Sequence, classes: Sequence[str]):
        self.models, self.classes = list(models), list(classes)

    @property
    def n_trees(self) -> int:
        return sum(m.getNumTrees for m in self.models)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for i, m in enumerate(self.models):
            own = m.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
            out = own.transform(out)
        parts = [vector_to_array(f"_p{i}") for i in range(len(self.models))]
        mean = F.array(*[sum((F.get(p, c) for p in parts[1:]), F.get(parts[0], c)) / len(parts) for c in range(len(self.classes))])
        out = out.withColumn("_ml_probs", mean)
        best = F.array_position("_ml_probs", F.array_max("_ml_probs")) - 1
        return (out.withColumn("probability", array_to_vector("_ml_probs")).withColumn("prediction", best.cast("double"))
                .drop("_ml_probs", *[f"_p{i}" for i in range(len(self.models))]))


def fit_multiclass(df: DataFrame, features_col: str, label: str, n_trees: int = 50, seed: int = 42,
                   weighted: bool = True, groups: int = 1, id_col: str | None = None, parallelism: int = 4):
    """ML7: multi-class forest. Returns (model, classes).

    With ``groups`` above 1 the trees are fitted in so many groups. A group sees its own Poisson
    bootstrap of the rows (by ``id_col``) and class weights balanced inside that bootstrap, and
    every tree resamples again within it; with one group the weights are balanced once. The data
    are written once; the bootstrap totals of all groups and classes are one aggregate.
    """
    if groups <= 1:
        data = with_weights(df, label, "weight") if weighted else df.withColumn("weight", F.lit(1.0))
        indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
        rf = RandomForestClassifier(featuresCol=features_col, labelCol="label_idx", weightCol="weight",
                                    numTrees=n_trees, seed=seed)
        model = Pipeline(stages=[indexer, rf]).fit(data)
        return model, list(model.stages[0].labels)
    if id_col is None or n_trees % groups:
        raise ValueError("groups need id_col and a number of trees that they divide")
    draws = [poisson_weight(id_col, g, seed).alias(f"_d{g}") for g in range(groups)]
    data = shared_table(df.where(F.col(label).isNotNull()).select(features_col, label, *draws), "bootstraps")
    totals = data.groupBy(label).agg(*[F.sum(f"_d{g}").alias(f"_d{g}") for g in range(groups)]).orderBy(label).collect()
    classes = [r[label] for r in totals]
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    data = data.withColumn("label_idx", index.cast("double"))

    def fit_group(g: int):
        drawn = [r[f"_d{g}"] for r in totals]
        n, k = sum(drawn), sum(d > 0 for d in drawn)
        balance = F.get(F.array(*[F.lit(n / (k * d) if weighted and d else 1.0) for d in drawn]), F.col("label_idx").cast("int"))
        rows = data.withColumn("weight", F.col(f"_d{g}") * balance).where("weight > 0")
        # every class keeps its index also where a bootstrap lacks it
        rows = rows.withColumn("label_idx", F.col("label_idx").alias("label_idx", metadata=nominal_labels(classes)))
        rf = RandomForestClassifier(featuresCol=features_col, labelCol="label_idx", weightCol="weight", numTrees=n_trees // groups, seed=seed + g)
        return rf.fit(rows)

    with ThreadPool(parallelism) as pool:
        return GroupedForest(pool.map(fit_group, range(groups)), classes), classes


def nominal_labels(classes: Sequence[str]) -> dict:
    return {"ml_attr": {"type": "nominal", "vals": list(classes), "name": "label_idx"}}


def reason_code(recognised: Column, ready: bool = True) -> Column:
    """ML9: why there are (no) predictions: model_not_ready, no_recognized_symptoms or ok."""
    if not ready:
        return F.lit("model_not_ready")
    return F.when(F.size(recognised) == 0, F.lit("no_recognized_symptoms")).otherwise(F.lit("ok"))


def predict_topk(model, df: DataFrame, classes: Sequence[str], k: int = 5) -> DataFrame:
    """ML9: top-k classes with probabilities and a reason code per row; without a model (None)
    every row says so and has no predictions."""
    if model is None:
        return (df.withColumn("reason", reason_code(F.col("recognised"), ready=False))
                .withColumn("predictions", F.lit(None).cast("array<struct<disease:string,probability:double>>")))
    out = model.transform(df)
    return (out.withColumn("reason", reason_code(F.col("recognised")))
            .withColumn("predictions", F.when(F.col("reason") == "ok", top_k_classes(F.col("probability"), classes, k))))


def forest_probabilities(model, features: Column, cuts: Sequence[Sequence[float]] | None = None) -> Column:
    """A fitted Spark forest as a row expression: class probabilities of an array of features.

    The trees' nodes are constant arrays; a row walks every tree in ``aggregate`` folds, so a
    prediction needs no vector column, no transformer and no join. ``cuts`` (``bin_cuts``) turn the
    splits of a forest over bins into splits of the values."""
    feature, threshold, left, right, share = [], [], [], [], []
    roots, depth, classes = [], 1, model.numClasses

    def add(node, level: int) -> int:
        nonlocal depth
        depth = max(depth, level)
        at = len(feature)
        stats = list(node.impurityStats().stats())
        total = sum(stats) or 1.0
        share.extend(s / total for s in stats)
        for column, value in ((feature, -1), (threshold, 0.0), (left, at), (right, at)):
            column.append(value)
        if node.subtreeDepth() > 0:
            split = node.split()
            feature[at], threshold[at] = split.featureIndex(), _split_value(split, cuts)
            left[at], right[at] = add(node.leftChild(), level + 1), add(node.rightChild(), level + 1)
        return at

    for tree in model.trees:
        roots.append(add(tree._java_obj.rootNode(), 1))
    constant = lambda values, kind: F.expr("array(" + ", ".join(f"CAST({v!r} AS {kind})" for v in values) + ")")
    f, t, lo, hi, p = constant(feature, "int"), constant(threshold, "double"), constant(left, "int"), constant(right, "int"), constant(share, "double")
    below = lambda n: F.get(features, F.get(f, n)) <= F.get(t, n)
    walk = lambda root: F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, lambda n, _: F.when(
        F.get(f, n) < 0, n).when(below(n), F.get(lo, n)).otherwise(F.get(hi, n)))
    leaves = F.transform(constant(roots, "int"), walk)
    zero = F.array_repeat(F.lit(0.0), classes)
    votes = F.aggregate(leaves, zero, lambda acc, n: F.zip_with(acc, F.slice(p, n * classes + 1, classes), lambda a, b: a + b))
    return F.transform(votes, lambda v: v / len(roots))


def add_forest_probabilities(df: DataFrame, model, features_col: str, out: str, known: str, cuts: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """``forest_probabilities`` of the array column ``features_col`` as ``out``, and whether every feature is there as ``known``.

    A value's place among a feature's split values (at most ``maxBins`` - 1, whatever the forest) names, for every tree, the
    leaves that its splits on this feature leave over, as bits of a word; the lowest bit left by all features is
    the row's leaf. Forests of trees with more than ``LEAVES`` leaves, or of more than ``LEAF_TREES`` trees, are walked.
    The lambda of ``known`` stands in the same step on purpose: it keeps the step out of whole-stage code, whose
    single method would be too long to be compiled."""
    every = F.forall(features_col, lambda v: v.isNotNull())
    flat = [_leaves(tree._java_obj.rootNode(), cuts) for tree in model.trees]
    at = [sorted({t for splits, _ in flat for f, t, _ in splits if f == i}) for i in range(model.numFeatures)]
    if len(flat) > LEAF_TREES or max(len(leaves) for _, leaves in flat) > LEAVES or max(map(len, at)) >= 1_000:
        return df.withColumns({out: forest_probabilities(model, F.col(features_col), cuts), known: every})

    def place(x: Column, values: Sequence[float], low: int, high: int) -> Column:
        """How many of the sorted values are below ``x``."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x <= values[middle], place(x, values, low, middle)).otherwise(place(x, values, middle + 1, high))

    places = [place(F.get(features_col, F.lit(i)), values, 0, len(values)) for i, values in enumerate(at)]
    votes: list[list[Column]] = [[] for _ in range(model.numClasses)]
    for splits, leaves in flat:
        every_leaf = (1 << len(leaves)) - 1
        word = F.lit(every_leaf).cast("bigint")
        for i in sorted({f for f, _, _ in splits}):
            masks = []
            for p in range(len(at[i]) + 1):
                left = every_leaf
                for f, t, gone in splits:
                    # beyond the split value the leaves on its left are out of reach
                    if f == i and p > at[i].index(t):
                        left &= ~gone
                masks.append(left)
            word = word.bitwiseAND(F.get(F.expr("array(" + ", ".join(f"{v}L" for v in masks) + ")"), places[i]))
        leaf = F.bit_count(word.bitwiseAND(F.negative(word)) - 1)
        for c, vote in enumerate(votes):
            vote.append(F.get(F.expr("array(" + ", ".join(f"CAST({shares[c]!r} AS double)" for shares in leaves) + ")"), leaf))
    return df.withColumns({out: F.array(*[sum(vote[1:], vote[0]) / len(flat) for vote in votes]), known: every})


def _leaves(node, cuts: Sequence[Sequence[float]] | None) -> tuple[list, list]:
    """A tree as its splits (feature, value, bits of the leaves on the left) and the class shares of its leaves, left to right."""
    splits, leaves = [], []

    def add(node) -> int:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            total = sum(stats) or 1.0
            leaves.append([s / total for s in stats])
            return 1 << (len(leaves) - 1)
        split = node.split()
        left = add(node.leftChild())
        splits.append((split.featureIndex(), _split_value(split, cuts), left))
        return left | add(node.rightChild())

    add(node)
    return splits, leaves


def _split_value(split, cuts: Sequence[Sequence[float]] | None) -> float:
    if "Continuous" not in split.getClass().getSimpleName():
        raise ValueError("only splits at a threshold are written as an expression")
    if cuts:
        return math.nextafter(cuts[split.featureIndex()][math.floor(split.threshold())], -math.inf)
    return split.threshold()


def model_summary(model: PipelineModel, results: DataFrame, train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                  positive: str, classes: Sequence[str]) -> DataFrame:
    """ML6: one table (section, name, value) of a fitted search: the best parameters, the scores on
    train and test, the test confusion counts and report, and the importances."""
    spark = train.sparkSession
    rf = model.stages[-1]
    rows = [("parameters", "n_estimators", float(rf.getNumTrees)), ("parameters", "max_depth", float(rf.getOrDefault("maxDepth"))),
            ("parameters", "min_instances_per_node", float(rf.getOrDefault("minInstancesPerNode"))), ("parameters", "n_features", float(len(features)))]
    best = results.orderBy(F.desc("mean_score"), "n_estimators", "max_depth").first()
    rows += [("cross_validation", "mean_score", best["mean_score"]), ("cross_validation", "std_score", best["std_score"])]
    p_pos = F.get(vector_to_array("probability"), list(classes).index(positive))
    for name, part in (("train", train), ("test", test)):
        p = shared_table(predict(model, part, features, classes).select(F.col(label).alias("y"), "predicted", p_pos.alias("p_pos")), "scored")
        prf = binary_prf(p, "y", "predicted", positive).first()
        rows += [(name, k, float(prf[k])) for k in ("precision", "recall", "f1", "accuracy")]
        rows.append((name, "roc_auc", auc_exact(p, "y", "p_pos", positive).first()["auc"]))
    rows += [("confusion", f"{r['label']} as {r['predicted']}", float(r["n"])) for r in confusion(p, "y", "predicted", classes).collect()]
    rows += [("report", f"{r['row']} {k}", r[k]) for r in class_report(p, "y", "predicted").collect() for k in ("precision", "recall", "f1") if r[k] is not None]
    rows += [("importance", r["feature"], r["importance"]) for r in feature_importances(model, features).collect()]
    return spark.createDataFrame(rows, "section string, name string, value double")


def map_to_features(m: Column, features: Sequence[str], canon) -> Column:
    """ML10: feature values from a measurement map matched on canonical keys; of equal keys the last counts.

    All keys are made canonical as one text, and a feature is the last of them of its name."""
    mark, plain = "\u0001", F.transform(F.map_keys(m), canon)
    if canon is canonical_key:
        spelled = F.split(F.regexp_replace(F.lower(F.array_join(F.map_keys(m), mark)), rf"[\P{{Alnum}}&&[^{mark}]]+", ""), mark)
        # a key that holds the mark itself would shift the others
        plain = F.when(F.size(spelled) == F.cardinality(m), spelled).otherwise(plain)
    keys, values = F.reverse(plain), F.reverse(F.map_values(m))
    return F.array(*[F.get(values, F.nullif(F.array_position(keys, F.lit(_canon_py(f))), F.lit(0)).cast("int") - 1) for f in features])


def _canon_py(s: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]", "", s.lower())
