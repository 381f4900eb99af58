"""Model training, search and evaluation on Spark ML.

The reference trains scikit-learn models on a driver-side pandas copy; here
the same steps are a ``pyspark.ml.Pipeline`` fitted on executors:
median imputation for numbers, most-frequent imputation for categories,
one-hot (unknown and null levels give all zeros), vector assembly, then a
random forest or decision tree. Only fitted parameters, levels and metrics
reach the driver."""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, OneHotEncoder, OneHotEncoderModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import impute, metrics, splits, stats

FEATURES = "features"
# The vector with the bins of the numbers in place of the numbers; its slots are those of FEATURES.
BINNED = "features_binned"
WEIGHT = "_tm_weight"
TARGETS = "_tm_targets"
# A classifier's trees look at bins, so rows with equal bins, levels and label can be one row with a
# weight. Done where that leaves at most one row of so many; otherwise the rows themselves are fitted.
ROWS_PER_GROUP = 4
# Partitions up to which sketches of quantiles are joined as they are.
SKETCH_PARTITIONS = 24
# Rows from which a fit on groups, a chain of small jobs for each tree, is the faster one.
GROUPS_FROM_ROWS = 500_000
# Bins of a number: Spark's default for a tree.
MAX_BINS = 32
GROUPS_PER_PARTITION = 40_000
# Trees of one forest that grow at the same time on row groups: each is a chain of small jobs.
TREES_AT_ONCE = 8
# Trees whose draws are written together: each tree's fit reads those of all of them.
TREES_PER_DRAW = 10
# Such draws that are there at the same time.
DRAWS_AT_ONCE = 4
# Targets of one bin cell in one row; a cell with more has several rows.
TARGETS_PER_ROW = 100_000
# Cells of a forest whose predictions a task keeps; with more it begins anew.
CELLS_KEPT = 1_000_000
# Tree training: per-pass node statistics budget (MB), so many trees grow per pass over
# the data instead of a few.
TREE_MEMORY_MB = 512
# Rows of one partition of a fit's input, whatever the cluster. Every partition sends the
# statistics of all open nodes once a level, so small partitions cost more than their rows.
ROWS_PER_PARTITION = 250_000
# Trees of one fit. Beside every row Spark keeps one number for each tree that grows at the
# same time; larger forests are grown in parts, so what is kept of a row has a bound.
TREES_PER_FIT = 50
# Forests of this depth and more keep every row's node in each tree instead of finding it again from
# the root; in shallower ones that costs more memory than it saves time.
NODE_IDS_FROM_DEPTH = 8


class _HasFills(Params):
    fills = Param(Params._dummy(), "fills", "JSON object column -> fitted fill value",
                  typeConverter=TypeConverters.toString)


class ModeImputerModel(Model, HasInputCols, _HasFills, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces nulls of string columns with the level fitted as most frequent."""

    @keyword_only
    def __init__(self, inputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        out = dataset
        for c in self.getInputCols():
            if fills.get(c) is not None:
                out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fills[c])))
        return out


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Most-frequent imputation for categorical (string) columns; ties go to
    the smallest level. Spark's ``Imputer`` handles numeric columns only."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        cols = self.getInputCols()
        # One row per column: a bounded result, like any fitted parameter.
        rows = impute.fit_mode(dataset, cols).collect()
        return ModeImputerModel(inputCols=cols, fills=json.dumps({r["feature"]: r["fill"] for r in rows}))


class MedianImputerModel(Model, HasInputCols, _HasFills, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls and NaN of numeric columns, as ``<col>__imp``, with the medians seen in training."""

    @keyword_only
    def __init__(self, inputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        for c in self.getInputCols():
            x = F.col(c).cast("double")
            dataset = dataset.withColumn(f"{c}__imp", F.coalesce(F.when(~F.isnan(x), x), F.lit(fills.get(c)).cast("double")))
        return dataset


def in_few_parts(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, for quantile sketches: one task joins those of all partitions, so a number that grows
    as the root of the partitions' keeps that step as short as the making of the sketches."""
    n = df.rdd.getNumPartitions()
    return df.coalesce(max(SKETCH_PARTITIONS, math.ceil(math.sqrt(1.5 * n)))) if n > SKETCH_PARTITIONS else df


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median imputation (``impute.fit_median``) as a pipeline stage."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        cols = self.getInputCols()
        rows = impute.fit_median(in_few_parts(dataset), cols).collect()  # one row per column
        return MedianImputerModel(inputCols=cols, fills=json.dumps({r["feature"]: r["fill"] for r in rows}))


class FeatureBins(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Bins of numeric columns for trees, found over all rows: one for each value of a column with at
    most ``maxBins`` values, else between quantiles. Fits to Spark's ``Bucketizer``. A bin holds its
    upper end, as a tree's split does."""

    maxBins = Param(Params._dummy(), "maxBins", "most bins of a column", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, maxBins=MAX_BINS):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Bucketizer:
        cols, bins = self.getInputCols(), self.getOrDefault(self.maxBins)
        at, dataset = [i / bins for i in range(1, bins)], in_few_parts(dataset)
        found = dataset.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(cols)],
                            *[F.percentile_approx(c, at, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        splits_of = []
        few = {i: c for i, c in enumerate(cols) if found[f"n{i}"] <= 2 * bins}  # bounded lists: the estimate is a few percent off
        listed = dataset.agg(*[F.collect_set(c).alias(f"v{i}") for i, c in few.items()]).first() if few else None  # one scan for all
        for i in range(len(cols)):
            ends = found[f"q{i}"] or []
            if i in few:
                values = sorted(listed[f"v{i}"])
                ends = values[:-1] if len(values) <= bins else ends
            # Bucketizer's bins hold their lower end: the next number after it is the first of the next bin
            cuts = sorted({x for x in (math.nextafter(e, math.inf) for e in ends) if math.isfinite(x)})
            splits_of.append([-math.inf, *(cuts or [0.0]), math.inf])
        return Bucketizer(splitsArray=splits_of, inputCols=cols, outputCols=self.getOutputCols(), handleInvalid="keep")


class PlainVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A vector column as dense and without attributes. Trees then compare every slot with a number; for a
    slot of zeros and ones that is the one split it also has as a category, found and followed faster."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(vector_to_array(self.getInputCol())))


def preprocessing_stages(categorical: Sequence[str], numeric: Sequence[str], max_bins: int | None = None) -> list:
    """Imputation + one-hot + assembly. A level that training did not see gets
    the index after the last level, which the encoder drops: all zeros. With ``max_bins``
    there is a second vector, BINNED, with the bins of the numbers."""
    stages: list = []
    categorical, numeric = list(categorical), list(numeric)
    if numeric:
        stages.append(MedianImputer(inputCols=numeric))
    vec_in = [f"{c}__imp" for c in numeric]
    bins = [f"{c}__bin" for c in numeric]
    if numeric and max_bins:
        stages.append(FeatureBins(inputCols=vec_in, outputCols=bins, maxBins=max_bins))
    if categorical:
        stages.append(ModeImputer(inputCols=categorical))
        idx = [f"{c}__idx" for c in categorical]
        ohe = [f"{c}__ohe" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
        vec_in += ohe
        bins += ohe
    if max_bins:
        stages.append(VectorAssembler(inputCols=bins, outputCol=f"{BINNED}__parts", handleInvalid="keep"))
        stages.append(PlainVector(inputCol=f"{BINNED}__parts", outputCol=BINNED))
    stages.append(VectorAssembler(inputCols=vec_in, outputCol=FEATURES, handleInvalid="keep"))
    return stages


class ForestVote(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The prediction of a forest from those of its parts: the mean of regression trees, or the
    sum of the trees' votes by class, with probability and prediction as one forest gives them."""

    trees = Param(Params._dummy(), "trees", "number of trees of each part", typeConverter=TypeConverters.toListInt)
    classes = Param(Params._dummy(), "classes", "whether the parts are classifiers", typeConverter=TypeConverters.toBoolean)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the prediction", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, trees=None, classes=False, predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, out = self.getOrDefault(self.trees), self.getOrDefault(self.predictionCol)
        parts = range(len(trees))
        if not self.getOrDefault(self.classes):
            mean = sum((F.col(f"_tm_prediction{i}") * n for i, n in enumerate(trees)), F.lit(0.0)) / sum(trees)
            return dataset.withColumn(out, mean).drop(*[f"_tm_prediction{i}" for i in parts])
        votes = vector_to_array("_tm_raw0")
        for i in parts[1:]:
            votes = F.zip_with(votes, vector_to_array(f"_tm_raw{i}"), lambda a, b: a + b)
        given = dataset.withColumn("_tm_votes", votes)
        share = F.transform("_tm_votes", lambda v: v / float(sum(trees)))  # each tree's votes sum to one
        best = (F.array_position("_tm_votes", F.array_max("_tm_votes")) - 1).cast("double")  # ties: the first class
        return (given.withColumns({"rawPrediction": array_to_vector("_tm_votes"), "probability": array_to_vector(share), out: best})
                .drop("_tm_votes", *[f"_tm_{c}{i}" for i in parts for c in ("raw", "probability", "prediction")]))


def forest_stages(estimator) -> list:
    """The stages that fit ``estimator``: itself, or, for a forest of more than TREES_PER_FIT
    trees, equal parts with seeds of their own and the vote over them."""
    classes = isinstance(estimator, RandomForestClassifier)
    if not (classes or isinstance(estimator, RandomForestRegressor)):
        return [estimator]
    if estimator.getMaxDepth() >= NODE_IDS_FROM_DEPTH:
        estimator = estimator.copy({estimator.cacheNodeIds: True, estimator.checkpointInterval: -1})
    if estimator.getNumTrees() <= TREES_PER_FIT:
        return [estimator]
    total = estimator.getNumTrees()
    n = -(-total // TREES_PER_FIT)
    trees = [total // n + (i < total % n) for i in range(n)]
    parts = []
    for i, k in enumerate(trees):
        own = {estimator.numTrees: k, estimator.seed: estimator.getSeed() + i, estimator.predictionCol: f"_tm_prediction{i}"}
        if classes:
            own |= {estimator.rawPredictionCol: f"_tm_raw{i}", estimator.probabilityCol: f"_tm_probability{i}"}
        parts.append(estimator.copy(own))
    return [*parts, ForestVote(trees=trees, classes=classes, predictionCol=estimator.getPredictionCol())]


def row_groups(df: DataFrame, steps: PipelineModel, label: str, categorical: Sequence[str], numeric: Sequence[str],
               least: int = ROWS_PER_GROUP) -> DataFrame | None:
    """The rows of ``df`` (as it was before ``steps``, which are fitted with bins) as one row for each label, bins and
    levels that occur, with their number as WEIGHT and the vector BINNED, in a fixed order. None if that
    leaves more than one row of ``least``, or there are fewer rows than GROUPS_FROM_ROWS (``least`` 0: never)."""
    same, cell = cells(df, steps, label, categorical, numeric)
    keys = [label, *cell]
    counts = same.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)).checkpoint(eager=True)
    n, rows = counts.agg(F.count(F.lit(1)), F.sum(WEIGHT)).first()
    if least and (n * least > (rows or 0) or (rows or 0) < GROUPS_FROM_ROWS):
        return None
    return stable_input(binned_vector(counts, steps).select(*keys, BINNED, WEIGHT), keys, max(1, -(-n // GROUPS_PER_PARTITION)))


def cells(df: DataFrame, steps: PipelineModel, label: str, categorical: Sequence[str], numeric: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The label, bins and levels of every row of ``df``, and the names of the bins and levels."""
    bins, levels = [f"{c}__bin" for c in numeric], [f"{c}__idx" for c in categorical]
    # the sum drops the bucketizer's metadata: bins are numbers to a tree, not categories
    return steps.transform(df).select(label, *[(F.col(c) + 0.0).alias(c) for c in bins], *levels), [*bins, *levels]


def binned_vector(df: DataFrame, steps: PipelineModel) -> DataFrame:
    """Adds the vector BINNED to rows with bins and levels."""
    for step in steps.stages:
        if isinstance(step, (OneHotEncoderModel, PlainVector)) or isinstance(step, VectorAssembler) and step.getOutputCol() != FEATURES:
            df = step.transform(df)
    return df


def target_lists(df: DataFrame, steps: PipelineModel, label: str, categorical: Sequence[str], numeric: Sequence[str],
                 least: int = ROWS_PER_GROUP) -> DataFrame | None:
    """The rows of ``df`` (as in ``row_groups``) as one row for each bins and levels that occur, with the targets of
    all its rows, sorted, as TARGETS and the vector BINNED; a cell with more than TARGETS_PER_ROW has several
    rows. None if cells are more than one row of ``least``, there are fewer rows than GROUPS_FROM_ROWS, or a
    target is no finite number (``least`` 0: for that alone)."""
    same, keys = cells(df, steps, label, categorical, numeric)
    y = F.col(label).cast("double")
    bad = F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == math.inf))
    counts = same.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tm_n"), bad.alias("_tm_bad")).checkpoint(eager=True)
    n, rows, most, wrong = counts.agg(F.count(F.lit(1)), F.sum("_tm_n"), F.max("_tm_n"), F.sum("_tm_bad")).first()
    if not n or wrong or least and (n * least > rows or rows < GROUPS_FROM_ROWS):
        return None
    dealt = same.select(*keys, y.alias("_tm_y"), F.monotonically_increasing_id().alias("_tm_row"))
    part = F.lit(0).cast("long")
    if most > TARGETS_PER_ROW:  # few cells: one of so many rows at most
        large = counts.where(F.col("_tm_n") > TARGETS_PER_ROW).select(*[F.col(c).alias(f"_tm_{c}") for c in keys], F.ceil(F.col("_tm_n") / TARGETS_PER_ROW).alias("_tm_parts"))
        dealt = dealt.join(F.broadcast(large), [F.col(c).eqNullSafe(F.col(f"_tm_{c}")) for c in keys], "left")
        part = F.when(F.col("_tm_parts").isNotNull(), F.pmod(F.xxhash64("_tm_row"), F.col("_tm_parts"))).otherwise(part)
    own = [*keys, "_tm_part"]
    lists = (dealt.select(*keys, part.alias("_tm_part"), "_tm_y").repartition(max(8, -(-rows // ROWS_PER_PARTITION)), *own)
             .groupBy(*own).agg(F.sort_array(F.collect_list("_tm_y")).alias(TARGETS)))
    return binned_vector(lists, steps).select(*own, BINNED, TARGETS).sortWithinPartitions(*own).checkpoint(eager=True)


def groups_alike(estimator) -> bool:
    """Whether ``estimator`` gives the same model on row groups with weights as on their rows: boosted trees on
    all rows, and forests whose trees draw as many rows as there are, with no more than one row asked of a leaf."""
    if isinstance(estimator, OneVsRest):
        return not estimator.isSet(estimator.weightCol) and groups_alike(estimator.getClassifier())
    if not isinstance(estimator, (RandomForestClassifier, RandomForestRegressor, GBTClassifier)):
        return False
    whole = estimator.getSubsamplingRate() == 1.0 and estimator.getMinInstancesPerNode() == 1 and not estimator.isSet(estimator.weightCol)
    return whole and estimator.getMaxBins() == MAX_BINS and (isinstance(estimator, GBTClassifier) or estimator.getBootstrap())


def bootstrap_weights(groups: DataFrame, keys: Sequence[str], draw: int, seed: int) -> DataFrame:
    """Adds ``_tm_drawn``: how often each tree of draw number ``draw`` (TREES_PER_DRAW trees) draws the rows of a
    group. A bootstrap draws each row Poisson(1) times, so a group of ``w`` rows together Poisson(w) times."""
    n = TREES_PER_DRAW

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def drawn(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, weight in it:
            yield pd.Series([np.random.default_rng([seed % 2 ** 64, draw, int(k) % 2 ** 64]).poisson(w, n).astype(float)
                             for k, w in zip(key, weight)], index=key.index, dtype=object)

    return groups.withColumn("_tm_drawn", drawn(F.xxhash64(*keys), F.col(WEIGHT)))


def draw_targets(lists: DataFrame, keys: Sequence[str], draw: int, seed: int) -> DataFrame:
    """Adds ``_tm_drawn`` to ``target_lists``: for each tree of draw number ``draw`` (TREES_PER_DRAW trees) how often it
    draws the rows of a list, then for each tree the mean of the targets it draws, then their standard
    deviation. Every row is drawn Poisson(1) times on its own."""
    n = TREES_PER_DRAW

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def drawn(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, targets in it:
            out = []
            for k, y in zip(key, targets):
                middle = y.mean()
                off = y - middle
                times = np.random.default_rng([seed % 2 ** 64, draw, int(k) % 2 ** 64]).poisson(1.0, (n, len(y))).astype(float)
                total = times.sum(axis=1)
                first, second = (times @ np.stack([off, off * off], axis=1)).T / np.maximum(total, 1)
                out.append(np.concatenate([total, middle + first, np.sqrt(np.maximum(second - first * first, 0))]))
            yield pd.Series(out, index=key.index, dtype=object)

    return lists.withColumn("_tm_drawn", drawn(F.xxhash64(*keys), F.col(TARGETS)))


def grow_trees(estimator, groups: DataFrame, first: int, n: int) -> list:
    """Trees number ``first`` to ``first + n - 1`` of a forest on ``row_groups``, or of a regression forest on
    ``target_lists``, each on its own bootstrap, as forests of one."""
    if n <= 0:
        return []
    numbers, label, seed = isinstance(estimator, RandomForestRegressor), estimator.getLabelCol(), estimator.getSeed()
    features = estimator.getFeatureSubsetStrategy()
    one = estimator.copy({estimator.numTrees: 1, estimator.bootstrap: False, estimator.weightCol: "_tm_w", estimator.featuresCol: BINNED, estimator.cacheNodeIds: False,
                          estimator.featureSubsetStrategy: ("onethird" if numbers else "sqrt") if features == "auto" else features})
    keys = [c for c in groups.columns if c not in (BINNED, WEIGHT, TARGETS)]
    draws = range(first // TREES_PER_DRAW, (first + n - 1) // TREES_PER_DRAW + 1)
    partitions = max(1, -(-groups.count() // GROUPS_PER_PARTITION)) if numbers else None

    def draw(k):
        if numbers:
            return stable_input(draw_targets(groups, keys, k, seed).select(*keys, BINNED, "_tm_drawn"), keys, partitions)
        return bootstrap_weights(groups, keys, k, seed).select(label, BINNED, "_tm_drawn").checkpoint(eager=True)

    def rows_of(drawn, j):
        times, mean, spread = (F.col("_tm_drawn")[part * TREES_PER_DRAW + j] for part in range(3))
        if numbers:  # two rows with the number, sum and sum of squares of the targets drawn, all a tree knows of them
            return drawn.where(times > 0).select(F.explode(F.array(mean - spread, mean + spread)).alias(label), BINNED, (times / 2).alias("_tm_w"))
        return drawn.where(times > 0).select(label, BINNED, times.alias("_tm_w"))

    trees = []
    with ThreadPoolExecutor(TREES_AT_ONCE) as pool:  # each thread only submits Spark jobs
        for i in range(0, len(draws), DRAWS_AT_ONCE):
            now = draws[i:i + DRAWS_AT_ONCE]
            drawn = dict(zip(now, pool.map(draw, now)))

            def grow(t, drawn=drawn):
                return one.copy({one.seed: seed + t}).fit(rows_of(drawn[t // TREES_PER_DRAW], t % TREES_PER_DRAW))

            trees += pool.map(grow, range(max(first, now[0] * TREES_PER_DRAW), min(first + n, (now[-1] + 1) * TREES_PER_DRAW)))
    return trees


def join_trees(estimator, trees: Sequence):
    """One forest of the trees of ``grow_trees``."""
    sc = SparkSession.active().sparkContext
    shared = ["labelCol", "predictionCol", "maxDepth", "seed", "featureSubsetStrategy"]
    if isinstance(estimator, RandomForestRegressor):
        of, kind = sc._jvm.org.apache.spark.ml.regression, "Regression"
    else:
        of, kind = sc._jvm.org.apache.spark.ml.classification, "Classification"
        shared += ["probabilityCol", "rawPredictionCol"]
    grown = sc._gateway.new_array(getattr(of, f"DecisionTree{kind}Model"), len(trees))
    for i, t in enumerate(trees):
        grown[i] = t._java_obj.trees()[0]
    if kind == "Regression":
        model = RandomForestRegressionModel(of.RandomForestRegressionModel(grown, trees[0].numFeatures))
    else:
        model = RandomForestClassificationModel(of.RandomForestClassificationModel(grown, trees[0].numFeatures, trees[0].numClasses))
    for c in shared:
        model._set(**{c: estimator.getOrDefault(c)})
    model._set(featuresCol=BINNED, numTrees=len(trees))
    model._transfer_params_to_java()
    return model


def fit_groups(estimator, groups: DataFrame):
    """``estimator`` fitted on ``row_groups`` (see ``groups_alike``), a regression forest on ``target_lists``."""
    if isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)):
        return join_trees(estimator, grow_trees(estimator, groups, 0, estimator.getNumTrees()))
    more = {estimator.weightCol: WEIGHT, estimator.featuresCol: BINNED}
    if isinstance(estimator, OneVsRest):
        inner = estimator.getClassifier()
        more[estimator.classifier] = inner.copy({inner.featuresCol: BINNED})
    return estimator.copy(more).fit(groups)


class SharedTrees:
    """Forests on the same row groups that differ only in their number of trees: the smaller one is
    the first trees of the larger one, and each tree is grown once. "sqrt" and "log2" that come to the same number of
    features are one setting."""

    def __init__(self, groups: DataFrame):
        self.groups, self.grown, self.locks = groups, defaultdict(list), defaultdict(Lock)
        self.slots = groups.select(BINNED).first()[0].size
        self.opening = Lock()

    def _features(self, strategy: str):
        return {"sqrt": math.ceil(math.sqrt(self.slots)), "log2": max(1, math.ceil(math.log(self.slots) / math.log(2)))}.get(strategy, strategy)

    def forest(self, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
        key, n = (estimator.getMaxDepth(), self._features(estimator.getFeatureSubsetStrategy())), estimator.getNumTrees()
        with self.opening:
            lock = self.locks[key]
        with lock:
            have = self.grown[key]
            have += grow_trees(estimator, self.groups, len(have), n - len(have))
        return join_trees(estimator, have[:n])


def fit_classifier(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], estimator) -> PipelineModel:
    """The pipeline of ``build_pipeline``, fitted on ``df``; a forest on row groups where those are few."""
    if not groups_alike(estimator):
        return build_pipeline(categorical, numeric, estimator).fit(df)
    return _fit_grouped(df, label, categorical, numeric, estimator, row_groups)


def fit_regressor(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], estimator) -> PipelineModel:
    """The pipeline of ``build_pipeline``, fitted on ``df``; a forest on lists of targets where those are few."""
    if not (isinstance(estimator, RandomForestRegressor) and groups_alike(estimator)) or df.count() < GROUPS_FROM_ROWS:
        return build_pipeline(categorical, numeric, estimator).fit(df)
    return _fit_grouped(df, label, categorical, numeric, estimator, target_lists)


def _fit_grouped(df, label, categorical, numeric, estimator, grouped) -> PipelineModel:
    steps = Pipeline(stages=preprocessing_stages(categorical, numeric, MAX_BINS)).fit(df)
    groups = grouped(df, steps, label, categorical, numeric)
    if groups is None:
        return build_pipeline(categorical, numeric, estimator).fit(df)
    return PipelineModel(stages=[*steps.stages, fit_groups(estimator, groups)])


def build_pipeline(categorical: Sequence[str], numeric: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(categorical, numeric) + forest_stages(estimator))


def rf_regressor(label: str, num_trees: int = 500, max_depth: int = 5, seed: int = 42,
                 feature_subset: str = "log2") -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol=FEATURES, numTrees=num_trees, maxDepth=max_depth,
                                 featureSubsetStrategy=feature_subset, seed=seed,
                                 maxMemoryInMB=TREE_MEMORY_MB)


def rf_classifier(label: str, num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=FEATURES, numTrees=num_trees, maxDepth=max_depth,
                                  seed=seed, maxMemoryInMB=TREE_MEMORY_MB)


def tree_classifier(label: str, max_depth: int = 5, seed: int = 42) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=max_depth, seed=seed,
                                  maxMemoryInMB=TREE_MEMORY_MB)


def tree_regressor(label: str, max_depth: int = 5, max_bins: int = 64, seed: int = 42) -> DecisionTreeRegressor:
    """One regression tree. A feature with at most ``max_bins`` different values is split at any of them."""
    return DecisionTreeRegressor(labelCol=label, featuresCol=FEATURES, maxDepth=max_depth, maxBins=max_bins, seed=seed,
                                 maxMemoryInMB=TREE_MEMORY_MB)


def index_label(df: DataFrame, label: str, out: str = "label_idx"):
    """String (or int) label -> double index, levels sorted; returns
    (indexed frame, fitted indexer)."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="error").fit(df)
    return model.transform(df), model


def fit_partitions(df: DataFrame) -> int:
    """Number of partitions of a fit's input with the rows of ``df``."""
    return max(8, -(-df.count() // ROWS_PER_PARTITION))


def stable_input(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` as tree fits should read it: dealt by key to a number of partitions that
    follows from its rows (ROWS_PER_PARTITION each, 8 at least) or is given, sorted in each,
    and written to the shared folder.

    Spark's forests draw their samples per partition and in row order, so the
    model depends on both; fixed like this it does not depend on the cluster."""
    from tidemark.session import shared_dir
    shared_dir(df.sparkSession)
    if partitions is None:
        partitions = fit_partitions(df)
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)


def train_classifier(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str],
                     estimator=None, test_fraction: float = 0.2, seed: int = 42, keys: Sequence[str] | None = None,
                     partitions: int | None = None):
    """Fit a classification pipeline on the train side of a stratified split and
    evaluate on the test side, with the split written once. Returns (model, label
    indexer, test predictions, metrics row: n, accuracy, auc_hard (one level
    against the rest, averaged), f1_weighted)."""
    keys = list(keys or df.columns)
    indexed, indexer = index_label(df, label)
    partitions = partitions or fit_partitions(indexed)  # the split keeps every row, and counting it would find its cuts twice
    s = stable_input(splits.stratified_split(indexed, keys, label, test_fraction, seed), keys, partitions)
    est = estimator or rf_classifier("label_idx", seed=seed)
    est.setLabelCol("label_idx")
    model = fit_classifier(s.where(F.col("split") == "train"), "label_idx", categorical, numeric, est)
    pred = model.transform(s.where(F.col("split") == "test"))
    return model, indexer, pred, metrics.multiclass_metrics(pred, "label_idx", "prediction")


def _rules(forest: RandomForestRegressionModel) -> list[np.ndarray] | None:
    """The trees of a forest one after the other, node by node: feature, threshold, left and right node, value (a leaf
    is followed by itself), and the roots. None if a split is not at a number."""
    feature, threshold, left, right, value, roots, waiting = [], [], [], [], [], [], []
    for line in forest.toDebugString.splitlines()[1:]:
        words = line.split()
        if not words:
            continue
        if words[0] == "Tree":
            roots.append(len(value))
        elif words[0] == "Else":  # the next node stands right of the node of that If
            right[waiting[-1]] = len(value)
            waiting.pop()
        elif words[0] == "Predict:":
            feature.append(0), threshold.append(math.inf), left.append(len(value)), right.append(len(value)), value.append(float(words[1]))
        elif words[0] == "If" and words[3] == "<=":
            waiting.append(len(value))
            feature.append(int(words[2])), threshold.append(float(words[4].rstrip(")"))), left.append(len(value) + 1), right.append(-1), value.append(0.0)
        else:
            return None
    return [np.array(x) for x in (feature, threshold, left, right, value, roots)]


def forest_depth(left: np.ndarray, right: np.ndarray, roots: np.ndarray) -> int:
    """Steps from a root to the deepest leaf."""
    depth, now = 0, roots
    while True:
        now = now[left[now] != now]  # leaves are followed by themselves
        if not len(now):
            return depth
        depth, now = depth + 1, np.concatenate([left[now], right[now]])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)``. A regression forest on bins is followed once in a task for all vectors that lie alike to
    every threshold of its trees, and each row gets that prediction."""
    *steps, forest = model.stages
    rules = _rules(forest) if isinstance(forest, RandomForestRegressionModel) and forest.getFeaturesCol() == BINNED else None
    if rules is None:
        return model.transform(df)
    feature, threshold, left, right, value, roots = rules
    inner, known_at_most = left != np.arange(len(left)), CELLS_KEPT
    ends = [np.unique(threshold[inner & (feature == f)]) for f in range(forest.numFeatures)]
    if math.prod(len(e) + 1 for e in ends) >= 2 ** 62:
        return model.transform(df)
    place = np.zeros(len(feature), dtype=np.int64)  # of a node's threshold among those of its feature
    for f, e in enumerate(ends):
        own = inner & (feature == f)
        place[own] = np.searchsorted(e, threshold[own])
    steps_down = forest_depth(left, right, roots)

    @F.arrow_udf(T.DoubleType())
    def follow(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, found = np.empty(0, dtype=np.int64), np.empty(0)
        for vectors in it:
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), len(ends))
            at = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(ends)], axis=1)  # x <= the threshold of place p: at <= p
            code = np.zeros(len(x), dtype=np.int64)
            for f, e in enumerate(ends):
                code = code * (len(e) + 1) + at[:, f]
            if len(known) > known_at_most:
                known, found = known[:0], found[:0]
            new, first = np.unique(code, return_index=True)
            i = np.searchsorted(known, new)
            fresh = np.ones(len(new), dtype=bool)
            inside = i < len(known)
            fresh[inside] = known[i[inside]] != new[inside]
            new, first = new[fresh], first[fresh]
            if len(new):
                cell, rows, total = at[first], np.arange(len(new)), np.zeros(len(new))
                for root in roots:
                    node = np.full(len(new), root)
                    for _ in range(steps_down):
                        node = np.where(cell[rows, feature[node]] <= place[node], left[node], right[node])
                    total += value[node]
                known, found = np.concatenate([known, new]), np.concatenate([found, total / len(roots)])
                order = np.argsort(known, kind="stable")
                known, found = known[order], found[order]
            yield pa.array(found[np.searchsorted(known, code)])

    return PipelineModel(stages=steps).transform(df).withColumn(forest.getPredictionCol(), follow(vector_to_array(BINNED)))


def feature_importances(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """(feature, importance) of the pipeline's tree model, the mean over the trees of a forest in
    parts, names taken from the assembled vector's attribute metadata (one row per vector slot)."""
    grown = [s for s in model.stages if hasattr(s, "featureImportances")]
    trees = [getattr(s, "getNumTrees", 1) for s in grown]
    assembled = model.transform(frame.limit(1))
    meta = assembled.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    names: dict[int, str] = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = (sum(s.featureImportances.toArray() * n for s, n in zip(grown, trees)) / sum(trees)).tolist()
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return frame.sparkSession.createDataFrame(rows, schema)


def search_classifier(train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str],
                      keys: Sequence[str], max_trials: int = 30, folds: int = 3, parallelism: int = 4, seed: int = 42,
                      time_limit: float | None = None, partitions: int | None = None):
    """Model search by F1 over a grid, k-fold cross validation (folds by key hash)
    with ``parallelism`` settings at a time. The whole grid is tried if ``max_trials`` allows; otherwise
    the settings with the smallest hashes, which spread over all its dimensions.
    With ``time_limit`` (seconds) settings are tried in that order, in rounds of
    ``parallelism``, and no round starts once the time is spent; the best model
    so far is returned. On row groups, settings that differ in the number of trees share their first trees.
    Returns (best PipelineModel, table of trial, numTrees, maxDepth, featureSubsetStrategy, f1)."""
    import hashlib
    import time

    rf = rf_classifier(label, seed=seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, [20, 50, 100]).addGrid(rf.maxDepth, [3, 5, 7])
            .addGrid(rf.featureSubsetStrategy, ["sqrt", "log2"]).build())

    def setting(pm):
        return int(pm[rf.numTrees]), int(pm[rf.maxDepth]), str(pm[rf.featureSubsetStrategy])

    grid = sorted(grid, key=lambda pm: hashlib.md5(repr((setting(pm), seed)).encode()).digest())[:max_trials]
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")
    data = stable_input(train.withColumn("_fold", F.floor(splits.hash_unit(keys, seed) * folds)), keys, partitions)
    # Preprocessing does not depend on the setting: fitted and applied once per fold.
    sides = []
    for k in range(folds):
        rows, held = data.where(F.col("_fold") != k), data.where(F.col("_fold") == k)
        fitted = Pipeline(stages=preprocessing_stages(categorical, numeric, MAX_BINS)).fit(rows)
        groups = row_groups(rows, fitted, label, categorical, numeric)
        if groups is not None:
            sides.append((SharedTrees(groups), row_groups(held, fitted, label, categorical, numeric, least=0)))
            continue
        ready = fitted.transform(data).select(label, FEATURES, "_fold").checkpoint(eager=True)
        sides.append((ready.where(F.col("_fold") != k), ready.where(F.col("_fold") == k)))

    def f1_of(pm, fit, test):
        if isinstance(fit, SharedTrees):
            return ev.copy({ev.weightCol: WEIGHT}).evaluate(fit.forest(rf.copy(pm)).transform(test))
        return ev.evaluate(Pipeline(stages=forest_stages(rf.copy(pm))).fit(fit).transform(test))

    def mean_f1(pm):
        return sum(f1_of(pm, fit, test) for fit, test in sides) / folds

    start = time.monotonic()
    results, best, best_f1 = [], None, float("-inf")
    with ThreadPoolExecutor(max(1, parallelism)) as pool:  # each thread only submits Spark jobs
        for i in range(0, len(grid), max(1, parallelism)):
            if time_limit is not None and results and time.monotonic() - start >= time_limit:
                break
            chunk = grid[i:i + max(1, parallelism)]
            for j, (pm, f1) in enumerate(zip(chunk, pool.map(mean_f1, chunk))):
                results.append((i + j, *setting(pm), float(f1)))
                if f1 > best_f1:
                    best, best_f1 = pm, f1
    best_model = fit_classifier(data, label, categorical, numeric, rf.copy(best)) if best is not None else None
    schema = "trial int, numTrees int, maxDepth int, featureSubsetStrategy string, f1 double"
    return best_model, train.sparkSession.createDataFrame(results, schema)


def model_families(label: str, n_classes: int = 2, seed: int = 42) -> list[tuple[str, str, object]]:
    """(family, setting, estimator) of the search over families: forests, logistic regressions and boosted
    trees (one against the rest for more than two classes), four settings each."""
    found: list[tuple[str, str, object]] = []
    for trees, depth in ((20, 4), (20, 7), (50, 4), (50, 7)):
        found.append(("forest", f"trees={trees},depth={depth}", rf_classifier(label, trees, depth, seed)))
    for reg, mix in ((0.0, 0.0), (0.01, 0.0), (0.01, 1.0), (0.1, 0.5)):
        found.append(("logistic", f"reg={reg},mix={mix}", LogisticRegression(labelCol=label, featuresCol=FEATURES, regParam=reg, elasticNetParam=mix, maxIter=50)))
    for rounds, depth in ((5, 2), (5, 4), (15, 2), (15, 4)):
        boosted = GBTClassifier(labelCol=label, featuresCol=FEATURES, maxIter=rounds, maxDepth=depth, seed=seed, maxMemoryInMB=TREE_MEMORY_MB)
        found.append(("boosted", f"rounds={rounds},depth={depth}",
                      boosted if n_classes == 2 else OneVsRest(classifier=boosted, labelCol=label, featuresCol=FEATURES)))
    return found


def search_models(train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str], families=None,
                  rungs: Sequence[float] = (0.25, 0.5, 1.0), test_fraction: float = 0.2, parallelism: int = 4, seed: int = 42,
                  time_limit: float | None = None, partitions: int | None = None):
    """Search over model families by successive halving, ranked by F1 on rows held out by key hash.

    Every setting is fitted on a hash sample of the training rows (the first share of
    ``rungs``), the better half on the next, larger sample, which holds the first, and so
    on. Preprocessing is fitted once per rung, on its rows. With ``time_limit`` (seconds) no rung
    starts once the time is spent. Equal scores go to the earlier setting. Returns (best
    PipelineModel, trials: rung, family, setting, n_rows, f1, kept)."""
    import time

    n_classes = train.select(label).distinct().count()
    settings = list(families if families is not None else model_families(label, n_classes, seed))
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")
    share = splits.hash_unit(keys, seed)
    # the held-out share lies at the low end; samples grow from there upwards
    data = stable_input(train.withColumn("_at", (share - test_fraction) / (1 - test_fraction)), keys, partitions)
    # by column: every rung scans some of them a dozen times; the partitions and their order stay
    data = data.select(*dict.fromkeys([label, *categorical, *numeric, "_at"])).persist(StorageLevel.DISK_ONLY)
    start, trials, best = time.monotonic(), [], None
    for rung, part in enumerate(rungs):
        if rung and time_limit is not None and time.monotonic() - start >= time_limit:
            break
        rows = data.where((F.col("_at") >= 0) & (F.col("_at") < part))
        n_rows = rows.count()
        held = data.where(F.col("_at") < 0)
        steps = Pipeline(stages=preprocessing_stages(categorical, numeric, MAX_BINS)).fit(rows)
        groups = row_groups(rows, steps, label, categorical, numeric) if any(groups_alike(e) for _, _, e in settings) else None
        held_groups = row_groups(held, steps, label, categorical, numeric, least=0) if groups is not None else None
        ready, test = (steps.transform(d).select(label, FEATURES) for d in (rows, held))
        # trees on rows read them often; a logistic regression reads them three times, which costs less than to write them
        if any(not isinstance(e, LogisticRegression) and (groups is None or not groups_alike(e)) for _, _, e in settings):
            ready, test = (d.checkpoint(eager=True) for d in (ready, test))

        def fitted(item, ready=ready, test=test, groups=groups, held_groups=held_groups):
            if groups is not None and groups_alike(item[2]):  # trees look at bins: the same fit on one row per group
                model = fit_groups(item[2], groups)
                return model, float(ev.copy({ev.weightCol: WEIGHT}).evaluate(model.transform(held_groups)))
            model = item[2].fit(ready)
            return model, float(ev.evaluate(model.transform(test)))

        with ThreadPoolExecutor(max(1, parallelism)) as pool:  # each thread only submits Spark jobs
            scored = list(pool.map(fitted, settings))
        order = sorted(range(len(settings)), key=lambda i: -scored[i][1])
        keep = order[:max(1, -(-len(order) // 2))]
        trials += [(rung, settings[i][0], settings[i][1], n_rows, scored[i][1], i in keep) for i in range(len(settings))]
        best = PipelineModel(stages=[*steps.stages, scored[order[0]][0]])
        settings = [settings[i] for i in sorted(keep)]
    data.unpersist()
    return best, train.sparkSession.createDataFrame(trials, "rung int, family string, setting string, n_rows long, f1 double, kept boolean")


def train_run(df: DataFrame, target: str, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str],
              run_id: str, num_trees: int = 500, max_depth: int = 5, test_fraction: float = 0.2, seed: int = 42,
              partitions: int | None = None, estimator=None, store: str | None = None, experiment: str = "default", data_path: str | None = None,
              data_version: int | None = None, period: str | None = None):
    """The monthly training job: profile the input, split by key hash, fit
    the regression pipeline (a random forest, or ``estimator`` with label ``target``),
    evaluate on the test side.

    Returns (model, stats, record) where ``stats`` is the long profile of the
    training input and ``record`` one row: run_id, n_rows, n_train, n_test,
    mae, mse, rmse, r2_test. With ``store`` all of it is published there as one run with
    the data's path and version, the parameters and the signature (``registry``), and
    stats and record are read back from it."""
    cols = list(dict.fromkeys([target, *categorical, *numeric, *keys]))
    data = df.select(*cols)
    profile = stats.profile(data.drop(*[k for k in keys if k not in (target, *categorical, *numeric)]),
                            [target, *numeric], categorical)
    s = stable_input(splits.hash_split(data, keys, test_fraction, seed), keys, partitions)
    est = estimator or rf_regressor(target, num_trees, max_depth, seed)
    model = fit_regressor(s.where(F.col("split") == "train"), target, categorical, numeric, est)
    # few tasks: each follows the forest once for every cell it meets
    pred = predict(model, s.where(F.col("split") == "test").coalesce(df.sparkSession.sparkContext.defaultParallelism))
    reg = metrics.regression_metrics(pred, target, "prediction")
    counts = splits.split_counts(s)
    # Split counts ride along as scalar subqueries of the one-row metrics.
    record = reg.select(F.lit(run_id).alias("run_id"),
                        *[counts.select(c).scalar().alias(c) for c in ("n_rows", "n_train", "n_test")],
                        "mae", "mse", "rmse", F.col("r2").alias("r2_test"))
    if store is not None:
        from tidemark.plans import registry
        used = {"target": target, "categorical": list(categorical), "numeric": list(numeric), "test_fraction": test_fraction, "seed": seed,
                "estimator": type(est).__name__, **{p.name: v for p, v in est.extractParamMap().items() if isinstance(v, (int, float, str, bool))}}
        kept = registry.publish_run(
            store, run_id, model, profile, record, experiment=experiment, metrics=["mae", "mse", "rmse", "r2_test"], parameters=used,
            signature=signature(df, [*categorical, *numeric], T.DoubleType()), data_path=data_path, data_version=data_version, period=period)
        profile = registry.run_profile(df.sparkSession, store, run_id)
        record = kept.select("run_id", "n_rows", "n_train", "n_test", *[F.col("metrics")[m].alias(m) for m in ("mae", "mse", "rmse", "r2_test")])
    return model, profile, record


def run_metrics(record: DataFrame, experiment: str, metrics: Sequence[str] = ("mae", "mse", "rmse", "r2_test")) -> DataFrame:
    """A training record as rows of the ``runs`` table:
    experiment, run_id, start_time, metric, value."""
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return record.select(F.lit(experiment).alias("experiment"), "run_id",
                         F.current_timestamp().cast("timestamp_ntz").alias("start_time"),
                         F.explode(F.array(*items)).alias("_m")).select("experiment", "run_id", "start_time", "_m.*")


def signature(df: DataFrame, inputs: Sequence[str], output: T.DataType) -> dict:
    """Model signature: input schema and output type as JSON-ready dicts."""
    return {"inputs": json.loads(T.StructType([df.schema[c] for c in inputs]).json()),
            "output": json.loads(output.json())}


def schema_matches(actual: T.StructType, expected: T.StructType) -> bool:
    """Same (name, type) pairs, order ignored. (The reference compares two
    results of ``list.sort()``, i.e. None with None, so it never fails.)"""
    def key(s: T.StructType):
        return sorted((f.name, f.dataType.simpleString()) for f in s.fields)
    return key(actual) == key(expected)
