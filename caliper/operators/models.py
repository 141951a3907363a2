"""Model stages and estimators on ``pyspark.ml`` (F1-F4, M1-M8, M10-M15, UD2).

Spark's own solvers do the fitting.  The functions here set the parameters
that make Spark optimise the same objective as the reference's estimators:

* L2 logistic regression with inverse strength ``C`` summed over ``n`` rows
  equals Spark's averaged loss with ``regParam = 1 / (C * n)`` and
  ``standardization=False`` (``n`` becomes the weight sum with ``weightCol``).
* Standard scaling uses the population std (sklearn), not Spark's sample std.
* Trees get explicit depths (Spark's default depth is 5).

Fitted column statistics (medians, means, stds) become ``SQLTransformer``
stages with literals: built-in, savable, and evaluated in generated code.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caliper.operators.lda import OnlineLDA
from caliper.operators.ranking import prefix_sums
from caliper.session import scratch_path, stored
from caliper.sources.io import spread


def _q(c: str) -> str:
    return f"`{c}`"


# F1 ---------------------------------------------------------------------------------
class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median imputation fitted on the training rows (``percentile``, not the approximate ``Imputer``).

    Adds ``<col><suffix>`` columns; the fitted stage is ``SELECT *, coalesce(...)``,
    so it applies to any frame that has the input columns.
    """

    suffix = Param(Params._dummy(), "suffix", "output column suffix", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] = (), suffix: str = "__imp"):
        super().__init__()
        self._set(inputCols=list(inputCols), suffix=suffix)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cols, suf = self.getInputCols(), self.getOrDefault(self.suffix)
        from caliper.operators.quantiles import exact_quantiles
        # all columns in one grouped call; one number per column, none for a column without values
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(_q(c)).cast("double").alias("v")) for c in cols])).alias("s"))
        med = {r["c"]: r["value"] for r in exact_quantiles(stacked.select("s.c", "s.v"), "v", [0.5], by=["c"]).collect()} if cols else {}
        fill = lambda c: repr(float(med[c])) if c in med else "CAST(NULL AS DOUBLE)"
        exprs = [f"coalesce(CAST({_q(c)} AS DOUBLE), {fill(c)}) AS {_q(c + suf)}" for c in cols]
        return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


# F2 ---------------------------------------------------------------------------------
class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - mean) / std_pop`` per column (sklearn's ``StandardScaler``) into ``<col><suffix>``."""

    suffix = Param(Params._dummy(), "suffix", "output column suffix", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] = (), suffix: str = "__sc"):
        super().__init__()
        self._set(inputCols=list(inputCols), suffix=suffix)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cols, suf = self.getInputCols(), self.getOrDefault(self.suffix)
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        st = df.agg(*aggs).first()
        exprs = []
        for c in cols:
            m, s = float(st[f"m_{c}"]), float(st[f"s_{c}"] or 0.0)
            s = s if s > 0 else 1.0
            exprs.append(f"({_q(c)} - {m!r}) / {s!r} AS {_q(c + suf)}")
        return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


# Bins of the trees ------------------------------------------------------------------
def bin_thresholds(df: DataFrame, cols: Sequence[str], bins: int = 32) -> dict[str, list[float]]:
    """The split candidates of ``pyspark.ml``'s trees, from all rows where those read a sample of some 10,000.

    A column of at most ``bins`` values is cut between every two neighbours, any other one between the two values whose
    running count comes nearest to a multiple of ``n / bins``.  NULL and NaN are no values (the trees refuse them).
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(_q(c)).cast("double").alias("v")) for c in cols])))
    long = long.where("v IS NOT NULL AND NOT isnan(v)")
    counts = stored(long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    size = {r["c"]: r for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).collect()}
    few = [c for c in size if size[c]["values"] <= bins]
    seen = [(r["c"], r["v"]) for r in counts.where(F.col("c").isin(few)).orderBy("c", "v").collect()] if few else []
    out = {c: [(a + b) / 2.0 for (k, a), (j, b) in zip(seen, seen[1:]) if k == j == c] for c in cols}
    for c in (c for c in size if c not in few):
        of_c, total = counts.where(F.col("c") == c).select("v", "n"), size[c]["n"]
        passed = lambda x: F.floor(x * F.lit(bins) / F.lit(total))
        at = prefix_sums(of_c, "v", ["n"]).where(passed(F.col("cum_n")) > passed(F.col("cum_n") - F.col("n"))).orderBy("v").collect()
        vs = [r["v"] for r in at]                                                     # at most ``bins`` values
        cell = F.size(F.filter(F.array(*[F.lit(v) for v in vs]), lambda v: v < F.col("v")))
        top = F.element_at(F.array(*[F.lit(v) for v in vs]), F.col("i") + 1)
        near = {r["i"]: r for r in of_c.withColumn("i", cell).where(F.col("i") < len(vs)).groupBy("i").agg(
            F.min("v").alias("lo"), F.max(F.when(F.col("v") < top, F.col("v"))).alias("below")).collect()}
        cuts = set()
        for i, r in enumerate(at):
            before, after = r["cum_n"] - r["n"], r["cum_n"]
            for k in range(before * bins // total + 1, min(after * bins // total, bins - 1) + 1):
                if after * bins - k * total <= k * total - before * bins:
                    cuts |= {(r["v"] + near[i + 1]["lo"]) / 2.0} if after < total else set()
                elif before > 0:
                    cuts.add(((vs[i - 1] if near[i]["below"] is None else near[i]["below"]) + r["v"]) / 2.0)
        out[c] = sorted(cuts)
    return out


class QuantileBins(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``<col><suffix>``: how many of the training rows' split candidates lie below the value; NULL and NaN have no bin.

    Trees see a value only by the bin that it falls in, so rows of equal bins are equal rows to them.
    """

    bins = Param(Params._dummy(), "bins", "most bins of a column", TypeConverters.toInt)
    suffix = Param(Params._dummy(), "suffix", "output column suffix", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] = (), bins: int = 32, suffix: str = "__bin"):
        super().__init__()
        self._set(inputCols=list(inputCols), bins=bins, suffix=suffix)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cuts = bin_thresholds(df, self.getInputCols(), self.getOrDefault(self.bins))
        exprs = []
        for c, ts in cuts.items():
            x = f"nanvl(CAST({_q(c)} AS DOUBLE), NULL)"
            below = " + ".join(f"CAST({x} > double('{t!r}') AS DOUBLE)" for t in ts) or f"{x} * 0"
            exprs.append(f"{below} AS {_q(c + self.getOrDefault(self.suffix))}")
        return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


# F3 / F4 ----------------------------------------------------------------------------
def one_hot_stages(cols: Sequence[str]) -> list:
    """All levels kept, unknown and NULL -> all zeros (the dropped slot is Spark's 'unknown' one)."""
    out = []
    for c in cols:
        out.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                 stringOrderType="alphabetAsc"))
        out.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True))
    return out


def tabular_stages(numeric: Sequence[str], categorical: Sequence[str] = (), impute: bool = False,
                   scale: bool = True, features_col: str = "features", bins: int = 0) -> list:
    """ColumnTransformer equivalent: (impute) -> scale numerics, one-hot categoricals, assemble; others dropped.

    ``bins``: the numerics are dealt into that many bins after scaling, for trees.
    """
    st: list = []
    num = list(numeric)
    if impute and num:
        st.append(MedianImputer(num, suffix="__imp"))
        num = [f"{c}__imp" for c in num]
    if scale and num:
        st.append(PopulationScaler(num, suffix="__sc"))
        num = [f"{c}__sc" for c in num]
    if bins and num:
        st.append(QuantileBins(num, bins))
        num = [f"{c}__bin" for c in num]
    st += one_hot_stages(categorical)
    inputs = num + [f"{c}__ohe" for c in categorical]
    st.append(VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid="keep"))
    return st


# M1-M8 --------------------------------------------------------------------------------
def linear_regression(features_col="features", label_col="label") -> LinearRegression:
    return LinearRegression(featuresCol=features_col, labelCol=label_col, regParam=0.0, solver="normal")


#: Rows carry the node that they reached in every tree (checkpointed now and then under ``spark.checkpoint.dir``),
#: so a level's tasks get the nodes to split and not all trees so far; a level of 300 trees fits one pass.
FOREST_FIT = {"cacheNodeIds": True, "checkpointInterval": 5, "maxMemoryInMB": 1024}


def random_forest_regressor(num_trees=300, max_depth=12, seed=42, features_col="features", label_col="label"):
    return RandomForestRegressor(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                 maxDepth=max_depth, featureSubsetStrategy="all", seed=seed, **FOREST_FIT)


def logistic_regression(C: float = 1.0, n_rows: float = 1.0, l1: bool = False, max_iter: int = 1000,
                        weight_col: str | None = None, features_col="features", label_col="label"):
    """sklearn ``LogisticRegression(C)``: ``regParam = 1 / (C * n)`` with n the row count (or weight sum)."""
    kw = dict(featuresCol=features_col, labelCol=label_col, regParam=1.0 / (C * n_rows),
              elasticNetParam=1.0 if l1 else 0.0, standardization=False, maxIter=max_iter, tol=1e-6)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(**kw)


def gbt_classifier(n_estimators=200, learning_rate=0.1, max_depth=3, seed=42, features_col="features",
                   label_col="label"):
    return GBTClassifier(featuresCol=features_col, labelCol=label_col, maxIter=n_estimators,
                         stepSize=learning_rate, maxDepth=max_depth, seed=seed)


def random_forest_classifier(num_trees=300, max_depth=12, weight_col: str | None = None, seed=42,
                             features_col="features", label_col="label"):
    kw = dict(featuresCol=features_col, labelCol=label_col, numTrees=num_trees, maxDepth=max_depth,
              featureSubsetStrategy="sqrt", seed=seed, **FOREST_FIT)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(**kw)


def gbt_regressor(n_estimators=100, learning_rate=0.1, max_depth=3, seed=42, features_col="features",
                  label_col="label"):
    return GBTRegressor(featuresCol=features_col, labelCol=label_col, maxIter=n_estimators, stepSize=learning_rate,
                        maxDepth=max_depth, lossType="squared", seed=seed)


def fit_by_features(stages: Sequence, boosting: GBTRegressor | GBTClassifier, train: DataFrame) -> PipelineModel:
    """``Pipeline([*stages, boosting])`` fitted on one row a feature vector: the mean label, weighted by the number of rows.

    Under squared loss rows of equal features have one prediction at every step, so means and weights give the
    same gains and leaves; distinct vectors stay rows of their own.  A null label keeps its group's label null.
    A classifier gets a row a feature vector and label: such rows have one gradient at every step.
    """
    prepare = Pipeline(stages=list(stages)).fit(train)
    x, y = boosting.getFeaturesCol(), boosting.getLabelCol()
    mean = F.when(F.count(y) == F.count(F.lit(1)), F.avg(F.col(y).cast("double")))
    n = F.count(F.lit(1)).cast("double").alias("_rows")
    rows = prepare.transform(train)
    rows = rows.groupBy(x, y).agg(n) if isinstance(boosting, GBTClassifier) else rows.groupBy(x).agg(mean.alias(y), n)
    rows = stored(rows, "feature-rows")
    return PipelineModel([*prepare.stages, boosting.copy({boosting.weightCol: "_rows"}).fit(rows)])


#: Feature vectors whose sums a task holds before it hands them on: all those of three columns in 32 bins (300 trees: 157 MB).
BOOTSTRAP_CELLS = 32 ** 3


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype="i4") * rows.shape[1]), pa.array(rows.ravel()))


def _rows(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def bootstrap_by_features(df: DataFrame, features_col: str, label_col: str, num_trees: int, seed: int) -> DataFrame:
    """``(tree, features, weight, label)``: each tree's bootstrap of the rows, summed up to a row a feature vector.

    A row is in a tree's sample Poisson(1) times.  For the rows of a batch together that is a Poisson number of draws
    with replacement, which is how they are made; a null label makes its vector's label NaN.  A task hands on one row
    a feature vector (more if it meets over ``BOOTSTRAP_CELLS``), so a group of the shuffle has as many rows as there are
    tasks, however many rows share a vector.
    """
    x = df.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("double").alias("y"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        at: dict[bytes, int] = {}
        sums = np.zeros((2, num_trees, 0))

        def summed() -> Iterator[pa.RecordBatch]:
            cells = np.frombuffer(b"".join(at), "f8").reshape(len(at), -1)
            for i in range(0, len(at), 256):
                w, wy = (np.ascontiguousarray(v[:, i:min(i + 256, len(at))].T) for v in sums)
                yield pa.RecordBatch.from_pydict({"x": _lists(cells[i:i + 256]), "w": _lists(w), "wy": _lists(wy)})

        for b in batches:
            if not (m := b.num_rows):
                continue
            y = b.column("y").to_numpy(zero_copy_only=False).astype("f8")
            vectors, local = np.unique(_rows(b.column("x")), axis=0, return_inverse=True)
            keys = [v.tobytes() for v in vectors]
            if at and len(at) + sum(k not in at for k in keys) > BOOTSTRAP_CELLS:
                yield from summed()
                at, sums = {}, np.zeros((2, num_trees, 0))
            place = np.array([at.setdefault(k, len(at)) for k in keys])
            if len(at) > sums.shape[2]:
                sums = np.concatenate([sums, np.zeros((2, num_trees, len(at) - sums.shape[2]))], axis=2)
            local = local.ravel()
            for t, k in enumerate(rng.poisson(m, num_trees)):
                rows = rng.integers(0, m, k)
                cell = local[rows]
                sums[0, t, place] += np.bincount(cell, minlength=len(vectors))
                sums[1, t, place] += np.bincount(cell, y[rows], minlength=len(vectors))
        if at:
            yield from summed()

    def total(parts: pa.Table) -> pa.Table:
        w, wy = _rows(parts["w"]).sum(axis=0), _rows(parts["wy"]).sum(axis=0)
        tree = np.flatnonzero(w)
        vector = np.repeat(_rows(parts["x"])[:1], len(tree), axis=0)
        return pa.table({"tree": pa.array(tree.astype("i4")), "x": _lists(vector), "weight": pa.array(w[tree]), "label": pa.array(wy[tree] / w[tree])})

    drawn = x.mapInArrow(draw, "x array<double>, w array<double>, wy array<double>")
    sums = drawn.groupBy("x").applyInArrow(total, "tree int, x array<double>, weight double, label double")
    return sums.select("tree", array_to_vector("x").alias(features_col), "weight", F.col("label").alias(label_col))


def fit_forest_by_features(stages: Sequence, forest: RandomForestRegressor, train: DataFrame, parallelism: int = 12) -> PipelineModel:
    """``Pipeline([*stages, forest])`` for a forest whose trees see all features, each tree fitted on one row a feature vector.

    Every tree has a bootstrap of the rows of its own (``bootstrap_by_features``); means and weights give the same
    gains and leaves as the rows would.  After that one pass nothing grows with the rows any more, only with the
    distinct vectors: give the stages bins.  Trees do not depend on one another and are fitted side by side.
    """
    if forest.getFeatureSubsetStrategy() != "all" or forest.getSubsamplingRate() != 1.0:
        raise ValueError("the trees of this forest draw features, or other than as many rows as there are")
    prepare = Pipeline(stages=list(stages)).fit(train)
    x, y, n = forest.getFeaturesCol(), forest.getLabelCol(), forest.getNumTrees()
    spark = train.sparkSession
    rows = bootstrap_by_features(prepare.transform(train), x, y, n, forest.getSeed())
    path = scratch_path(spark, "tree-rows")
    rows.repartition("tree").write.partitionBy("tree").parquet(path)
    schema = rows.drop("tree").schema
    tree = DecisionTreeRegressor(featuresCol=x, labelCol=y, weightCol="weight", maxDepth=forest.getMaxDepth(), maxBins=forest.getMaxBins(),
                                 seed=forest.getSeed())
    with ThreadPool(parallelism) as pool:
        trees = pool.map(lambda t: tree.fit(spark.read.schema(schema).parquet(f"{path}/tree={t}")), range(n), chunksize=1)
    sc = spark.sparkContext
    java = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    for i, t in enumerate(trees):
        java[i] = t._java_obj
    model = RandomForestRegressionModel(sc._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(java, trees[0].numFeatures))
    forest._copyValues(model)._transfer_params_to_java()                              # a prediction divides by ``numTrees``
    return PipelineModel([*prepare.stages, model])


def predict_by_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)``'s prediction, which the last stage makes once for each distinct feature vector."""
    *prepare, last = model.stages
    x, out = last.getFeaturesCol(), last.getPredictionCol()
    rows = PipelineModel(prepare).transform(df).withColumn("_x", vector_to_array(x))
    vectors = stored(spread(rows.select(x, "_x").dropDuplicates(["_x"])), "feature-vectors")
    return rows.join(stored(last.transform(vectors).select("_x", out), "vector-predictions"), "_x").drop("_x")


# M10 ----------------------------------------------------------------------------------
def online_lda(k=10, passes=20, subsampling_rate=0.05, learning_offset=50.0, learning_decay=0.7, seed=42,
               features_col="features"):
    """sklearn's ``max_iter`` counts passes; Spark's counts mini-batches of ``subsamplingRate``."""
    return OnlineLDA(k=k, optimizer="online", maxIter=max(1, int(round(passes / subsampling_rate))),
               subsamplingRate=subsampling_rate, learningOffset=learning_offset, learningDecay=learning_decay,
               optimizeDocConcentration=False, seed=seed, featuresCol=features_col)


# M12 / M13 ----------------------------------------------------------------------------
def f1_evaluator(label_col="label", prediction_col="prediction") -> MulticlassClassificationEvaluator:
    """F1 of class 1 (not Spark's default weighted F1)."""
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col,
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def grid_search(estimator, param_grid: dict, fold_col: str, label_col="label", parallelism: int = 4,
                seed: int = 42, n_folds: int = 3) -> CrossValidator:
    """Grid search scored by class-1 F1 over precomputed stratified folds; best params refit on all rows."""
    b = ParamGridBuilder()
    for p, vals in param_grid.items():
        b = b.addGrid(p, list(vals))
    return CrossValidator(estimator=estimator, estimatorParamMaps=b.build(), evaluator=f1_evaluator(label_col),
                          foldCol=fold_col, numFolds=n_folds, parallelism=parallelism, seed=seed)


def refit_penalty(C: float, n_rows: float) -> float:
    """``regParam`` of sklearn's ``C`` for a fit on ``n_rows`` rows; folds and refit have different row counts."""
    return 1.0 / (C * n_rows)


def cv_summary(cv_model) -> list[tuple[dict, float, float]]:
    """(params, mean, std) per grid point; report mean +- 2 std."""
    out = []
    for pm, m, s in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, cv_model.stdMetrics):
        out.append(({p.name: v for p, v in pm.items()}, float(m), float(s)))
    return out


# M14 / M15 -----------------------------------------------------------------------------
def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


def linear_score(features: Sequence[str], coefs: Sequence[float], intercept: float, logistic: bool = True) -> Column:
    """A fitted linear model applied as a column expression (independent check of ``transform``)."""
    z = F.lit(float(intercept))
    for c, w in zip(features, coefs):
        z = z + F.lit(float(w)) * F.col(c)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) if logistic else z
