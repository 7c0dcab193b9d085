"""Distributed training, scoring, importances and trial sweeps on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from operator import and_

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.scalars import HASH_RANGE, as_col, stable_hash
from lakeloom.session import materialize

FEATURES = "features"


def assemble(features: Sequence[str], name: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="skip")


def train_logistic(df: DataFrame, features: Sequence[str], label: str, c: float = 0.1) -> PipelineModel:
    """Penalised logistic regression; ``c`` is the inverse penalty of the whole sample."""
    n = df.count()
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=label, regParam=1.0 / (c * max(n, 1)), standardization=False)
    return Pipeline(stages=[assemble(features), lr]).fit(df)


def train_random_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, seed: int = 0) -> PipelineModel:
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=trees, seed=seed)
    return Pipeline(stages=[assemble(features), rf]).fit(df)


def train_linear(df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Ordinary least squares through normal equations."""
    lr = LinearRegression(featuresCol=FEATURES, labelCol=label, solver="normal")
    return Pipeline(stages=[assemble(features), lr]).fit(df)


def train_svm(df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Linear support vectors, one class against the rest."""
    svc = LinearSVC(featuresCol=FEATURES, labelCol=label, maxIter=20)
    return Pipeline(stages=[assemble(features), OneVsRest(classifier=svc, featuresCol=FEATURES, labelCol=label)]).fit(df)


def save_model(model: PipelineModel, path: str) -> str:
    """Keep a trained model below a path all executors can reach."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Predictions beside the kept columns."""
    return model.transform(df).select(*keep, "prediction")


def probability_of(df: DataFrame, column: str = "probability", label: int = 1) -> Column:
    return vector_to_array(df[column])[label]


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 of one predictor in a single aggregation."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.regr_r2(b, a).alias("r2")
    )


def linear_score(weights: Mapping[str, float], intercept: float) -> Column:
    """Score of a given linear model."""
    out = F.lit(float(intercept))
    for c, w in weights.items():
        out = out + F.col(c).cast("double") * F.lit(float(w))
    return out


def feature_importance(df: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Importances of a fitted forest, one row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )


def sweep(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
    rates: Sequence[float] = (0.1, 0.3), depths: Sequence[int] = (3,), max_trials: int | None = None, trees: int = 10, seed: int = 0,
) -> list[tuple[dict, PipelineModel, float]]:
    """Boosted trees over a grid; trials with their log loss on the test part, best first.

    The whole grid is tried unless ``max_trials`` names how many of its points are, in order.
    """
    stage = assemble(features)
    trials = []
    for rate, depth in list(product(rates, depths))[:max_trials]:
        gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, stepSize=rate, maxDepth=depth, maxIter=trees, seed=seed)
        model = Pipeline(stages=[stage, gbt]).fit(train)
        scored = model.transform(test)
        loss = scored.agg(log_loss(label, probability_of(scored)).alias("l")).first()["l"]
        trials.append(({"learning_rate": rate, "max_depth": depth}, model, loss))
    return sorted(trials, key=lambda t: t[2])


def log_loss(label: Column | str, p: Column) -> Column:
    y = as_col(label).cast("double")
    q = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.avg(-(y * F.log(q) + (1 - y) * F.log(1 - q)))


def trial_table(df: DataFrame, trials: Sequence[tuple[dict, PipelineModel, float]]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(i, float(p["learning_rate"]), int(p["max_depth"]), float(loss)) for i, (p, _, loss) in enumerate(trials)],
        "rank int, learning_rate double, max_depth int, logloss double",
    )


def train_boosted(
    assembled: DataFrame, label: str, classes: Sequence[float], rate: float = 0.1, depth: int = 3, trees: int = 10, seed: int = 0,
    weight: str | None = None,
) -> list:
    """Boosted trees for any number of classes: one model per class against the rest, on a table with a features column.
    ``weight`` names a column that tells how many rows a row stands for."""
    out = []
    for c in classes:
        own = assembled.select(FEATURES, F.when(F.col(label) == c, 1.0).otherwise(0.0).alias("own"), *([weight] if weight else []))
        gbt = GBTClassifier(featuresCol=FEATURES, labelCol="own", stepSize=rate, maxDepth=depth, maxIter=trees, seed=seed)
        out.append((gbt.setWeightCol(weight) if weight else gbt).fit(own))
    return out


def boosted_scores(models: Sequence, assembled: DataFrame, classes: Sequence[float]) -> DataFrame:
    """``probability`` (array, one number per class, sum 1) and ``prediction`` (the likeliest class, the first among ties)."""
    out = assembled
    for i, model in enumerate(models):
        model = model.copy().setProbabilityCol("__p").setRawPredictionCol("__r").setPredictionCol("__y")
        out = model.transform(out).withColumn(f"__p{i}", vector_to_array("__p")[1]).drop("__p", "__r", "__y")
    total = sum((F.col(f"__p{i}") for i in range(1, len(models))), F.col("__p0"))
    out = out.withColumn("probability", F.array(*[F.col(f"__p{i}") / total for i in range(len(models))]))
    best = F.array_position("probability", F.array_max("probability")).cast("int")
    out = out.withColumn("prediction", F.element_at(F.array(*[F.lit(float(c)) for c in classes]), best))
    return out.drop(*[f"__p{i}" for i in range(len(models))])


def _values(df: DataFrame, features: Sequence[str], *keep: Column | str) -> tuple[DataFrame, list[str]]:
    """Rows whose features are all known as plain double columns ``__x0``, ``__x1`` ..., one per component, and their names."""
    if all(isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in features):
        parts, rows = [F.col(c).cast("double") for c in features], df
    else:
        rows = assemble(features, "__v").transform(df)
        first = rows.select(F.size(vector_to_array("__v")).alias("n")).first()
        parts = [vector_to_array("__v")[i] for i in range(first["n"] if first else 0)]
    names = [f"__x{i}" for i in range(len(parts))]
    out = rows.select(*[p.alias(n) for p, n in zip(parts, names)], *keep)
    return out.where(reduce(and_, [F.col(n).isNotNull() & ~F.isnan(n) for n in names], F.lit(True))), names


def bin_edges(rows: DataFrame, names: Sequence[str], bins: int = 32, fine: int = 1_000) -> list[list[float]]:
    """Per column at most ``bins`` - 1 values where a new bin begins: every value where there are few, else quantiles."""
    grid = [i / fine for i in range(fine + 1)]
    got = rows.agg(*[F.percentile_approx(c, grid, 10 * fine).alias(c) for c in names]).first()
    out = []
    for c in names:
        values = np.array(got[c] or [0.0])
        held = np.unique(values[np.isfinite(values)])
        if len(held) > bins:
            held = np.unique(np.quantile(values[np.isfinite(values)], np.arange(1, bins) / bins, method="nearest"))
        else:
            held = held[1:] if len(held) > 1 else held
        out.append([float(x) for x in held] or [0.0])
    return out


def binned(rows: DataFrame, names: Sequence[str], edges: Sequence[Sequence[float]], name: str = "__b") -> tuple[DataFrame, list[str]]:
    """``rows`` with the number of each value's bin, and the names of these columns. Bins are in order, so the numbers lose the
    mark of categories that ``Bucketizer`` gives them."""
    into = [f"{name}{i}" for i in range(len(names))]
    splits = [[-float("inf"), *e, float("inf")] for e in edges]
    out = Bucketizer(splitsArray=splits, inputCols=list(names), outputCols=into).transform(rows)
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in into}), into


class Binned:
    """A model of bin numbers that takes the features themselves."""

    def __init__(self, model, edges: Sequence[Sequence[float]]):
        self.model, self.edges = model, edges

    def copy(self) -> Binned:
        return Binned(self.model.copy(), self.edges)

    def setProbabilityCol(self, name: str) -> Binned:
        self.model.setProbabilityCol(name)
        return self

    def setRawPredictionCol(self, name: str) -> Binned:
        self.model.setRawPredictionCol(name)
        return self

    def setPredictionCol(self, name: str) -> Binned:
        self.model.setPredictionCol(name)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"__x{i}" for i in range(len(self.edges))]
        values = df.withColumns({n: vector_to_array(FEATURES)[i] for i, n in enumerate(names)}).withColumnRenamed(FEATURES, "__features")
        rows, into = binned(values, names, self.edges)
        scored = self.model.transform(assemble(into).transform(rows))
        return scored.drop(FEATURES, *names, *into).withColumnRenamed("__features", FEATURES)


def halving_sweep(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: Sequence[str], classes: Sequence[float],
    rates: Sequence[float] = (0.1, 0.3), depths: Sequence[int] = (3,), eta: int = 2, trees: int = 10, seed: int = 0,
) -> tuple[DataFrame, list, dict]:
    """Successive halving of a grid of boosted trees: the trace of all trials, the best trial's models and its parameters.

    Rung by rung, 1/``eta`` of the trials with the least log loss on the test part go on (ties to the earlier grid point), on
    ``eta`` times as many rows; the last trial has all of them. A rung's rows are those whose hash of ``key`` is below its
    share, so each sample holds the one before, on every run and cluster. Trace: trial, rung, learning_rate, max_depth,
    rows, logloss, accuracy, survived. Rows whose features or label are null take no part.

    Trees split between bins of a feature's values (32 at most, as ``pyspark.ml`` has them; from quantiles of the train
    part). So all rows are binned and counted once, by bins, label and first rung, and every trial is trained and
    scored on these counts: rows with the same bins weigh as many as they are. The returned models take the features.
    """
    grid = [{"learning_rate": float(r), "max_depth": int(d)} for r, d in product(rates, depths)]
    if not grid or eta < 2 or not classes:
        raise ValueError("a sweep needs grid points, classes and an eta of 2 or more")
    steps = [len(grid)]
    while steps[-1] > 1:
        steps.append(-(-steps[-1] // eta))
    shares = [HASH_RANGE // eta ** (len(steps) - 1 - rung) for rung in range(len(steps))]
    hashed = stable_hash(*key, seed=seed + 5)
    known = F.col(label).cast("double").alias("__label")
    rows, names = _values(train.where(F.col(label).isNotNull()), features, known, hashed.alias("__h"))
    edges = bin_edges(rows, names)

    def counted(df: DataFrame, *by: Column) -> tuple[DataFrame, list[str]]:
        into, bins = binned(df, names, edges)
        return materialize(into.groupBy(*bins, "__label", *by).agg(F.count(F.lit(1)).alias("__n")), "sweep"), bins

    first = sum(((F.col("__h") >= share).cast("int") for share in shares[:-1]), F.lit(0))
    fitted, bins = counted(rows, first.alias("__first"))
    held = counted(_values(test.where(F.col(label).isNotNull()), features, known)[0])[0]
    stage = assemble(bins)
    held = materialize(stage.transform(held).select(FEATURES, "__label", "__n"), "held")
    alive, trace, best = list(range(len(grid))), [], None
    for rung, _ in enumerate(steps):
        own = fitted.where(F.col("__first") <= rung).groupBy(*bins, "__label").agg(F.sum("__n").cast("double").alias("__n"))
        own = materialize(stage.transform(own).select(FEATURES, "__label", "__n"), "rung")
        n, done = int(own.agg(F.sum("__n")).first()[0] or 0), []
        for trial in alive:
            p = grid[trial]
            models = train_boosted(own, "__label", classes, p["learning_rate"], p["max_depth"], trees, seed, "__n")
            scored = boosted_scores(models, held, classes)
            chance = F.element_at("probability", F.array_position(F.array(*[F.lit(float(c)) for c in classes]), F.col("__label")).cast("int"))
            loss = F.sum(-F.log(F.greatest(chance, F.lit(1e-15))) * F.col("__n")) / F.sum("__n")
            right = F.sum((F.col("prediction") == F.col("__label")).cast("double") * F.col("__n")) / F.sum("__n")
            done.append((*scored.agg(loss.alias("loss"), right.alias("right")).first(), trial, models))
        done.sort(key=lambda d: (d[0], d[2]))
        alive = sorted(d[2] for d in done[:steps[rung + 1] if rung + 1 < len(steps) else 1])
        best = done[0]
        for loss, right, trial, _ in done:
            p = grid[trial]
            trace.append((trial, rung, p["learning_rate"], p["max_depth"], n, loss, right, trial in alive))
    names = "trial int, rung int, learning_rate double, max_depth int, rows long, logloss double, accuracy double, survived boolean"
    return train.sparkSession.createDataFrame(trace, names), [Binned(m, edges) for m in best[3]], grid[best[2]]


class Reconstruction:
    """Linear reconstruction through ``k`` principal components of the normal class.

    The fit is a distributed covariance; only the features x k loadings and the means reach the driver.
    """

    def __init__(self, features: Sequence[str], means: Sequence[float], loadings: np.ndarray):
        self.features, self.means, self.loadings = list(features), list(means), loadings

    @classmethod
    def fit(cls, normal: DataFrame, features: Sequence[str], k: int) -> Reconstruction:
        row = normal.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)]).first()
        data = assemble(features).transform(normal)
        pca = PCA(k=k, inputCol=FEATURES, outputCol="components").fit(data)
        return cls(features, [row[f"m{i}"] for i in range(len(features))], pca.pc.toArray())

    def apply(self, df: DataFrame, suffix: str = "_hat") -> DataFrame:
        """Add a reconstructed column per feature; plain column arithmetic, so no Python in the tasks."""
        projector = self.loadings @ self.loadings.T
        centred = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(self.features, self.means)]
        out = {}
        for j, c in enumerate(self.features):
            value = F.lit(float(self.means[j]))
            for i, x in enumerate(centred):
                value = value + x * F.lit(float(projector[i, j]))
            out[c + suffix] = value
        return df.withColumns(out)
