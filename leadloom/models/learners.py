"""Classifiers and regressors of Spark ML behind one fit/predict shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "_features"
#: Rows of a task of a fit, while there are fewer tasks than two per core, and at most.
ROWS_PER_FIT_TASK, MOST_ROWS_PER_FIT_TASK = 50_000, 500_000
#: Fits that run side by side, and rows per core up to which they do.
FITS_SIDE_BY_SIDE, ROWS_PER_CORE_SIDE_BY_SIDE = 3, 1_000_000


def fit_tasks(df: DataFrame) -> int:
    """Tasks that a fit on the rows of ``df`` (stored, as it is counted) should have.

    Every task of a tree learner hands on statistics of all nodes of a level, tens of MB for the deep levels of a forest, and a
    fit has hundreds of short jobs. So its tasks follow the rows and the cores, not the number of shuffle partitions.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-rows // ROWS_PER_FIT_TASK), 2 * cores), -(-rows // MOST_ROWS_PER_FIT_TASK))


def neighbours(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """The rows, in every task in the order of their features.

    Rows that follow each other then reach the same nodes of a tree, whose statistics (tens of MB for the deep levels of a
    forest) are still in the processor's cache. The order of the rows, and so what a seed draws, does not depend on the run.
    """
    return df.sortWithinPartitions(*features, key)


def side_by_side(df: DataFrame) -> int:
    """Fits on the rows of ``df`` (stored, as it is counted) that should run at a time: several while they are small.

    A small fit is hundreds of short jobs that leave cores idle between them. A large one fills all cores by itself, and what fits
    keep in memory of their rows adds up.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return FITS_SIDE_BY_SIDE if df.count() <= cores * ROWS_PER_CORE_SIDE_BY_SIDE else 1


def node_options(name: str, df: DataFrame) -> dict[str, object]:
    """Options of fits on the rows of ``df`` (stored, as it is counted): a forest keeps the node of every row in every tree.

    Each level finds it from the root otherwise, for every row and tree again. The trees are the same. The nodes take 8 bytes a
    row and tree, so it is for rows of which several fits run at a time.
    """
    return {"cacheNodeIds": True} if name in ("forest", "forest_small") and side_by_side(df) > 1 else {}


def make(name: str, label: str, seed: int = 42, **params: object) -> Estimator:
    """A classifier by name: ``gbt``, ``gbt_small``, ``forest``, ``logit``."""
    common = {"featuresCol": FEATURES, "labelCol": label}
    if name == "gbt":
        return GBTClassifier(**common, seed=seed, **{"maxIter": 20, "maxDepth": 5, **params})
    if name == "gbt_small":
        return GBTClassifier(**common, seed=seed, **{"maxIter": 5, "maxDepth": 3, **params})
    if name == "forest":
        return RandomForestClassifier(**common, seed=seed, **{"numTrees": 30, "maxDepth": 10, **params})
    if name == "forest_small":
        return RandomForestClassifier(**common, seed=seed, **{"numTrees": 10, "maxDepth": 4, **params})
    if name == "logit":
        return LogisticRegression(**common, **params)
    raise ValueError(f"unknown learner {name!r}")


def assembled(estimator: Estimator, features: list[str]) -> Pipeline:
    vector = VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="keep")
    return Pipeline(stages=[vector, estimator])


@dataclass(frozen=True)
class Fitted:
    """A fitted classifier with the features it reads."""

    name: str
    model: PipelineModel
    features: list[str]

    def predict(self, df: DataFrame, score: str = "prob_1", prediction: str = "prediction") -> DataFrame:
        """Add the class and the probability of class 1; the input columns stay."""
        return self._named(df, self.model.transform(df), score, prediction)

    def predict_vectors(self, df: DataFrame, score: str = "prob_1", prediction: str = "prediction") -> DataFrame:
        """:meth:`predict` for rows whose vector :data:`FEATURES` is there already, in the order of ``features``."""
        out = df
        for stage in self.model.stages[1:]:
            out = stage.transform(out)
        return self._named(df, out, score, prediction)

    @staticmethod
    def _named(df: DataFrame, out: DataFrame, score: str, prediction: str) -> DataFrame:
        return out.select(
            *df.columns,
            F.col("prediction").cast("int").alias(prediction),
            vector_to_array("probability")[1].alias(score),
        )


def fit(df: DataFrame, name: str, features: list[str], label: str, seed: int = 42, **params: object) -> Fitted:
    model = assembled(make(name, label, seed, **params), features).fit(df.select(*features, label))
    return Fitted(name, model, list(features))


@dataclass(frozen=True)
class SoftVote:
    """Mean probability of several models; class 1 where the mean is above one half."""

    models: list[Fitted]

    def _vote(self, df: DataFrame, score: str, prediction: str, vectors: bool) -> DataFrame:
        out, scores = df, []
        for i, model in enumerate(self.models):
            out = (model.predict_vectors if vectors else model.predict)(out, f"_p{i}", f"_c{i}")
            scores.append(F.col(f"_p{i}"))
        return average_scores(out, scores, score, prediction).select(*df.columns, prediction, score)

    def predict(self, df: DataFrame, score: str = "prob_1", prediction: str = "prediction") -> DataFrame:
        return self._vote(df, score, prediction, vectors=False)

    def predict_vectors(self, df: DataFrame, score: str = "prob_1", prediction: str = "prediction") -> DataFrame:
        return self._vote(df, score, prediction, vectors=True)


def average_scores(df: DataFrame, scores: list, score: str = "prob_1", prediction: str = "prediction") -> DataFrame:
    """Soft voting over score columns."""
    columns = [F.col(s) if isinstance(s, str) else s for s in scores]
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    mean = total / F.lit(float(len(columns)))
    return df.withColumn(score, mean).withColumn(prediction, F.when(F.col(score) > 0.5, 1).otherwise(0))


def soft_vote(df: DataFrame, names: list[str], features: list[str], label: str, seed: int = 42) -> SoftVote:
    """Fit every named learner on the same rows."""
    return SoftVote([fit(df, name, features, label, seed) for name in names])


def fit_regressor(df: DataFrame, features: list[str], label: str, trees: int = 5, seed: int = 42) -> PipelineModel:
    forest = RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=trees, seed=seed)
    return assembled(forest, features).fit(df.select(*features, label))


def mean_squared_error(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.avg(error * error).alias("mse"))
