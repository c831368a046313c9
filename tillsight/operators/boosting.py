"""Boosted trees of a whole grid: early stopping on a validation part, all round counts from one fit.

A boosted ensemble of r rounds is the first r trees of a longer one, so one fit with the most rounds
stands for every smaller count of the grid. The fit ends by itself with the first round that does
not lower the loss on the validation part, a keyed hash share of the training rows; round counts
beyond that end are the same model and are measured once.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import hash_below
from tillsight.operators.features import FOLD, auc

VALIDATION = "validates"
VALIDATION_SHARE = 0.2
SEED = 2019


def with_validation(df: DataFrame, key: str = "mobile", share: float = VALIDATION_SHARE) -> DataFrame:
    """Mark the rows that decide when to stop, by a hash of the key."""
    return df.withColumn(VALIDATION, hash_below(share, F.lit("validation"), key))


def prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble after its first rounds; the model itself if it has no more."""
    if rounds >= model.getNumTrees:
        return model
    context, whole = SparkContext._active_spark_context, model._java_obj
    ml = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights, strict=False)):
        trees[i], weights[i] = tree._java_obj, weight
    shorter = ml.classification.GBTClassificationModel(whole.uid(), trees, weights)
    return model._copyValues(GBTClassificationModel(shorter))


def grow(train: DataFrame, rate: float, depth: int, rounds: int) -> GBTClassificationModel:
    """An ensemble of at most ``rounds`` trees, ended early by the marked rows.

    Without marked rows of both labels there is nothing to stop by, and all rounds are run.
    """
    classifier = GBTClassifier(labelCol="labels", featuresCol="features", maxIter=rounds, stepSize=rate, maxDepth=depth,
                               seed=SEED, validationTol=0.0)
    if train.filter(VALIDATION).select("labels").distinct().count() > 1:
        classifier = classifier.setValidationIndicatorCol(VALIDATION)
    return classifier.fit(train)


@dataclass(frozen=True)
class Trial:
    """Area under ROC of one grid point on one left-out fold, and the rounds that were really run."""

    rounds: int
    rate: float
    depth: int
    fold: int
    grown: int
    auc: float


def trials(train: DataFrame, rounds: Sequence[int], rates: Sequence[float], depths: Sequence[int], folds: Sequence[int],
           parallelism: int = 4) -> list[Trial]:
    """Every grid point on every one of the folds; ``train`` has features, labels, the fold and the validation mark."""

    def ensemble(task: tuple[int, float, int]) -> list[Trial]:
        fold, rate, depth = task
        left_out = train.filter(F.col(FOLD) == fold)
        model = grow(train.filter(F.col(FOLD) != fold), rate, depth, max(rounds))
        measured: dict[int, float] = {}
        out = []
        for count in rounds:
            grown = min(count, model.getNumTrees)
            if grown not in measured:
                measured[grown] = auc(prefix(model, grown).transform(left_out))
            out.append(Trial(count, rate, depth, fold, grown, measured[grown]))
        return out

    tasks = [(fold, rate, depth) for fold in folds for rate in rates for depth in depths]
    with ThreadPoolExecutor(parallelism) as pool:
        return [trial for group in pool.map(ensemble, tasks) for trial in group]
