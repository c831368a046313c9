"""Churn: member features in training or scoring mode, model selection, batch scoring."""

from __future__ import annotations

import datetime as dt
import itertools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import asof as asof_date
from tillsight.functions.scalars import mean_latency, recency, shift_days, tenure
from tillsight.operators.aggregates import basket_totals, department_totals, member_profile
from tillsight.operators.boosting import grow, trials, with_validation
from tillsight.operators.features import (
    CATEGORICAL, FOLD, NUMERIC, auc, churn_label, feature_pipeline, fill, hash_split, log_odds, prepare, present, scaled,
    to_features, with_fold,
)
from tillsight.operators.filters import observation_window, trailing_window
from tillsight.operators.joins import assemble_features, member_store, only_members, sku_department
from tillsight.operators.linear import search_linear
from tillsight.operators.visits import Period, baskets, profile, seen
from tillsight.session import settle

# The full search grids per method, as parameter name -> values.
FULL_GRIDS = {
    "svm": {"maxIter": [10, 20, 50], "regParam": [0.001, 0.01, 0.1, 1.0]},
    "logistic_regression": {
        "elasticNetParam": [0.0, 0.5, 1.0], "fitIntercept": [False, True],
        "maxIter": [10, 100], "regParam": [0.01, 0.5, 2.0],
    },
    "boosted_trees": {"maxIter": [10, 100, 1000], "stepSize": [0.01, 0.1, 0.2, 0.4], "maxDepth": [5, 6]},
    "naive_bayes": {},
}


def churn_features(txn: DataFrame, sku: DataFrame, item: DataFrame, member: DataFrame, store: DataFrame,
                   asof: str, pw: int, cw: int | None = None) -> DataFrame:
    """One row per member seen in the window.

    Without ``cw`` the window is the last ``pw`` days before asof (scoring). With it the window
    ends ``cw`` days earlier and the label tells whether the member came back since (training).
    """
    day = "txn_date"
    if cw is None:
        reference = asof_date(asof)
        seen_txn, seen_sku = trailing_window(txn, day, asof, pw), trailing_window(sku, day, asof, pw)
    else:
        reference = shift_days(asof_date(asof), cw)
        seen_txn = observation_window(txn, day, asof, pw, cw)
        seen_sku = observation_window(sku, day, asof, pw, cw)
    visits = member_profile(seen_txn.filter("mobile is not null"))
    visits = visits.withColumns({
        "recency": recency("last_date", reference),
        "tenure": tenure("first_date", reference),
        "latency": mean_latency("first_date", "last_date", "total_visits"),
    })
    if cw is not None:
        visits = churn_label(visits, trailing_window(txn, day, asof, cw))
    assembled = assemble_features(
        visits,
        basket_totals(seen_sku),
        department_totals(sku_department(item, seen_sku)),
        member_store(member, store).select("mobile", "gender", "tier", "state", "city"),
    )
    return assembled.select(
        "mobile", *CATEGORICAL, *NUMERIC, "uniqueitems", "qty", "ndept", "nstores", *present(visits, ["labels"])
    )


def churn_features_from_states(states: str, txn: DataFrame, sku: DataFrame, item: DataFrame, member: DataFrame,
                               store: DataFrame, asof: str, pw: int, cw: int | None = None) -> DataFrame:
    """The rows of ``churn_features`` from the monthly states written below ``states``.

    A new as-of date reads states of whole months, and transactions and lines of the edge days only. The
    states must be of the same transactions.
    """
    end, spark = dt.date.fromisoformat(str(asof)), txn.sparkSession
    if cw is None:
        reference, period = end, Period(end - dt.timedelta(pw))
    else:
        reference = end - dt.timedelta(cw)
        period = Period(end - dt.timedelta(pw + cw), reference)
    visits = profile(spark, states, txn, period)
    visits = visits.withColumns({
        "recency": recency("last_date", F.lit(reference)),
        "tenure": tenure("first_date", F.lit(reference)),
        "latency": mean_latency("first_date", "last_date", "total_visits"),
    })
    if cw is not None:
        visits = churn_label(visits, seen(spark, states, txn, Period(reference)))
    people = member_store(member, store).select("mobile", "gender", "tier", "state", "city")
    whole = visits.join(baskets(spark, states, sku, item, period), "mobile", "left").join(people, "mobile", "left")
    return whole.select(
        "mobile", *CATEGORICAL, *NUMERIC, "uniqueitems", "qty", "ndept", "nstores", *present(visits, ["labels"])
    )


@dataclass(frozen=True)
class Search:
    """The chosen classifier, its grid point, and the area under ROC of every (point, left-out fold)."""

    model: Model
    best: dict
    trials: list[tuple[dict, int, float]]


@dataclass(frozen=True)
class ChurnModel:
    """Fitted pipeline, from raw features to prediction, and its area under ROC on the test part."""

    method: str
    pipeline: PipelineModel
    auc: float
    search: Search


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All points of a grid given by parameter name, the last parameter turning fastest."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def search(train: DataFrame, method: str, grid: dict[str, list] | None = None, folds: int = 5, parallelism: int = 4) -> Search:
    """Best classifier on (mobile, features, labels), cross-validated over the full grid or the caller's.

    Folds are a hash of the member. The highest mean area under ROC wins, of equal ones the first point. Linear
    methods solve all points and folds together, boosted trees take all round counts from one
    ensemble, Naive Bayes is fitted point by point. A grid of one point is fitted without folds.
    """
    grid = FULL_GRIDS[method] if grid is None else grid
    points = grid_points(grid)
    train = settle(with_fold(train, folds), "folds")
    held = sorted(row[FOLD] for row in train.select(FOLD).distinct().collect())  # at most ``folds`` numbers
    if method in ("svm", "logistic_regression"):
        model, found, best = search_linear(train, method, grid)
        return Search(model, best, found)
    if method == "boosted_trees":
        return _search_boosted(train, points, held, parallelism)
    found = []
    if len(points) > 1:
        def tried(task):
            point, fold = task
            model = _bayes(point).fit(train.filter(F.col(FOLD) != fold))
            return point, fold, auc(log_odds(model.transform(train.filter(F.col(FOLD) == fold))), "log_odds")

        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(tried, itertools.product(points, held)))
    areas = [sum(a for p, _, a in found if p == point) for point in points]
    best = points[areas.index(max(areas))]
    return Search(_bayes(best).fit(train), best, found)


def _bayes(point: dict) -> NaiveBayes:
    return NaiveBayes(labelCol="labels", featuresCol="features", **point)


def _search_boosted(train: DataFrame, points: list[dict], folds: list[int], parallelism: int) -> Search:
    train = settle(with_validation(train), "validation")
    full = [{"maxIter": 20, "stepSize": 0.1, "maxDepth": 5, **point} for point in points]
    rounds, rates, depths = (sorted({p[name] for p in full}) for name in ("maxIter", "stepSize", "maxDepth"))
    found, best = [], full[0]
    if len(full) > 1:
        for trial in trials(train, rounds, rates, depths, folds, parallelism):
            found.append(({"maxIter": trial.rounds, "stepSize": trial.rate, "maxDepth": trial.depth}, trial.fold, trial.auc))
        means = {tuple(p.values()): sum(a for q, _, a in found if q == p) for p in full}
        best = max(full, key=lambda p: means[tuple(p.values())])  # the first of equal ones
    return Search(grow(train, best["stepSize"], best["maxDepth"], best["maxIter"]), best, found)


def fit_classifier(train: DataFrame, method: str, grid: dict[str, list] | None = None, folds: int = 5, parallelism: int = 4):
    """Best classifier of ``search``."""
    return search(train, method, grid, folds, parallelism).model


def fit_churn(features: DataFrame, method: str = "boosted_trees", grid: dict[str, list] | None = None,
              folds: int = 5) -> ChurnModel:
    """Split, encode on the training part only, select the classifier, measure on the test part.

    The prepared features are written once, so that the many passes of the search read a table
    instead of computing the windows and joins again.
    """
    ready = settle(prepare(features), "churn-features")
    train, test = hash_split(ready)
    pipeline = feature_pipeline(present(ready, CATEGORICAL), present(ready, NUMERIC))
    if method == "svm":
        pipeline = scaled(pipeline)
    encoder = pipeline.fit(train)
    found = search(to_features(train, encoder), method, grid, folds)
    whole = PipelineModel([*encoder.stages, found.model])
    return ChurnModel(method, whole, auc(log_odds(whole.transform(test)), "log_odds"), found)


def score_churn(features: DataFrame, model: PipelineModel, members: DataFrame | None = None) -> DataFrame:
    """(mobile, prediction) for the requested members, or all.

    No empty column is dropped here: the fitted encoder expects those it was trained on.
    """
    ready = fill(features if members is None else only_members(features, members))
    return model.transform(ready).select("mobile", F.col("prediction").cast("int").alias("prediction"))
