"""Linear classifiers of a whole grid in shared passes over the data.

Every grid point on every fold is one column of a weight matrix. A pass multiplies each batch of
features with the matrix and sums all losses and gradients at once, so the data is read as often as
the slowest column needs, not once per column. The minimisers are generators that ask for the loss
at a point and go on when they get it; columns that have ended leave the matrix. A limit on the
iterations is a stop on the way of a longer run, so points that differ in it alone share a column.

Features are standardised as the columns' own training rows demand, and the penalty falls on the
standardised coefficients. Logistic loss without L1 penalty is minimised by L-BFGS, all else by its
orthant-wise variant.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.features import FOLD
from tillsight.session import settle

MEMORY, TOLERANCE = 10, 1e-8  # corrections kept; relative change of loss or gradient that ends a run
ARMIJO, CURVATURE = 1e-4, 0.9
ROWS = 4096  # rows multiplied together
DIRECT = 64  # task results added up on the driver; more are first added up in tasks
NONE = -1  # fold number of a column that leaves no fold out


@dataclass
class Column:
    """One minimisation: penalties, whether there is an intercept, and the rows it may see."""

    loss: str
    l1: float
    l2: float
    intercept: bool
    rounds: tuple[int, ...]
    left_out: int
    found: dict[int, np.ndarray] = field(default_factory=dict)


@dataclass(frozen=True)
class Moments:
    """Rows, positive rows, means and deviations of the features."""

    n: float
    positive: float
    mean: np.ndarray
    deviation: np.ndarray

    @staticmethod
    def of(parts: Sequence[tuple]) -> Moments:
        """Of (n, positive, mean, squared differences) of disjoint parts together."""
        n, positive, mean, squares = together(parts)
        return Moments(n, positive, mean, np.sqrt(squares / max(n - 1, 1)))


def together(parts: Sequence[tuple]) -> tuple:
    """(n, positive, mean, squared differences) of disjoint parts together."""
    n, positive, mean, squares = 0.0, 0.0, 0.0, 0.0
    for m, p, other, more in parts:
        delta, total = other - mean, n + m
        squares = squares + more + delta * delta * (n * m / total)
        mean = mean + delta * (m / total)
        n, positive = total, positive + p
    return n, positive, mean, squares


# Minimisers


def _direction(gradient: np.ndarray, steps: deque) -> np.ndarray:
    """Two-loop recursion over the kept (step, change of gradient) pairs."""
    out, used = -gradient, []
    for s, y in reversed(steps):
        a = (s @ out) / (s @ y)
        out = out - a * y
        used.append(a)
    if steps:
        s, y = steps[-1]
        out = out * ((s @ y) / (y @ y))
    for (s, y), a in zip(steps, reversed(used), strict=True):
        out = out + s * (a - (y @ out) / (s @ y))
    return out


def _strong_wolfe(x, f, slope, direction, first) -> Generator:
    """Step along the direction with enough decrease and a flat enough slope, by bracketing and bisection."""
    low, low_f, high, step = 0.0, f, None, first
    for _ in range(30):
        value, gradient = yield x + step * direction
        here = gradient @ direction
        if not np.isfinite(value) or value > f + ARMIJO * step * slope or (low > 0 and value >= low_f):
            high = step
        elif abs(here) <= -CURVATURE * slope:
            return step, value, gradient
        elif here >= 0:
            high = step
        else:
            low, low_f = step, value
        step = (low + high) / 2 if high is not None else 2 * step
    return None


def _orthant(x: np.ndarray, gradient: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """Gradient of loss plus L1 penalty, at zeros the one-sided one nearest to none."""
    right, left = gradient + l1, gradient - l1
    at_zero = np.where(left > 0, left, np.where(right < 0, right, 0.0))
    return np.where(x == 0, at_zero, gradient + np.sign(x) * l1)


def minimise(start: np.ndarray, rounds: Sequence[int], l1: np.ndarray | None) -> Generator:
    """Yield points, receive (loss, gradient) there; returns the point after each of the rounds."""
    x, found = start, {}
    value, gradient = yield x
    penalty = (lambda w: 0.0) if l1 is None else (lambda w: float(np.abs(w) @ l1))
    total, steps, history = value + penalty(x), deque(maxlen=MEMORY), deque(maxlen=MEMORY)
    for n in range(1, max(rounds) + 1):
        full = gradient if l1 is None else _orthant(x, gradient, l1)
        if np.linalg.norm(full) <= TOLERANCE * max(1.0, abs(total)):
            break
        direction = _direction(full, steps)
        if l1 is not None:
            direction = np.where(direction * full < 0, direction, 0.0)
        slope = full @ direction
        if slope >= 0:
            direction, slope = -full, -(full @ full)
            steps.clear()
        first = 1.0 if steps else 1.0 / max(np.linalg.norm(direction), 1e-12)
        if l1 is None:
            taken = yield from _strong_wolfe(x, value, slope, direction, first)
            if taken is None:
                break
            step, new_value, new_gradient = taken
            new_x = x + step * direction
            new_total = new_value
        else:
            side, step = np.where(x != 0, np.sign(x), -np.sign(full)), first
            for _ in range(30):
                new_x = x + step * direction
                new_x = np.where((new_x * side < 0) & (l1 > 0), 0.0, new_x)
                new_value, new_gradient = yield new_x
                new_total = new_value + penalty(new_x)
                if new_total <= total + ARMIJO * (full @ (new_x - x)):
                    break
                step /= 2
            else:
                break
        if (change := new_gradient - gradient) @ (new_x - x) > 1e-300:
            steps.append((new_x - x, change))
        x, value, gradient = new_x, new_value, new_gradient
        history.append(total)
        total = new_total
        if n in rounds:
            found[n] = x
        if len(history) == MEMORY and history[0] - total <= TOLERANCE * abs(total):
            break
    return {n: found.get(n, x) for n in rounds}


# Passes


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, n, positive, mean, squared differences) of every fold in the task's rows."""
    parts: dict[int, tuple] = {}
    for batch in batches:
        x, y, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for number in np.unique(fold).tolist():
            own = x[fold == number]
            mean = own.mean(axis=0)
            new = float(len(own)), float(y[fold == number].sum()), mean, ((own - mean) ** 2).sum(axis=0)
            parts[number] = together([parts[number], new]) if number in parts else new
    if parts:
        n, positive, mean, squares = zip(*parts.values(), strict=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(parts), pa.int32()), pa.array(n, pa.float64()), pa.array(positive, pa.float64()),
            pa.array(list(mean), pa.list_(pa.float64())), pa.array(list(squares), pa.list_(pa.float64()))],
            ["fold", "n", "positive", "mean", "squares"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _loss(margin: np.ndarray, hinge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each margin, and its slope without the sign: hinge or logistic by column, one exponential for both."""
    if hinge.all():
        return np.maximum(0.0, 1 - margin), (margin < 1).astype(float)
    tail = np.exp(-np.abs(margin))
    loss = np.maximum(0.0, -margin) + np.log1p(tail)
    pull = np.where(margin > 0, tail, 1.0) / (1 + tail)
    if hinge.any():
        loss = np.where(hinge, np.maximum(0.0, 1 - margin), loss)
        pull = np.where(hinge, (margin < 1).astype(float), pull)
    return loss, pull


def _gradients(shared):
    """Losses and gradients of all columns over the task's rows, as one row of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, left_out, hinge = shared.value  # weights: features and, last, the intercept
        total = np.zeros((len(weights) + 1, weights.shape[1]))
        for batch in batches:
            x, y, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for begin in range(0, len(x), ROWS):
                part = slice(begin, begin + ROWS)
                sign = (2.0 * y[part] - 1)[:, None]
                seen = fold[part][:, None] != left_out[None]
                margin = sign * (x[part] @ weights[:-1] + weights[-1])
                loss, pull = _loss(margin, hinge)
                pull = np.where(seen, -sign * pull, 0.0)
                total[0] += np.where(seen, loss, 0.0).sum(axis=0)
                total[1:-1] += x[part].T @ pull
                total[-1] += pull.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for batch in batches:
        for row in batch.column(0):
            total = total + np.frombuffer(row.as_py())
    if not isinstance(total, float):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])


class Table:
    """Features around zero with a deviation of one, labels and folds, read again in every pass.

    ``train`` has features, labels and the fold. The rows are written once and kept by the executors;
    a lost one is read again.
    """

    def __init__(self, train: DataFrame):
        rows = settle(train.select(vector_to_array("features").alias("x"), F.col("labels").cast("double").alias("y"),
                                   F.col(FOLD).cast("int").alias("fold")), "matrix")
        kind = "fold int, n double, positive double, mean array<double>, squares array<double>"
        parts = [(r.fold, (r.n, r.positive, np.array(r.mean), np.array(r.squares))) for r in rows.mapInArrow(_moments, kind).collect()]  # a row per fold and task
        self.folds = sorted({fold for fold, _ in parts})
        self.moments = {out: Moments.of([p for fold, p in parts if fold != out]) for out in (NONE, *self.folds)
                        if any(fold != out for fold, _ in parts)}
        whole = self.moments[NONE]
        self.center, self.scale = whole.mean, np.where(whole.deviation > 0, whole.deviation, 1.0)
        self.rows = rows
        self.partitions = rows.rdd.getNumPartitions()
        self.rows.persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        self.rows.unpersist()

    def raw(self, column: Column, w: np.ndarray) -> np.ndarray:
        """Coefficients and intercept for features as they come, from those for standardised ones."""
        own = self.moments[column.left_out]
        out = np.zeros(len(w))
        np.divide(w[:-1], own.deviation, out=out[:-1], where=own.deviation > 0)
        if column.intercept:
            out[-1] = w[-1] - out[:-1] @ own.mean
        return out

    def losses(self, columns: Sequence[Column], points: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """Mean loss with the L2 penalty, and its gradient, of each column at its point."""
        weights = np.stack([self.raw(c, w) for c, w in zip(columns, points, strict=True)], axis=1)
        context = self.rows.sparkSession.sparkContext
        shared = context.broadcast((weights, np.array([c.left_out for c in columns]),
                                    np.array([c.loss == "hinge" for c in columns])))
        sums = self.rows.mapInArrow(_gradients(shared), "total binary")
        if self.partitions > DIRECT:
            sums = sums.repartition(int(self.partitions**0.5)).mapInArrow(_add, "total binary")
        total = sum(np.frombuffer(row.total) for row in sums.collect()).reshape(-1, len(columns))
        shared.destroy()
        out = []
        for i, (column, w) in enumerate(zip(columns, points, strict=True)):
            own = self.moments[column.left_out]
            gradient = np.zeros(len(w))
            shifted = total[1:-1, i] - (own.mean * total[-1, i] if column.intercept else 0.0)
            np.divide(shifted, own.deviation, out=gradient[:-1], where=own.deviation > 0)
            gradient[-1] = total[-1, i] if column.intercept else 0.0
            gradient /= own.n
            gradient[:-1] += column.l2 * w[:-1]
            out.append((total[0, i] / own.n + column.l2 / 2 * float(w[:-1] @ w[:-1]), gradient))
        return out

    def solve(self, columns: Sequence[Column]) -> None:
        """Minimise all columns; ``found`` gets the raw weights after each of their rounds."""
        running = {}
        for column in columns:
            own = self.moments[column.left_out]
            start = np.zeros(len(own.mean) + 1)
            if column.intercept and column.loss == "logistic" and 0 < own.positive < own.n:
                start[-1] = np.log(own.positive / (own.n - own.positive))
            l1 = None
            if column.l1 or column.loss == "hinge":  # the hinge has kinks: only a decrease is asked of a step
                l1 = np.full(len(start), column.l1)
                l1[-1] = 0.0
            run = minimise(start, column.rounds, l1)
            running[id(column)] = column, run, next(run)
        while running:
            asked = list(running.values())
            told = self.losses([a[0] for a in asked], [a[2] for a in asked])
            for (column, run, _), answer in zip(asked, told, strict=True):
                try:
                    running[id(column)] = column, run, run.send(answer)
                except StopIteration as end:
                    column.found = {n: self.raw(column, w) for n, w in end.value.items()}
                    del running[id(column)]

    def scores(self, models: Sequence[tuple[int, int, np.ndarray]]) -> DataFrame:
        """point, fold, score and label of every row of each model's left-out fold: models are (point, fold, weights)."""
        shared = self.rows.sparkSession.sparkContext.broadcast(list(models))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                for point, left_out, w in shared.value:
                    mine = fold == left_out
                    n = int(mine.sum())
                    if n:
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(n, point, np.int32)), pa.array(np.full(n, left_out, np.int32)),
                            pa.array(x[mine] @ w[:-1] + w[-1]), pa.array(y[mine])], ["point", "fold", "score", "label"])

        return self.rows.mapInArrow(run, "point int, fold int, score double, label double")


def areas(scored: DataFrame, keys: Sequence[str] = ("point", "fold"), score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under ROC per key: pairs of a positive and a negative row in the right order, ties by half.

    Equal scores are counted first. Running counts go over range partitions of (key, score), so no
    key's scores are sorted in one task. A key without rows of both labels has a null area.
    """
    counted = scored.groupBy(*keys, score).agg(F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    ranged = settle(counted.repartitionByRange(*keys, score).withColumn("part", F.spark_partition_id()), "ranged")
    whole = Window.partitionBy(*keys)
    sums = ranged.groupBy(*keys, "part").agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "part", F.coalesce(F.sum("part_neg").over(earlier), F.lit(0.0)).alias("start"),
                         F.sum("part_pos").over(whole).alias("all_pos"), F.sum("part_neg").over(whole).alias("all_neg"))
    own = Window.partitionBy(*keys, "part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = ranged.withColumn("own", F.coalesce(F.sum("neg").over(own), F.lit(0.0))).join(starts, [*keys, "part"])
    pairs = F.sum(F.col("pos") * (F.col("start") + F.col("own") + F.col("neg") / 2))
    both = F.first("all_pos") * F.first("all_neg")
    return below.groupBy(*keys).agg(F.when(both > 0, pairs / both).alias("area"))


# Grids


def points_of(method: str, grid: dict[str, list]) -> list[dict]:
    """Grid points in order, the last parameter turning fastest; unknown parameters raise ValueError."""
    known = {"svm": {"maxIter": 100, "regParam": 0.0},
             "logistic_regression": {"elasticNetParam": 0.0, "fitIntercept": True, "maxIter": 100, "regParam": 0.0}}[method]
    if odd := set(grid) - set(known):
        raise ValueError(f"unknown parameters of {method}: {sorted(odd)}")
    out = [dict(known)]
    for name, options in grid.items():
        out = [{**point, name: option} for point in out for option in options]
    return out


def _column(method: str, point: dict, rounds: tuple[int, ...], left_out: int) -> Column:
    if method == "svm":
        return Column("hinge", 0.0, point["regParam"], True, rounds, left_out)
    l1 = point["regParam"] * point["elasticNetParam"]
    return Column("logistic", l1, point["regParam"] - l1, point["fitIntercept"], rounds, left_out)


def solve_grid(table: Table, method: str, points: Sequence[dict], left_out: Sequence[int]) -> dict[tuple[int, int], np.ndarray]:
    """Raw weights, intercept last, of every (point number, left-out fold)."""
    shared: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        shared.setdefault(tuple((k, v) for k, v in sorted(point.items()) if k != "maxIter"), []).append(i)
    columns = {(key, out): _column(method, points[same[0]], tuple(sorted({points[i]["maxIter"] for i in same})), out)
               for key, same in shared.items() for out in left_out}
    table.solve(list(columns.values()))
    return {(i, out): column.found[points[i]["maxIter"]] for (key, out), column in columns.items() for i in shared[key]}


def model_of(method: str, weights: np.ndarray):
    """A Spark ML model with these weights, which transforms and is saved like any other."""
    context = SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    coefficients = _py2java(context, Vectors.dense(weights[:-1]))
    if method == "svm":
        uid = ml.util.Identifiable.randomUID("linearsvc")
        model = LinearSVCModel(ml.classification.LinearSVCModel(uid, coefficients, float(weights[-1])))
    else:
        uid = ml.util.Identifiable.randomUID("logreg")
        model = LogisticRegressionModel(ml.classification.LogisticRegressionModel(uid, coefficients, float(weights[-1])))
    return model.setFeaturesCol("features")


def search_linear(train: DataFrame, method: str, grid: dict[str, list]):
    """Best model over the folds of ``train`` (features, labels, fold), and the area of each (point, fold).

    The highest mean area wins, of equal ones the first in grid order. A fold that holds rows of one
    label only has no area and does not count.
    """
    table = Table(train)
    try:
        points = points_of(method, grid)
        folds = table.folds if len(points) > 1 and len(table.folds) > 1 else []
        weights = solve_grid(table, method, points, [NONE, *folds])
        tried = [(i, out, w) for (i, out), w in weights.items() if out != NONE]
        found = {(r.point, r.fold): r.area for r in areas(table.scores(tried)).collect()} if tried else {}
    finally:
        table.close()

    def mean(i: int) -> float:
        own = [a for (point, _), a in found.items() if point == i and a is not None]
        return sum(own) / len(own) if own else 0.0

    best = min(range(len(points)), key=lambda i: (-round(mean(i), 12), i))
    tried = [({name: points[i][name] for name in grid}, fold, area) for (i, fold), area in sorted(found.items())]
    return model_of(method, weights[best, NONE]), tried, {name: points[best][name] for name in grid}
