"""Churn features, models, persistence."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
import __spark_entry__ as entry
from conftest import values
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tillsight.operators import features as M
from tillsight.plans import churn as C
from tillsight.operators.aggregates import member_profile
from tillsight.operators.boosting import grow, prefix, trials, with_validation
from tillsight.operators.linear import NONE, Table, _loss, areas, points_of, search_linear, solve_grid
from tillsight.sources.writers import load_model, save_model

SMALL_GRIDS = {
    "svm": {"maxIter": [10], "regParam": [0.01, 0.1]},
    "logistic_regression": {"maxIter": [10], "regParam": [0.01, 0.5]},
    "boosted_trees": {"maxIter": [2, 5], "stepSize": [0.1], "maxDepth": [3]},
    "naive_bayes": {"smoothing": [0.5, 1.0]},
}

ASOF = "2020-07-01"


def day(n):
    return dt.date(2020, 7, 1) - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    rows = [  # days before asof
        ("stay", 1, 50), ("stay", 2, 40), ("stay", 3, 5), ("gone", 4, 60), ("gone", 5, 35),
        ("edge", 6, 30), ("edge", 7, 70), ("edge2", 8, 45), ("edge2", 9, 30), ("late", 10, 2), ("old", 11, 90),
    ]
    txn = spark.createDataFrame(
        [(m, b, day(d), Decimal(100), 1, 1, 2, 3) for m, b, d in rows],
        "mobile string, bill bigint, txn_date date, amount decimal(18,2), store bigint, collected bigint, "
        "available bigint, lapsed bigint")
    sku = txn.select("mobile", "bill", F.explode(F.array(F.lit(7), F.lit(8))).alias("item"), F.lit(2).alias("qty"), "txn_date")
    item = spark.createDataFrame([(7, "x"), (8, "x")], "item int, department string")
    member = spark.createDataFrame([("stay", "gold", None, 1), ("gone", "base", "Female", 9)],
                                   "mobile string, tier string, gender string, store bigint")
    store = spark.createDataFrame([(1, "north", "town")], "store bigint, state string, city string")
    return txn, sku, item, member, store


def test_training_features(tables):
    got = {r.mobile: r for r in C.churn_features(*tables, ASOF, pw=30, cw=30).collect()}
    # day 30 lies in neither window, nor does day 60, the far edge of the observation window
    assert sorted(got) == ["edge2", "gone", "stay"]
    assert {m: r.labels for m, r in got.items()} == {"stay": 0, "gone": 1, "edge2": 1}
    stay = got["stay"]
    assert (stay.total_visits, stay.recency, stay.tenure, stay.latency, stay.max_latency) == (2, 10, 20, 10.0, 10)
    assert (stay.uniqueitems, stay.qty, stay.ndept, stay.state) == (4, 8, 2, "north")
    assert (got["gone"].latency, got["gone"].state, got["edge2"].tier) == (None, None, None)


def test_scoring_features(tables):
    got = {r.mobile: r for r in C.churn_features(*tables, ASOF, pw=45).collect()}
    assert sorted(got) == ["edge", "edge2", "gone", "late", "stay"]
    assert "labels" not in got["stay"].asDict() and (got["stay"].recency, got["stay"].tenure) == (5, 40)


def test_fill_and_prepare(tables):
    features = C.churn_features(*tables, ASOF, pw=60, cw=30)
    ready = M.prepare(features)
    assert {r.mobile: r.gender for r in ready.collect()} == {"stay": "Male", "gone": "Female"}
    assert values(M.fill(features.withColumn("latency", F.lit(None).cast("double"))), "latency") == [(999,), (999,)]


def sample(spark, shift=0):
    """Churners come seldom and long ago."""
    labels = (F.col("id") % 2).cast("int")
    noise = F.pmod(F.xxhash64("id"), F.lit(7)).cast("int")
    return spark.range(shift, shift + 400).select(
        F.col("id").cast("string").alias("mobile"), labels.alias("labels"),
        F.when(F.col("id") % 3 == 0, "Male").otherwise("Female").alias("gender"),
        F.concat(F.lit("t"), F.col("id") % 4).alias("tier"), F.lit("s").alias("state"),
        F.when(F.col("id") % 5 > 0, "c1").otherwise("c2").alias("city"),
        (noise + 10 - 6 * labels).alias("total_txn"), (noise + 9 - 5 * labels).alias("total_visits"),
        (noise * 10.0 + 50).alias("total_amount"), noise.alias("pointscollected"), F.lit(0).alias("lapsedpoints"),
        noise.alias("availablepoints"), (noise + 20 * labels).alias("max_latency"), (noise + 30 * labels).alias("recency"),
        F.lit(300).alias("tenure"), (noise + 5.5).alias("latency"),
    )


@pytest.mark.parametrize("method", ["svm", "naive_bayes", "logistic_regression", "boosted_trees"])
def test_fit_save_load_score(spark, tmp_path, method):
    model = C.fit_churn(sample(spark), method, SMALL_GRIDS[method], folds=2)
    assert 0.9 <= model.auc <= 1.0
    assert len(model.search.trials) == 4 and model.search.best in C.grid_points(SMALL_GRIDS[method])
    fresh = sample(spark, 1000).drop("labels")
    before = values(C.score_churn(fresh, model.pipeline), "mobile", "prediction")
    again = load_model(save_model(model.pipeline, str(tmp_path / "model")))
    assert before == values(C.score_churn(fresh, again), "mobile", "prediction") and len(before) == 400
    wanted = spark.createDataFrame([("1001",), ("1002",), ("1002",), ("nobody",)], "mobile string")
    assert [m for m, _ in values(C.score_churn(fresh, again, wanted), "mobile", "prediction")] == ["1001", "1002"]


def test_unseen_category_is_scored(spark):
    model = C.fit_churn(sample(spark), "naive_bayes")
    odd = sample(spark, 2000).withColumn("tier", F.lit("never seen")).drop("labels")
    assert C.score_churn(odd, model.pipeline).count() == 400


def test_split_is_disjoint_and_fitting_sees_train_only(spark):
    train, test = M.hash_split(sample(spark))
    assert train.join(test, "mobile").count() == 0 and train.count() + test.count() == 400
    model = M.scaled(M.feature_pipeline()).fit(train)
    deviation = train.agg(F.stddev_samp("recency")).first()[0]
    assert abs(model.stages[-1].std[M.NUMERIC.index("recency")] - deviation) < 1e-9


def test_grids():
    sizes = {m: 1 for m in C.FULL_GRIDS}
    for method, grid in C.FULL_GRIDS.items():
        assert method == "naive_bayes" or set(SMALL_GRIDS[method]) <= set(grid)
        sizes[method] = len(C.grid_points(grid))
    assert sizes == {"svm": 12, "logistic_regression": 36, "boosted_trees": 24, "naive_bayes": 1}


@pytest.mark.parametrize("name", ["m8_linear_svm", "m10_logistic_regression", "m11_boosted_trees", "m15_score_churn",
                                  "c8_churn_fit_score"])
def test_registered_queries_search_the_full_grid(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def ask(train, method, grid=None, folds=5, parallelism=4):
        raise Asked(grid, folds)

    monkeypatch.setattr(C, "search", ask)
    with pytest.raises(Asked) as asked:
        entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert asked.value.args == (None, 5)


def test_auc_of_ties_and_of_no_information(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (1.0, 0), (2.0, 1)], "score double, labels int")
    assert M.auc(df, "score") == pytest.approx(0.875)
    assert M.auc(df.withColumn("score", F.lit(1.0)), "score") == pytest.approx(0.5)


def vectors(spark, rows=600, seed=3):
    """Noisy labels of two informative, one constant and one useless feature, with folds and validation marks."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(5, 2, rows), rng.normal(0, 1, rows), np.full(rows, 7.0), rng.normal(100, 30, rows)])
    y = (0.8 * x[:, 0] - 1.2 * x[:, 1] + rng.normal(0, 2, rows) > 4).astype(int)
    df = spark.createDataFrame([(str(i), Vectors.dense(v), int(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))],
                               ["mobile", "features", "labels"])
    return with_validation(M.with_fold(df, 3))


def test_a_prefix_is_the_fit_with_fewer_rounds(spark):
    df = vectors(spark)
    long = grow(df, 0.1, 3, 40)
    assert 4 < long.getNumTrees <= 40
    short = grow(df, 0.1, 3, 4)
    both = prefix(long, 4).transform(df).select("mobile", F.col("rawPrediction").alias("a")).join(
        short.transform(df).select("mobile", F.col("rawPrediction").alias("b")), "mobile").collect()
    assert all(r.a == r.b for r in both) and prefix(long, 1000) is long


def test_early_stop_and_every_trial(spark):
    df = vectors(spark)
    noise = df.withColumn("labels", (F.xxhash64("mobile") % 2 == 0).cast("int"))
    assert grow(noise, 0.4, 5, 200).getNumTrees < 50
    one_label = noise.withColumn("validates", F.col("validates") & (F.col("labels") == 1))
    assert grow(one_label, 0.4, 2, 3).getNumTrees == 3  # nothing to stop by
    found = trials(df, [2, 5, 400], [0.1, 0.4], [2], [0, 1, 2])
    assert sorted((t.rounds, t.rate, t.depth, t.fold) for t in found) == sorted(
        (r, s, 2, f) for r in (2, 5, 400) for s in (0.1, 0.4) for f in range(3))
    for t in found:
        assert t.grown <= t.rounds and 0.6 < t.auc <= 1.0
        model = grow(df.filter(F.col("fold") != t.fold), t.rate, t.depth, t.rounds)
        if t.rounds == 5 and t.fold == 0:
            assert t.auc == pytest.approx(M.auc(model.transform(df.filter("fold = 0"))))


@pytest.mark.parametrize("grid", [
    {"elasticNetParam": [0.0, 0.5, 1.0], "fitIntercept": [False, True], "maxIter": [100], "regParam": [0.01, 0.5]}])
def test_logistic_regression_equals_sparks(spark, grid):
    df = vectors(spark)
    table, points = Table(df), points_of("logistic_regression", grid)
    solved = solve_grid(table, "logistic_regression", points, [NONE, 0])
    table.close()
    for (i, out), weights in solved.items():
        classifier = LogisticRegression(labelCol="labels", **points[i])
        model = classifier.fit(df if out == NONE else df.filter(F.col("fold") != out))
        assert np.abs(weights[:-1] - model.coefficients.toArray()).max() < 1e-3, points[i]
        assert abs(weights[-1] - model.intercept) < 1e-2


def hinge(df, weights, penalty):
    rows = df.select("features", "labels").collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([2 * r.labels - 1 for r in rows])
    return np.maximum(0, 1 - y * (x @ weights[:-1] + weights[-1])).mean() + penalty / 2 * (
        (weights[:-1] * x.std(axis=0, ddof=1)) ** 2).sum()


def test_svm_reaches_a_loss_no_higher_than_sparks(spark):
    df = vectors(spark)
    table, points = Table(df), points_of("svm", {"maxIter": [50], "regParam": [0.01, 0.1, 1.0]})
    solved = solve_grid(table, "svm", points, [NONE])
    table.close()
    for (i, _), weights in solved.items():
        model = LinearSVC(labelCol="labels", **points[i]).fit(df)
        theirs = np.append(model.coefficients.toArray(), model.intercept)
        assert hinge(df, weights, points[i]["regParam"]) <= hinge(df, theirs, points[i]["regParam"]) + 2e-3


def test_iteration_limits_share_a_run(spark):
    df = vectors(spark)
    table, points = Table(df), points_of("logistic_regression", {"maxIter": [1, 3, 100], "regParam": [0.01]})
    together = solve_grid(table, "logistic_regression", points, [NONE])
    alone = solve_grid(table, "logistic_regression", points[:1], [NONE])
    table.close()
    assert np.allclose(together[0, NONE], alone[0, NONE]) and not np.allclose(together[0, NONE], together[2, NONE])


def test_unknown_parameters_are_refused(spark):
    with pytest.raises(ValueError, match="threshold"):
        points_of("svm", {"threshold": [0.0]})


def test_search_finds_the_better_point(spark):
    model, found, best = search_linear(vectors(spark), "logistic_regression", {"regParam": [50.0, 0.01], "elasticNetParam": [1.0]})
    assert best == {"regParam": 0.01, "elasticNetParam": 1.0} and len(found) == 6
    assert all(area == pytest.approx(0.5) for point, _, area in found if point["regParam"] == 50.0)


def test_areas_of_many_keys(spark):
    rng = np.random.default_rng(5)
    rows = [(p, f, float(rng.integers(0, 20)), float(rng.integers(0, 2))) for p in range(3) for f in range(2) for _ in range(200)]
    rows += [(9, 9, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "point int, fold int, score double, label double")
    got = {(r.point, r.fold): r.area for r in areas(df).collect()}
    assert got.pop((9, 9)) is None and len(got) == 6
    for (p, f), area in got.items():
        mine = [(s, c) for a, b, s, c in rows if (a, b) == (p, f)]
        pairs = [(s > t) + (s == t) / 2 for s, c in mine if c for t, d in mine if not d]
        assert area == pytest.approx(sum(pairs) / len(pairs))


def test_folds_follow_the_member(spark):
    df = sample(spark)
    folds = dict(values(M.with_fold(df, 5), "mobile", "fold"))
    assert folds == dict(values(M.with_fold(df.repartition(7), 5), "mobile", "fold"))
    assert sorted(set(folds.values())) == [0, 1, 2, 3, 4]


def test_losses_of_mixed_columns_at_far_margins():
    margin = np.array([[-800.0, -2.0, 0.0], [0.0, 0.5, 900.0], [3.0, 1.0, -1.0]])
    for hinge in ([False] * 3, [True] * 3, [False, True, False]):
        loss, pull = _loss(margin, np.array(hinge))
        assert np.allclose(loss, np.where(hinge, np.maximum(0, 1 - margin), np.logaddexp(0, -margin)), rtol=1e-14)
        assert np.allclose(pull, np.where(hinge, margin < 1, np.exp(-np.logaddexp(0, margin))), rtol=1e-14)


def test_member_without_a_number_has_a_profile(spark):
    day = dt.date(2001, 1, 1)
    rows = [(None, 1, day, 5, 1), (None, 2, None, 6, 1), ("a", 3, day, 7, 1), ("a", 3, day, 8, 2), ("a", 4, day + dt.timedelta(9), 9, 2)]
    txn = spark.createDataFrame(rows, "mobile string, bill long, txn_date date, amount long, store long").selectExpr(
        "*", "1L AS lapsed", "2L AS available", "3L AS collected")
    found = {r.mobile: (r.total_amount, r.total_visits, r.max_latency, r.total_txn, r.nstores) for r in member_profile(txn).collect()}
    assert found == {None: (11.0, 1, None, 2, 1), "a": (24.0, 2, 9, 2, 2)}
