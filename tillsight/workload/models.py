"""Queries for churn features and models."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators import features as M
from tillsight.operators.filters import observation_window, trailing_window
from tillsight.operators.visits import write_states
from tillsight.plans import churn as C
from tillsight.session import new_path, settle
from tillsight.sources.writers import load_model, save_model
from tillsight.workload.registry import query, rounded
from tillsight.workload.relational import COMMON, profile_sql
from tillsight.workload.views import ASOF, CW, PW, Views

def features_sql(txn: str, sku: str, reference: str, label: str = "") -> str:
    return f"""
    SELECT p.mobile, gender, tier, state, city, total_txn, total_visits, total_amount, pointscollected, lapsedpoints,
           availablepoints, max_latency, {reference} - last_date AS recency, {reference} - first_date AS tenure,
           CASE WHEN total_visits > 1 THEN CAST(last_date - first_date AS DOUBLE) / (total_visits - 1) END
               AS latency,
           uniqueitems, qty, ndept, nstores{label}
    FROM ({profile_sql(txn)}) AS p
    LEFT JOIN (SELECT mobile, count(DISTINCT (bill, item)) AS uniqueitems, CAST(sum(qty) AS BIGINT) AS qty
               FROM {sku} GROUP BY mobile) AS s ON p.mobile = s.mobile
    LEFT JOIN (SELECT mobile, count(DISTINCT (bill, department)) AS ndept
               FROM {sku} JOIN item ON {sku}.item = item.item GROUP BY mobile) AS d ON p.mobile = d.mobile
    LEFT JOIN member ON p.mobile = member.mobile
    LEFT JOIN store ON member.store = store.store"""


LABEL = ", CASE WHEN p.mobile IN (SELECT mobile FROM since) THEN 0 ELSE 1 END AS labels"
NUMBERS = list(M.NUMERIC)
TRAINING_SHARE = "b3333333"  # 70 % of the hash range
FOLDS = 5


def positions_sql(source: str, fitted: str, value: str = "value") -> str:
    """Feature vector as (mobile, pos, value) rows: numbers, then one-hot blocks by category.

    ``fitted`` is where the categories are counted. The most frequent value comes first, equal
    ones in text order.
    """
    numbers = " UNION ALL ".join(
        f"SELECT mobile, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM {source}" for i, c in enumerate(NUMBERS)
    )
    ranked = " UNION ALL ".join(
        f"SELECT {i} AS block, {c} AS category, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx "
        f"FROM {fitted} GROUP BY {c}" for i, c in enumerate(M.CATEGORICAL)
    )
    values = " UNION ALL ".join(f"SELECT mobile, {i} AS block, {c} AS category FROM {source}"
                                for i, c in enumerate(M.CATEGORICAL))
    return f"""
    SELECT mobile, pos, {value} AS value FROM (
        {numbers}
        UNION ALL
        SELECT v.mobile, {len(NUMBERS)} + r.idx + coalesce(
                   (SELECT count(*) FROM ({ranked}) AS earlier WHERE earlier.block < r.block), 0) AS pos,
               CASE WHEN v.category = r.category THEN 1.0e0 ELSE 0.0e0 END AS value
        FROM ({values}) AS v JOIN ({ranked}) AS r ON v.block = r.block)"""


EXTRA = {
    **COMMON,
    "past_sku": f"SELECT * FROM sku WHERE txn_date > DATE '{ASOF}' - {PW + CW} AND txn_date < DATE '{ASOF}' - {CW}",
    "late_txn": f"SELECT * FROM txn WHERE txn_date > DATE '{ASOF}' - {PW}",
    "late_sku": f"SELECT * FROM sku WHERE txn_date > DATE '{ASOF}' - {PW}",
    "features": features_sql("past", "past_sku", f"(DATE '{ASOF}' - {CW})", LABEL),
    "ready": """
        SELECT * REPLACE (coalesce(gender, 'Male') AS gender, CAST(trunc(coalesce(latency, 999)) AS BIGINT) AS latency)
        FROM features WHERE total_visits > 1""",
    "late_features": features_sql("late_txn", "late_sku", f"DATE '{ASOF}'"),
    "late_ready": """
        SELECT * REPLACE (coalesce(gender, 'Male') AS gender, CAST(trunc(coalesce(latency, 999)) AS BIGINT) AS latency)
        FROM late_features WHERE total_visits > 1""",
    "train": f"SELECT * FROM ready WHERE substr(md5(mobile), 1, 8) < '{TRAINING_SHARE}'",
    "test": f"SELECT * FROM ready WHERE substr(md5(mobile), 1, 8) >= '{TRAINING_SHARE}'",
}


def sql_query(name, sql=None):
    return query(name, sql, EXTRA)


def training_features(v: Views) -> DataFrame:
    return C.churn_features(v.txn, v.sku, v.item, v.member, v.store, ASOF, PW, CW)


def scoring_features(v: Views) -> DataFrame:
    return C.churn_features(v.txn, v.sku, v.item, v.member, v.store, ASOF, PW)


def ready(v: Views) -> DataFrame:
    """Prepared training rows, written once since fitting reads them several times."""
    return settle(M.prepare(training_features(v)), "ready")


def positions(df: DataFrame, column: str) -> DataFrame:
    """(mobile, pos, value) rows of a vector column."""
    return df.select("mobile", F.posexplode(vector_to_array(column)).alias("pos", "value"))


@sql_query("c7_churn_features", "SELECT * FROM features")
def _(v):
    return training_features(v)


@sql_query("c7_churn_features_scoring", features_sql("late_txn", "late_sku", f"DATE '{ASOF}'"))
def _(v):
    return scoring_features(v)


STATE_DATES = ("2001-08-01", "1998-03-17", "1997-01-31")  # the first of a month, its middle, its end


def dated(text: str, i: int) -> str:
    """A view's SQL for another as-of date."""
    for name in ("past_sku", "past", "since"):
        text = re.sub(rf"\b{name}\b", f"{name}_{i}", text)
    return text.replace(ASOF, STATE_DATES[i])


STATES = {f"{name}_{i}": dated({**COMMON, **EXTRA}[name], i)
          for i in range(len(STATE_DATES)) for name in ("past", "since", "past_sku")}


@query("c7_churn_features_states", " UNION ALL ".join(
    f"SELECT '{day}' AS asof, * FROM ({dated(EXTRA['features'], i)})" for i, day in enumerate(STATE_DATES)),
    {**EXTRA, **STATES})
def _(v):
    path = new_path(v.spark, "states")
    write_states(v.txn, v.sku, v.item, path)
    parts = [C.churn_features_from_states(path, v.txn, v.sku, v.item, v.member, v.store, day, PW, CW)
             .select(F.lit(day).alias("asof"), "*") for day in STATE_DATES]
    return reduce(DataFrame.unionByName, parts)


@sql_query("m1_churn_label", """
    SELECT DISTINCT mobile, CASE WHEN mobile IN (SELECT mobile FROM since) THEN 0 ELSE 1 END AS labels FROM past""")
def _(v):
    past = observation_window(v.txn, "txn_date", ASOF, PW, CW).select("mobile").distinct()
    return M.churn_label(past, trailing_window(v.txn, "txn_date", ASOF, CW))


INDEXED = " UNION ALL ".join(
    f"SELECT mobile, '{c}' AS name, CAST(idx AS DOUBLE) AS idx FROM ready JOIN (SELECT {c} AS category, "
    f"row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM ready GROUP BY {c}) AS r ON {c} = category"
    for c in M.CATEGORICAL
)


@sql_query("m2_category_index", INDEXED)
def _(v):
    df = ready(v)
    indexed = M.category_index(M.CATEGORICAL).fit(df).transform(df)
    names = [f"{c}_index" for c in M.CATEGORICAL]
    rows = indexed.unpivot("mobile", names, "name", "idx")
    return rows.withColumn("name", F.regexp_replace("name", "_index$", ""))


@sql_query("m3_one_hot", f"""
    SELECT mobile, pos - {len(NUMBERS)} AS pos, value FROM ({positions_sql('ready', 'ready')})
    WHERE pos >= {len(NUMBERS)}""")
def _(v):
    df = ready(v)
    indexed = M.category_index(M.CATEGORICAL).fit(df).transform(df)
    hot = M.one_hot(M.CATEGORICAL).fit(indexed).transform(indexed)
    return positions(M.assembler(M.CATEGORICAL, []).transform(hot), "features")


@sql_query("m4_assembler", " UNION ALL ".join(
    f"SELECT mobile, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM ready" for i, c in enumerate(NUMBERS)))
def _(v):
    return positions(M.assembler([], M.NUMERIC).transform(ready(v)), "features")


@sql_query("m5_feature_pipeline", positions_sql("ready", "ready"))
def _(v):
    df = ready(v)
    return positions(M.to_features(df, M.feature_pipeline().fit(df)), "features")


@sql_query("m6_hash_split", "SELECT mobile, 'train' AS part FROM train UNION ALL SELECT mobile, 'test' FROM test")
def _(v):
    train, test = M.hash_split(M.prepare(training_features(v)).select("mobile"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@sql_query("m7_scaled", f"""
    SELECT x.mobile, x.pos, round(CASE WHEN s.deviation = 0 THEN 0 ELSE x.value / s.deviation END, 6) AS value
    FROM ({positions_sql('ready', 'train')}) AS x
    JOIN (SELECT pos, stddev_samp(value) AS deviation FROM ({positions_sql('train', 'train')}) GROUP BY pos) AS s
      ON x.pos = s.pos""")
def _(v):
    df = ready(v)
    train, _ = M.hash_split(df)
    model = M.scaled(M.feature_pipeline()).fit(train)
    return rounded(positions(M.to_features(df, model), "features"), 6, "value")


def bayes_sql(source: str, fitted: str, smoothing: str = "1.0e0") -> str:
    """(mobile, score): log odds of multinomial Naive Bayes, counted over ``fitted``, for the rows of ``source``."""
    return f"""
    SELECT x.mobile, round(sum(x.value * t.odds) + any_value(p.odds), 9) AS score
    FROM ({positions_sql(source, fitted)}) AS x
    JOIN (SELECT pos, ln(one + {smoothing}) - ln(sum(one) OVER () + {smoothing} * count(*) OVER ())
                    - ln(zero + {smoothing}) + ln(sum(zero) OVER () + {smoothing} * count(*) OVER ()) AS odds
          FROM (SELECT pos, sum(CASE WHEN labels = 1 THEN value ELSE 0 END) AS one,
                       sum(CASE WHEN labels = 0 THEN value ELSE 0 END) AS zero
                FROM ({positions_sql(fitted, fitted)}) AS f JOIN {fitted} ON f.mobile = {fitted}.mobile GROUP BY pos)) AS t
      ON x.pos = t.pos
    CROSS JOIN (SELECT ln(count(*) FILTER (labels = 1) + {smoothing}) - ln(count(*) FILTER (labels = 0) + {smoothing})
                    AS odds FROM {fitted}) AS p
    GROUP BY x.mobile"""


def area_sql(scored: str) -> str:
    """Area under ROC of (score, labels) rows."""
    return f"""
    SELECT round((sum(CASE WHEN labels = 1 THEN rank END) - sum(labels) * (sum(labels) + 1) / 2.0e0)
           / (CAST(sum(labels) AS DOUBLE) * (count(*) - sum(labels))), 6) AS auc
    FROM (SELECT labels, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS rank
          FROM ({scored}))"""


FOLD_SQL = f"CAST('0x' || substr(md5('fold|' || mobile), 1, 8) AS BIGINT) % {FOLDS}"


def grid_sql(method: str) -> str:
    """Every grid point of the method with every fold and the members left out in it."""
    grid = C.FULL_GRIDS[method]
    names = ", ".join(f'"{name}"' for name in grid)
    points = ", ".join(str(tuple(p.values())).replace("True", "true").replace("False", "false") for p in C.grid_points(grid))
    return f"""
    SELECT {", ".join(f'CAST({n} AS DOUBLE) AS {n}' for n in names.split(", "))}, fold, members, true AS measured
    FROM (VALUES {points}) AS g({names})
    CROSS JOIN (SELECT CAST({FOLD_SQL} AS INTEGER) AS fold, count(*) AS members FROM train GROUP BY 1)"""


def searched(v: Views, method: str) -> DataFrame:
    """Every point and fold of the search, the members left out, and whether it was measured there."""
    found = C.fit_churn(training_features(v), method, folds=FOLDS).search
    assert found.best in [point for point, _, _ in found.trials]
    rows = [(*map(float, point.values()), fold, area) for point, fold, area in found.trials]
    tried = v.spark.createDataFrame(rows, ", ".join(f"{name} double" for name in found.best) + ", fold int, area double")
    train, _ = M.hash_split(ready(v))
    held = M.with_fold(train, FOLDS).groupBy("fold").agg(F.count("*").alias("members"))
    return tried.join(held, "fold").withColumn("measured", F.col("area").between(0.0, 1.0)).drop("area")


@sql_query("m8_linear_svm", grid_sql("svm"))
def _(v):
    return searched(v, "svm")


@sql_query("m9_naive_bayes", area_sql(f"""
    SELECT s.score, test.labels FROM ({bayes_sql('test', 'train')}) AS s JOIN test ON s.mobile = test.mobile""")
    .replace("SELECT round", "SELECT 'naive_bayes' AS method, round", 1))
def _(v):
    model = C.fit_churn(training_features(v), "naive_bayes")
    return rounded(M.score_record(v.spark, model.method, model.auc).drop("ts"), 6, "auc")


@sql_query("m10_logistic_regression", grid_sql("logistic_regression"))
def _(v):
    return searched(v, "logistic_regression")


@sql_query("m11_boosted_trees", grid_sql("boosted_trees"))
def _(v):
    return searched(v, "boosted_trees")


SMOOTHINGS = (0.5, 1.0, 20.0)


def trial_sql(smoothing: float, fold: int) -> str:
    """Area under ROC of Naive Bayes on one left-out fold; the encoding is that of the whole training part."""
    counted = bayes_sql("train", "train", f"{smoothing}e0").replace(
        "GROUP BY pos)) AS t", f"WHERE {FOLD_SQL.replace('mobile', 'train.mobile')} <> {fold} GROUP BY pos)) AS t").replace(
        "AS odds FROM train)", f"AS odds FROM train WHERE {FOLD_SQL} <> {fold})")
    scored = f"""SELECT s.score, train.labels FROM ({counted}) AS s JOIN train ON s.mobile = train.mobile
                 WHERE {FOLD_SQL.replace('mobile', 'train.mobile')} = {fold}"""
    return area_sql(scored).replace("SELECT round", f"SELECT {smoothing}e0 AS smoothing, {fold} AS fold, round", 1)


@sql_query("m12_cross_validation", f"""
    SELECT *, smoothing = first_value(smoothing) OVER (ORDER BY mean DESC, smoothing) AS chosen
    FROM (SELECT *, round(avg(auc) OVER (PARTITION BY smoothing), 6) AS mean FROM (
        {" UNION ALL ".join(trial_sql(s, f) for s in SMOOTHINGS for f in range(FOLDS))}))""")
def _(v):
    train, _ = M.hash_split(ready(v))
    data = M.to_features(train, M.feature_pipeline().fit(train))
    found = C.search(data, "naive_bayes", {"smoothing": list(SMOOTHINGS)}, FOLDS)
    rows = [(p["smoothing"], fold, round(a, 6), p == found.best) for p, fold, a in found.trials]
    tried = v.spark.createDataFrame(rows, "smoothing double, fold int, auc double, chosen boolean")
    return tried.withColumn("mean", F.round(F.avg("auc").over(Window.partitionBy("smoothing")), 6))


AUC = """
    SELECT {head} round((sum(CASE WHEN labels = 1 THEN rank END) - sum(labels) * (sum(labels) + 1) / 2.0e0)
           / (CAST(sum(labels) AS DOUBLE) * (count(*) - sum(labels))), 6) AS auc
    FROM (SELECT labels, rank() OVER (ORDER BY recency) + (count(*) OVER (PARTITION BY recency) - 1) / 2.0e0 AS rank
          FROM ready)"""


def recency_auc(v: Views) -> float:
    """How well recency alone tells churners: a score SQL can rank as well."""
    scored = M.prepare(training_features(v)).select("labels", F.col("recency").cast("double").alias("recency"))
    return M.auc(scored, "recency")


@sql_query("m13_auc", AUC.format(head=""))
def _(v):
    return rounded(M.score_record(v.spark, "recency", recency_auc(v)).select("auc"), 6, "auc")


@sql_query("m14_score_record", AUC.format(head="'recency' AS method,"))
def _(v):
    return rounded(M.score_record(v.spark, "recency", recency_auc(v)).drop("ts"), 6, "auc")


@sql_query("m15_score_churn")
def _(v):
    model = C.fit_churn(training_features(v), "logistic_regression")
    return C.score_churn(scoring_features(v), model.pipeline, v.member)


@sql_query("m15_score_churn_bayes", f"""
    SELECT mobile, CAST(score > 0 AS INTEGER) AS prediction FROM ({bayes_sql('late_ready', 'train')})
    WHERE mobile IN (SELECT mobile FROM member)""")
def _(v):
    model = C.fit_churn(training_features(v), "naive_bayes")
    return C.score_churn(scoring_features(v), model.pipeline, v.member)


@sql_query("c8_churn_fit_score", "SELECT count(*) AS members, count(*) AS predicted FROM late_ready")
def _(v):
    model = C.fit_churn(training_features(v), "boosted_trees")
    scored = C.score_churn(scoring_features(v), model.pipeline)
    return scored.agg(F.count("*").alias("members"), F.count_if(F.col("prediction").isin(0, 1)).alias("predicted"))


@sql_query("s8_model_persistence", "SELECT count(*) AS members, 0 AS mismatches FROM ready")
def _(v):
    df = ready(v)
    model = C.fit_churn(training_features(v), "naive_bayes").pipeline
    again = load_model(save_model(model, new_path(v.spark, "model")))
    before = model.transform(df).select("mobile", F.col("prediction").alias("before"))
    after = again.transform(df).select("mobile", F.col("prediction").alias("after"))
    return before.join(after, "mobile").agg(
        F.count("*").alias("members"), F.count_if(F.col("before") != F.col("after")).alias("mismatches")
    )
