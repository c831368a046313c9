"""Churn features for Spark ML: preparation, pipeline stages, split, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.scalars import hash_below
from tillsight.operators.filters import drop_null_columns, impute, repeat_visitors

# Model columns, and what stands in for a missing gender or latency.
CATEGORICAL = ("gender", "tier", "state", "city")
NUMERIC = (
    "total_txn", "total_visits", "total_amount", "pointscollected", "lapsedpoints",
    "availablepoints", "max_latency", "recency", "tenure", "latency",
)
DEFAULTS = {"gender": "Male", "latency": 999.0}
FOLD = "fold"


def churn_label(features: DataFrame, churn_window: DataFrame) -> DataFrame:
    """Label 0 for members seen in the churn window, 1 for the others.

    Both sides hold one row per member and are grouped by it, so the join needs no shuffle.
    """
    seen = churn_window.select("mobile").distinct().withColumn("labels", F.lit(0))
    return features.join(seen, "mobile", "left").withColumn("labels", F.coalesce("labels", F.lit(1)))


def fill(features: DataFrame) -> DataFrame:
    """Repeat visitors with missing values filled and whole-number latencies."""
    filled = impute(repeat_visitors(features), DEFAULTS)
    return filled.withColumns({c: F.col(c).cast("int") for c in ("max_latency", "latency")})


def prepare(features: DataFrame) -> DataFrame:
    """Training rows: filled, and without the columns that hold no value at all."""
    return drop_null_columns(fill(features))


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def category_index(categorical: Sequence[str]) -> StringIndexer:
    """Index per category by frequency; unseen values get an index of their own."""
    return StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical],
                         handleInvalid="keep")


def one_hot(categorical: Sequence[str]) -> OneHotEncoder:
    """One-hot vectors of the indexed categories."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in categorical],
                         outputCols=[f"{c}_hot" for c in categorical])


def assembler(categorical: Sequence[str], numeric: Sequence[str], output: str = "features") -> VectorAssembler:
    """Numbers first, then the one-hot vectors, in the given order."""
    return VectorAssembler(inputCols=[*numeric, *[f"{c}_hot" for c in categorical]], outputCol=output)


def feature_pipeline(categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC) -> Pipeline:
    """Index, encode and assemble."""
    encode = [category_index(categorical), one_hot(categorical)] if categorical else []
    return Pipeline(stages=[*encode, assembler(categorical, numeric)])


def scaled(pipeline: Pipeline) -> Pipeline:
    """The pipeline with standard scaling (deviation only) of its features."""
    *before, last = pipeline.getStages()
    raw = last.copy().setOutputCol("raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False)
    return Pipeline(stages=[*before, raw, scaler])


def to_features(df: DataFrame, model: PipelineModel) -> DataFrame:
    """(mobile, features) and the labels where the frame has them."""
    return model.transform(df).select("mobile", "features", *present(df, ["labels"]))


def hash_split(df: DataFrame, key: str = "mobile", share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: disjoint and stable under any partitioning."""
    chosen = hash_below(share, key)
    return df.filter(chosen), df.filter(~chosen)


def with_fold(df: DataFrame, folds: int = 5, key: str = "mobile") -> DataFrame:
    """Number each row's fold by a hash of the key, so that folds never depend on the partitioning."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("fold|"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(FOLD, F.coalesce(F.pmod(draw, F.lit(folds)), F.lit(0)).cast("int"))


def log_odds(df: DataFrame, output: str = "log_odds") -> DataFrame:
    """Difference of the raw scores of both classes: a Naive Bayes raw score alone ranks rows by size as well."""
    raw = vector_to_array("rawPrediction")
    return df.withColumn(output, F.element_at(raw, 2) - F.element_at(raw, 1))


def auc(df: DataFrame, score: str = "rawPrediction", label: str = "labels") -> float:
    """Area under the ROC curve over all distinct scores."""
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                              metricName="areaUnderROC", numBins=0)
    return evaluator.evaluate(df)


def score_record(spark: SparkSession, method: str, value: float) -> DataFrame:
    """One (method, auc, ts) row."""
    row = spark.createDataFrame([(method, float(value))], "method string, auc double")
    return row.withColumn("ts", F.current_timestamp())
