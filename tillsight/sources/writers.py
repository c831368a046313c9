"""Feature, insight, log and model writers."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators.factors import FactorModel
from tillsight.operators.ranking import top_n


def write_features(df: DataFrame, path: str, format: str = "parquet") -> str:
    """Write a feature table, replacing what is there."""
    df.write.mode("overwrite").format(format).option("header", True).save(path)
    return path


def append_insight(df: DataFrame, path: str) -> str:
    """Append insight rows, one folder per insight."""
    df.write.mode("append").partitionBy("insight_id").parquet(path)
    return path


def replace_run(df: DataFrame, path: str, insight_id: str, run_id: str) -> str:
    """Write the rows of one insight and run, replacing all that is there, also by no rows at all."""
    folder = f"{path}/insight_id={quote(insight_id, safe='')}/run_id={quote(run_id, safe='')}"
    df.drop("insight_id", "run_id").write.mode("overwrite").parquet(folder)
    return folder


def upsert_latest(old: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Union of both with the latest row per key; new rows win over old ones of equal age."""
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    others = [c for c in old.columns if c not in (*key, order)]
    kept = top_n(both, list(key), order, [F.desc("is_new"), *[F.desc(c) for c in others]], 1)
    return kept.select(*old.columns)


def append_run_log(df: DataFrame, path: str) -> str:
    """Append (run_id, insight_id, ts, status, error) rows."""
    df.write.mode("append").parquet(path)
    return path


def save_model(model: MLWritable, path: str) -> str:
    """Save a fitted pipeline, replacing what is there."""
    model.write().overwrite().save(path)
    return path


def save_factors(model: FactorModel, path: str) -> str:
    """Save user and item factors under the caller's keys, and the model they come from, replacing what is there."""
    model.users.write.mode("overwrite").parquet(f"{path}/users")
    model.items.write.mode("overwrite").parquet(f"{path}/items")
    model.als.write().overwrite().save(f"{path}/als")
    return path


def load_factors(spark: SparkSession, path: str) -> FactorModel:
    """Load saved factors."""
    return FactorModel(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"), ALSModel.load(f"{path}/als"))


def append_score(record: DataFrame, path: str) -> str:
    """Append a (method, auc, ts) row to the history of fitted models."""
    record.write.mode("append").parquet(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)
