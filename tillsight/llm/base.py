"""What the operators of this subpackage share: session settings, input tables, size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import new_path, shared_folder, tune

# A side of at most this many rows may be broadcast; anything larger is shuffled.
BROADCAST_ROWS = 2_000_000
ARROW_BATCH = "16m"  # bytes handed to a Python worker at once


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on."""
    tune(spark, small_tasks=False)  # they hold no more than a batch of what a task reads
    shared_folder(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table of the input folder, with the named columns only if there are any."""
    prepare(spark)
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back; ``release`` can delete it later."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.settled_path = path
    return back


def release(*frames: DataFrame) -> None:
    """Delete settled frames that nothing reads any more: all that depends on them has been written itself."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.settled_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a settled frame whose row count is within the limit, else the frame as it is."""
    return F.broadcast(df) if df.count() <= limit else df


def scratch(stem: str) -> str:
    """A column name no caller's column has."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"


__all__ = ["prepare", "table", "sized", "scratch", "settle", "release"]
