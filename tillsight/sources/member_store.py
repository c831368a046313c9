"""A keyed table in buckets: an upsert rewrites the touched buckets and swaps the manifest last.

Rows lie in folders, one per bucket of the key's hash and write. A manifest, a small table of (bucket,
folder), says which folders are the table now. An upsert reads the buckets its new rows fall into, writes
their merged rows to new folders, and then writes the next manifest; until that is complete the old state
stands, whatever has failed. Replaced folders stay until ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.sources.writers import upsert_latest

BUCKET = "store_bucket"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests, ascending."""
    files, place = _files(spark, f"{path}/manifest")
    if not files.exists(place):
        return []
    done = [entry.getPath() for entry in files.listStatus(place)
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))]
    return sorted(int(folder.getName().rpartition("-")[2]) for folder in done)


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, str]:
    rows = spark.read.schema("bucket int, folder string").parquet(f"{path}/manifest/v-{version}").collect()
    return {row["bucket"]: row["folder"] for row in rows}  # at most as many as there are buckets


def _bucket(key: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: Sequence[str], buckets: int) -> dict[int, str]:
    """Write the rows by bucket to folders of their own; which bucket lies where."""
    spark, token = rows.sparkSession, uuid.uuid4().hex
    keyed = rows.withColumn(BUCKET, _bucket(key, buckets))
    keyed.repartition(BUCKET, F.pmod(F.xxhash64(*key, F.lit(1)), F.lit(4))).write.partitionBy(BUCKET).parquet(f"{path}/data/{token}")
    files, place = _files(spark, f"{path}/data/{token}")
    names = [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]
    return {int(name.partition("=")[2]): f"{token}/{name}" for name in names if name.startswith(f"{BUCKET}=")}


def _publish(spark: SparkSession, path: str, version: int, manifest: dict[int, str]) -> int:
    rows = spark.createDataFrame(sorted(manifest.items()), "bucket int, folder string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v-{version}")  # over what a failed write left
    return version


def create_store(df: DataFrame, path: str, key: Sequence[str], buckets: int = 64) -> int:
    """Write a table with one row per key as a new store; returns the version 1."""
    spark = df.sparkSession
    if _versions(spark, path):
        raise AnalysisException(f"there is a store at {path}")
    return _publish(spark, path, 1, _write(df, path, key, buckets))


def read_store(spark: SparkSession, path: str, schema, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The table, or some of its buckets; an older version by its number while its folders are kept."""
    versions = _versions(spark, path)
    manifest = _manifest(spark, path, version or versions[-1])
    folders = [f"{path}/data/{folder}" for bucket, folder in sorted(manifest.items()) if only is None or bucket in set(only)]
    reader = spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_store(new: DataFrame, path: str, key: Sequence[str], order: str, buckets: int = 64) -> tuple[int, list[int]]:
    """Merge rows into the store, the latest per key by ``order``; the new version and the rewritten buckets.

    ``buckets`` is the number the store was made with. Keys may be null: they are a key like any. No new
    rows leave the version as it is.
    """
    spark = new.sparkSession
    version = _versions(spark, path)[-1]
    touched = sorted(row["b"] for row in new.select(_bucket(key, buckets).alias("b")).distinct().collect())
    if not touched:
        return version, []
    old = read_store(spark, path, new.schema, version, touched)
    written = _write(upsert_latest(old, new, key, order), path, key, buckets)
    manifest = {**_manifest(spark, path, version), **written}
    return _publish(spark, path, version + 1, manifest), touched


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the folders that none of the latest ``keep`` versions refers to; how many were deleted."""
    versions = _versions(spark, path)
    kept = {folder for version in versions[-keep:] for folder in _manifest(spark, path, version).values()}
    files, place = _files(spark, f"{path}/data")
    gone = 0
    for token in files.listStatus(place):
        for entry in files.listStatus(token.getPath()):
            if entry.isDirectory() and f"{token.getPath().getName()}/{entry.getPath().getName()}" not in kept:
                gone += bool(files.delete(entry.getPath(), True))
    for version in versions[:-keep]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/v-{version}"), True)
    return gone
