"""Session settings, and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on. Hot keys are split by the adaptive skew join;
# forcing it lets Spark add a shuffle when the rows after the join feed an aggregation on
# the same key, where it would otherwise leave the hot partition whole.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# The most that a task of the retail plans reads. Groupings of all lines on the bill remove hardly any row before the
# shuffle, and stages after it chain many joins and groupings: both hold in memory a multiple of what the task reads.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def tune(spark: SparkSession, small_tasks: bool = True) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else built; a smaller task size of its own is kept."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZES.items():
        if not small_tasks and spark.conf.get(key) == value:
            spark.conf.unset(key)
        elif small_tasks and _bytes(spark.conf.get(key)) > _bytes(value):
            spark.conf.set(key, value)
    return spark


def _bytes(size: str) -> int:
    """A size setting as a number of bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)(?:i?b)?", size.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Build a session; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only in local mode, where one machine is all there is.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tillsight-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results several later branches read: they are computed once, and a lost executor costs
    a re-read instead of the whole lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.settled_path = path
    return back


def release(df: DataFrame) -> None:
    """Delete a settled result that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.settled_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession, every: float = 5.0) -> Iterator[None]:
    """Have the driver collect its garbage every so many seconds while the body runs.

    Spark deletes a shuffle's files when the driver's object for it is collected. A driver that has little to do puts that
    off for up to half an hour, in which an iterative job leaves the files of all its iterations on the disks.
    """
    done = threading.Event()

    def run() -> None:
        while not done.wait(every):
            spark.sparkContext._jvm.System.gc()

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
