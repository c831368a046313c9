"""Joins that stay balanced when one key holds a large part of all rows.

At run time Spark splits a hot partition over several tasks, but only where both join sides come
straight from a shuffle. A side that was just grouped by the join key keeps its partitioning and
has none. Joining on the key together with a hash of it makes Spark shuffle that side for the
join: it is small, one row per key, and the large side can then be split by size as needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT = "split_key"


def many_to_one(rows: DataFrame, lookup: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows with a lookup of one row per key."""
    keyed = rows.withColumn(SPLIT, F.xxhash64(*key))
    return keyed.join(lookup.withColumn(SPLIT, F.xxhash64(*key)), [*key, SPLIT], how).drop(SPLIT)


def matched(rows: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the other frame, however often it does."""
    return many_to_one(rows, other.select(*key).distinct(), key, "left_semi")


def unmatched(rows: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in the other frame."""
    return many_to_one(rows, other.select(*key).distinct(), key, "left_anti")
