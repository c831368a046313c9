"""Unions and differences of member sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.joins import reply_matrix
from tillsight.operators.matching import unmatched


def stack(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def stack_types(typed: DataFrame, questions: DataFrame, languages: DataFrame) -> DataFrame:
    """Replies of all types in all languages, without a loop over either."""
    return reply_matrix(typed, questions, languages).select("mobile", "language", "question")


def segment_members(segments: DataFrame, run_id: str) -> DataFrame:
    """Distinct members of a run's segments."""
    return segments.filter(F.col("run_id") == run_id).select("mobile").distinct()


def uncovered(df: DataFrame, *covered: DataFrame) -> DataFrame:
    """Rows of members none of the covered frames holds."""
    for part in covered:
        df = unmatched(df, part, ["mobile"])
    return df


def unbought(scores: DataFrame, purchases: DataFrame) -> DataFrame:
    """Scored pairs the user has not bought."""
    return unmatched(scores, purchases, ["user", "item"])
