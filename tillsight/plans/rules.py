"""Rule results: NPS replies, lifetime value, value blended with NPS, ticket plus points."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import blend, nps_type, ticket_plus_points
from tillsight.operators.aggregates import mean_response, ticket_and_points
from tillsight.operators.filters import filter_points_ratio, filter_value_range
from tillsight.operators.joins import add_tags, join_response, reply_matrix

YEAR = 365


def nps_reply(nps: DataFrame, questions: DataFrame, languages: DataFrame) -> DataFrame:
    """Follow-up question for every NPS response, in every language."""
    answered = nps.withColumn("score", F.col("response").try_cast("int")).filter("score is not null")
    typed = answered.select("mobile", nps_type("score").alias("type"))
    return reply_matrix(typed, questions, languages)


def default_value(txn: DataFrame, years: float = 1.0) -> DataFrame:
    """Average ticket times purchases per year times years, for callers without a value table.

    Average ticket times purchases is the amount spent, so one pass suffices; a history shorter
    than a year counts as a year.
    """
    days = F.greatest(F.datediff(F.max("txn_date"), F.min("txn_date")), F.lit(YEAR)).cast("double")
    spent = F.sum("amount").cast("double")
    return txn.groupBy("mobile").agg((spent * F.lit(YEAR * float(years)) / days).alias("value"))


def clv(value: DataFrame, start: float, end: float, tags: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Whole-number lifetime value within [start, end], with tag columns."""
    whole = value.select("mobile", F.col("value").cast("bigint").alias("value"))
    return add_tags(filter_value_range(whole, "value", start, end), tags or {})


def nps_value(nps: DataFrame, value: DataFrame, start: float, end: float,
              tags: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Value blended half and half with the mean NPS response, within [start, end]."""
    joined = join_response(mean_response(nps), value)
    blended = joined.select("mobile", blend("response", "value").alias("value"))
    return add_tags(filter_value_range(blended, "value", start, end), tags or {})


def atv_points(txn: DataFrame, rate: float, start: float, end: float) -> DataFrame:
    """Average ticket plus points worth, for members whose points are worth start to end percent."""
    chosen = filter_points_ratio(ticket_and_points(txn), rate, start, end)
    return chosen.select("mobile", ticket_plus_points("atv", "available", rate).alias("value"))
