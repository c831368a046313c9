"""Projections, filters and small column clean-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import asof as asof_date
from tillsight.functions.scalars import null_string, points_share, shift_days


def project_members(members: DataFrame) -> DataFrame:
    """Base member list: the key alone, as text."""
    return members.select(F.col("mobile").cast("string").alias("mobile"))


def filter_value_range(df: DataFrame, column: str, start: float, end: float) -> DataFrame:
    """Rows whose value lies in [start, end]."""
    return df.filter(F.col(column).between(start, end))


def filter_points_ratio(df: DataFrame, rate: float, start: float, end: float) -> DataFrame:
    """Rows whose points are worth between start and end percent of the average ticket."""
    return df.filter(points_share("atv", "available", rate).between(start, end))


def filter_text(df: DataFrame, column: str, min_length: int = 5) -> DataFrame:
    """Rows with a text of at least ``min_length`` characters."""
    return df.filter(F.length(column) >= min_length)


def trailing_window(df: DataFrame, day: str, asof: str, days: int) -> DataFrame:
    """Rows after asof - days."""
    return df.filter(F.col(day) > shift_days(asof_date(asof), days))


def observation_window(df: DataFrame, day: str, asof: str, pw: int, cw: int) -> DataFrame:
    """Rows strictly between asof - (pw + cw) and asof - cw; both edge days are left out."""
    end = asof_date(asof)
    return df.filter((F.col(day) > shift_days(end, pw + cw)) & (F.col(day) < shift_days(end, cw)))


def price_band(lines: DataFrame, value: str = "value", low: float = 0.7, high: float = 1.3) -> DataFrame:
    """Lines whose amount lies within a band around the member's value."""
    net, target = F.col("net").cast("double"), F.col(value).cast("double")
    return lines.filter(net.between(target * F.lit(low), target * F.lit(high)))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without a single value. One aggregate job finds them all."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def stamp_insight(df: DataFrame, insight_id: str, group: str) -> DataFrame:
    """Mark rows with the insight they belong to."""
    return df.withColumns({"insight_id": F.lit(insight_id), "insight_group": F.lit(group)})


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def impute(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a default per column; columns not present are skipped."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()})


def repeat_visitors(df: DataFrame, min_visits: int = 2) -> DataFrame:
    """Members with at least ``min_visits`` visits."""
    return df.filter(F.col("total_visits") >= min_visits)


def exclude_items(df: DataFrame, text: str, column: str = "item") -> DataFrame:
    """Rows whose item does not carry the text."""
    return df.filter(~F.col(column).contains(text))


def filter_code_length(df: DataFrame, column: str, low: int = 1, high: int | None = None) -> DataFrame:
    """Rows whose item code is between ``low`` and ``high`` characters long."""
    size: Column = F.length(F.col(column).cast("string"))
    kept = size >= low if high is None else size.between(low, high)
    return df.filter(kept)


def require(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in the given (or any) columns."""
    return df.na.drop(subset=list(columns) if columns else None)


def known_pairs(purchases: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases whose user and item the factor model knows."""
    known = purchases.join(users.select("user"), "user", "left_semi")
    return known.join(items.select("item"), "item", "left_semi").select(*purchases.columns)


def negative_only(df: DataFrame) -> DataFrame:
    """Responses of negative polarity."""
    return df.filter(F.col("polarity") < 0)


def null_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the words that stand for a missing value into nulls."""
    return df.withColumns({c: null_string(c) for c in columns})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
