"""Scalar expressions on dates, numbers and demographics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges (inclusive) and labels of the age brackets, and the NPS cuts.
AGE_FLOOR = 0
AGE_BRACKETS = ((15, "(0-15]"), (25, "(15-25]"), (35, "(25-35]"), (45, "(35-45]"), (100, "(45-100]"))
NPS_TYPES = ((7, "Detractor"), (9, "Passive"))
NPS_TOP = "Promoter"
NULL_WORDS = ("nan", "None", "none")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nps_type(response: Column | str) -> Column:
    """Detractor below 7, Passive below 9, Promoter above; null stays null."""
    response = _column(response)
    chain = F.when(response.isNull(), F.lit(None).cast("string"))
    for upper, label in NPS_TYPES:
        chain = chain.when(response < upper, F.lit(label))
    return chain.otherwise(F.lit(NPS_TOP))


def blend(response: Column | str, value: Column | str, weight: float = 0.5) -> Column:
    """Mix of response and value; the value alone for members who gave no response."""
    response, value = _column(response), _column(value)
    mixed = response * F.lit(weight) + value * F.lit(1.0 - weight)
    return F.when(response.isNull(), value).otherwise(mixed)


def _rate(rate: Column | float) -> Column:
    return rate if isinstance(rate, Column) else F.lit(float(rate))


def ticket_plus_points(atv: Column | str, points: Column | str, rate: Column | float) -> Column:
    """Average ticket plus the money worth of the points balance."""
    return _column(atv) + _column(points) * _rate(rate)


def points_share(atv: Column | str, points: Column | str, rate: Column | float) -> Column:
    """Points worth as a percentage of the average ticket; null on a zero ticket."""
    return F.try_divide(_column(points) * _rate(rate) * F.lit(100.0), _column(atv))


def asof(text: str | date) -> Column:
    """As-of date as a literal."""
    return F.to_date(F.lit(str(text)))


def shift_days(day: Column | str, days: int) -> Column:
    """The day ``days`` before."""
    return F.date_sub(_column(day), int(days))


def recency(last: Column | str, reference: Column | str) -> Column:
    """Days from the last visit to the reference date."""
    return F.datediff(_column(reference), _column(last))


def tenure(first: Column | str, reference: Column | str) -> Column:
    """Days from the first visit to the reference date."""
    return F.datediff(_column(reference), _column(first))


def mean_latency(first: Column | str, last: Column | str, visits: Column | str) -> Column:
    """Mean days between visits; null for a single visit."""
    span = F.datediff(_column(last), _column(first)).cast("double")
    return F.try_divide(span, (_column(visits) - 1).cast("double"))


def lenient_number(c: Column | str) -> Column:
    """Number in the text, null where there is none."""
    return _column(c).try_cast("double")


def null_string(c: Column | str) -> Column:
    """Null for the words that stand for a missing value."""
    c = _column(c)
    return F.when(c.isin(*NULL_WORDS), F.lit(None).cast("string")).otherwise(c)


def age_bracket(age: Column | str) -> Column:
    """Right-closed age bracket; null outside all of them."""
    age = _column(age)
    chain = F.when(age.isNull() | (age <= AGE_FLOOR), F.lit(None).cast("string"))
    for upper, label in AGE_BRACKETS:
        chain = chain.when(age <= upper, F.lit(label))
    return chain


def demographic_condition(bracket: Column | str, gender: Column | str) -> Column:
    """0 nothing known, 1 age only, 2 gender only, 3 both."""
    age_known = _column(bracket).isNotNull().cast("int")
    gender_known = _column(gender).isNotNull().cast("int")
    return age_known + gender_known * 2


def cohort_key(bracket: Column | str, gender: Column | str) -> Column:
    """``bracket,gender``; an age without a gender has no cohort of its own, so ``,``."""
    gender = _column(gender)
    known = F.when(gender.isNotNull(), _column(bracket))
    return F.concat(F.coalesce(known, F.lit("")), F.lit(","), F.coalesce(gender, F.lit("")))


def hash_below(share: float, *key: Column | str) -> Column:
    """True for about ``share`` of the keys: a stable pick that no repartitioning changes."""
    threshold = format(int(share * 2**32), "08x")
    text = F.concat_ws("|", *[_column(c).cast("string") for c in key])
    return F.substring(F.md5(text), 1, 8) < F.lit(threshold)
