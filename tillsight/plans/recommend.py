"""Recommendations: repeat buyers by factors, everybody else by cohort popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import age_bracket, cohort_key, lenient_number
from tillsight.operators.aggregates import popular_items
from tillsight.operators.factors import recommend_unbought
from tillsight.operators.filters import filter_code_length, known_pairs, null_strings, price_band, require, trailing_window
from tillsight.operators.joins import cohort_lists, lines_with_value, restrict_to_segment
from tillsight.operators.matching import many_to_one
from tillsight.operators.ranking import ranked_list, top_n
from tillsight.operators.sets import stack, uncovered
from tillsight.plans.rules import atv_points
from tillsight.session import settle

EXCLUDED = "Carry Bag"


def clean_demographics(members: DataFrame) -> DataFrame:
    """Members with missing-value words as nulls and a numeric age."""
    cleaned = null_strings(members, ["gender"])
    return cleaned.withColumn("age", lenient_number(F.col("age").cast("string")))


def popular_lists(fav: DataFrame, n: int, excluded: str = EXCLUDED, column: str = "item",
                  within: Sequence[str] = ()) -> DataFrame:
    """Top n items as a comma-joined text: of each cohort, of each group of ``within``, and of all.

    Group lists have a null cohort, the list of all has nulls throughout.
    """
    key = ["level", *within, "cohort"]
    sums = popular_items(fav, excluded, column, within, groups=True)
    return ranked_list(top_n(sums, key, "txns", ["item"], n), key, "rank", "item", n).drop("level")


def cohort_recommend(favourites: DataFrame, members: DataFrame, n: int, excluded: str = EXCLUDED,
                     column: str = "item", within: Sequence[str] = (), everyone: bool = False) -> DataFrame:
    """Popular items for the members with favourites, or for ``everyone``: by age and gender, by gender, or overall.

    A member whose only favourite is the excluded item gets the overall list. A cohort without a list
    gets that of its group, or that of all favourites. ``within`` names member columns whose groups are ranked
    apart from each other.
    """
    people = clean_demographics(members).select("mobile", "age", "gender", *within)
    fav = many_to_one(favourites, people, ["mobile"])
    fav = settle(fav.select(*dict.fromkeys(["mobile", "item", column, "txns", "age", "gender", *within])), "favourites")
    own = fav.groupBy("mobile").agg(
        ((F.count("*") == 1) & F.max(F.col(column).contains(excluded))).alias("only_excluded"))
    joined = many_to_one(people, own, ["mobile"], "left" if everyone else "inner")
    cohort = F.when(F.col("only_excluded"), F.lit(",")).otherwise(cohort_key(age_bracket("age"), "gender"))
    keyed = joined.select("mobile", *within, cohort.alias("cohort"))
    return cohort_lists(keyed, popular_lists(fav, n, excluded, column, within), within)


def recommend(purchases: DataFrame, members: DataFrame, favourites: DataFrame, users: DataFrame, items: DataFrame,
              n: int, excluded: str = EXCLUDED, column: str = "item", code_length: tuple[int, int | None] = (1, None),
              digits: int | None = None, window: tuple[str, int] | None = None) -> DataFrame:
    """(mobile, items, tier): factor lists for repeat buyers, cohort lists for the others.

    Tiers: ``repeat`` bought on several days and is known to the model, ``once`` bought on one
    day, ``rest`` are the remaining buyers; every buyer among the members has a row. Everything a member bought is kept out of a factor
    list. ``window``, an as-of date and a number of days, keeps only purchases after that many
    days before the date. One pass over the purchases leaves a row per member and item, from which the tiers
    follow: a member bought on several days when the first and the last day differ.
    """
    if window is not None:
        purchases = trailing_window(purchases, "txn_date", *window)
    favourites = filter_code_length(require(favourites, ["mobile", "item"]), "item", *code_length)
    bought = restrict_to_segment(purchases, members).groupBy("mobile", "item").agg(
        F.min("txn_date").alias("first"), F.max("txn_date").alias("last")
    )
    bought = settle(bought, "bought")
    buyers = settle(bought.groupBy("mobile").agg((F.min("first") < F.max("last")).alias("repeat_buyer")), "buyers")
    repeat = restrict_to_segment(bought, buyers.filter("repeat_buyer"))
    pairs = settle(known_pairs(repeat.select(F.col("mobile").alias("user"), "item"), users, items), "pairs")
    known = pairs.select("user").distinct()
    scored = recommend_unbought(users.join(known, "user", "left_semi"), items, pairs, n, digits)
    by_factor = scored.select(F.col("user").alias("mobile"), "items", F.lit("repeat").alias("tier"))

    tier = F.when(F.col("repeat_buyer"), "rest").otherwise("once")
    others = uncovered(buyers, known.withColumnRenamed("user", "mobile")).select("mobile", tier.alias("tier"))
    people = members.select("mobile", "age", "gender").join(others, "mobile")
    by_cohort = cohort_recommend(favourites, people, n, excluded, column, ["tier"], everyone=True)
    return stack(by_factor, by_cohort.select("mobile", "items", "tier"))


def atv_points_recommend(txn: DataFrame, sku: DataFrame, members: DataFrame, favourites: DataFrame, users: DataFrame,
                         items: DataFrame, rate: float, start: float, end: float, n: int,
                         band: tuple[float, float] = (0.7, 1.3), **options) -> DataFrame:
    """Recommendations from the purchases priced around the member's ticket-plus-points value."""
    value = atv_points(txn, rate, start, end)
    lines = price_band(lines_with_value(sku, value), low=band[0], high=band[1]).drop("value", "net")
    return recommend(lines, members, favourites, users, items, n, **options)
