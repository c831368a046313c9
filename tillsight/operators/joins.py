"""Joins on members, items and labels.

No side carries a broadcast hint: Spark broadcasts a side whose measured size is below its
threshold and shuffles otherwise, and its adaptive skew join splits hot keys (see matching).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.matching import many_to_one, matched
from tillsight.operators.ranking import first_match
from tillsight.session import settle


def restrict_to_segment(df: DataFrame, segment: DataFrame) -> DataFrame:
    """Rows of members in the segment."""
    return matched(df, segment, ["mobile"])


only_members = restrict_to_segment


def add_segment_columns(df: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows of members in the segment table, with its columns."""
    return df.join(segments, "mobile")


def join_points(atv: DataFrame, points: DataFrame) -> DataFrame:
    """Average ticket with the points balance; a member may have several rows of points."""
    return many_to_one(points, atv, ["mobile"])


def join_response(nps_avg: DataFrame, value: DataFrame) -> DataFrame:
    """Every member value, with the mean response where there is one."""
    return nps_avg.join(value, "mobile", "right")


def member_store(member: DataFrame, store: DataFrame) -> DataFrame:
    """Members with state and city of the store they enrolled at."""
    places = store.select(F.col("store").alias("store_code"), "state", "city")
    joined = member.join(places, member["store"] == places["store_code"], "left")
    return joined.drop("store_code")


def sku_department(item: DataFrame, sku: DataFrame) -> DataFrame:
    """Basket lines with the department of the item."""
    return sku.join(item.select("item", "department"), "item")


def assemble_features(txn: DataFrame, sku: DataFrame, dept: DataFrame, member: DataFrame) -> DataFrame:
    """Member rows of the transaction profile with basket, department and member columns."""
    return txn.join(sku, "mobile", "left").join(dept, "mobile", "left").join(member, "mobile", "left")


def unlabelled(negative: DataFrame, labelled: DataFrame) -> DataFrame:
    """Responses no rule has labelled; nulls compare equal."""
    seen = labelled.select(F.col("mobile").alias("seen_mobile"), F.col("response").alias("seen_response")).distinct()
    same = negative["mobile"].eqNullSafe(seen["seen_mobile"]) & negative["response"].eqNullSafe(seen["seen_response"])
    return negative.join(seen, same, "left_anti")


def label_reply(df: DataFrame, replies: DataFrame, default: str = "none") -> DataFrame:
    """Reply message of each label, or the default; the first message by text if several."""
    lookup = first_match(replies.select(F.col("type").alias("label"), "message"), ["label"], ["message"])
    return many_to_one(df, lookup, ["label"], "left").withColumn("message", F.coalesce("message", F.lit(default)))


def reply_matrix(typed: DataFrame, questions: DataFrame, languages: DataFrame) -> DataFrame:
    """Each member with the question of their type in every language.

    A type without a question in some language falls back to its first question. The languages
    enter as one array, so types and members meet them by explode and not by a cross join. A member
    whose type has no question at all keeps one row with a null language and question.
    """
    all_languages = languages.agg(F.sort_array(F.collect_set("language"))).scalar()
    own = questions.groupBy("type", "language").agg(F.min("question").alias("own"))
    general = first_match(questions, ["type"], ["language", "question"]).select(
        "type", F.col("question").alias("general"), F.explode(all_languages).alias("language")
    )
    lookup = general.join(own, ["type", "language"], "left")
    texts = F.collect_list(F.struct("language", F.coalesce("own", "general").alias("question")))
    by_type = lookup.groupBy("type").agg(texts.alias("texts"))  # as many as there are languages
    matrix = many_to_one(typed.select("mobile", "type"), by_type, ["type"], "left")
    return matrix.select("mobile", "type", F.inline_outer("texts"))


def seen_flag(df: DataFrame, seen: DataFrame, name: str = "seen") -> DataFrame:
    """Flag rows whose member occurs in ``seen``."""
    keys = seen.select("mobile").distinct().withColumn(name, F.lit(True))
    return many_to_one(df, keys, ["mobile"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def lines_with_value(sku: DataFrame, value: DataFrame) -> DataFrame:
    """Basket lines of the valued members, with the value."""
    return many_to_one(sku, value.select("mobile", "value"), ["mobile"])


def member_demographics(favourites: DataFrame, members: DataFrame, cohort: DataFrame) -> DataFrame:
    """Favourites of the cohort's members with their age and gender."""
    chosen = matched(favourites, cohort, ["mobile"])
    return chosen.join(members.select("mobile", "age", "gender"), "mobile")


MAX_LISTS = 10_000  # lists looked up in one value; more are joined


def cohort_lists(members: DataFrame, lists: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Every member with the item list of their cohort, or of the nearest group that has one.

    ``lists`` has the ``within`` columns, cohort and items. A list with a null cohort is for the whole group
    of ``within``, one with nulls throughout for everybody; a member gets null items only without any.
    Cohorts are few, so their lists travel as one value and no member is shuffled to find one.
    """
    def key(columns: Sequence[str], known: int):
        return F.to_json(F.struct(*[F.col(c) if i < known else F.lit(None).alias(c) for i, c in enumerate(columns)]))

    keys = [*within, "cohort"]
    lists = lists.select(key(keys, len(keys)).alias("list_key"), "items").groupBy("list_key").agg(F.max("items").alias("items"))
    lists = settle(lists, "lists")
    levels = [key(keys, len(keys)), key(keys, len(within)), key(keys, 0)]
    if lists.count() <= MAX_LISTS:
        entries = lists.agg(F.map_from_entries(F.collect_list(F.struct("list_key", "items")))).scalar()
        items = F.coalesce(*[F.try_element_at(entries, level) for level in levels])
        return members.select("mobile", *within, "cohort", items.alias("items"))
    for i, level in enumerate(levels):
        own = lists.select(F.col("list_key").alias(f"key_{i}"), F.col("items").alias(f"items_{i}"))
        members = many_to_one(members.withColumn(f"key_{i}", level), own, [f"key_{i}"], "left")
    items = F.coalesce(*[f"items_{i}" for i in range(len(levels))])
    return members.select("mobile", *within, "cohort", items.alias("items"))


def add_tags(df: DataFrame, tags: Mapping[str, DataFrame]) -> DataFrame:
    """One column per tag table (mobile, value); each keeps a single value per member."""
    for name, tag in tags.items():
        single = tag.groupBy("mobile").agg(F.max("value").alias(name))
        df = df.join(single, "mobile", "left")
    return df
