"""Feedback: from raw responses to a reply per negative response."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.text import clean_text, has_letter, text_id
from tillsight.operators.filters import filter_text, negative_only
from tillsight.operators.joins import label_reply
from tillsight.operators.matching import many_to_one
from tillsight.operators.sets import stack
from tillsight.operators.text import FEEDBACK_RULES, Rule, naive_bayes_label, sentiment, with_labels
from tillsight.session import settle


def clean_feedback(feed: DataFrame, min_length: int = 5) -> DataFrame:
    """(mobile, response) with cleaned text; too short and blank responses are dropped."""
    usable = filter_text(feed, "response", min_length).filter(has_letter("response"))
    return usable.select("mobile", clean_text("response").alias("response"))


def feedback_reply(feed: DataFrame, lexicon: DataFrame, replies: DataFrame, rules: Iterable[Rule] = FEEDBACK_RULES,
                   include_rules: bool = False, default: str = "none", stems: DataFrame | None = None,
                   digits: int | None = None) -> DataFrame:
    """(mobile, label, message) for negative responses.

    Rules label some of them and train the model that labels the rest; the replies go to the
    rest, and to the rule-labelled ones too if asked for. A rule depends on the text alone, so
    "no rule met" is a filter and needs no anti join. With a (token, stem) table the model learns stems.
    """
    negative = negative_only(sentiment(clean_feedback(feed), lexicon)).select("mobile", "response")
    keyed = settle(with_labels(negative, rules).withColumn("text_id", text_id("response")), "negative")
    by_rule = keyed.withColumn("label", F.explode("labels")).select("mobile", "text_id", "response", "label")
    rest = keyed.filter(F.size("labels") == 0).select("mobile", "text_id", "response")
    # copies of a text get the same label, so the model sees each text of the rest once
    texts = rest.groupBy("text_id").agg(F.first("response").alias("response"))
    predicted = naive_bayes_label(by_rule.select("text_id", "response", "label"), texts, "text_id", stems, digits)
    labelled = many_to_one(rest.select("mobile", "text_id"), predicted, ["text_id"]).select("mobile", "label")
    if include_rules:
        labelled = stack(labelled, by_rule.select("mobile", "label"))
    return label_reply(labelled, replies, default).select("mobile", "label", "message")
