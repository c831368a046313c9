"""Feedback text: tokens, sentiment, keyword rules, Naive Bayes.

Tokens travel with a narrow key and never with the text they come from, and partial
aggregation folds a text's tokens back into one row in the map stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.text import MIN_TOKEN, contains_all, contains_none, text_id, token_array, words
from tillsight.operators.matching import many_to_one, matched
from tillsight.operators.ranking import first_match
from tillsight.session import settle

TERM_BUCKETS = 1 << 20  # of tokens by hash, each with one count
COMMON_TERMS = 1 << 18  # tokens that are sent to all texts, at most: each is this share of all tokens or more


@dataclass(frozen=True)
class Rule:
    """A label and its alternatives; each is (all of these words, none of those words)."""

    label: str
    alternatives: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...]

    def matches(self, text: Column) -> Column:
        hit = F.lit(False)
        for required, forbidden in self.alternatives:
            hit = hit | (contains_all(text, required) & contains_none(text, forbidden))
        return hit


def rule(label: str, required: str, forbidden: str = "") -> Rule:
    """Rule with one alternative, words separated by blanks."""
    return Rule(label, ((tuple(required.split()), tuple(forbidden.split())),))


# The feedback rules, in order. A response gets every label it meets.
FEEDBACK_RULES = (
    Rule("improve staff friendliness", ((("staff",), ()), (("Staff",), ()))),
    rule("more variety", "variety", "staff"),
    rule("size not available", "size", "staff variety"),
    rule("improve experience", "experience", "staff variety size"),
    rule("improve range of products", "range products", "staff variety size experience"),
    rule("range is high", "range price", "staff variety size experience"),
    rule("issue with sales person", "sale person", "variety size experience"),
    rule("issue at the billing counter", "billing counter", "variety size experience"),
    rule("discount related", "discount", "counter variety size experience billing"),
    Rule("points related", ((("points",), ("variety",)), (("issued",), ()))),
    rule("product related issues", "product products", "billing counter discount salesman range staff"),
)


def tokens(df: DataFrame, text: str = "response", keep: Sequence[str] = ("mobile",)) -> DataFrame:
    """One row per token, with the kept key columns.

    Keys are columns, not expressions: an expression would be computed again for every token.

    The outer form of explode spares a second split: for the inner one Spark adds a filter on
    the array's size, which computes the array again.
    """
    return df.select(*keep, F.explode_outer(words(text)).alias("token")).filter(F.length("token") >= MIN_TOKEN)


def stem_tokens(token_rows: DataFrame, stems: DataFrame) -> DataFrame:
    """Replace tokens by their stem where the (token, stem) table has one."""
    lookup = first_match(stems, ["token"], ["stem"])
    stemmed = many_to_one(token_rows, lookup, ["token"], "left")
    others = [c for c in token_rows.columns if c != "token"]
    return stemmed.select(*others, F.coalesce("stem", "token").alias("token"))


def frequent_buckets(token_rows: DataFrame, min_count: int) -> DataFrame:
    """The hash buckets that hold at least ``min_count`` token rows: at most ``TERM_BUCKETS`` numbers.

    A bucket counts all of its tokens, so it holds no fewer rows than any one of them.
    """
    counts = token_rows.groupBy(_term_bucket().alias("bucket")).agg(F.count("*").alias("rows"))
    return counts.filter(F.col("rows") >= min_count).select("bucket")


def maybe_frequent(token_rows: DataFrame, min_count: int) -> DataFrame:
    """The token rows less those of buckets too small for any token to be seen ``min_count`` times.

    The buckets' number is bounded whatever the input, so they go to every task and the rows that
    they leave out are not shuffled. The tokens are read twice.
    """
    bucket, columns = "term_bucket", token_rows.columns
    wanted = F.broadcast(frequent_buckets(token_rows, min_count).withColumnRenamed("bucket", bucket))
    return token_rows.withColumn(bucket, _term_bucket()).join(wanted, bucket, "left_semi").select(*columns)


def _term_bucket() -> Column:
    return F.pmod(F.xxhash64("token"), F.lit(TERM_BUCKETS)).cast("int")


def frequent_terms(token_rows: DataFrame, min_count: int = 15, n: int = 50) -> DataFrame:
    """The n most frequent tokens among those seen at least ``min_count`` times; null counts as one.

    Tokens that are surely rarer are left out before any token is shuffled.
    """
    if min_count > 1:
        token_rows = maybe_frequent(token_rows, min_count)
    counts = token_rows.groupBy("token").agg(F.count("*").alias("count"))
    return counts.filter(F.col("count") >= min_count).orderBy(F.desc("count"), "token").limit(n)


def frequent_nouns(token_rows: DataFrame, nouns: DataFrame, n: int = 50, min_count: int = 15) -> DataFrame:
    """Frequent terms among the listed nouns."""
    return frequent_terms(matched(token_rows, nouns, ["token"]), min_count, n)


def sentiment(df: DataFrame, lexicon: DataFrame, text: str = "response") -> DataFrame:
    """Mean polarity and subjectivity of a response's lexicon words; 0 when it has none.

    The lexicon is a (token, polarity, subjectivity) table of decimals.
    """
    texts = df.select(text_id(text).alias("text_id"), text)
    lookup = first_match(lexicon, ["token"], ["polarity", "subjectivity"])
    hits = many_to_one(tokens(texts, text, ["text_id"]), lookup, ["token"])
    # copies of a text share its id; they add to sum and count alike, so the means stay
    means = hits.groupBy("text_id").agg(
        *[F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(c) for c in ("polarity", "subjectivity")]
    )
    scored = many_to_one(df.withColumn("text_id", text_id(text)), means, ["text_id"], "left").drop("text_id")
    return scored.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("polarity", "subjectivity")})


def label_slots(rules: Iterable[Rule], text: str = "response") -> Column:
    """Array with a rule's label where the response meets the rule and null elsewhere."""
    return F.array(*[F.when(r.matches(F.col(text)), F.lit(r.label)) for r in rules])


def with_labels(df: DataFrame, rules: Iterable[Rule], text: str = "response") -> DataFrame:
    """Add the array of labels whose rule a response meets."""
    return df.withColumn("labels", F.filter(label_slots(rules, text), lambda label: label.isNotNull()))


def rule_labels(df: DataFrame, rules: Iterable[Rule] = FEEDBACK_RULES, text: str = "response") -> DataFrame:
    """One row per response and label met."""
    return df.withColumn("label", F.explode_outer(label_slots(rules, text))).filter("label is not null")


def bag_of_words(train: DataFrame, rest: DataFrame, key: str = "text_id") -> DataFrame:
    """Token counts of both sets in long form; a null label marks the rest.

    This is the sparse matrix itself: the vocabulary is its distinct tokens and stays on the
    executors, whatever its size.
    """
    parts = train.select(key, "label", "response").unionByName(
        rest.select(key, F.lit(None).cast("string").alias("label"), "response")
    )
    return tokens(parts, keep=(key, "label")).groupBy(key, "label", "token").agg(F.count("*").alias("n"))


def _stemmed(token_rows: DataFrame, stems: DataFrame | None) -> DataFrame:
    return token_rows if stems is None else stem_tokens(token_rows, stems)


def token_counts(train: DataFrame, rest: DataFrame) -> DataFrame:
    """Written (label, token, n) of both sets, as the tokens stand; a null label marks the rest."""
    everything = train.select("label", "response").unionByName(
        rest.select(F.lit(None).cast("string").alias("label"), "response")
    )
    counts = tokens(everything, keep=("label",)).groupBy("label", "token").agg(F.count("*").alias("n"))
    return settle(counts, "token-counts")  # far smaller than the texts, and read several times


def class_statistics(train: DataFrame, counts: DataFrame, stems: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per class: log prior and log denominator; per class and token: log count weight.

    Multinomial model with add-one smoothing over the joint vocabulary of ``counts``, of stems if a (token, stem) table is
    given. The prior is the plain share of a class.
    """
    if stems is not None:
        counts = settle(_stemmed(counts, stems).groupBy("label", "token").agg(F.sum("n").alias("n")), "stem-counts")
    vocabulary = counts.agg(F.countDistinct("token")).scalar()
    learned = counts.filter("label is not null")
    totals = learned.groupBy("label").agg(F.sum("n").alias("total"))
    sizes = train.groupBy("label").agg(F.count("*").alias("docs"))
    all_docs = sizes.agg(F.sum("docs")).scalar()
    classes = sizes.join(totals, "label", "left").select(
        "label",
        F.log(F.col("docs") / all_docs).alias("log_prior"),
        F.log((F.coalesce("total", F.lit(0)) + vocabulary).cast("double")).alias("log_size"),
    )
    weights = learned.select("label", "token", F.log((F.col("n") + 1).cast("double")).alias("weight"))
    return classes, weights


def weighed_tokens(rest: DataFrame, key: str, counts: DataFrame, weights: DataFrame, stems: DataFrame | None = None) -> DataFrame:
    """(key, label, hit): a row per class for each token of the rest that has weights, copies included.

    A token's weights are those of its stem. Frequent tokens, no more than ``COMMON_TERMS`` by their share of all, get
    their weights where the texts lie; only rows of rarer tokens that may have weights are shuffled.
    """
    spoken = counts.filter("label is null").select("token", "n")
    stemmed = _stemmed(spoken.withColumn("spoken", F.col("token")), stems)
    merits = F.collect_list(F.struct("label", "weight")).alias("merits")  # as many as there are classes
    lookup = stemmed.join(weights, "token").groupBy(F.col("spoken").alias("token"), "n").agg(merits)
    lookup = settle(lookup, "token-weights")
    least = spoken.agg((F.sum("n") / COMMON_TERMS).alias("least")).scalar()
    common = F.broadcast(lookup.filter(F.col("n") >= least).select("token", "merits"))
    scarce = lookup.filter(F.col("n") < least).select("token", "merits")
    bucket, rows = "term_bucket", tokens(rest, keep=(key,))
    buckets = F.broadcast(scarce.select(_term_bucket().alias(bucket)).distinct())
    # frequent tokens may fall in a bucket too: they find nothing among the rare ones, but would be shuffled for it
    candidates = rows.withColumn(bucket, _term_bucket()).join(buckets, bucket, "left_semi").join(
        common.select("token"), "token", "left_anti")
    found = rows.join(common, "token").select(key, "merits").unionByName(
        many_to_one(candidates, scarce, ["token"]).select(key, "merits"))
    return found.select(key, F.inline("merits").alias("label", "hit"))


def naive_bayes_scores(train: DataFrame, rest: DataFrame, key: str = "text_id", stems: DataFrame | None = None) -> DataFrame:
    """Log score of every class for each response of the rest."""
    counts = token_counts(train, rest)
    classes, weights = class_statistics(train, counts, stems)
    hits = weighed_tokens(rest, key, counts, weights, stems).groupBy(key, "label").agg(F.sum("hit").alias("hit"))
    # the classes are as few as the labels, so they come in as one array per response
    table = classes.agg(F.collect_list(F.struct("label", "log_prior", "log_size"))).scalar()
    docs = rest.select(key, F.size(token_array("response")).alias("words"))
    docs = docs.withColumn("class", F.explode(table)).select(key, "words", "class.*")
    score = F.col("log_prior") + F.coalesce("hit", F.lit(0.0)) - F.col("words") * F.col("log_size")
    return docs.join(hits, [key, "label"], "left").select(key, "label", score.alias("score"))


def naive_bayes_label(train: DataFrame, rest: DataFrame, key: str = "text_id", stems: DataFrame | None = None,
                      digits: int | None = None) -> DataFrame:
    """Most likely label of each response; the first label in order on equal scores.

    ``train`` holds (key, response, label), ``rest`` (key, response) with one row per key. With
    ``digits`` scores are compared after rounding, so that the order of summation cannot decide.
    """
    scores = naive_bayes_scores(train, rest, key, stems)
    if digits is not None:
        scores = scores.withColumn("score", F.round("score", digits))
    return first_match(scores, [key], [F.desc("score"), "label"]).select(key, "label")
