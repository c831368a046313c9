"""Per-key ranking, visit gaps and ordering.

No window here takes a key's raw rows whole into one task: rankings are cut to n rows in
the map stage, and gaps run over a member's distinct dates, which the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.matching import many_to_one

# Up to this n the rows Spark leaves per key and map task are few enough for one reduce task.
MAP_SIDE_LIMIT = 100
SALTS = 64


def top_n(df: DataFrame, partition: Sequence[str], score: str | Column, tie: Sequence[str | Column],
          n: int, rank: str = "rank") -> DataFrame:
    """Best n rows per key: highest score first, then the tie columns.

    Spark's group limit prunes each key to n rows in every map task. For a larger n a salted
    first pass ranks parts of a key, which keeps every row that can reach the result.
    """
    best = F.desc(score) if isinstance(score, str) else score
    order = [best, *tie]
    if n > MAP_SIDE_LIMIT:
        salted = df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        within = Window.partitionBy(*partition, "salt").orderBy(*order)
        df = salted.withColumn("pass", F.row_number().over(within)).filter(F.col("pass") <= n)
        df = df.drop("salt", "pass")
    whole = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


def first_match(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in a stated order."""
    first, *rest = order
    ascending = F.asc(first) if isinstance(first, str) else first
    return top_n(df, key, ascending, rest, 1).drop("rank")


def one_per_member(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """One row per member in a stated order."""
    return first_match(df, ["mobile"], order)


def by_date(df: DataFrame, day: str = "txn_date", tie: Sequence[str] = ("mobile", "bill", "item")) -> DataFrame:
    """Sort by date. The tie columns also let the range shuffle split a crowded day."""
    return df.orderBy(day, *[c for c in tie if c in df.columns])


def latest_points(txn: DataFrame) -> DataFrame:
    """Points balance on the last date of each member; several rows on that date are kept."""
    last = txn.groupBy("mobile").agg(F.max("txn_date").alias("txn_date"))
    return many_to_one(txn, last, ["mobile", "txn_date"]).select("mobile", "txn_date", "bill", "available")


def visit_gaps(txn: DataFrame) -> DataFrame:
    """Each visit date of a member and the days since the one before."""
    visits = txn.groupBy("mobile", "txn_date").agg(F.count("*").alias("bills"))
    return with_gaps(visits)


def with_gaps(visits: DataFrame) -> DataFrame:
    """Add the days since the previous visit to one row per member and date."""
    before = F.lag("txn_date").over(Window.partitionBy("mobile").orderBy("txn_date"))
    return visits.withColumn("gap", F.datediff("txn_date", before))


def max_line_amount(sku: DataFrame) -> DataFrame:
    """Each line with the largest line amount of its member."""
    peak = sku.groupBy("mobile").agg(F.max("net").alias("max_net"))
    return many_to_one(sku, peak, ["mobile"])


def ranked_list(df: DataFrame, key: str | Sequence[str], rank: str, item: str, n: int, name: str = "items") -> DataFrame:
    """Items ranked 1 to n per key as one comma-joined text, in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct(rank, F.col(item).cast("string").alias("code"))))
    joined = F.array_join(F.transform(pairs, lambda p: p["code"]), ",")
    keys = [key] if isinstance(key, str) else list(key)
    return df.filter(F.col(rank) <= n).groupBy(*keys).agg(joined.alias(name))


def scale_scores(df: DataFrame, user: str = "user", score: str = "score") -> DataFrame:
    """Min-max scaled score per user; 0 where a user's scores are all equal."""
    edges = df.groupBy(user).agg(F.min(score).alias("low"), F.max(score).alias("high"))
    spread = F.try_divide((F.col(score) - F.col("low")).cast("double"), (F.col("high") - F.col("low")).cast("double"))
    scaled = many_to_one(df, edges, [user]).withColumn("scaled", F.coalesce(spread, F.lit(0.0)))
    return scaled.drop("low", "high")
