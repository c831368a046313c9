"""Connected components of a link table by alternating star contractions.

Each round first points every node's larger neighbours at its smallest one, then its smaller
neighbours. Links never outgrow their first number, a node's links are only ever reduced to a
minimum (partial sums) and joined back, and the number of rounds is logarithmic in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import release, settle
from tillsight.operators.matching import many_to_one

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # u is the larger end
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = many_to_one(both, lowest, ["u"])
    if large:
        out = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = joined.select(F.col("m").alias("a"), F.col("v").alias("b"))
        out = moved.union(lowest.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node ``label`` of every node of the links (a, b); both columns are bigint.

    Self links are ignored, repeated links and either direction count once, nulls are dropped. No
    links give no rows.
    """
    current = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .filter("a < b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        following = settle(_star(_star(current, True), False), "links")
        release(current)
        current = following
    else:
        raise RuntimeError("components did not settle")
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return leaves.union(current.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
