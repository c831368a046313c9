"""How well factors rank what users bought later: area under ROC of held-out items, counted in blocks.

A held-out item of a user wins against an unbought one with a lower score, and half against one of
the same score. Nobody needs the scored pairs for that: a task multiplies a block of users with a
block of items and only counts, so per user and item block one row of counts comes out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillsight.functions.scalars import hash_below
from tillsight.operators.factors import BLOCK, CELLS, block_counts, factor_scores
from tillsight.operators.filters import known_pairs
from tillsight.session import settle

USERS, ITEMS, BOUGHT, HELD = range(4)


def _hash_block(column: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(column), blocks).cast("int")


def _wins(own: np.ndarray, all_sorted: np.ndarray, bought: np.ndarray) -> float:
    """Unbought items below each of the own scores, equal ones by half; ``all_sorted`` holds the bought ones too."""
    bought = np.sort(bought)
    below = np.searchsorted(all_sorted, own, "left") - np.searchsorted(bought, own, "left")
    upto = np.searchsorted(all_sorted, own, "right") - np.searchsorted(bought, own, "right")
    return float((below + upto).sum()) / 2


def _count_block(digits: int, schema: pa.Schema):
    """Task code: the wins of one user block's held-out items over one item block, by score and by popularity."""

    def matrix(rows: pa.Table) -> np.ndarray:
        flat = rows["factors"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.astype(np.float64).reshape(rows.num_rows, -1)

    def by_user(rows: pa.Table, users: pa.Array) -> tuple[pa.Table, np.ndarray]:
        """Rows in order of their user's place, and the places."""
        place = pc.index_in(rows["user"].combine_chunks(), users)
        rows, place = rows.filter(place.is_valid()), place.drop_null().to_numpy()
        order = np.argsort(place, kind="stable")
        return rows.take(pa.array(order)), place[order]

    def count(group: pa.Table) -> pa.Table:
        kind = group["kind"].to_numpy()
        held = group.filter(pa.array(kind == HELD))
        users = group.filter(pa.array(kind == USERS))
        users = users.filter(pc.is_in(users["user"], held["user"].combine_chunks())).sort_by("user")
        items = group.filter(pa.array(kind == ITEMS)).sort_by("item")
        if not users.num_rows or not items.num_rows or not held.num_rows:
            return schema.empty_table()
        names = users["user"].combine_chunks()
        held, held_at = by_user(held, names)
        bought, bought_at = by_user(group.filter(pa.array(kind == BOUGHT)), names)
        column = pc.index_in(bought["item"].combine_chunks(), items["item"].combine_chunks())
        known = column.is_valid().to_numpy(zero_copy_only=False)
        column, bought_at = column.drop_null().to_numpy(), bought_at[known]
        score = np.round(held["score"].to_numpy(), digits)
        popular, own_popular = items["popularity"].to_numpy(), held["popularity"].to_numpy()
        popular_sorted = np.sort(popular)
        left, right = matrix(users), matrix(items).T
        step = max(1, CELLS // items.num_rows)
        wins, popular_wins = np.zeros(len(left)), np.zeros(len(left))
        for start in range(0, len(left), step):
            scores = np.round(left[start:start + step] @ right, digits)
            for i in range(start, start + len(scores)):
                mine = slice(*np.searchsorted(held_at, (i, i + 1)))
                own = column[slice(*np.searchsorted(bought_at, (i, i + 1)))]
                line = scores[i - start]
                wins[i] = _wins(score[mine], np.sort(line), line[own])
                popular_wins[i] = _wins(own_popular[mine], popular_sorted, popular[own])
        return pa.table([names, pa.array(wins), pa.array(popular_wins)], schema=schema)

    return count


def held_out_auc(users: DataFrame, items: DataFrame, user_item: DataFrame, share: float = 0.2, digits: int = 9,
                 block: int = BLOCK) -> DataFrame:
    """user, held, auc and popularity_auc of every user with held-out items, among the items the user never bought.

    Pairs are held out as ``holdout`` does it, those of unknown users or items not at all. Popularity
    is the number of users who bought the item. Scores are compared after rounding to ``digits``.
    A user who bought every item has null areas.
    """
    truth = known_pairs(user_item.filter(F.col("qty") != 0), users, items).select("user", "item").distinct()
    truth = settle(truth.withColumn("held", hash_below(share, "user", "item")), "truth")
    popularity = truth.groupBy("item").agg(F.count("*").cast("double").alias("popularity"))
    goods = settle(items.select("item", F.col("factors").cast("array<float>").alias("factors")).join(
        popularity, "item", "left").withColumn("popularity", F.coalesce("popularity", F.lit(0.0))), "goods")
    held = truth.filter("held").select("user", "item")
    scored = factor_scores(held, users, goods.select("item", "factors")).join(goods.select("item", "popularity"), "item")
    user_blocks, item_blocks = block_counts(users, goods, block)
    user_type, item_type = users.schema["user"].dataType, items.schema["item"].dataType

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    def part(kind: int, df: DataFrame, ub: Column, ib: Column) -> DataFrame:
        def column(name, kind):
            return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

        return df.select(ub.alias("ub"), ib.alias("ib"), F.lit(kind).alias("kind"), column("user", user_type),
                         column("item", item_type), column("factors", "array<float>"), column("score", "double"),
                         column("popularity", "double"))

    by_user, by_item = _hash_block("user", user_blocks), _hash_block("item", item_blocks)
    parts = part(USERS, users, by_user, every(item_blocks))
    for df in (part(ITEMS, goods, every(user_blocks), by_item), part(BOUGHT, truth, by_user, by_item),
               part(HELD, scored, by_user, every(item_blocks))):
        parts = parts.unionByName(df)
    out = parts.select("user").withColumns({"wins": F.lit(0.0), "popular_wins": F.lit(0.0)}).schema
    counted = parts.groupBy("ub", "ib").applyInArrow(_count_block(digits, to_arrow_schema(out)), out)
    sizes = truth.groupBy("user").agg(F.count_if("held").alias("held"), F.count("*").alias("bought"))
    total = goods.count()
    pairs = F.col("held") * (F.lit(total) - F.col("bought"))
    wins = counted.groupBy("user").agg(F.sum("wins").alias("wins"), F.sum("popular_wins").alias("popular_wins"))
    return sizes.filter("held > 0").join(wins, "user").select(
        "user", "held", F.try_divide(F.col("wins"), pairs).alias("auc"),
        F.try_divide(F.col("popular_wins"), pairs).alias("popularity_auc"))
