"""Mixing sources to target weights by weighted fair queueing.

A source's documents stand in a shuffled order, a hash of the id, once for every epoch. Each copy
has a virtual finish time: the source's words up to and including it, divided by the source's
target. All copies together are ordered by finish time and cut where their words reach the budget,
so that every source has then been served in proportion to its target.

Running sums are taken without putting a source into one task: the hash is cut into cells, each
cell's sum is added up over the cells before it, and only the rest is summed within a cell. The cut
of the whole order is found in histograms of finish times, narrowed until one cell is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.base import scratch, settle
from tillsight.operators.matching import many_to_one

WEIGHTS = (3, 1, 2)
CELL_ROWS = 2_000  # documents of a source per cell, about
EPOCHS = 2
SALT = "mix-1:"
ROW = "row_hash"  # of all columns


def word_count(text: str):
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = 1.5, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, n_docs and target of every source in ``sizes`` (source, size).

    Sources by code point, null last, weigh 3, 1, 2 in turn. The budget, ``share`` of all words,
    is divided by weight; a target above ``epochs`` times its source's size stops there and the rest
    is divided again by weight until none is above.
    """
    totals = settle(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")),
                    "sources")
    # The place in the order, without one task for all: range partitions count their own.
    ranged = settle(totals.repartitionByRange(F.col("source").asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.col("place"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = settle(ranged.withColumn("own", own).join(starts, "part").select(
        "source", "source_size", "n_docs", (F.col("own") + F.col("start")).alias("place"))
        .withColumn("weight", weights), "weighed")
    budget = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:  # each round caps at least one more source, or ends
        capped = F.lit(level) * F.col("weight") > epochs * F.col("source_size")
        full, open_weight = weighed.agg(
            F.sum(F.when(capped, epochs * F.col("source_size")).otherwise(0)),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0))).first()
        if not open_weight:
            break
        following = (budget - full) / open_weight
        if following == level:
            break
        level = following
    target = F.least(F.lit(float(level)) * F.col("weight"), (epochs * F.col("source_size")).cast("double"))
    return weighed.select("source", "source_size", "n_docs", "place", "weight", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, epochs: int = EPOCHS, id_column: str = "doc_id",
        source_column: str = "source", text_column: str = "text") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every document row.

    ``copies`` is how often the mix holds the document, ``taken`` the words it takes from it. The cut
    never exceeds the budget. The order depends on ids and sources only, so reruns agree. Null
    sources are one source, null ids one place in the order; null and empty texts have size 0 and
    are taken whole as often as they come before the cut. Rows that repeat an id are ordered by size.
    An empty table gives an empty one. Other columns of the input have no influence.
    """
    return _mix(docs, share, epochs, id_column, source_column, text_column).drop(ROW)


def _mix(docs: DataFrame, share: float, epochs: int, id_column: str, source_column: str, text_column: str) -> DataFrame:
    """The rows of ``mix`` with a hash of all columns, which tells rows of one id apart."""
    order = F.conv(F.substring(F.md5(F.concat(F.lit(SALT), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13),
                   16, 10).cast("bigint")
    rows = settle(docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                              word_count(text_column).alias("size"), F.xxhash64(*docs.columns).alias(ROW))
                  .withColumn("spin", order), "sizes")
    targets = settle(source_targets(rows, share, epochs), "targets")
    names = targets.select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("no_source"),
                           "source_size", "target", "place", "n_docs")
    joined = many_to_one(rows.withColumn("s", F.coalesce("source", F.lit(""))).withColumn("no_source", F.col("source").isNull()),
                         names, ["s", "no_source"])
    # 13 hex digits are 52 bits; a source's cells have CELL_ROWS documents on average
    cells = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(CELL_ROWS)))
    placed = joined.withColumn("cell", F.floor(F.col("spin") / F.lit(float(1 << 52)) * cells))
    placed = settle(placed.select("doc_id", ROW, "size", "spin", "source_size", "target", "place", "cell"), "placed")
    sums = placed.groupBy("place", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("place").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sums.select("place", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("offset")),
                     "offsets")
    within = Window.partitionBy("place", "cell").orderBy("spin", "doc_id", "size", ROW).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("within", F.sum("size").over(within)).join(offsets, ["place", "cell"]).select(
        "doc_id", ROW, "size", "spin", "source_size", "target", "place", (F.col("within") + F.col("offset")).alias("upto"))
    copies = summed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn(
        "finish", F.when(F.col("target") > 0, (F.col("upto") + F.col("epoch") * F.col("source_size")) / F.col("target"))
        .otherwise(F.lit(0.0)))
    copies = settle(copies, "copies")
    budget = min(share, epochs) * (targets.agg(F.sum("source_size")).first()[0] or 0)
    last, inside = cut(copies, budget)
    served = F.when(F.col("finish") < F.lit(last), 1).when((F.col("finish") == F.lit(last)) & inside, 1).otherwise(0)
    taken = copies.withColumn("served", served).groupBy("place", "spin", "doc_id", ROW, "size", "upto").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("served").alias("copies"), F.count("*").alias("rows"))
    # rows that are alike in every column were grouped: give each its share back
    repeated = taken.withColumn("again", F.explode(F.sequence(F.lit(1), (F.col("rows") / epochs).cast("int"))))
    each = (F.col("copies") / (F.col("rows") / epochs)).cast("bigint")
    return repeated.select("doc_id", ROW, "size", "source_size", "target", each.alias("copies"),
                           (each * F.col("size")).alias("taken"))


def cut(copies: DataFrame, budget: float, cells: int = 4096):
    """Finish time of the last copy served, and a condition on the copies that finish exactly then.

    Copies are served by (finish, place, upto, doc_id) as long as their words stay within the budget.
    """
    low, high = copies.agg(F.min("finish"), F.max("finish")).first()
    if low is None:
        return 0.0, F.lit(True)
    inside, left = F.lit(True), budget
    while True:
        size, first, final, words = copies.filter(inside).agg(
            F.count("*"), F.min("finish"), F.max("finish"), F.sum("size")).first()
        if words <= left:
            return final, F.lit(True)
        if size <= 20_000 or first == final:
            break
        low, high = first, final
        cell = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit((high - low) / cells)), F.lit(cells - 1))
        counted = copies.filter(inside).groupBy(cell.alias("cell")).agg(
            F.sum("size").alias("size"), F.min("finish").alias("low"), F.max("finish").alias("high")).collect()
        for row in sorted(counted, key=lambda r: r["cell"]):
            if left - row["size"] < 0:
                inside = inside & F.col("finish").between(row["low"], row["high"])
                break
            left -= row["size"]
    # All within the remaining cell: few copies, or copies of one finish time, in range order.
    by = Window.orderBy("finish", "place", "upto", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = copies.filter(inside).withColumn("total", F.sum("size").over(by)).filter(F.col("total") <= F.lit(left))
    edge = kept.orderBy(F.desc("finish"), F.desc("place"), F.desc("upto"), F.desc_nulls_last("doc_id")).first()
    if edge is None:
        first = copies.filter(inside).agg(F.min("finish")).first()[0]
        return first, F.lit(False)
    earlier = (F.col("place") == F.lit(edge["place"])) & (F.col("upto") <= F.lit(edge["upto"]))
    return edge["finish"], (F.col("place") < F.lit(edge["place"])) | earlier


def mixed(docs: DataFrame, share: float = 1.5, epochs: int = EPOCHS, id_column: str = "doc_id",
          source_column: str = "source", text_column: str = "text") -> DataFrame:
    """The documents that the mix holds, with ``copies`` and ``taken``.

    Each row has its own share, also where rows repeat an id; rows alike in all columns get one share each, too.
    """
    shares = _mix(docs, share, epochs, id_column, source_column, text_column)
    key, name = scratch("row"), scratch("id")
    shares = settle(shares.filter("copies > 0").select(F.col(ROW).alias(key), F.col("doc_id").alias(name), "copies", "taken"), "shares")
    kept = docs.withColumn(key, F.xxhash64(*docs.columns)).drop("copies", "taken")
    alike = settle(docs.select(F.xxhash64(*docs.columns).alias(key)).groupBy(key).agg(F.count("*").alias("n"))
                   .filter("n > 1").select(key), "alike")
    # of rows that are alike one meets all their shares; there are few, if any
    several = kept.join(alike, key, "left_semi").dropDuplicates([key, id_column])
    rows = kept.join(alike, key, "left_anti").unionByName(several).withColumn(name, F.col(id_column))
    joined = rows.join(shares, (rows[key] == shares[key]) & rows[name].eqNullSafe(shares[name]))
    return joined.select(*[rows[c] for c in kept.columns if c != key], "copies", "taken")
