"""Mergeable visit states: a member's profile over any window from monthly states and the edge days.

A state covers one member and month and holds what can be put together again: first and last visit, longest
gap, visits, rows, sums, distinct bills, bill lines and bill departments, and the set of stores. Two neighbouring states
merge by the seam, the days between the last visit of one and the first of the other. A bill that lies in
several months would be counted in each; such bills are kept aside, line by line, and taken off again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MONTH = "month"


def _month(day: str):
    return F.trunc(day, "month")


def visit_states(txn: DataFrame) -> DataFrame:
    """One state of visits per member and month; rows without a member or date are left out."""
    txn = txn.filter("mobile is not null and txn_date is not null").withColumn(MONTH, _month("txn_date"))
    days = txn.groupBy("mobile", MONTH, "txn_date").agg(
        F.sum("amount").alias("amount"), F.sum("lapsed").alias("lapsed"), F.sum("available").alias("available"),
        F.sum("collected").alias("collected"), F.count("*").alias("rows"))
    before = F.lag("txn_date").over(Window.partitionBy("mobile", MONTH).orderBy("txn_date"))
    states = days.withColumn("gap", F.datediff("txn_date", before)).groupBy("mobile", MONTH).agg(
        F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"), F.max("gap").alias("gap"),
        F.count("*").alias("visits"), F.sum("rows").alias("rows"),
        *[F.sum(c).alias(c) for c in ("amount", "lapsed", "available", "collected")])
    spread = txn.groupBy("mobile", MONTH).agg(
        F.countDistinct("bill").alias("bills"), F.collect_set("store").alias("stores"))  # no more than there are stores
    return states.join(spread, ["mobile", MONTH])


def basket_states(sku: DataFrame, item: DataFrame) -> DataFrame:
    """Distinct lines and departments of bills, and quantities, per member and month."""
    sku = sku.filter("mobile is not null and txn_date is not null").withColumn(MONTH, _month("txn_date"))
    lines = sku.groupBy("mobile", MONTH, "bill", "item").agg(F.sum("qty").alias("qty"))
    totals = lines.groupBy("mobile", MONTH).agg(F.count("item").alias("lines"), F.sum("qty").alias("qty"))
    named = lines.join(item.select("item", "department"), "item").select("mobile", MONTH, "bill", "department").distinct()
    return totals.join(named.groupBy("mobile", MONTH).agg(F.count("department").alias("departments")), ["mobile", MONTH], "left")


def _spanning(df: DataFrame, *kept: str) -> DataFrame:
    """Distinct (mobile, bill, month, kept columns) of the bills that lie in several months."""
    rows = df.filter("mobile is not null and bill is not null and txn_date is not null").select(
        "mobile", "bill", _month("txn_date").alias(MONTH), *kept).distinct()
    odd = rows.groupBy("mobile", "bill").agg(F.min(MONTH).alias("low"), F.max(MONTH).alias("high")).filter("low < high")
    return rows.join(odd.select("mobile", "bill"), ["mobile", "bill"])


def write_states(txn: DataFrame, sku: DataFrame, item: DataFrame, path: str) -> None:
    """Write the states of all months below ``path``, by month, and the bills that span months."""
    lines = _spanning(sku, "item").join(item.select("item", "department"), "item", "left")
    for name, df in (("visits", visit_states(txn)), ("baskets", basket_states(sku, item))):
        df.write.partitionBy(MONTH).parquet(f"{path}/{name}")
    _spanning(txn).write.parquet(f"{path}/bills")
    lines.write.parquet(f"{path}/lines")


class Period:
    """The days strictly between two dates, or after one, as whole months and edge days."""

    def __init__(self, after: dt.date, before: dt.date | None = None):
        self.after, self.before = after, before
        first = after + dt.timedelta(days=1)
        self.start = first if first.day == 1 else (first.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        self.end = before.replace(day=1) if before else None  # the first day no whole month holds
        if self.end and self.end < self.start:
            self.end = self.start
        if self.end and before <= self.start:
            self.start = self.end = before  # no whole month: all days are edge days

    def whole(self, df: DataFrame) -> DataFrame:
        """Rows of the states of whole months."""
        kept = df.filter(F.col(MONTH) >= F.lit(self.start))
        return kept if self.end is None else kept.filter(F.col(MONTH) < F.lit(self.end))

    def edges(self, df: DataFrame, day: str = "txn_date") -> DataFrame:
        """Rows of the days outside whole months."""
        low = (F.col(day) > F.lit(self.after)) & (F.col(day) < F.lit(self.start))
        if self.end is None:
            return df.filter(low)
        return df.filter(low | ((F.col(day) >= F.lit(self.end)) & (F.col(day) < F.lit(self.before))
                                & (F.col(day) > F.lit(self.after))))


def merged(states: DataFrame) -> DataFrame:
    """One state of visits per member from those of disjoint spans of time; the sets of stores become their number."""
    seam = F.datediff("first_date", F.lag("last_date").over(Window.partitionBy("mobile").orderBy("first_date")))
    return states.withColumn("seam", seam).groupBy("mobile").agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.max(F.greatest("gap", "seam")).alias("gap"), F.sum("visits").alias("visits"), F.sum("rows").alias("rows"),
        *[F.sum(c).alias(c) for c in ("amount", "lapsed", "available", "collected", "bills")],
        F.size(F.array_distinct(F.flatten(F.collect_list("stores")))).cast("bigint").alias("nstores"))


def _counted_again(spanning: DataFrame, edge: DataFrame, period: Period, key: list[str], column: str) -> DataFrame:
    """How often too much each member's distinct keys are counted over the period's parts."""
    known = [c for c in key if c in spanning.columns]
    parts = period.whole(spanning).select(*known, MONTH)
    edge = period.edges(edge).withColumn(MONTH, _month("txn_date"))
    own = edge.select(*known, MONTH).join(spanning.select("mobile", "bill").distinct(), ["mobile", "bill"], "left_semi")
    times = parts.unionByName(own).distinct().groupBy(*known).agg((F.count("*") - 1).alias("again"))
    return times.filter(F.col(known[-1]).isNotNull()).groupBy("mobile").agg(F.sum("again").alias(column))


def profile(spark: SparkSession, path: str, txn: DataFrame, period: Period) -> DataFrame:
    """What ``member_profile`` gives for the period, from written states; of ``txn`` only edge days are read."""
    edge = visit_states(period.edges(txn))
    states = period.whole(spark.read.schema(edge.schema).parquet(f"{path}/visits")).unionByName(edge)
    twice = _counted_again(spark.read.parquet(f"{path}/bills"), txn, period, ["mobile", "bill"], "again")
    return merged(states).join(twice, "mobile", "left").select(
        "mobile", F.col("amount").cast("double").alias("total_amount"), F.col("visits").alias("total_visits"),
        F.col("lapsed").alias("lapsedpoints"), F.col("available").alias("availablepoints"),
        F.col("collected").alias("pointscollected"), "first_date", "last_date",
        # several rows on a single day are a gap of no days
        F.coalesce("gap", F.when(F.col("rows") > 1, F.lit(0))).alias("max_latency"),
        (F.col("bills") - F.coalesce("again", F.lit(0))).alias("total_txn"), "nstores")


def baskets(spark: SparkSession, path: str, sku: DataFrame, item: DataFrame, period: Period) -> DataFrame:
    """(mobile, uniqueitems, qty, ndept) for the period, from written states and the lines of edge days."""
    edge = basket_states(period.edges(sku), item)
    states = period.whole(spark.read.schema(edge.schema).parquet(f"{path}/baskets")).unionByName(edge)
    totals = states.groupBy("mobile").agg(
        F.sum("lines").alias("uniqueitems"), F.sum("qty").alias("qty"), F.sum("departments").alias("ndept"))
    lines = spark.read.parquet(f"{path}/lines")
    named = sku.join(item.select("item", "department"), "item", "left")
    items = _counted_again(lines.drop("department"), sku, period, ["mobile", "bill", "item"], "items_again")
    departments = _counted_again(lines.drop("item"), named, period, ["mobile", "bill", "department"], "departments_again")
    again = totals.join(items, "mobile", "left").join(departments, "mobile", "left")
    return again.select("mobile", (F.col("uniqueitems") - F.coalesce("items_again", F.lit(0))).alias("uniqueitems"), "qty",
                        (F.col("ndept") - F.coalesce("departments_again", F.lit(0))).alias("ndept"))


def seen(spark: SparkSession, path: str, txn: DataFrame, period: Period) -> DataFrame:
    """Members with a visit in the period."""
    states = spark.read.schema(visit_states(txn).schema).parquet(f"{path}/visits")
    whole = period.whole(states).select("mobile")
    return whole.union(period.edges(txn).filter("mobile is not null").select("mobile")).distinct()
