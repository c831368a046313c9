"""Aggregations on transactions, baskets, purchases and favourites.

Two-level counts group on the finer key first, so a hot member is spread over that key's
shuffle and reaches the member level pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import age_bracket
from tillsight.operators.filters import exclude_items
from tillsight.operators.ranking import with_gaps


def average_ticket(txn: DataFrame) -> DataFrame:
    """Average ticket per member: amount over distinct bills."""
    spent = F.sum("amount").cast("double")
    return txn.groupBy("mobile").agg(F.try_divide(spent, F.countDistinct("bill")).alias("atv"))


def ticket_and_points(txn: DataFrame) -> DataFrame:
    """Average ticket and latest points balance in one pass; the largest bill breaks ties."""
    spent = F.sum("amount").cast("double")
    latest = F.max_by("available", F.struct("txn_date", "bill"))
    return txn.groupBy("mobile").agg(
        F.try_divide(spent, F.countDistinct("bill")).alias("atv"), latest.alias("available")
    )


def mean_response(nps: DataFrame) -> DataFrame:
    """Mean whole-number response per member; texts that are no number are left out."""
    score = F.col("response").try_cast("int")
    return nps.groupBy("mobile").agg(F.avg(score).alias("response"))


def basket_totals(sku: DataFrame) -> DataFrame:
    """Distinct items per bill and quantities, summed per member."""
    lines = sku.groupBy("mobile", "bill", "item").agg(F.sum("qty").alias("qty"))
    return lines.groupBy("mobile").agg(F.count("item").alias("uniqueitems"), F.sum("qty").alias("qty"))


def department_totals(sku_dept: DataFrame) -> DataFrame:
    """Distinct departments per bill, summed per member."""
    lines = sku_dept.select("mobile", "bill", "department").distinct()
    return lines.groupBy("mobile").agg(F.count("department").alias("ndept"))


def member_profile(txn: DataFrame) -> DataFrame:
    """Totals, visits, points and the longest gap between visits, one row per member.

    Gaps run over a member's distinct dates, which the calendar bounds.
    """
    visits = txn.groupBy("mobile", "txn_date").agg(
        F.sum("amount").alias("amount"),
        F.sum("lapsed").alias("lapsed"),
        F.sum("available").alias("available"),
        F.sum("collected").alias("collected"),
        F.count("txn_date").alias("rows"),
    )
    totals = with_gaps(visits).groupBy("mobile").agg(
        F.sum("amount").cast("double").alias("total_amount"),
        F.count("txn_date").alias("total_visits"),
        F.sum("lapsed").alias("lapsedpoints"),
        F.sum("available").alias("availablepoints"),
        F.sum("collected").alias("pointscollected"),
        F.min("txn_date").alias("first_date"),
        F.max("txn_date").alias("last_date"),
        # several bills on a single day are a gap of no days
        F.coalesce(F.max("gap"), F.when(F.sum("rows") > 1, F.lit(0))).alias("max_latency"),
    )
    spread = txn.groupBy("mobile").agg(
        F.countDistinct("bill").alias("total_txn"), F.countDistinct("store").alias("nstores")
    )
    # the member without a number has a row too
    same = totals["mobile"].eqNullSafe(spread["mobile"])
    return totals.join(spread, same).drop(spread["mobile"])


def member_label(txn: DataFrame) -> DataFrame:
    """Largest label per member."""
    return txn.groupBy("mobile").agg(F.max("labels").alias("labels"))


def purchase_days(purchases: DataFrame) -> DataFrame:
    """Distinct purchase dates per member; more than one makes a repeat buyer."""
    days = purchases.groupBy("mobile").agg(F.countDistinct("txn_date").alias("days"))
    return days.withColumn("repeat_buyer", F.col("days") > 1)


def daily_item_qty(purchases: DataFrame) -> DataFrame:
    """Quantity per member, item and day."""
    return purchases.groupBy("mobile", "item", "txn_date").agg(F.sum("qty").alias("qty"))


def user_item_qty(purchases: DataFrame) -> DataFrame:
    """User-item matrix in long form."""
    pairs = purchases.select(F.col("mobile").alias("user"), "item", "qty")
    return pairs.groupBy("user", "item").agg(F.sum("qty").alias("qty"))


def matrix_sparsity(user_item: DataFrame) -> DataFrame:
    """Percentage of empty cells of the user-item matrix."""
    filled = F.count(F.when(F.col("qty") != 0, F.lit(1)))
    sizes = user_item.agg(
        F.countDistinct("user").alias("users"), F.countDistinct("item").alias("items"), filled.alias("filled")
    )
    cells = F.col("users").cast("double") * F.col("items")
    return sizes.withColumn("sparsity", F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.col("filled").cast("double"), cells)))


def popular_by_age_gender(fav: DataFrame) -> DataFrame:
    """Purchases per age bracket, gender and item."""
    known = fav.withColumn("bracket", age_bracket("age")).filter("bracket is not null and gender is not null")
    return known.groupBy("bracket", "gender", "item").agg(F.sum("txns").alias("txns"))


def popular_by_gender(fav: DataFrame) -> DataFrame:
    """Purchases per gender and item."""
    return fav.filter("gender is not null").groupBy("gender", "item").agg(F.sum("txns").alias("txns"))


def popular_overall(fav: DataFrame) -> DataFrame:
    """Purchases per item among members with neither age nor gender."""
    unknown = fav.withColumn("bracket", age_bracket("age")).filter("bracket is null and gender is null")
    return unknown.groupBy("item").agg(F.sum("txns").alias("txns"))


def cohort_item_pivot(fav: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """Items by cohort. Cohorts make the columns: they are few and fixed, items grow."""
    totals = fav.groupBy("item", "cohort").agg(F.sum("txns").alias("txns"))
    return totals.groupBy("item").pivot("cohort", list(cohorts)).agg(F.sum("txns"))


def only_excluded_item(fav: DataFrame, text: str, column: str = "item") -> DataFrame:
    """Rows per member, and whether the single row is the excluded item."""
    rows = fav.groupBy("mobile").agg(
        F.count("*").alias("rows"), F.max(F.col(column).contains(text)).alias("excluded")
    )
    alone = (F.col("rows") == 1) & F.coalesce(F.col("excluded"), F.lit(False))
    return rows.select("mobile", "rows", alone.alias("only_excluded"))


def favourite_counts(lines: DataFrame) -> DataFrame:
    """Lines per member and item."""
    return lines.groupBy("mobile", "item").agg(F.count("*").alias("txns"))


def distinct_languages(questions: DataFrame) -> DataFrame:
    """Languages that have questions."""
    return questions.select("language").distinct()


def non_null_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column, as (column_name, non_null) rows."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "non_null")


def column_availability(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Which required columns a table has and how many values they hold."""
    have = {c.lower(): c for c in df.columns}
    counts = [
        (F.count(have[c.lower()]) if c.lower() in have else F.sum(F.lit(0)).cast("bigint")).alias(c)
        for c in required
    ]
    rows = df.agg(*counts).unpivot([], list(required), "column_name", "non_null")
    present = F.lower("column_name").isin(*have)
    return rows.select("column_name", present.alias("present"), F.coalesce("non_null", F.lit(0)).alias("non_null"))


def popular_items(fav: DataFrame, text: str, column: str = "item", within: Sequence[str] = (), groups: bool = False) -> DataFrame:
    """Purchases per cohort and item for all three popularity levels at once.

    A row counts for its bracket and gender, for its gender alone, or, when neither is known,
    for everybody; the first sum shrinks the rows before they are repeated per level. With ``groups`` there are also
    the sums of each group of ``within`` and of all, whatever is known; a column ``level`` tells the three apart, and
    what does not apply is null. The first sums are dealt out by item: those of all levels follow in the same task, which
    gets a row per item and demographic group, not per member.
    """
    base = (
        exclude_items(fav, text, column)
        .withColumn("bracket", age_bracket("age"))
        .groupBy(*within, "bracket", "gender", "item")
        .agg(F.sum("txns").alias("txns"))
        .repartition("item")
    )
    both = F.concat_ws(",", "bracket", "gender")
    gender = F.concat(F.lit(","), F.col("gender"))
    feeds = (
        F.when(F.col("bracket").isNotNull() & F.col("gender").isNotNull(), F.array(both, gender))
        .when(F.col("gender").isNotNull(), F.array(gender))
        .when(F.col("bracket").isNull(), F.array(F.lit(",")))
    )

    def level(number: int, known: Sequence[str], cohort: Column) -> Column:
        own = [(F.col(c) if c in known else F.lit(None).cast(fav.schema[c].dataType)).alias(c) for c in within]
        return F.struct(F.lit(number).alias("level"), *own, cohort.cast("string").alias("cohort"))

    levels = F.transform(F.coalesce(feeds, F.array().cast("array<string>")), lambda c: level(0, within, c))
    if groups:
        wider = (list(within), []) if within else ([],)
        levels = F.concat(levels, F.array(*[level(1 + i, known, F.lit(None)) for i, known in enumerate(wider)]))
    sums = base.select("item", "txns", F.inline(levels)).groupBy("level", *within, "cohort", "item").agg(F.sum("txns").alias("txns"))
    return sums if groups else sums.drop("level")
