"""Input views over the test tables, as DataFrames and as SQL text.

Points, gender, age, responses and segments are stand-ins derived from the tables' columns.
Small caller-supplied tables (lexicon, questions, replies, ...) are written once as SQL that
both engines read.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASOF, PW, CW = "2001-08-01", 365, 180
EXCLUDED = "plate"
MONEY, NET = "decimal(18,2)", "decimal(18,4)"

# Caller-supplied tables.
SMALL = {
    "questions": """
        SELECT * FROM (VALUES
            ('en', 'Detractor', 'What went wrong?'), ('en', 'Passive', 'What can we improve?'),
            ('en', 'Promoter', 'What did you like?'), ('fr', 'Detractor', 'Que faire mieux ?'),
            ('fr', 'Promoter', 'Merci, un mot ?'), ('de', 'Passive', 'Was fehlt Ihnen?')
        ) AS t(language, type, question)""",
    "replies": """
        SELECT * FROM (VALUES
            ('about this', 'Sorry about this'), ('about this', 'We hear you'),
            ('delivery', 'We will deliver better'), ('short visit', 'Please stay longer')
        ) AS t(type, message)""",
    "lexicon": """
        SELECT token, CAST(polarity AS DECIMAL(6,3)) AS polarity, CAST(subjectivity AS DECIMAL(6,3)) AS subjectivity
        FROM (VALUES
            ('the', -0.1, 0.3), ('and', 0.2, 0.1), ('that', -0.7, 0.9), ('this', -0.3, 0.6), ('with', 0.4, 0.2),
            ('from', 0.1, 0.4), ('de', -0.05, 0.2), ('la', 0.05, 0.15), ('der', -0.6, 0.7), ('que', 0.3, 0.5)
        ) AS t(token, polarity, subjectivity)""",
    "stems": """
        SELECT * FROM (VALUES ('things', 'thing'), ('tion', 'te'), ('was', 'be'), ('are', 'be'), ('is', 'be'))
        AS t(token, stem)""",
    "nouns": """
        SELECT * FROM (VALUES ('er'), ('st'), ('thon'), ('ther'), ('erin'), ('tion'), ('than'), ('thes'))
        AS t(token)""",
}

VIEWS = {
    **SMALL,
    "languages": "SELECT DISTINCT language FROM questions",
    "txn": """
        SELECT CAST(o_custkey AS VARCHAR) AS mobile, o_orderkey AS bill, CAST(o_orderdate AS DATE) AS txn_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(c_nationkey AS BIGINT) AS store,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS collected,
               CAST(floor(o_totalprice / 50) AS BIGINT) AS available,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 0 END AS BIGINT) AS lapsed
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "sku": """
        SELECT CAST(o_custkey AS VARCHAR) AS mobile, l_orderkey AS bill, l_partkey AS item,
               CAST(l_quantity AS BIGINT) AS qty,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net,
               CAST(o_orderdate AS DATE) AS txn_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "item": "SELECT p_partkey AS item, p_brand AS department, p_name AS name FROM part",
    "member": """
        SELECT CAST(c_custkey AS VARCHAR) AS mobile, c_mktsegment AS tier, CAST(c_nationkey AS BIGINT) AS store,
               CASE WHEN c_custkey % 3 = 1 THEN 'Male' WHEN c_custkey % 3 = 2 THEN 'Female' END AS gender,
               CAST(CASE WHEN c_custkey % 5 <> 0 THEN 1 + c_custkey % 90 END AS BIGINT) AS age
        FROM customer""",
    "store": """
        SELECT CAST(n_nationkey AS BIGINT) AS store, n_name AS city, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "feed": """
        SELECT CAST(user_id AS VARCHAR) AS mobile, event_type AS query_type,
               CAST(floor(value) AS BIGINT) % 11 AS response
        FROM events""",
    "nps": "SELECT mobile, response FROM feed WHERE query_type = 'view'",
    "typed": """
        SELECT mobile, CASE WHEN response < 7 THEN 'Detractor' WHEN response < 9 THEN 'Passive'
                            ELSE 'Promoter' END AS type
        FROM nps""",
    "feedback": "SELECT CAST(doc_id AS VARCHAR) AS mobile, text AS response FROM documents",
    "favourites": """
        SELECT mobile, sku.item, name, count(*) AS txns
        FROM sku JOIN item ON sku.item = item.item GROUP BY mobile, sku.item, name""",
    "purchases": 'SELECT mobile AS "user", item, qty FROM sku',
    "segments": "SELECT c_mktsegment AS run_id, CAST(c_custkey AS VARCHAR) AS mobile FROM customer",
    "member_segments": "SELECT mobile, run_id AS segment FROM segments",
    "users": 'SELECT CAST(vec_id AS VARCHAR) AS "user", embedding AS factors FROM embeddings',
    "items": "SELECT CAST(vec_id AS BIGINT) AS item, embedding AS factors FROM embeddings",
    "fav_member": """
        SELECT favourites.mobile, item, name, txns, CAST(age AS DOUBLE) AS age, gender
        FROM favourites JOIN member ON favourites.mobile = member.mobile""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """SQL text with the views it refers to, directly or through others, as WITH parts."""
    known = {**VIEWS, **(extra or {})}
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                needed.setdefault(name, known[name])

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({text.strip()})" for name, text in needed.items())
    return f"WITH {parts}\n{body.strip()}"


class Views:
    """The same views as DataFrames over one table folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def small(self, name: str) -> DataFrame:
        return self.spark.sql(SMALL[name])

    @cached_property
    def txn(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        joined = self.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            F.col("o_custkey").cast("string").alias("mobile"),
            F.col("o_orderkey").alias("bill"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.col("c_nationkey").cast("bigint").alias("store"),
            F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("collected"),
            F.floor(F.col("o_totalprice") / 50).cast("bigint").alias("available"),
            F.when(F.col("o_orderkey") % 7 == 0, 10).otherwise(0).cast("bigint").alias("lapsed"),
        )

    @cached_property
    def sku(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        joined = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        price = F.col("l_extendedprice").cast(MONEY)
        share = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
        return joined.select(
            F.col("o_custkey").cast("string").alias("mobile"),
            F.col("l_orderkey").alias("bill"),
            F.col("l_partkey").alias("item"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            (price * share).cast(NET).alias("net"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
        )

    @cached_property
    def item(self) -> DataFrame:
        part = self.table("part")
        return part.select(
            F.col("p_partkey").alias("item"), F.col("p_brand").alias("department"), F.col("p_name").alias("name")
        )

    @cached_property
    def member(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.cast("string").alias("mobile"),
            F.col("c_mktsegment").alias("tier"),
            F.col("c_nationkey").cast("bigint").alias("store"),
            F.when(key % 3 == 1, "Male").when(key % 3 == 2, "Female").alias("gender"),
            F.when(key % 5 != 0, 1 + key % 90).cast("bigint").alias("age"),
        )

    @cached_property
    def store(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").cast("bigint").alias("store"), F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )

    @cached_property
    def feed(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").cast("string").alias("mobile"), F.col("event_type").alias("query_type"),
            (F.floor("value").cast("bigint") % 11).alias("response"),
        )

    @cached_property
    def nps(self) -> DataFrame:
        return self.feed.filter("query_type = 'view'").select("mobile", "response")

    @cached_property
    def feedback(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("mobile"), F.col("text").alias("response")
        )

    @cached_property
    def favourites(self) -> DataFrame:
        named = self.sku.join(self.item.select("item", "name"), "item")
        return named.groupBy("mobile", "item", "name").agg(F.count("*").alias("txns"))

    @cached_property
    def fav_member(self) -> DataFrame:
        people = self.member.select("mobile", F.col("age").cast("double").alias("age"), "gender")
        return self.favourites.join(people, "mobile")

    @cached_property
    def purchases(self) -> DataFrame:
        return self.sku.select(F.col("mobile").alias("user"), "item", "qty")

    @cached_property
    def segments(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_mktsegment").alias("run_id"), F.col("c_custkey").cast("string").alias("mobile")
        )

    @cached_property
    def users(self) -> DataFrame:
        vectors = self.table("embeddings")
        return vectors.select(F.col("vec_id").cast("string").alias("user"), F.col("embedding").alias("factors"))

    @cached_property
    def items(self) -> DataFrame:
        vectors = self.table("embeddings")
        return vectors.select(F.col("vec_id").cast("bigint").alias("item"), F.col("embedding").alias("factors"))
