"""Queries for composite results, sources, sinks and the batch run."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tillsight.operators import aggregates as A
from tillsight.operators.filters import observation_window, project_members, trailing_window
from tillsight.plans import batch as B
from tillsight.plans import rules as I
from tillsight.plans.churn import churn_features, fit_churn
from tillsight.session import new_path
from tillsight.sources import readers as SR
from tillsight.sources import writers as SW
from tillsight.sources.member_store import create_store, read_store, upsert_store
from tillsight.sources.writers import load_model, save_model
from tillsight.workload.registry import query
from tillsight.workload.relational import COMMON
from tillsight.workload.texts import RULES
from tillsight.workload.views import ASOF, CW, PW, Views


def sql_query(name, sql=None):
    return query(name, sql, COMMON)


@sql_query("c1_nps_reply", """
    SELECT mobile, typed.type, l.language, coalesce(
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language = l.language),
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language =
            (SELECT min(f.language) FROM questions AS f WHERE f.type = typed.type))) AS question
    FROM typed, (SELECT DISTINCT language FROM questions) AS l""")
def _(v):
    questions = v.small("questions")
    return I.nps_reply(v.nps, questions, questions.select("language"))


@sql_query("c2_clv", """
    SELECT value.mobile, CAST(trunc(value) AS BIGINT) AS value, t.segment
    FROM value LEFT JOIN (SELECT mobile, max(segment) AS segment FROM member_segments GROUP BY mobile) AS t
      ON value.mobile = t.mobile
    WHERE trunc(value) BETWEEN 300000 AND 600000""")
def _(v):
    tags = {"segment": v.segments.select("mobile", F.col("run_id").alias("value"))}
    return I.clv(I.default_value(v.txn), 300000, 600000, tags)


NPV = """SELECT value.mobile, CASE WHEN response IS NULL THEN value
                ELSE response * 0.5e0 + value * 0.5e0 END AS value
         FROM value LEFT JOIN mean_nps ON mean_nps.mobile = value.mobile"""


@sql_query("c3_nps_value", f"SELECT * FROM ({NPV}) WHERE value BETWEEN 300000 AND 600000")
def _(v):
    return I.nps_value(v.nps, I.default_value(v.txn), 300000, 600000)


@sql_query("c4_atv_points", "SELECT mobile, value FROM atv_value")
def _(v):
    return I.atv_points(v.txn, 0.5, 0.5, 2)


# ---- sources and sinks


@sql_query("s1_read_table", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
           AS o_orderdate, o_orderpriority FROM orders""")
def _(v):
    orders = SR.read_table(v.spark, SR.Source(base=v.folder), "orders.parquet")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@sql_query("s2_read_keyed_table", "SELECT * FROM part")
def _(v):
    base, keyspace = os.path.split(v.folder)
    return SR.read_keyed_table(v.spark, SR.Source(base=base), keyspace, "part.parquet")


@sql_query("s3_read_features", "SELECT * FROM member")
def _(v):
    path = SW.write_features(v.member, new_path(v.spark, "features"), "csv")
    return SR.read_features(v.spark, path, v.member.schema)


@sql_query("s4_write_features", "SELECT mobile, item, name, txns FROM favourites")
def _(v):
    return SR.read_features(v.spark, SW.write_features(v.favourites, new_path(v.spark, "features")))


@sql_query("s5_read_or_empty", "SELECT * FROM customer")
def _(v):
    source = SR.Source(base=v.folder)
    customer = SR.read_or_empty(v.spark, source, "customer.parquet", v.table("customer").schema)
    return customer.unionByName(SR.read_or_empty(v.spark, source, "feed_master.parquet", customer.schema))


@sql_query("s6_append_insight", """
    SELECT mobile, value, '14' AS insight_id FROM value
    UNION ALL SELECT mobile, value, '16' FROM atv_value""")
def _(v):
    path = new_path(v.spark, "results")
    for insight_id, df in (("14", I.default_value(v.txn)), ("16", I.atv_points(v.txn, 0.5, 0.5, 2))):
        SW.append_insight(df.withColumn("insight_id", F.lit(insight_id)), path)
    return v.spark.read.parquet(path).withColumn("insight_id", F.col("insight_id").cast("string"))


@sql_query("s7_upsert_latest", """
    SELECT mobile, CAST(txn_date AS VARCHAR) AS txn_date, bill, CAST(amount AS DOUBLE) AS amount FROM (
        SELECT *, row_number() OVER (PARTITION BY mobile ORDER BY txn_date DESC, is_new DESC, bill DESC, amount DESC)
                  AS rn
        FROM (SELECT mobile, txn_date, bill, amount, 0 AS is_new FROM past
              UNION ALL SELECT mobile, txn_date, bill, amount, 1 FROM since))
    WHERE rn = 1""")
def _(v):
    rows = v.txn.select("mobile", "txn_date", "bill", "amount")
    old = observation_window(rows, "txn_date", ASOF, PW, CW)
    return SW.upsert_latest(old, trailing_window(rows, "txn_date", ASOF, CW), ["mobile"], "txn_date")


@sql_query("s1_split_read", """
    SELECT bill, item, count(*) AS lines, 1 AS splits FROM sku GROUP BY bill, item""")
def _(v):
    v.sku.createOrReplaceTempView("split_source")
    rows = SR.read_split(v.spark, SR.Source("catalog"), "split_source", "bill", 16).withColumn("split", F.spark_partition_id())
    return rows.groupBy("bill", "item").agg(F.count("*").alias("lines"), F.countDistinct("split").alias("splits"))


@sql_query("s7_upsert_store", """
    SELECT mobile, CAST(txn_date AS VARCHAR) AS txn_date, bill, CAST(amount AS DOUBLE) AS amount FROM (
        SELECT *, row_number() OVER (PARTITION BY mobile ORDER BY txn_date DESC, is_new DESC, bill DESC, amount DESC)
                  AS rn
        FROM (SELECT mobile, txn_date, bill, amount, 0 AS is_new FROM past
              UNION ALL SELECT mobile, txn_date, bill, amount, 1 FROM since))
    WHERE rn = 1""")
def _(v):
    path = new_path(v.spark, "store")
    rows = v.txn.select("mobile", "txn_date", "bill", "amount")
    past = observation_window(rows, "txn_date", ASOF, PW, CW)
    create_store(SW.upsert_latest(past, past.limit(0), ["mobile"], "txn_date"), path, ["mobile"], 16)
    upsert_store(trailing_window(rows, "txn_date", ASOF, CW), path, ["mobile"], "txn_date", 16)
    return read_store(v.spark, path, rows.schema)


@sql_query("s9_append_run_log", """
    SELECT DISTINCT run_id, '14' AS insight_id, 'done' AS status FROM segments
    UNION ALL SELECT DISTINCT run_id, '16', 'failed' FROM segments""")
def _(v):
    path = new_path(v.spark, "log")
    runs = v.segments.select("run_id").distinct()
    for insight_id, status in (("14", "done"), ("16", "failed")):
        SW.append_run_log(runs.select("run_id", F.lit(insight_id).alias("insight_id"), F.lit(status).alias("status")), path)
    return v.spark.read.parquet(path)


@sql_query("s10_column_availability", """
    SELECT 'Mobile' AS column_name, TRUE AS present, count(mobile) AS non_null FROM member
    UNION ALL SELECT 'tier', TRUE, count(tier) FROM member
    UNION ALL SELECT 'gender', TRUE, count(gender) FROM member
    UNION ALL SELECT 'EnrolledStoreCode', FALSE, 0""")
def _(v):
    return A.column_availability(v.member, ["Mobile", "tier", "gender", "EnrolledStoreCode"])


# ---- batch

# The insight specs of the batch query, one that fails among them.
SPECS = """
    SELECT * FROM (VALUES
        ('12,npv,-,Range,300000,600000,-,,,-,,,value,BUILDING'),
        ('12,npv,-,Range,0,400000,-,,,-,,,value,AUTOMOBILE'),
        ('13,NPS,-,Varchar,,,-,,,-,,,nps,MACHINERY'),
        ('13,NPS,-,Varchar,,,-,,,-,,,nps,HOUSEHOLD'),
        ('14,clv,-,Range,300000,600000,-,,,-,,,value,FURNITURE'),
        ('16,ticket,-,Double,0.5,2,-,0.5,10,-,,,value,BUILDING'),
        ('16,ticket,-,Double,0.2,3,-,0.25,10,-,,,value,MACHINERY'),
        ('99,unknown,-,Double,0,1,-,,,-,,,none,BUILDING'),
        ('14,clv,-,Range,0,100000000,-,,,-,,,value,BUILDING'),
        ('0,probable_churn,-,Any,365,,-,,,-,,,churn,FURNITURE')
    ) AS t(line)"""


def batch_tables(v: Views):
    return {
        "member": project_members(v.member), "txn": v.txn, "nps": v.nps, "feedback": v.feedback,
        "questions": v.small("questions"), "replies": v.small("replies"), "lexicon": v.small("lexicon"),
        "segments": v.segments, "rules": RULES,
        "member_segments": v.segments.select("mobile", F.col("run_id").alias("segment")),
    }


def run_of(name: str) -> str:
    return f"(SELECT mobile FROM segments WHERE run_id = '{name}')"


def ticket_sql(rate: str, low: str, high: str) -> str:
    return f"""SELECT mobile, atv + available * {rate} AS value FROM ticket
               WHERE available * {rate} * 100.0e0 / atv BETWEEN {low} AND {high}"""


def written_sql(insight_id: str, run_id: str, rows: str, detail: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{insight_id}' AS insight_id, '{run_id}' AS run_id, 'done' AS status, mobile,
                      round(CAST(value AS DOUBLE), 6) AS value, {detail} AS detail
               FROM ({rows}) WHERE mobile IN {run_of(run_id)}"""


REPLY_SQL = """
    SELECT mobile, NULL AS value, l.language || ': ' || coalesce(
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language = l.language),
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language =
            (SELECT min(f.language) FROM questions AS f WHERE f.type = typed.type))) AS detail
    FROM typed, (SELECT DISTINCT language FROM questions) AS l"""
WHOLE = "SELECT mobile, trunc(value) AS value FROM value"


@sql_query("c10_run_batch", " UNION ALL ".join([
    written_sql("12", "BUILDING", f"SELECT * FROM ({NPV}) WHERE value BETWEEN 300000 AND 600000"),
    written_sql("12", "AUTOMOBILE", f"SELECT * FROM ({NPV}) WHERE value BETWEEN 0 AND 400000"),
    written_sql("13", "MACHINERY", REPLY_SQL, "detail"), written_sql("13", "HOUSEHOLD", REPLY_SQL, "detail"),
    written_sql("14", "FURNITURE", f"SELECT * FROM ({WHOLE}) WHERE value BETWEEN 300000 AND 600000"),
    written_sql("14", "BUILDING", f"SELECT * FROM ({WHOLE}) WHERE value BETWEEN 0 AND 100000000"),
    written_sql("16", "BUILDING", ticket_sql("0.5e0", "0.5", "2")),
    written_sql("16", "MACHINERY", ticket_sql("0.25e0", "0.2", "3")),
    """SELECT '0', 'FURNITURE', 'done', mobile, NULL, 'scored' FROM (
           SELECT mobile FROM txn WHERE txn_date > DATE '2001-08-01' - 365 GROUP BY mobile HAVING count(DISTINCT txn_date) > 1)
       WHERE mobile IN (SELECT mobile FROM segments WHERE run_id = 'FURNITURE')""",
    "SELECT '99', 'BUILDING', 'failed', NULL, NULL, NULL"]))
def _(v):
    path = new_path(v.spark, "batch")
    model = fit_churn(churn_features(v.txn, v.sku, v.item, v.member, v.store, ASOF, PW, CW), "naive_bayes").pipeline
    saved = load_model(save_model(model, new_path(v.spark, "churn-model")))
    tables = {**batch_tables(v), "member": v.member, "sku": v.sku, "item": v.item, "store": v.store, "churn_model": saved,
              "churn_asof": ASOF}
    log = B.run_batch(v.spark, B.parse_specs(v.spark.sql(SPECS)), tables, path)
    rows = None
    for name in ("npv", "NPS", "clv", "ticket", "probable_churn"):
        written = v.spark.read.parquet(f"{path}/results/name={name}")
        detail = F.lit(None).cast("string")
        if name == "NPS":
            detail = F.concat("language", F.lit(": "), "value")
        if name == "probable_churn":
            detail = F.when(F.col("value").isin("0", "1"), "scored")
        number = F.round(F.col("value").try_cast("double"), 6) if name not in ("NPS", "probable_churn") else F.lit(None).cast("double")
        part = written.select(F.col("insight_id").cast("string").alias("insight_id"), "run_id", "mobile",
                              number.alias("value"), detail.alias("detail"))
        rows = part if rows is None else rows.unionByName(part)
    return log.select("run_id", "insight_id", "status").join(rows, ["insight_id", "run_id"], "left")
