"""Queries for filters, joins, aggregations, rankings, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillsight.functions import scalars as S
from tillsight.functions import text as X
from tillsight.operators import aggregates as A
from tillsight.operators import bitmaps as B
from tillsight.operators import filters as P
from tillsight.operators import joins as J
from tillsight.operators import ranking as W
from tillsight.operators import sets as U
from tillsight.operators.text import frequent_terms, tokens
from tillsight.plans.rules import default_value
from tillsight.session import settle
from tillsight.workload.registry import query
from tillsight.workload.views import ASOF, CW, EXCLUDED, PW

COHORTS = [f"{b},{g}" for b in ("(0-15]", "(15-25]", "(25-35]", "(35-45]", "(45-100]") for g in ("Female", "Male")]

BRACKET = """CASE WHEN age IS NULL OR age <= 0 THEN NULL WHEN age <= 15 THEN '(0-15]' WHEN age <= 25 THEN '(15-25]'
    WHEN age <= 35 THEN '(25-35]' WHEN age <= 45 THEN '(35-45]' WHEN age <= 100 THEN '(45-100]' END"""

COMMON = {
    "value": """
        SELECT mobile, CAST(sum(amount) AS DOUBLE) * 365.0
                       / CAST(greatest(max(txn_date) - min(txn_date), 365) AS DOUBLE) AS value
        FROM txn GROUP BY mobile""",
    "atv": """
        SELECT mobile, CAST(sum(amount) AS DOUBLE) / count(DISTINCT bill) AS atv FROM txn GROUP BY mobile""",
    "last_row": """
        SELECT mobile, available FROM (
            SELECT mobile, available,
                   row_number() OVER (PARTITION BY mobile ORDER BY txn_date DESC, bill DESC) AS rn
            FROM txn) WHERE rn = 1""",
    "ticket": "SELECT atv.mobile, atv, available FROM atv JOIN last_row ON atv.mobile = last_row.mobile",
    "atv_value": """
        SELECT mobile, atv + available * 0.5e0 AS value FROM ticket
        WHERE available * 0.5e0 * 100.0e0 / atv BETWEEN 0.5 AND 2""",
    "mean_nps": "SELECT mobile, avg(CAST(response AS DOUBLE)) AS response FROM nps GROUP BY mobile",
    "user_item": """SELECT mobile AS "user", item, CAST(sum(qty) AS BIGINT) AS qty FROM sku GROUP BY mobile, item""",
    "cohorts": f"""
        SELECT mobile, item, name, txns, gender, {BRACKET} AS bracket,
               CASE WHEN gender IS NOT NULL THEN coalesce({BRACKET}, '') ELSE '' END || ',' || coalesce(gender, '')
                   AS cohort
        FROM fav_member""",
    "building": "SELECT DISTINCT mobile FROM segments WHERE run_id = 'BUILDING'",
    "past": f"""SELECT * FROM txn WHERE txn_date > DATE '{ASOF}' - {PW + CW} AND txn_date < DATE '{ASOF}' - {CW}""",
    "since": f"SELECT * FROM txn WHERE txn_date > DATE '{ASOF}' - {CW}",
}


def sql_query(name, sql):
    return query(name, sql, COMMON)


def ticket(v):
    return A.ticket_and_points(v.txn)


# ---- filters and projections


@sql_query("p1_project_members", "SELECT mobile FROM member")
def _(v):
    return P.project_members(v.member)


@sql_query("p2_filter_value_range",
           "SELECT mobile, value FROM value WHERE value BETWEEN 300000 AND 600000")
def _(v):
    return P.filter_value_range(default_value(v.txn), "value", 300000, 600000)


@sql_query("p3_filter_points_ratio",
           "SELECT mobile, atv, available FROM ticket "
           "WHERE available * 0.5e0 * 100.0e0 / atv BETWEEN 0.5 AND 2")
def _(v):
    return P.filter_points_ratio(ticket(v), 0.5, 0.5, 2)


@sql_query("p4_filter_text",
           "SELECT mobile, sha256(response) AS text_id FROM feedback WHERE length(response) >= 5")
def _(v):
    return P.filter_text(v.feedback, "response").select("mobile", X.text_id("response").alias("text_id"))


@sql_query("p5_trailing_window",
           f"SELECT mobile, bill, CAST(txn_date AS VARCHAR) AS txn_date FROM txn WHERE txn_date > DATE '{ASOF}' - {PW}")
def _(v):
    return P.trailing_window(v.txn, "txn_date", ASOF, PW).select("mobile", "bill", "txn_date")


@sql_query("p6_observation_window", "SELECT mobile, bill, CAST(txn_date AS VARCHAR) AS txn_date FROM past")
def _(v):
    return P.observation_window(v.txn, "txn_date", ASOF, PW, CW).select("mobile", "bill", "txn_date")


@sql_query("p7_price_band", """
    SELECT sku.mobile, bill, item, qty, CAST(net AS DOUBLE) AS net
    FROM sku JOIN atv_value ON sku.mobile = atv_value.mobile
    WHERE CAST(net AS DOUBLE) BETWEEN value * 0.2e0 AND value * 1.3e0""")
def _(v):
    value = P.filter_points_ratio(ticket(v), 0.5, 0.5, 2)
    value = value.select("mobile", S.ticket_plus_points("atv", "available", 0.5).alias("value"))
    return P.price_band(J.lines_with_value(v.sku, value), low=0.2).select("mobile", "bill", "item", "qty", "net")


@sql_query("p8_drop_null_columns", "SELECT mobile, tier, store, gender, age FROM member")
def _(v):
    return P.drop_null_columns(v.member.withColumn("nothing", F.lit(None).cast("string")))


@sql_query("p9_stamp_insight",
           "SELECT mobile, atv, '16' AS insight_id, 'value' AS insight_group FROM atv")
def _(v):
    return P.stamp_insight(A.average_ticket(v.txn), "16", "value")


@sql_query("p10_lower_columns", "SELECT mobile, tier, store FROM member")
def _(v):
    return P.lower_columns(v.member.select(F.col("mobile").alias("Mobile"), F.col("tier").alias("TIER"), "store"))


@sql_query("p11_impute",
           "SELECT mobile, tier, store, coalesce(gender, 'Male') AS gender, coalesce(age, 999) AS age FROM member")
def _(v):
    return P.impute(v.member, {"gender": "Male", "age": 999})


@sql_query("p12_repeat_visitors",
           "SELECT mobile, count(DISTINCT txn_date) AS total_visits FROM txn GROUP BY mobile "
           "HAVING count(DISTINCT txn_date) > 1")
def _(v):
    return P.repeat_visitors(v.txn.groupBy("mobile").agg(F.countDistinct("txn_date").alias("total_visits")))


@sql_query("p13_exclude_items", f"SELECT * FROM item WHERE NOT contains(name, '{EXCLUDED}')")
def _(v):
    return P.exclude_items(v.item, EXCLUDED, "name")


@sql_query("p14_filter_code_length",
           "SELECT mobile, item, txns FROM favourites WHERE length(CAST(item AS VARCHAR)) BETWEEN 1 AND 3")
def _(v):
    return P.filter_code_length(v.favourites, "item", 1, 3).select("mobile", "item", "txns")


@sql_query("p15_require", "SELECT * FROM member WHERE gender IS NOT NULL AND age IS NOT NULL")
def _(v):
    return P.require(v.member, ["gender", "age"])


@sql_query("p16_known_pairs", """
    SELECT "user", item, qty FROM purchases
    WHERE "user" IN (SELECT "user" FROM users) AND item IN (SELECT item FROM items)""")
def _(v):
    return P.known_pairs(v.purchases, v.users, v.items)


@sql_query("p18_null_strings", "SELECT mobile, tier, store, gender, age FROM member")
def _(v):
    return P.null_strings(P.impute(v.member, {"gender": "None"}), ["gender", "tier"])


# ---- joins


@sql_query("j1_restrict_to_segment", "SELECT nps.* FROM nps WHERE mobile IN (SELECT mobile FROM building)")
def _(v):
    return J.restrict_to_segment(v.nps, U.segment_members(v.segments, "BUILDING"))


@sql_query("j2_add_segment_columns",
           "SELECT atv.mobile, atv, segment FROM atv "
           "JOIN member_segments ON atv.mobile = member_segments.mobile")
def _(v):
    segments = v.segments.select("mobile", F.col("run_id").alias("segment"))
    return J.add_segment_columns(A.average_ticket(v.txn), segments)


LATEST = """SELECT mobile, txn_date, bill, available FROM (
        SELECT mobile, txn_date, bill, available, max(txn_date) OVER (PARTITION BY mobile) AS last FROM txn)
    WHERE txn_date = last"""


@sql_query("j3_join_points", f"""
    SELECT atv.mobile, atv, bill, available
    FROM atv JOIN ({LATEST}) AS points ON atv.mobile = points.mobile""")
def _(v):
    points = W.latest_points(v.txn).drop("txn_date")
    return J.join_points(A.average_ticket(v.txn), points)


@sql_query("j4_join_response", """
    SELECT value.mobile, response, value
    FROM mean_nps RIGHT JOIN value ON mean_nps.mobile = value.mobile""")
def _(v):
    return J.join_response(A.mean_response(v.nps), default_value(v.txn))


@sql_query("j5_member_store",
           "SELECT member.*, state, city FROM member LEFT JOIN store ON member.store = store.store")
def _(v):
    return J.member_store(v.member, v.store)


@sql_query("j6_sku_department",
           "SELECT mobile, bill, sku.item, qty, department FROM sku JOIN item ON sku.item = item.item")
def _(v):
    return J.sku_department(v.item, v.sku).select("mobile", "bill", "item", "qty", "department")


@sql_query("j7_assemble_features", """
    SELECT p.mobile, p.total_txn, uniqueitems, qty, ndept, tier
    FROM (SELECT mobile, count(DISTINCT bill) AS total_txn FROM txn GROUP BY mobile) AS p
    LEFT JOIN (SELECT mobile, count(DISTINCT (bill, item)) AS uniqueitems, CAST(sum(qty) AS BIGINT) AS qty
               FROM sku GROUP BY mobile) AS s ON p.mobile = s.mobile
    LEFT JOIN (SELECT mobile, count(DISTINCT (bill, department)) AS ndept
               FROM sku JOIN item ON sku.item = item.item GROUP BY mobile) AS d ON p.mobile = d.mobile
    LEFT JOIN member ON p.mobile = member.mobile""")
def _(v):
    features = J.assemble_features(
        A.member_profile(v.txn), A.basket_totals(v.sku), A.department_totals(J.sku_department(v.item, v.sku)), v.member
    )
    return features.select("mobile", "total_txn", "uniqueitems", "qty", "ndept", "tier")


@sql_query("j10_reply_matrix", """
    SELECT mobile, typed.type, language, coalesce(own, general) AS question
    FROM typed
    JOIN (SELECT t.type, l.language,
                 (SELECT min(q.question) FROM questions AS q WHERE q.type = t.type AND q.language = l.language) AS own,
                 (SELECT q.question FROM questions AS q WHERE q.type = t.type
                  ORDER BY q.language, q.question LIMIT 1) AS general
          FROM (SELECT DISTINCT type FROM questions) AS t, (SELECT DISTINCT language FROM questions) AS l) AS m
      ON typed.type = m.type""")
def _(v):
    typed = v.nps.select("mobile", S.nps_type("response").alias("type"))
    questions = v.small("questions")
    return J.reply_matrix(typed, questions, A.distinct_languages(questions))


@sql_query("j11_seen_flag", """
    SELECT DISTINCT mobile, mobile IN (SELECT mobile FROM since) AS seen FROM past""")
def _(v):
    past = P.observation_window(v.txn, "txn_date", ASOF, PW, CW).select("mobile").distinct()
    return J.seen_flag(past, P.trailing_window(v.txn, "txn_date", ASOF, CW))


@sql_query("j12_lines_with_value", """
    SELECT sku.mobile, bill, item, qty, value
    FROM sku JOIN value ON sku.mobile = value.mobile""")
def _(v):
    lines = J.lines_with_value(v.sku, default_value(v.txn)).drop("net", "txn_date")
    return lines


@sql_query("j13_member_demographics", """
    SELECT favourites.mobile, item, txns, age, gender
    FROM favourites JOIN member ON favourites.mobile = member.mobile
    WHERE favourites.mobile IN (SELECT mobile FROM building)""")
def _(v):
    cohort = U.segment_members(v.segments, "BUILDING")
    return J.member_demographics(v.favourites.drop("name"), v.member, cohort)


@sql_query("j14_add_tags", """
    SELECT mobile, atv, s.days, t.points
    FROM atv
    LEFT JOIN (SELECT mobile AS m, count(DISTINCT txn_date) AS days FROM since GROUP BY mobile) AS s ON mobile = s.m
    LEFT JOIN (SELECT mobile AS m, max(available) AS points FROM past GROUP BY mobile) AS t ON mobile = t.m""")
def _(v):
    since = P.trailing_window(v.txn, "txn_date", ASOF, CW)
    past = P.observation_window(v.txn, "txn_date", ASOF, PW, CW)
    tags = {
        "days": since.groupBy("mobile").agg(F.countDistinct("txn_date").alias("value")),
        "points": past.select("mobile", F.col("available").alias("value")),
    }
    return J.add_tags(A.average_ticket(v.txn), tags)


@sql_query("j15_cohort_lists", """
    SELECT m.mobile, m.cohort, l.items
    FROM (SELECT DISTINCT mobile, cohort FROM cohorts) AS m
    JOIN (SELECT cohort, CAST(count(DISTINCT item) AS VARCHAR) AS items FROM cohorts GROUP BY cohort) AS l
      ON m.cohort = l.cohort""")
def _(v):
    keyed = v.fav_member.withColumn("cohort", S.cohort_key(S.age_bracket("age"), "gender"))
    lists = keyed.groupBy("cohort").agg(F.countDistinct("item").cast("string").alias("items"))
    return J.cohort_lists(keyed.select("mobile", "cohort").distinct(), lists)


@sql_query("j16_only_members",
           "SELECT mobile, value FROM value WHERE mobile IN (SELECT mobile FROM mean_nps)")
def _(v):
    return J.only_members(default_value(v.txn), v.nps)


# ---- aggregations


@sql_query("a1_average_ticket", "SELECT mobile, atv FROM atv")
def _(v):
    return A.average_ticket(v.txn)


@sql_query("a2_mean_response", "SELECT mobile, response FROM mean_nps")
def _(v):
    return A.mean_response(v.nps)


@sql_query("a3_basket_totals", """
    SELECT mobile, CAST(sum(items) AS BIGINT) AS uniqueitems, CAST(sum(qty) AS BIGINT) AS qty
    FROM (SELECT mobile, bill, count(DISTINCT item) AS items, sum(qty) AS qty FROM sku GROUP BY mobile, bill)
    GROUP BY mobile""")
def _(v):
    return A.basket_totals(v.sku)


@sql_query("a4_department_totals", """
    SELECT mobile, CAST(sum(departments) AS BIGINT) AS ndept
    FROM (SELECT mobile, bill, count(DISTINCT department) AS departments
          FROM sku JOIN item ON sku.item = item.item GROUP BY mobile, bill)
    GROUP BY mobile""")
def _(v):
    return A.department_totals(J.sku_department(v.item, v.sku))


def profile_sql(source: str) -> str:
    return f"""
    SELECT t.mobile, CAST(sum(amount) AS DOUBLE) AS total_amount, count(DISTINCT bill) AS total_txn,
           count(DISTINCT t.txn_date) AS total_visits, CAST(sum(lapsed) AS BIGINT) AS lapsedpoints,
           CAST(sum(available) AS BIGINT) AS availablepoints, CAST(sum(collected) AS BIGINT) AS pointscollected,
           min(t.txn_date) AS first_date, max(t.txn_date) AS last_date, count(DISTINCT store) AS nstores,
           coalesce(max(gap), CASE WHEN count(*) > 1 THEN 0 END) AS max_latency
    FROM {source} AS t
    LEFT JOIN (SELECT mobile, txn_date, txn_date - lag(txn_date) OVER (PARTITION BY mobile ORDER BY txn_date) AS gap
               FROM (SELECT DISTINCT mobile, txn_date FROM {source})) AS g
      ON t.mobile = g.mobile AND t.txn_date = g.txn_date
    GROUP BY t.mobile"""


@sql_query("a5_member_profile", f"""
    SELECT * REPLACE (CAST(first_date AS VARCHAR) AS first_date, CAST(last_date AS VARCHAR) AS last_date)
    FROM ({profile_sql('txn')})""")
def _(v):
    return A.member_profile(v.txn)


@sql_query("a6_member_label", """
    SELECT mobile, max(CASE WHEN lapsed > 0 THEN 1 ELSE 0 END) AS labels FROM txn GROUP BY mobile""")
def _(v):
    return A.member_label(v.txn.withColumn("labels", (F.col("lapsed") > 0).cast("int")))


@sql_query("a7_purchase_days", """
    SELECT mobile, count(DISTINCT txn_date) AS days, count(DISTINCT txn_date) > 1 AS repeat_buyer
    FROM sku GROUP BY mobile""")
def _(v):
    return A.purchase_days(v.sku)


@sql_query("a8_daily_item_qty", """
    SELECT mobile, item, CAST(txn_date AS VARCHAR) AS txn_date, CAST(sum(qty) AS BIGINT) AS qty
    FROM sku GROUP BY mobile, item, txn_date""")
def _(v):
    return A.daily_item_qty(v.sku)


@sql_query("a9_user_item_qty", "SELECT * FROM user_item")
def _(v):
    return A.user_item_qty(v.sku)


@sql_query("a10_matrix_sparsity", """
    SELECT count(DISTINCT "user") AS users, count(DISTINCT item) AS items,
           count(*) FILTER (WHERE qty <> 0) AS filled,
           100.0e0 * (1.0e0 - CAST(count(*) FILTER (WHERE qty <> 0) AS DOUBLE)
                 / (CAST(count(DISTINCT "user") AS DOUBLE) * count(DISTINCT item))) AS sparsity
    FROM user_item""")
def _(v):
    return A.matrix_sparsity(A.user_item_qty(v.sku))


@sql_query("a11_popular_by_age_gender", """
    SELECT bracket, gender, item, CAST(sum(txns) AS BIGINT) AS txns FROM cohorts
    WHERE bracket IS NOT NULL AND gender IS NOT NULL GROUP BY bracket, gender, item""")
def _(v):
    return A.popular_by_age_gender(v.fav_member)


@sql_query("a12_popular_by_gender", """
    SELECT gender, item, CAST(sum(txns) AS BIGINT) AS txns FROM cohorts WHERE gender IS NOT NULL
    GROUP BY gender, item""")
def _(v):
    return A.popular_by_gender(v.fav_member)


@sql_query("a13_popular_overall", """
    SELECT item, CAST(sum(txns) AS BIGINT) AS txns FROM cohorts WHERE bracket IS NULL AND gender IS NULL
    GROUP BY item""")
def _(v):
    return A.popular_overall(v.fav_member)


PIVOT = ", ".join(f"CAST(sum(txns) FILTER (WHERE cohort = '{c}') AS BIGINT) AS \"{c}\"" for c in COHORTS)


@sql_query("a14_cohort_item_pivot", f"SELECT item, {PIVOT} FROM cohorts GROUP BY item")
def _(v):
    return A.cohort_item_pivot(
        v.fav_member.withColumn("cohort", S.cohort_key(S.age_bracket("age"), "gender")), COHORTS
    )


@sql_query("a15_only_excluded_item", f"""
    SELECT mobile, count(*) AS rows, count(*) = 1 AND bool_or(contains(name, '{EXCLUDED}')) AS only_excluded
    FROM favourites GROUP BY mobile""")
def _(v):
    return A.only_excluded_item(v.favourites, EXCLUDED, "name")


@sql_query("a16_distinct_languages", "SELECT DISTINCT lang AS language FROM documents")
def _(v):
    return A.distinct_languages(v.table("documents").withColumnRenamed("lang", "language"))


TOKENS = "SELECT mobile, unnest(regexp_extract_all(lower(response), '[\\p{L}\\p{N}_]{2,}')) AS token FROM feedback"


@sql_query("a17_frequent_terms", f"""
    SELECT token, count(*) AS count FROM ({TOKENS}) GROUP BY token HAVING count(*) >= 15
    ORDER BY count(*) DESC, token LIMIT 50""")
def _(v):
    return frequent_terms(tokens(v.feedback))


@sql_query("a18_non_null_counts", """
    SELECT 'mobile' AS column_name, count(mobile) AS non_null FROM member
    UNION ALL SELECT 'tier', count(tier) FROM member UNION ALL SELECT 'store', count(store) FROM member
    UNION ALL SELECT 'gender', count(gender) FROM member UNION ALL SELECT 'age', count(age) FROM member""")
def _(v):
    return A.non_null_counts(v.member)


# ---- windows, ordering


@sql_query("w1_latest_points",
           f"SELECT mobile, CAST(txn_date AS VARCHAR) AS txn_date, bill, available FROM ({LATEST})")
def _(v):
    return W.latest_points(v.txn)


@sql_query("w2_visit_gaps", """
    SELECT mobile, CAST(txn_date AS VARCHAR) AS txn_date, bills,
           txn_date - lag(txn_date) OVER (PARTITION BY mobile ORDER BY txn_date) AS gap
    FROM (SELECT mobile, txn_date, count(*) AS bills FROM txn GROUP BY mobile, txn_date)""")
def _(v):
    return W.visit_gaps(v.txn)


@sql_query("w3_max_line_amount", """
    SELECT mobile, bill, item, qty, CAST(net AS DOUBLE) AS net,
           CAST(max(net) OVER (PARTITION BY mobile) AS DOUBLE) AS max_net
    FROM sku""")
def _(v):
    return W.max_line_amount(v.sku).drop("txn_date")


@sql_query("w4_top_n", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY qty DESC, item) AS rank FROM user_item)
    WHERE rank <= 5""")
def _(v):
    return W.top_n(A.user_item_qty(v.sku), ["user"], "qty", ["item"], 5)


@sql_query("k1_by_date",
           "SELECT mobile, bill, item, qty, CAST(txn_date AS VARCHAR) AS txn_date FROM sku ORDER BY txn_date, mobile, bill, item")
def _(v):
    return W.by_date(v.sku).drop("net")


@sql_query("k2_top_terms", """
    SELECT item AS token, count(*) AS count FROM sku GROUP BY item HAVING count(*) >= 15
    ORDER BY count(*) DESC, item LIMIT 20""")
def _(v):
    return frequent_terms(v.sku.select(F.col("item").alias("token")), n=20)


@sql_query("k3_first_match", """
    SELECT event_type, ts, event_id FROM (
        SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts, event_id,
               row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE), event_id) AS rn FROM events)
    WHERE rn = 1""")
def _(v):
    events = v.table("events").select("event_type", F.col("ts").cast("date").alias("ts"), "event_id")
    return W.first_match(events, ["event_type"], ["ts", "event_id"])


@sql_query("k4_one_per_member", """
    SELECT mobile, CAST(txn_date AS VARCHAR) AS txn_date, bill FROM (
        SELECT mobile, txn_date, bill, row_number() OVER (PARTITION BY mobile ORDER BY txn_date, bill) AS rn FROM txn)
    WHERE rn = 1""")
def _(v):
    return W.one_per_member(v.txn.select("mobile", "txn_date", "bill"), ["txn_date", "bill"])


# ---- sets


# Every group of members there is: market segments, response types, stores' cities, recent visitors.
GROUPS = """
    SELECT 'run ' || run_id AS segment, mobile FROM segments
    UNION SELECT 'type ' || type, mobile FROM typed
    UNION SELECT 'city ' || city, mobile FROM member JOIN store ON member.store = store.store
    UNION SELECT 'since', mobile FROM since"""


def groups(v):
    """(segment, mobile) rows of the same groups."""
    cities = J.member_store(v.member, v.store)
    return U.stack(
        v.segments.select(F.concat(F.lit("run "), "run_id").alias("segment"), "mobile"),
        v.nps.select(F.concat(F.lit("type "), S.nps_type("response")).alias("segment"), "mobile"),
        cities.filter("city is not null").select(F.concat(F.lit("city "), "city").alias("segment"), "mobile"),
        P.trailing_window(v.txn, "txn_date", ASOF, CW).select(F.lit("since").alias("segment"), "mobile"))


def group_bitmaps(v):
    """Their bitmaps, written once, and the members' numbers."""
    rows = groups(v)
    numbers = settle(B.member_numbers(rows), "numbers")
    return settle(B.segment_bitmaps(rows, numbers), "bitmaps"), numbers


@query("u3_segment_bitmaps", """
    SELECT 'size' AS kind, segment AS a, CAST(NULL AS VARCHAR) AS b, count(*) AS members FROM groups GROUP BY segment
    UNION ALL SELECT 'overlap', x.segment, y.segment, count(*)
    FROM groups AS x JOIN groups AS y ON x.mobile = y.mobile AND x.segment < y.segment GROUP BY x.segment, y.segment
    UNION ALL SELECT 'union', 'runs', NULL, count(DISTINCT mobile) FROM groups WHERE starts_with(segment, 'run ')
    UNION ALL SELECT 'union', 'all', NULL, count(DISTINCT mobile) FROM groups""", {**COMMON, "groups": GROUPS})
def _(v):
    bitmaps, _ = group_bitmaps(v)
    names = [r.segment for r in bitmaps.select("segment").distinct().collect()]
    united = B.merge(B.union(bitmaps, [n for n in names if n.startswith("run ")], "runs"), B.union(bitmaps, names, "all"))
    nothing = F.lit(None).cast("string").alias("b")
    return U.stack(
        B.sizes(bitmaps).select(F.lit("size").alias("kind"), F.col("segment").alias("a"), nothing, "members"),
        B.overlaps(bitmaps).select(F.lit("overlap").alias("kind"), "a", "b", "members"),
        B.sizes(united).select(F.lit("union").alias("kind"), F.col("segment").alias("a"), nothing, "members"))


@query("u4_segment_difference", """
    SELECT 'lapsed' AS segment, mobile FROM groups WHERE segment = 'run BUILDING'
    AND mobile NOT IN (SELECT mobile FROM groups WHERE segment IN ('since', 'type Promoter'))
    UNION ALL SELECT 'loyal', mobile FROM groups WHERE segment = 'run BUILDING'
    AND mobile IN (SELECT mobile FROM groups WHERE segment = 'since')
    AND mobile IN (SELECT mobile FROM groups WHERE segment = 'type Promoter')""", {**COMMON, "groups": GROUPS})
def _(v):
    bitmaps, numbers = group_bitmaps(v)
    lapsed = B.difference(bitmaps, "run BUILDING", ["since", "type Promoter"], "lapsed")
    loyal = B.intersection(bitmaps, ["run BUILDING", "since", "type Promoter"], "loyal")
    return B.members_of(lapsed.unionByName(loyal), numbers)


@sql_query("u1_stack", """
    SELECT mobile, bill, 'past' AS part FROM past UNION ALL SELECT mobile, bill, 'since' FROM since""")
def _(v):
    past = P.observation_window(v.txn, "txn_date", ASOF, PW, CW).select("mobile", "bill", F.lit("past").alias("part"))
    since = P.trailing_window(v.txn, "txn_date", ASOF, CW).select(F.lit("since").alias("part"), "bill", "mobile")
    return U.stack(past, since)


@sql_query("u2_stack_types", """
    SELECT mobile, l.language, coalesce(
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language = l.language),
        (SELECT min(q.question) FROM questions AS q WHERE q.type = typed.type AND q.language =
            (SELECT min(f.language) FROM questions AS f WHERE f.type = typed.type))) AS question
    FROM typed, (SELECT DISTINCT language FROM questions) AS l""")
def _(v):
    typed = v.nps.select("mobile", S.nps_type("response").alias("type"))
    questions = v.small("questions")
    return U.stack_types(typed, questions, A.distinct_languages(questions))


@sql_query("u3_segment_members", "SELECT mobile FROM building")
def _(v):
    return U.segment_members(v.segments, "BUILDING")


@sql_query("u4_uncovered", """
    SELECT mobile FROM member WHERE mobile NOT IN (SELECT mobile FROM mean_nps)
    AND mobile NOT IN (SELECT mobile FROM building)""")
def _(v):
    return U.uncovered(v.member.select("mobile"), v.nps, U.segment_members(v.segments, "BUILDING"))


# ---- scalar functions


@sql_query("f1_nps_type", "SELECT mobile, response, type FROM (SELECT mobile, response, CASE WHEN response < 7 "
           "THEN 'Detractor' WHEN response < 9 THEN 'Passive' ELSE 'Promoter' END AS type FROM nps)")
def _(v):
    return v.nps.withColumn("type", S.nps_type("response"))


@sql_query("f2_blend", """
    SELECT value.mobile, CASE WHEN response IS NULL THEN value ELSE response * 0.5e0 + value * 0.5e0 END
           AS blended
    FROM value LEFT JOIN mean_nps ON mean_nps.mobile = value.mobile""")
def _(v):
    joined = J.join_response(A.mean_response(v.nps), default_value(v.txn))
    return joined.select("mobile", S.blend("response", "value").alias("blended"))


@sql_query("f3_ticket_plus_points", "SELECT mobile, atv + available * 0.5e0 AS value FROM ticket")
def _(v):
    return ticket(v).select("mobile", S.ticket_plus_points("atv", "available", 0.5).alias("value"))


@sql_query("f4_day_differences", f"""
    SELECT mobile, DATE '{ASOF}' - max(txn_date) AS recency, DATE '{ASOF}' - min(txn_date) AS tenure,
           CASE WHEN count(DISTINCT txn_date) > 1 THEN CAST(max(txn_date) - min(txn_date) AS DOUBLE)
                      / (count(DISTINCT txn_date) - 1) END AS latency
    FROM txn GROUP BY mobile""")
def _(v):
    profile = A.member_profile(v.txn)
    return profile.select(
        "mobile", S.recency("last_date", S.asof(ASOF)).alias("recency"),
        S.tenure("first_date", S.asof(ASOF)).alias("tenure"),
        S.mean_latency("first_date", "last_date", "total_visits").alias("latency"),
    )


@sql_query("f5_shift_days", "SELECT bill, CAST(txn_date - 30 AS VARCHAR) AS day FROM txn")
def _(v):
    return v.txn.select("bill", S.shift_days("txn_date", 30).alias("day"))


@sql_query("f6_asof", f"SELECT bill, CAST(DATE '{ASOF}' AS VARCHAR) AS asof, DATE '{ASOF}' - txn_date AS age FROM txn")
def _(v):
    return v.txn.select("bill", S.asof(ASOF).alias("asof"), S.recency("txn_date", S.asof(ASOF)).alias("age"))


@sql_query("f7_clean_text", """
    SELECT mobile, CASE WHEN regexp_matches(cleaned, '[a-z]') THEN sha256(cleaned) END AS text_id
    FROM (SELECT mobile, lower(regexp_replace(response, '[^A-Za-z\\s]+', '', 'g')) AS cleaned FROM feedback)""")
def _(v):
    return v.feedback.select("mobile", X.text_id(X.clean_text("response")).alias("text_id"))


@sql_query("f8_contains", """
    SELECT mobile, contains(response, 'that') AND contains(response, 'with') AS both_words,
           NOT contains(response, 'from') AND NOT contains(response, 'this') AS neither
    FROM feedback""")
def _(v):
    return v.feedback.select(
        "mobile", X.contains_all("response", ["that", "with"]).alias("both_words"),
        X.contains_none("response", ["from", "this"]).alias("neither"),
    )


@sql_query("f9_lenient_number", """
    SELECT event_id, TRY_CAST(props AS DOUBLE) AS whole,
           TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS DOUBLE) AS digits
    FROM events""")
def _(v):
    digits = F.regexp_replace("props", "[^0-9]", "")
    return v.table("events").select(
        "event_id", S.lenient_number("props").alias("whole"), S.lenient_number(digits).alias("digits")
    )


@sql_query("f10_age_bracket", f"SELECT mobile, age, {BRACKET} AS bracket FROM member")
def _(v):
    return v.member.select("mobile", "age", S.age_bracket("age").alias("bracket"))


@sql_query("f11_demographic_condition", f"""
    SELECT mobile, CASE WHEN {BRACKET} IS NOT NULL THEN 1 ELSE 0 END
                   + CASE WHEN gender IS NOT NULL THEN 2 ELSE 0 END AS condition
    FROM member""")
def _(v):
    return v.member.select("mobile", S.demographic_condition(S.age_bracket("age"), F.col("gender")).alias("condition"))


@sql_query("f12_cohort_key", f"""
    SELECT mobile, CASE WHEN gender IS NOT NULL THEN coalesce({BRACKET}, '') ELSE '' END || ','
                   || coalesce(gender, '') AS cohort
    FROM member""")
def _(v):
    return v.member.select("mobile", S.cohort_key(S.age_bracket("age"), "gender").alias("cohort"))


@sql_query("f13_ranked_list", """
    SELECT "user", string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) AS items FROM (
        SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY qty DESC, item) AS rank FROM user_item)
    WHERE rank <= 5 GROUP BY "user" """)
def _(v):
    return W.ranked_list(W.top_n(A.user_item_qty(v.sku), ["user"], "qty", ["item"], 5), "user", "rank", "item", 5)


@sql_query("f14_scale_scores", """
    SELECT "user", item, qty, coalesce(CAST(qty - low AS DOUBLE) / nullif(high - low, 0), 0.0e0) AS scaled
    FROM (SELECT *, min(qty) OVER (PARTITION BY "user") AS low, max(qty) OVER (PARTITION BY "user") AS high
          FROM user_item)""")
def _(v):
    return W.scale_scores(A.user_item_qty(v.sku), "user", "qty")


@sql_query("f15_as_text", """
    SELECT CAST(mobile AS VARCHAR) AS mobile, tier, CAST(store AS VARCHAR) AS store, gender,
           CAST(age AS VARCHAR) AS age FROM member""")
def _(v):
    return P.as_text(v.member)
