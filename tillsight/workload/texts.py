"""Queries for feedback text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillsight.functions.text import text_id, token_array
from tillsight.operators import filters as P
from tillsight.operators import joins as J
from tillsight.operators import text as T
from tillsight.operators.factors import dense_index
from tillsight.operators.rules import as_table, table_labels
from tillsight.plans.feedback import clean_feedback, feedback_reply
from tillsight.workload.registry import query, rounded
from tillsight.workload.views import Views

# Rules on words that occur in the test texts, of every shape a rule can have.
RULES = (
    T.rule("about this", "this", "whou"),
    T.Rule("delivery", ((("deliv",), ("that",)), (("erin",), ()))),
    T.rule("from and with", "from with", "this"),
    T.rule("foreign", "der und"),
)

WORD = "[\\p{L}\\p{N}_]{2,}"
# Log scores: one multinomial model over {train} (text_id, response, label) and {rest} (text_id, response).
BAYES = """
    SELECT text_id, label FROM (
        SELECT text_id, label, row_number() OVER (PARTITION BY text_id ORDER BY round(score, 6) DESC, label) AS rn
        FROM (
            SELECT d.text_id, c.label, c.log_prior + coalesce(h.hit, 0) - d.words * c.log_size AS score
            FROM (SELECT text_id, len(regexp_extract_all(lower(response), '{word}')) AS words FROM {rest}) AS d,
                 (SELECT s.label, ln(CAST(s.docs AS DOUBLE) / (SELECT count(*) FROM {train})) AS log_prior,
                         ln(CAST(coalesce(t.total, 0) + (SELECT count(DISTINCT token) FROM {words}) AS DOUBLE))
                             AS log_size
                  FROM (SELECT label, count(*) AS docs FROM {train} GROUP BY label) AS s
                  LEFT JOIN (SELECT label, count(*) AS total FROM {words} WHERE label IS NOT NULL GROUP BY label) AS t
                    ON s.label = t.label) AS c
            LEFT JOIN (
                SELECT b.text_id, w.label, sum(b.n * w.weight) AS hit
                FROM (SELECT text_id, token, count(*) AS n FROM {words} WHERE label IS NULL GROUP BY text_id, token) AS b
                JOIN (SELECT label, token, ln(CAST(count(*) + 1 AS DOUBLE)) AS weight FROM {words}
                      WHERE label IS NOT NULL GROUP BY label, token) AS w ON b.token = w.token
                GROUP BY b.text_id, w.label) AS h ON h.text_id = d.text_id AND h.label = c.label))
    WHERE rn = 1"""


def bayes(train: str, rest: str, words: str) -> str:
    return BAYES.format(train=train, rest=rest, words=words, word=WORD)


def stemmed_of(words: str) -> str:
    return f"""SELECT text_id, label, coalesce(stem, {words}.token) AS token
               FROM {words} LEFT JOIN stems ON {words}.token = stems.token"""


def words_of(train: str, rest: str) -> str:
    return f"""
        SELECT text_id, label, unnest(regexp_extract_all(lower(response), '{WORD}')) AS token
        FROM (SELECT text_id, label, response FROM {train}
              UNION ALL SELECT text_id, CAST(NULL AS VARCHAR), response FROM {rest})"""


MANY = 10_000  # rules of the table query
EXTRA = {
    "cleaned": """
        SELECT mobile, cleaned AS response, sha256(cleaned) AS text_id FROM (
            SELECT mobile, lower(regexp_replace(response, '[^A-Za-z\\s]+', '', 'g')) AS cleaned
            FROM feedback WHERE length(response) >= 5)
        WHERE regexp_matches(cleaned, '[a-z]')""",
    "words": f"SELECT mobile, unnest(regexp_extract_all(lower(response), '{WORD}')) AS token FROM cleaned",
    "scored": """
        SELECT cleaned.mobile, response, text_id, coalesce(polarity, 0) AS polarity,
               coalesce(subjectivity, 0) AS subjectivity
        FROM cleaned LEFT JOIN (
            SELECT mobile, CAST(sum(polarity) AS DOUBLE) / count(*) AS polarity,
                   CAST(sum(subjectivity) AS DOUBLE) / count(*) AS subjectivity
            FROM words JOIN lexicon ON words.token = lexicon.token GROUP BY mobile) AS m ON cleaned.mobile = m.mobile""",
    "negative": "SELECT mobile, response, text_id FROM scored WHERE polarity < 0",
    "by_rule": """
        SELECT mobile, text_id, response, 'about this' AS label FROM negative
        WHERE contains(response, 'this') AND NOT contains(response, 'whou')
        UNION ALL SELECT mobile, text_id, response, 'delivery' FROM negative
        WHERE contains(response, 'deliv') AND NOT contains(response, 'that') OR contains(response, 'erin')
        UNION ALL SELECT mobile, text_id, response, 'from and with' FROM negative
        WHERE contains(response, 'from') AND contains(response, 'with') AND NOT contains(response, 'this')
        UNION ALL SELECT mobile, text_id, response, 'foreign' FROM negative
        WHERE contains(response, 'der') AND contains(response, 'und')""",
    "rest": """
        SELECT mobile, response, text_id FROM negative
        WHERE mobile || text_id NOT IN (SELECT mobile || text_id FROM by_rule)""",
    "rest_texts": "SELECT DISTINCT text_id, response FROM rest",
    "rule_words": words_of("by_rule", "rest_texts"),
    "graded": """
        SELECT sha256(CAST(documents.doc_id AS VARCHAR)) AS text_id, text AS response,
               CAST(quality AS VARCHAR) AS label
        FROM documents JOIN labels ON documents.doc_id = labels.doc_id""",
    "ungraded": """
        SELECT sha256(CAST(doc_id AS VARCHAR)) AS text_id, text AS response FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "graded_words": words_of("graded", "ungraded"),
    "stemmed_graded_words": stemmed_of("graded_words"),
    "stemmed_rule_words": stemmed_of("rule_words"),
    "benchmark_tokens": """
        SELECT token, row_number() OVER (ORDER BY token) - 1 AS n
        FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS token FROM benchmark)""",
    "rule_list": f"""
        SELECT i, 'r' || (i % 500) AS label, a.token AS w1, substr(b.token, 1, 4) AS w2, c.token AS w3
        FROM range({MANY}) AS r(i) CROSS JOIN (SELECT count(*) AS total FROM benchmark_tokens)
        JOIN benchmark_tokens AS a ON a.n = i % total JOIN benchmark_tokens AS b ON b.n = (i * 7 + 3) % total
        JOIN benchmark_tokens AS c ON c.n = (i * 13 + 5) % total""",
    "found": """
        SELECT text_id, word FROM (SELECT DISTINCT text_id, response FROM cleaned),
            (SELECT w1 AS word FROM rule_list UNION SELECT w2 FROM rule_list UNION SELECT w3 FROM rule_list)
        WHERE contains(response, word)""",
    "first_reply": "SELECT type AS label, min(message) AS message FROM replies GROUP BY type",
}


def sql_query(name, sql):
    return query(name, sql, EXTRA)


def scored(v: Views):
    return T.sentiment(clean_feedback(v.feedback), v.small("lexicon"))


def negative(v: Views):
    return P.negative_only(scored(v)).select("mobile", "response")


def graded(v: Views):
    """Documents with and without a quality label, keyed by document."""
    labels = v.table("labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    documents = v.table("documents").select("doc_id", F.col("text").alias("response"))
    keyed = documents.withColumn("text_id", text_id(F.col("doc_id").cast("string")))
    return keyed.join(labels, "doc_id").drop("doc_id"), keyed.join(labels, "doc_id", "left_anti").drop("doc_id")


@sql_query("p17_negative_only", "SELECT mobile, round(polarity, 12) AS polarity FROM scored WHERE polarity < 0")
def _(v):
    return rounded(P.negative_only(scored(v)).select("mobile", "polarity"), 12, "polarity")


@sql_query("t1_tokens", f"""
    SELECT mobile, len(regexp_extract_all(lower(response), '{WORD}')) AS n,
           md5(array_to_string(regexp_extract_all(lower(response), '{WORD}'), ' ')) AS tokens
    FROM feedback""")
def _(v):
    words = token_array("response")
    return v.feedback.select("mobile", F.size(words).alias("n"), F.md5(F.array_join(words, " ")).alias("tokens"))


@sql_query("t2_sentiment",
           "SELECT mobile, round(polarity, 12) AS polarity, round(subjectivity, 12) AS subjectivity FROM scored")
def _(v):
    return rounded(scored(v).drop("response"), 12, "polarity", "subjectivity")


@sql_query("t3_frequent_nouns", """
    SELECT words.token, count(*) AS count
    FROM words JOIN nouns ON words.token = nouns.token
    WHERE mobile IN (SELECT mobile FROM negative)
    GROUP BY words.token HAVING count(*) >= 15 ORDER BY count(*) DESC, words.token LIMIT 5""")
def _(v):
    return T.frequent_nouns(T.tokens(negative(v)), v.small("nouns"), 5)


@sql_query("t4_rule_labels", "SELECT mobile, label FROM by_rule")
def _(v):
    return T.rule_labels(negative(v), RULES).select("mobile", "label")


@sql_query("t4_rules_as_table", "SELECT mobile, label FROM by_rule")
def _(v):
    return table_labels(negative(v), as_table(v.spark, RULES)).select("mobile", "label")


@sql_query("t4_ten_thousand_rules", """
    SELECT DISTINCT mobile, label FROM rule_list
    JOIN found AS f1 ON f1.word = w1 JOIN found AS f2 ON f2.word = w2 AND f2.text_id = f1.text_id
    JOIN cleaned ON cleaned.text_id = f1.text_id
    ANTI JOIN found AS f3 ON f3.word = w3 AND f3.text_id = f1.text_id""")
def _(v):
    words = v.table("benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"))).alias("token"))
    numbered = dense_index(words, "token")
    total = numbered.count()
    rules = v.spark.range(MANY).select(F.col("id").alias("rule_id"), F.concat(F.lit("r"), F.col("id") % 500).alias("label"))
    for name, factor, shift in (("w1", 1, 0), ("w2", 7, 3), ("w3", 13, 5)):
        place = numbered.select(F.col("token").alias(name), F.col("token_id").cast("bigint").alias(f"{name}_at"))
        rules = rules.withColumn(f"{name}_at", (F.col("rule_id") * factor + shift) % total).join(place, f"{name}_at")
    rules = rules.select("rule_id", "label", F.array("w1", F.substring("w2", 1, 4)).alias("required"), F.array("w3").alias("forbidden"))
    return table_labels(clean_feedback(v.feedback), rules).select("mobile", "label")


@sql_query("t5_bag_of_words", """
    SELECT label, token, count(*) AS n, count(DISTINCT text_id) AS texts FROM graded_words GROUP BY label, token""")
def _(v):
    bag = T.bag_of_words(*graded(v))
    return bag.groupBy("label", "token").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))


@sql_query("t6_naive_bayes_label", bayes("graded", "ungraded", "graded_words"))
def _(v):
    return T.naive_bayes_label(*graded(v), digits=6)


@sql_query("t6_naive_bayes_stems", bayes("graded", "ungraded", "stemmed_graded_words"))
def _(v):
    return T.naive_bayes_label(*graded(v), stems=v.small("stems"), digits=6)


@sql_query("t7_stem_tokens", """
    SELECT coalesce(stem, words.token) AS token, count(*) AS n
    FROM words LEFT JOIN stems ON words.token = stems.token GROUP BY coalesce(stem, words.token)""")
def _(v):
    stemmed = T.stem_tokens(T.tokens(clean_feedback(v.feedback)), v.small("stems"))
    return stemmed.groupBy("token").agg(F.count("*").alias("n"))


@sql_query("j8_unlabelled", "SELECT mobile, text_id FROM rest")
def _(v):
    left = negative(v)
    return J.unlabelled(left, T.rule_labels(left, RULES)).select("mobile", text_id("response").alias("text_id"))


@sql_query("j9_label_reply", """
    SELECT mobile, by_rule.label, coalesce(message, 'none') AS message
    FROM by_rule LEFT JOIN first_reply ON by_rule.label = first_reply.label""")
def _(v):
    labelled = T.rule_labels(negative(v), RULES).select("mobile", "label")
    return J.label_reply(labelled, v.small("replies"))


def reply_sql(words: str) -> str:
    return f"""
    SELECT mobile, p.label, coalesce(message, 'none') AS message
    FROM rest JOIN ({bayes('by_rule', 'rest_texts', words)}) AS p ON rest.text_id = p.text_id
    LEFT JOIN first_reply ON p.label = first_reply.label"""


@sql_query("c6_feedback_reply", reply_sql("rule_words"))
def _(v):
    return feedback_reply(v.feedback, v.small("lexicon"), v.small("replies"), RULES, digits=6)


@sql_query("c6_feedback_reply_stems", reply_sql("stemmed_rule_words"))
def _(v):
    return feedback_reply(v.feedback, v.small("lexicon"), v.small("replies"), RULES, stems=v.small("stems"), digits=6)
