"""Small-frame cases: nulls, ties, duplicates, window edges."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from tillsight.operators import aggregates as A
from tillsight.operators import filters as P
from tillsight.operators import joins as J
from tillsight.operators import ranking as W
from tillsight.operators import rules
from tillsight.operators import sets as U
from tillsight.operators import text as T
from tillsight.operators.rules import as_table, table_labels
from tillsight.operators.text import FEEDBACK_RULES, naive_bayes_label, rule_labels

TXN = ("mobile string, bill bigint, txn_date date, amount decimal(18,2), store bigint, collected bigint, "
       "available bigint, lapsed bigint")


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def txn(frame, rows):
    """(mobile, bill, day, amount, store, available)"""
    return frame([(m, b, day(d), Decimal(amount), s, 1, a, 0) for m, b, d, amount, s, a in rows], TXN)


@pytest.fixture
def history(frame):
    return txn(frame, [
        ("a", 1, 0, 10, 1, 5), ("a", 2, 0, 20, 1, 6), ("a", 3, 10, 30, 2, 7), ("a", 4, 14, 40, 2, 8),
        ("b", 5, 3, 50, 1, 9), ("b", 6, 3, 70, 1, 4), ("c", 7, 5, 1, 1, 0),
    ])


def test_profile(history):
    got = {r.mobile: r for r in A.member_profile(history).collect()}
    assert (got["a"].total_amount, got["a"].total_txn, got["a"].total_visits, got["a"].nstores) == (100.0, 4, 3, 2)
    # the longest gap is the true maximum; two bills on one day are a gap of no days; one bill is none
    assert (got["a"].max_latency, got["b"].max_latency, got["c"].max_latency) == (10, 0, None)
    assert (got["a"].first_date, got["a"].last_date) == (day(0), day(14))


def test_latest_points_keeps_ties_and_the_single_pass_takes_the_largest_bill(history):
    assert values(W.latest_points(history), "mobile", "available") == [("a", 8), ("b", 4), ("b", 9), ("c", 0)]
    assert values(A.ticket_and_points(history), "mobile", "available") == [("a", 8), ("b", 4), ("c", 0)]


def test_visit_gaps(history):
    assert values(W.visit_gaps(history).filter("mobile = 'a'"), "txn_date", "bills", "gap") == [
        (day(0), 2, None), (day(10), 1, 10), (day(14), 1, 4)]


def test_windows_leave_the_edge_days_out(frame):
    df = frame([(n, day(n)) for n in range(0, 31)], "n int, txn_date date")
    asof = str(day(30))
    assert [r.n for r in P.trailing_window(df, "txn_date", asof, 10).orderBy("n").collect()] == list(range(21, 31))
    # day 20 (= asof - cw) is neither observed nor in the churn window
    assert [r.n for r in P.observation_window(df, "txn_date", asof, 15, 10).orderBy("n").collect()] == list(range(6, 20))


def test_baskets_count_null_bills_as_one_and_null_items_as_none(frame):
    sku = frame([("a", None, 1, 2), ("a", None, 1, 3), ("a", None, None, 1), ("a", 9, 1, 1)],
                "mobile string, bill bigint, item bigint, qty bigint")
    assert values(A.basket_totals(sku), "mobile", "uniqueitems", "qty") == [("a", 2, 7)]


def test_departments_of_an_item_listed_twice(frame):
    sku = frame([("a", 1, 7)], "mobile string, bill bigint, item bigint")
    item = frame([(7, "x"), (7, "y"), (8, "x")], "item bigint, department string")
    assert values(A.department_totals(J.sku_department(item, sku)), "mobile", "ndept") == [("a", 2)]


def test_top_n_orders_ties_and_keeps_all_when_n_is_large(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("s"), "id")
    small = W.top_n(df, ["k"], "s", ["id"], 2)
    assert values(small, "k", "rank", "s", "id")[:2] == [(0, 1, 6, 6), (0, 2, 6, 27)]
    # beyond the map-side limit the salted pass must give the same rows as a plain ranking
    large = values(W.top_n(df, ["k"], "s", ["id"], 1500), "k", "rank", "id")
    expected = []
    for k in range(3):
        rows = sorted((i for i in range(6000) if i % 3 == k), key=lambda i: (-(i % 7), i))
        expected += [(k, r + 1, i) for r, i in enumerate(rows[:1500])]
    assert large == sorted(expected, key=repr)


def test_ranked_list_keeps_rank_order(frame):
    df = frame([("u", 2, 10), ("u", 1, 30), ("u", 3, 20), ("u", 4, 40)], "user string, rank int, item int")
    assert values(W.ranked_list(df, "user", "rank", "item", 3), "user", "items") == [("u", "30,10,20")]


def test_scale_scores(frame):
    df = frame([("u", 1.0), ("u", 3.0), ("u", 2.0), ("v", 5.0)], "user string, score double")
    assert values(W.scale_scores(df), "user", "score", "scaled") == [
        ("u", 1.0, 0.0), ("u", 2.0, 0.5), ("u", 3.0, 1.0), ("v", 5.0, 0.0)]


def test_reply_matrix_falls_back_per_type(frame):
    typed = frame([("a", "Passive"), ("b", "Promoter"), ("c", "Other")], "mobile string, type string")
    questions = frame([("en", "Passive", "p?"), ("fr", "Promoter", "q ?"), ("fr", "Passive", "r ?")],
                      "language string, type string, question string")
    got = values(J.reply_matrix(typed, questions, A.distinct_languages(questions)), "mobile", "language", "question")
    assert got == [("a", "en", "p?"), ("a", "fr", "r ?"), ("b", "en", "q ?"), ("b", "fr", "q ?"), ("c", None, None)]


def test_label_reply_takes_one_message_and_a_default(frame):
    df = frame([("a", "x"), ("b", "y")], "mobile string, label string")
    replies = frame([("x", "second"), ("x", "first")], "type string, message string")
    assert values(J.label_reply(df, replies), "mobile", "message") == [("a", "first"), ("b", "none")]


def test_unlabelled_compares_nulls(frame):
    negative = frame([("a", "x"), ("a", "y"), (None, "x")], "mobile string, response string")
    labelled = frame([("a", "x"), (None, "x"), ("a", "x")], "mobile string, response string")
    assert values(J.unlabelled(negative, labelled), "mobile", "response") == [("a", "y")]


def test_tags_do_not_multiply_rows(frame):
    df = frame([("a",), ("b",)], "mobile string")
    tag = frame([("a", 1), ("a", 3)], "mobile string, value int")
    assert values(J.add_tags(df, {"t": tag, "u": tag}), "mobile", "t", "u") == [("a", 3, 3), ("b", None, None)]


def test_sets(frame):
    df = frame([("a",), ("b",), ("c",)], "mobile string")
    assert values(U.uncovered(df, df.filter("mobile = 'a'"), df.filter("mobile = 'c'")), "mobile") == [("b",)]
    segments = frame([("r", "a"), ("r", "a"), ("q", "b")], "run_id string, mobile string")
    assert values(U.segment_members(segments, "r"), "mobile") == [("a",)]


def test_null_columns_and_availability(frame):
    df = frame([("a", None, 1), ("b", None, None)], "Mobile string, empty string, n int")
    assert P.drop_null_columns(df).columns == ["Mobile", "n"]
    assert values(A.non_null_counts(df), "column_name", "non_null") == [("Mobile", 2), ("empty", 0), ("n", 1)]
    assert values(A.column_availability(df, ["mobile", "n", "gone"]), "column_name", "present", "non_null") == [
        ("gone", False, 0), ("mobile", True, 2), ("n", True, 1)]
    none = A.column_availability(df.limit(0), ["mobile", "gone"])
    assert values(none, "column_name", "non_null") == [("gone", 0), ("mobile", 0)]


def test_only_excluded_item(frame):
    fav = frame([("a", "Carry Bag L"), ("b", "Carry Bag"), ("b", "shoe"), ("c", "shoe"), ("d", None)],
                "mobile string, item string")
    assert values(A.only_excluded_item(fav, "Carry Bag"), "mobile", "only_excluded") == [
        ("a", True), ("b", False), ("c", False), ("d", False)]


def test_code_length_and_price_band(frame):
    df = frame([("1",), ("12",), ("123",), (None,)], "item string")
    assert values(P.filter_code_length(df, "item"), "item") == [("1",), ("12",), ("123",)]
    assert values(P.filter_code_length(df, "item", 1, 1), "item") == [("1",)]
    lines = frame([(70.0, 100.0), (69.9, 100.0), (130.0, 100.0), (130.1, 100.0), (None, 1.0)], "net double, value double")
    assert values(P.price_band(lines), "net") == [(130.0,), (70.0,)]


RESPONSES = {
    "staff rude": ["improve staff friendliness"],
    "variety small": ["more variety"],
    "variety staff": ["improve staff friendliness"],
    "size wrong": ["size not available"],
    "bad experience": ["improve experience"],
    "range of products": ["improve range of products"],
    "range price": ["range is high"],
    "sales person": ["issue with sales person"],
    "staff sales person": ["improve staff friendliness", "issue with sales person"],
    "billing counter slow": ["issue at the billing counter"],
    "no discount": ["discount related"],
    "points gone": ["points related"],
    "points variety": ["more variety"],
    "variety issued": ["more variety", "points related"],
    "products break": ["product related issues"],
    "product breaks": [],
    "fine": [],
}


def test_feedback_rules(frame):
    df = frame([(t,) for t in RESPONSES], "response string")
    got = {}
    for response, label in values(T.rule_labels(df), "response", "label"):
        got.setdefault(response, []).append(label)
    assert got == {t: labels for t, labels in RESPONSES.items() if labels}


def test_sentiment_counts_repeats_and_defaults_to_zero(frame):
    df = frame([("a", "bad bad good"), ("b", "bad bad good"), ("c", "plain"), ("d", None)],
               "mobile string, response string")
    lexicon = frame([("bad", -1.0, 1.0), ("good", 0.5, 0.4)], "token string, polarity double, subjectivity double")
    lexicon = lexicon.select("token", *[F.col(c).cast("decimal(6,3)").alias(c) for c in ("polarity", "subjectivity")])
    got = values(T.sentiment(df, lexicon), "mobile", "polarity", "subjectivity")
    assert [(m, round(p, 6), round(s, 6)) for m, p, s in got] == [
        ("a", -0.5, 0.8), ("b", -0.5, 0.8), ("c", 0.0, 0.0), ("d", 0.0, 0.0)]
    assert values(P.negative_only(T.sentiment(df, lexicon)), "mobile") == [("a",), ("b",)]


def test_naive_bayes_against_brute_force(frame):
    import math

    train = [("1", "slow till", "till"), ("2", "slow slow queue", "till"), ("3", "torn shirt", "goods"),
             ("4", "shirt colour", "goods"), ("5", "torn seam", "goods")]
    rest = [("6", "slow shirt till"), ("7", "unheard words"), ("8", "x"), ("9", "torn torn queue")]
    words = {k: [w for w in t.split() if len(w) > 1] for k, t, *_ in train + rest}
    vocabulary = {w for ws in words.values() for w in ws}
    expected = []
    for key, _ in rest:
        scores = {}
        for label in ("goods", "till"):
            mine = [w for k, _, l in train if l == label for w in words[k]]
            prior = math.log(sum(l == label for *_, l in train) / len(train))
            scores[label] = prior + sum(
                math.log((mine.count(w) + 1) / (len(mine) + len(vocabulary))) for w in words[key])
        expected.append((key, max(sorted(scores), key=scores.get)))
    got = T.naive_bayes_label(
        frame(train, "text_id string, response string, label string"), frame(rest, "text_id string, response string"))
    assert values(got, "text_id", "label") == expected


def test_rare_terms_never_shuffle(spark):
    rare = spark.range(50_000).select(F.concat(F.lit("rare"), F.col("id")).alias("token"))
    often = spark.range(3_000).select(F.concat(F.lit("often"), F.col("id") % 30).alias("token"))
    nulls = spark.range(40).select(F.lit(None).cast("string").alias("token"))
    rows = rare.union(often).union(nulls)
    left = T.maybe_frequent(rows, 15).groupBy(F.col("token").startswith("often").alias("often")).count().collect()
    left = {r.often: r["count"] for r in left}
    assert left[True] == 3_000 and left[None] == 40 and left.get(False, 0) < 100  # at most what shares a bucket with a frequent token
    found = T.frequent_terms(rows, 15, 100).collect()
    assert [tuple(r) for r in found] == sorted((f"often{i}", 100) for i in range(30)) + [(None, 40)]
    assert T.frequent_terms(rows, 101, 100).count() == 0
    assert T.frequent_terms(rows.limit(0), 2, 5).count() == 0


def test_frequent_terms_and_stems(frame):
    rows = frame([("aa",)] * 3 + [("bb",)] * 2 + [("cc",)] * 2 + [("dd",)], "token string")
    assert [tuple(r) for r in T.frequent_terms(rows, 2, 2).collect()] == [("aa", 3), ("bb", 2)]
    nouns = frame([("cc",), ("dd",)], "token string")
    assert [tuple(r) for r in T.frequent_nouns(rows, nouns, 5, 2).collect()] == [("cc", 2)]
    stems = frame([("bb", "aa"), ("bb", "zz")], "token string, stem string")
    assert values(T.stem_tokens(rows, stems).groupBy("token").count(), "token", "count") == [
        ("aa", 5), ("cc", 2), ("dd", 1)]


def test_reply_matrix_keeps_members_without_any_question(frame):
    typed = frame([("a", "Promoter"), ("b", "Other")], "mobile string, type string")
    questions = frame([("Promoter", "en", "why?")], "type string, language string, question string")
    got = values(J.reply_matrix(typed, questions, A.distinct_languages(questions)), "mobile", "language", "question")
    assert got == [("a", "en", "why?"), ("b", None, None)]


def naive_labels(texts, rules):
    return sorted({(mobile, label) for mobile, text in texts if text is not None for label, required, forbidden in rules
                   if all(w in text for w in required) and not any(w in text for w in forbidden)})


def test_rules_as_a_table_equal_every_rule_tried(spark):
    rng = random.Random(8)
    letters = "abcdé "
    texts = [(f"m{i}", "".join(rng.choices(letters, k=rng.randrange(0, 60)))) for i in range(120)]
    texts += [("copy", texts[0][1]), ("none", None), ("empty", ""), ("long", "abc" * 20_000 + "zzé"), ("m1", texts[2][1])]

    def word():
        return "".join(rng.choices("abcdé", k=rng.randrange(1, 6)))

    rules = [(f"l{i % 40}", [word() for _ in range(rng.randrange(1, 4))], [word() for _ in range(rng.randrange(0, 3))]) for i in range(400)]
    rules += [("end", ["zzé"], []), ("nowhere", ["qqq"], []), ("contrary", ["ab"], ["ab"]), ("twice", ["ab", "ab"], ["zzzz"]), ("plain", ["b"], None)]
    df = spark.createDataFrame(texts, "mobile string, response string")
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)],
                                  "rule_id int, label string, required array<string>, forbidden array<string>")
    got = table_labels(df, table)
    assert got.columns == ["mobile", "response", "label"]
    want = [(mobile, label) for row, (mobile, text) in enumerate(texts)
            for _, label in naive_labels([(row, text)], [(a, b, c or []) for a, b, c in rules])]
    assert values(got, "mobile", "label") == sorted(want, key=repr)


def test_the_fixed_rules_as_a_table(spark):
    texts = ["staff is rude", "size and variety", "the price range is high", "range of products", "billing counter", "points issued late", None,
             "experience with staff", "discount on size", "Staff", "product quality of products", "sale person"]
    df = spark.createDataFrame(list(enumerate(texts)), "mobile int, response string")
    assert values(table_labels(df, as_table(spark, FEEDBACK_RULES)), "mobile", "label") == values(rule_labels(df), "mobile", "label")


def test_rules_are_tried_where_the_texts_lie(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "ab cd"), (2, "cd"), (3, None)], "mobile int, response string")
    table = spark.createDataFrame([(i, f"l{i % 3}", [w], ["x", None, ""]) for i, w in enumerate(("ab", "cd", "ef", "cd", "a", "b", None)) if w]
                                  + [(None, "never", ["ab"], None), (9, "both", ["ab"], None), (9, "both", ["cd"], None)],
                                  "rule_id int, label string, required array<string>, forbidden array<string>")
    want = [(1, "both"), (1, "l0"), (1, "l1"), (1, "l2"), (2, "l0"), (2, "l1")]
    assert "Exchange" not in plan(table_labels(texts, table))
    assert values(table_labels(texts, table), "mobile", "label") == want
    monkeypatch.setattr(rules, "BLOCK_RULES", 2)  # the same from several blocks
    assert values(table_labels(texts, table), "mobile", "label") == want


def test_rules_without_required_words_are_refused(spark):
    df = spark.createDataFrame([("a", "x")], "mobile string, response string")
    for required in ([], None, [""], [None]):
        table = spark.createDataFrame([(1, "l", required, ["x"])], "rule_id int, label string, required array<string>, forbidden array<string>")
        with pytest.raises(ValueError, match="required"):
            table_labels(df, table)


def test_the_classifier_learns_stems(spark):
    train = spark.createDataFrame([("1", "till broken", "till"), ("2", "shirt torn", "goods")], "text_id string, response string, label string")
    rest = spark.createDataFrame([("3", "tills tills torn")], "text_id string, response string")
    stems = spark.createDataFrame([("tills", "till"), ("tills", "tillx")], "token string, stem string")
    assert values(naive_bayes_label(train, rest), "label") == [("goods",)]
    assert values(naive_bayes_label(train, rest, stems=stems), "label") == [("till",)]


def test_naive_bayes_rare_and_frequent_tokens_score_alike(frame, monkeypatch):
    """Rare tokens meet their weights by a shuffle, frequent ones by a broadcast: scores are those of either way alone."""
    train = frame([("a", "till queue queue was", "slow"), ("b", "till fine fine are", "good"), ("c", None, "good"), ("d", "odd", None)],
                  "text_id string, response string, label string")
    rest = frame([("x", "queue queue till odd unheard"), ("y", "fine are till are till"), ("y", "queue"), ("z", None), (None, "till")],
                 "text_id string, response string")
    stems = frame([("are", "was"), ("unheard", "queue")], "token string, stem string")
    for lookup in (None, stems):
        found = []
        for terms in (1, 6, 1 << 18):  # none, some and all tokens are frequent
            monkeypatch.setattr(T, "COMMON_TERMS", terms)
            found.append(values(T.naive_bayes_scores(train, rest, stems=lookup).selectExpr("text_id", "label", "round(score, 9) AS score"),
                                "text_id", "label", "score"))
        assert found[0] == found[1] == found[2] and len(found[0]) == 5 * 3


def test_naive_bayes_shuffles_no_row_per_text_and_token(spark, monkeypatch, no_broadcast):
    train = spark.range(200).selectExpr("cast(id AS string) AS text_id", "concat('till queue w', id % 7) AS response", "cast(id % 2 AS string) AS label")
    rest = spark.range(300).selectExpr("cast(id AS string) AS text_id", "concat('till queue w', id % 9, ' z', id) AS response")
    counts = T.token_counts(train, rest)
    _, weights = T.class_statistics(train, counts)
    monkeypatch.setattr(T, "COMMON_TERMS", 100)
    text = plan(T.weighed_tokens(rest, "text_id", counts, weights)).replace("\n", " ")
    assert "BroadcastHashJoin" in text and "HashAggregate(keys=[text_id" not in text
