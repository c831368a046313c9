"""Composite results, recommendation tiers, feedback replies."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import values

from tillsight.operators import joins as J
from tillsight.operators.text import rule
from tillsight.plans import feedback as FB
from tillsight.plans import rules as I
from tillsight.plans import recommend as R


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_nps_reply_covers_all_types_and_languages_and_drops_nulls(frame):
    nps = frame([("a", "3"), ("b", "8"), ("c", "9"), ("d", None), ("e", "no")], "mobile string, response string")
    questions = frame([(lang, t, f"{lang}-{t}") for lang in ("en", "fr") for t in ("Detractor", "Passive", "Promoter")],
                      "language string, type string, question string")
    got = values(I.nps_reply(nps, questions, questions.select("language")), "mobile", "question")
    assert got == [("a", "en-Detractor"), ("a", "fr-Detractor"), ("b", "en-Passive"), ("b", "fr-Passive"),
                   ("c", "en-Promoter"), ("c", "fr-Promoter")]


def test_value_results(frame):
    value = frame([("a", 10.9), ("b", 20.1), ("c", -1.5), ("d", None)], "mobile string, value double")
    assert values(I.clv(value, -1, 10), "mobile", "value") == [("a", 10), ("c", -1)]
    nps = frame([("a", "4"), ("a", "7"), ("x", "9")], "mobile string, response string")
    assert values(I.nps_value(nps, value, 0, 30), "mobile", "value") == [("a", 8.2), ("b", 20.1)]


def test_ticket_plus_points(frame):
    txn = frame([("a", 1, day(0), Decimal(100), 9), ("a", 2, day(5), Decimal(300), 40), ("z", 3, day(1), Decimal(0), 5)],
                "mobile string, bill bigint, txn_date date, amount decimal(18,2), available bigint")
    # 40 points at 0.5 are worth 10 % of the average ticket of 200; a zero ticket has no ratio
    assert values(I.atv_points(txn, 0.5, 10, 10), "mobile", "value") == [("a", 220.0)]
    assert I.atv_points(txn, 0.5, 10.1, 50).count() == 0


@pytest.fixture
def shop(frame):
    purchases = frame([
        ("rep", "i1", day(0), 1), ("rep", "i2", day(3), 1),        # several days, known
        ("old", "zz", day(0), 1), ("old", "yy", day(9), 1),        # several days, unknown items
        ("one", "i1", day(0), 2), ("one", "i3", day(0), 1),        # one day
        ("bag", "Carry Bag", day(4), 1),                           # one day, excluded item only
        ("out", "i1", day(0), 1), ("out", "i2", day(1), 1),        # not a member
    ], "mobile string, item string, txn_date date, qty int")
    members = frame([("rep", "30", "Male"), ("old", "15", "Female"), ("one", "16", "None"), ("bag", "40", "Male"),
                     ("idle", "20", "Male")], "mobile string, age string, gender string")
    favourites = frame([("rep", "i1", 5), ("old", "zz", 2), ("old", "yy", 7), ("one", "i1", 4), ("one", "i3", 4),
                        ("bag", "Carry Bag", 9), (None, "i1", 1), ("one", None, 1)],
                       "mobile string, item string, txns int")
    users = frame([("rep", [1.0, 0.0]), ("one", [1.0, 1.0]), ("out", [0.0, 1.0])], "user string, factors array<double>")
    items = frame([("i1", [9.0, 0.0]), ("i2", [8.0, 1.0]), ("i3", [7.0, 2.0]), ("i4", [7.0, 3.0]), ("i5", [1.0, 9.0])],
                  "item string, factors array<double>")
    return purchases, members, favourites, users, items


def test_recommendation_tiers(shop):
    purchases, members, favourites, users, items = shop
    got = values(R.recommend(purchases, members, favourites, users, items, 2), "mobile", "items", "tier")
    # "one" has an age without a gender, so the overall list; nobody without both feeds it, so that of the tier; same for "bag"
    assert got == [("bag", "i1,i3", "once"), ("old", "yy,zz", "rest"), ("one", "i1,i3", "once"), ("rep", "i3,i4", "repeat")]


def test_one_code_items_only(shop):
    purchases, members, favourites, users, items = shop
    got = R.recommend(purchases, members, favourites, users, items, 2, code_length=(1, 1))
    assert values(got, "mobile", "items", "tier") == [
        ("bag", None, "once"), ("old", None, "rest"), ("one", None, "once"), ("rep", "i3,i4", "repeat")]


def test_purchases_of_a_window_only(shop):
    purchases, members, favourites, users, items = shop
    got = R.recommend(purchases, members, favourites, users, items, 2, window=(str(day(5)), 4))
    # only day 3 and later: "rep" and "old" bought on one day each, "one" not at all
    assert values(got, "mobile", "tier") == [("bag", "once"), ("old", "once"), ("rep", "once")]


@pytest.mark.parametrize("most", [10_000, 0])
def test_nearest_list(frame, monkeypatch, most):
    monkeypatch.setattr(J, "MAX_LISTS", most)
    members = frame([("a", "t", "x"), ("b", "t", "y"), ("c", "u", "x"), ("d", None, "x"), ("e", "u", None)],
                    "mobile string, tier string, cohort string")
    lists = frame([("t", "x", "1"), ("t", None, "2"), (None, None, "3")], "tier string, cohort string, items string")
    assert values(J.cohort_lists(members, lists, ["tier"]), "mobile", "items") == [
        ("a", "1"), ("b", "2"), ("c", "3"), ("d", "3"), ("e", "3")]
    none = J.cohort_lists(members, lists.filter("tier = 't'"), ["tier"])
    assert values(none, "mobile", "items") == [("a", "1"), ("b", "2"), ("c", None), ("d", None), ("e", None)]


def test_cohorts(frame):
    members = frame([("a", "10", "Male"), ("b", "12", "Male"), ("c", None, "Male"), ("d", None, None), ("e", "10", None),
                     ("f", "10", "Male"), ("g", "101", None)], "mobile string, age string, gender string")
    favourites = frame([("a", "x", 1), ("a", "y", 2), ("b", "x", 2), ("c", "z", 9), ("d", "w", 1), ("e", "v", 50),
                        ("f", "Carry Bag", 99), ("g", "u", 1)], "mobile string, item string, txns int")
    got = {m: (c, i) for m, c, i in values(R.cohort_recommend(favourites, members, 2), "mobile", "cohort", "items")}
    assert got["a"] == got["b"] == ("(0-15],Male", "x,y")      # 3 against 2
    assert got["c"] == (",Male", "z,x")                        # gender level counts a and b too
    assert got["d"] == got["g"] == (",", "u,w")                # age out of range counts as unknown
    assert got["e"] == (",", "u,w")                            # age alone feeds nothing and gets the overall list
    assert got["f"] == (",", "u,w")                            # nothing but the excluded item


RULES = (rule("till", "till"), rule("goods", "shirt", "till"))


@pytest.fixture
def feed(frame):
    return frame([
        ("1", "Bad till, slow queue"), ("2", "bad torn SHIRT"), ("3", "bad slow queue!"), ("4", "Bad torn seam 1"),
        ("5", "good till"), ("6", "bad slow queue!"), ("7", "12345"), ("8", None), ("9", "bad"),
    ], "mobile string, response string")


def test_feedback_reply(feed, frame, spark):
    lexicon = spark.sql("select 'bad' token, -0.5 polarity, 0.5 subjectivity union all select 'good', 0.5, 0.5")
    replies = frame([("till", "new till"), ("other", "?")], "type string, message string")
    got = values(FB.feedback_reply(feed, lexicon, replies, RULES), "mobile", "label", "message")
    # 5 is positive, 7 blank, 8 null, 9 too short; copies 3 and 6 both get an answer
    assert got == [("3", "till", "new till"), ("4", "goods", "none"), ("6", "till", "new till")]
    both = FB.feedback_reply(feed, lexicon, replies, RULES, include_rules=True)
    assert [m for m, in values(both, "mobile")] == ["1", "2", "3", "4", "6"]


def test_partitioning_does_not_change_results(shop, feed, frame, spark):
    purchases, members, favourites, users, items = shop
    columns = ("mobile", "items", "tier")
    one = values(R.recommend(*[d.coalesce(1) for d in shop], 2), *columns)
    assert one == values(R.recommend(*[d.repartition(7) for d in shop], 2), *columns)
    lexicon = spark.sql("select 'bad' token, -0.5 polarity, 0.5 subjectivity")
    replies = frame([("till", "new till")], "type string, message string")
    few, many = [values(FB.feedback_reply(f, lexicon, replies, RULES), "mobile", "label")
                 for f in (feed.coalesce(1), feed.repartition(5))]
    assert few == many


def test_favourites_are_computed_once(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    favourites = frame([("a", "x", 1), ("a", "y", 2), ("b", "x", 2), ("c", "z", 9)], "mobile string, item string, txns bigint")
    members = frame([("a", 30, "f", "t1"), ("b", 30, "f", "t2"), ("c", None, None, "t2")], "mobile string, age int, gender string, tier string")
    counting = favourites.mapInArrow(counted, favourites.schema)
    got = R.cohort_recommend(counting, members, 2, within=["tier"], everyone=True)
    assert values(got, "mobile", "items") == [("a", "y,x"), ("b", "x"), ("c", "z")]
    assert seen.value == 4  # each list and the members' lookup computed them again before
