"""Segment bitmaps, monthly visit states and held-out areas against their plain counterparts."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight.functions.scalars import hash_below
from tillsight.operators import aggregates as A
from tillsight.operators import bitmaps as B
from tillsight.operators import visits as V
from tillsight.operators.evaluation import held_out_auc
from tillsight.operators.joins import sku_department
from tillsight.session import settle


EDGES = (0, 32767, 32768, 65535, 65536, 99999)


@pytest.fixture(scope="module")
def groups(spark):
    """Overlapping groups of 100,000 members, whose numbers fill more than three buckets."""
    people = spark.range(100_000).select(F.format_string("%06d", "id").alias("mobile"), "id")
    rules = {"all": ("true", lambda i: True), "even": ("id % 2 = 0", lambda i: i % 2 == 0),
             "third": ("id % 3 = 0", lambda i: i % 3 == 0), "late": ("id >= 70000", lambda i: i >= 70000),
             "none": ("false", lambda i: False),
             "edge": (f"id in {EDGES}", lambda i: i in EDGES)}
    rows = None
    for name, (rule, _) in rules.items():
        part = people.filter(rule).select(F.lit(name).alias("segment"), "mobile")
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.unionByName(rows.filter("segment = 'edge'")).unionByName(spark.createDataFrame([("edge", None)], "segment string, mobile string"))
    numbers = settle(B.member_numbers(rows), "numbers")
    sets = {name: {f"{i:06d}" for i in range(100_000) if holds(i)} for name, (_, holds) in rules.items()}
    return settle(B.segment_bitmaps(rows, numbers), "bitmaps"), numbers, sets


def test_sizes_and_overlaps(groups):
    bitmaps, _, sets = groups
    assert bitmaps.select("bucket").distinct().count() == 4
    assert dict(values(B.sizes(bitmaps), "segment", "members")) == {n: len(s) for n, s in sets.items() if s}
    names = sorted(n for n in sets if sets[n])
    wanted = [(a, b, len(sets[a] & sets[b])) for a in names for b in names if a < b and sets[a] & sets[b]]
    assert values(B.overlaps(bitmaps), "a", "b", "members") == wanted


def test_set_operations(groups):
    bitmaps, numbers, sets = groups

    def members(df):
        return {m for _, m in values(B.members_of(df, numbers), "segment", "mobile")}

    assert members(B.union(bitmaps, ["even", "late", "none"], "x")) == sets["even"] | sets["late"]
    assert members(B.intersection(bitmaps, ["even", "third", "late"], "x")) == sets["even"] & sets["third"] & sets["late"]
    assert members(B.intersection(bitmaps, ["even", "none"], "x")) == set()
    assert members(B.difference(bitmaps, "edge", ["late", "even"], "x")) == sets["edge"] - sets["late"] - sets["even"]
    assert members(B.difference(bitmaps, "edge", ["none"], "x")) == sets["edge"]
    assert members(B.difference(bitmaps, "edge", ["all"], "x")) == set()


def test_merge_adds_members(spark, groups):
    bitmaps, numbers, sets = groups
    new = spark.createDataFrame([("edge", "000001"), ("new", "050000"), ("new", "stranger")], "segment string, mobile string")
    both = B.merge(bitmaps, B.segment_bitmaps(new, numbers))
    assert dict(values(B.sizes(both), "segment", "members")) == {
        **{n: len(s) for n, s in sets.items() if s}, "edge": 7, "new": 1}


DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def history(spark):
    """Visits of a year; some bills lie on several days and in several months, some members come on one day only."""
    rng = random.Random(4)
    txn, sku = [], []
    for bill in range(900):
        member = rng.choice([None, "once", *[f"m{i}" for i in range(12)]])
        days = [rng.randrange(366)] if member != "once" else [100]
        if rng.random() < 0.2:
            days += [rng.randrange(366) for _ in range(rng.randrange(1, 4))]
        for n in days:
            day = DAY + dt.timedelta(n) if rng.random() > 0.02 else None
            txn.append((member, bill % 700 if rng.random() > 0.02 else None, day, Decimal(rng.randrange(100)), rng.choice([1, 2, 3, None]),
                        rng.randrange(9), rng.randrange(9), rng.randrange(9)))
            sku += [(member, bill % 700, rng.choice([1, 2, 3, 4, None, 99]), rng.randrange(5), day) for _ in range(rng.randrange(4))]
    txn = spark.createDataFrame(txn, "mobile string, bill bigint, txn_date date, amount decimal(18,2), store bigint, "
                                     "collected bigint, available bigint, lapsed bigint")
    sku = spark.createDataFrame(sku, "mobile string, bill bigint, item int, qty bigint, txn_date date")
    item = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "item int, department string")
    return txn, sku, item


@pytest.fixture(scope="module")
def states(history, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states") / "all")
    V.write_states(*history, path)
    return path


PERIODS = [(-1, None), (-1, 400), (30, 60), (31, 60), (14, 20), (14, 45), (20, 200), (59, 61), (30, 31), (365, None), (90, 91)]


@pytest.mark.parametrize("after, before", PERIODS)
def test_profiles_from_states(spark, history, states, after, before):
    txn, sku, item = history
    low, high = DAY + dt.timedelta(after), DAY + dt.timedelta(before) if before is not None else None
    period = V.Period(low, high)

    def window(df):
        kept = df.filter((F.col("txn_date") > F.lit(low)) & F.col("mobile").isNotNull())
        return kept if high is None else kept.filter(F.col("txn_date") < F.lit(high))

    plain = A.member_profile(window(txn))
    assert values(V.profile(spark, states, txn, period), *plain.columns) == values(plain, *plain.columns)
    lines = A.basket_totals(window(sku)).join(A.department_totals(sku_department(item, window(sku))), "mobile", "left")
    got = V.baskets(spark, states, sku, item, period)
    assert values(got.fillna(0), "mobile", "uniqueitems", "qty", "ndept") == values(lines.fillna(0), "mobile", "uniqueitems", "qty", "ndept")
    assert values(V.seen(spark, states, txn, period), "mobile") == values(window(txn).select("mobile").distinct(), "mobile")


def test_only_edge_days_are_read_again(history):
    txn, _, _ = history
    period = V.Period(DAY + dt.timedelta(20), DAY + dt.timedelta(200))
    days = {d for d, in values(period.edges(txn), "txn_date")}
    assert days and all(d < dt.date(2020, 2, 1) or d >= dt.date(2020, 7, 1) for d in days)


def test_held_out_areas_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    u, v = rng.normal(size=(30, 4)).round(1), rng.normal(size=(25, 4)).round(1)
    v[7] = v[8]  # equal scores
    users = spark.createDataFrame([(f"u{i:02d}", x.tolist()) for i, x in enumerate(u)], "user string, factors array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item bigint, factors array<double>")
    bought = {(f"u{int(a):02d}", int(b)) for a, b in zip(rng.integers(0, 32, 260), rng.integers(0, 27, 260), strict=True)}
    bought |= {("u03", i) for i in range(25)}  # nothing left unbought
    pairs = spark.createDataFrame([(a, b, 2) for a, b in bought] + [("u01", 0, 0)], "user string, item bigint, qty bigint")
    held = {(r.user, r.item) for r in pairs.filter(hash_below(0.3, "user", "item") & (F.col("qty") != 0)).collect()}
    known = {(a, b) for a, b in bought if int(a[1:]) < 30 and b < 25}
    popularity = [sum(b == i for _, b in known) for i in range(25)]

    def area(name, score):
        own = [score[i] for a, i in known & held if a == name]
        others = [score[i] for i in range(25) if (name, i) not in known]
        pairs = [(s > t) + (s == t) / 2 for s in own for t in others]
        return sum(pairs) / len(pairs) if pairs else None

    for block in (65536, 8):
        got = {r.user: r for r in held_out_auc(users, items, pairs, 0.3, block=block).collect()}
        assert set(got) == {a for a, _ in known & held} and got["u03"].auc is None
        for name, row in got.items():
            score = (u[int(name[1:])].astype(np.float32).astype(float) @ v.astype(np.float32).astype(float).T).round(9)
            assert row.held == sum(a == name for a, _ in known & held)
            if row.auc is not None:
                assert row.auc == pytest.approx(area(name, score)) and row.popularity_auc == pytest.approx(area(name, popularity))
