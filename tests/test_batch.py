"""Batch run: dispatch, isolation, repeatability; sources and sinks."""

import datetime as dt

import pytest
from conftest import plan, values
from pyspark.sql import Row
from pyspark.sql import functions as F

from tillsight.plans import batch as B
from tillsight.sources import member_store as MS
from tillsight.sources import readers as SR
from tillsight.sources import writers as SW


@pytest.fixture
def tables(frame):
    questions = frame([("en", t, t) for t in ("Detractor", "Passive", "Promoter")],
                      "language string, type string, question string")
    return {
        "nps": frame([("a", "2"), ("b", "9"), ("c", "9")], "mobile string, response string"),
        "value": frame([("a", 10.0), ("b", 20.0), ("c", 30.0)], "mobile string, value double"),
        "segments": frame([("r1", "a"), ("r1", "a"), ("r1", "b"), ("r2", "c")], "run_id string, mobile string"),
        "questions": questions,
    }


def specs(frame, *lines):
    return B.parse_specs(frame([(line,) for line in lines], "line string"))


CLV = "14,clv,-,Range,0,100,-,,,-,,,value,r1"
NPV = "12,npv,-,Range,0,100,-,,,-,,,value,r2"
NPS = "13,NPS,-,Varchar,,,-,,,-,,,nps,r1"


def test_specs_are_typed(frame):
    row = specs(frame, "16, ticket ,x,Double,0.5,2,U,0.25,10,V,a,,G,r9", "short,one").orderBy("id").collect()
    assert (row[0].name, row[0].start, row[0].start1, row[0].start2, row[0].group, row[0].run_id) == (
        "ticket", 0.5, 0.25, None, "G", "r9")
    assert row[1].run_id is None


def test_run_writes_each_insight_for_its_segment_and_goes_on_after_a_failure(spark, frame, tables, tmp_path):
    path = str(tmp_path)
    lines = specs(frame, CLV, "99,lost,-,Range,0,1,-,,,-,,,g,r1", "19,feedback_message,-,Varchar,,,-,,,-,,,g,r1", NPV, NPS)
    log = B.run_batch(spark, lines, tables, path)
    assert values(log, "insight_id", "status") == [
        ("12", "done"), ("13", "done"), ("14", "done"), ("19", "failed"), ("99", "failed")]
    clv = spark.read.parquet(f"{path}/results/name=clv")
    assert values(clv, "mobile", "value", "insight_group", "run_id") == [("a", "10", "value", "r1"), ("b", "20", "value", "r1")]
    npv = spark.read.parquet(f"{path}/results/name=npv")
    assert values(npv, "mobile", "value") == [("c", "19.5")]
    assert values(spark.read.parquet(f"{path}/results/name=NPS"), "mobile", "value") == [("a", "Detractor"), ("b", "Promoter")]
    assert spark.read.parquet(f"{path}/log").count() == 5


def test_a_second_run_replaces_only_its_own_rows(spark, frame, tables, tmp_path):
    path = str(tmp_path)
    other = CLV.replace("r1", "r2")
    for lines in ((CLV, other), (CLV,)):
        B.run_batch(spark, specs(frame, *lines), tables, path)
    rows = spark.read.parquet(f"{path}/results/name=clv")
    assert values(rows, "mobile", "run_id") == [("a", "r1"), ("b", "r1"), ("c", "r2")]


def run_specs(frame):
    lines = [CLV, CLV.replace("0,100,", "15,100,"), CLV.replace("r1", "r2"), CLV.replace("r1", "empty"), NPV, NPV.replace("r2", "r1"),
             NPS, NPS.replace("r1", "r2")]
    ticket = "16,ticket,-,Double,0,{end},-,{rate},,-,,,value,{run}"
    lines += [ticket.format(end=e, rate=r, run=n) for e, r, n in ((1000, 0.5, "r1"), (1, 0.25, "r2"), (1000, 1, "r2"))]
    return specs(frame, *lines)


@pytest.fixture
def whole(frame, tables):
    tables["txn"] = frame([("a", 1, "2020-01-01", 100.0, 7), ("a", 2, "2020-02-01", 50.0, 9), ("b", 3, "2020-01-05", 20.0, 0),
                           ("c", 4, "2020-01-06", 30.0, 90)],
                          "mobile string, bill bigint, txn_date string, amount double, available bigint")
    tables["member_segments"] = frame([("a", "s1"), ("a", "s2"), ("b", "s1"), ("c", "s3")], "mobile string, segment string")
    return tables


TAGS = ("mobile string, value string", [("a", "x"), ("b", "y"), ("c", "z")])


def test_shared_runs_equal_runs_by_themselves(spark, frame, whole, tmp_path):
    tags = {"r1": {"city": frame(TAGS[1], TAGS[0])}, "r2": {"town": frame(TAGS[1][1:], TAGS[0])}}
    lines = run_specs(frame)
    log = B.run_batch(spark, lines, whole, str(tmp_path), tags=tags)
    assert {r.status for r in log.collect()} == {"done"} and log.count() == 11
    by_run = {}
    for spec in lines.collect():
        rows = B.compute(spec, whole, tags=tags.get(spec.run_id)).collect()
        by_run.setdefault((spec.name, spec.id, spec.run_id), []).extend(rows)
    for (name, insight, run), rows in by_run.items():
        got = spark.read.parquet(f"{tmp_path}/results/name={name}/insight_id={insight}/run_id={run}")
        columns = [c for c in got.columns]
        if rows:
            assert sorted(columns) == sorted(c for c in rows[0].asDict() if c not in ("insight_id", "run_id"))
        assert values(got, *columns) == sorted((tuple(r[c] for c in columns) for r in rows), key=repr), (name, run)


def test_shared_insights_read_the_transactions_once(spark, frame, whole, tmp_path):
    whole["txn"].write.parquet(f"{tmp_path}/txn")
    whole["txn"] = spark.read.parquet(f"{tmp_path}/txn")
    asked = [s for s in run_specs(frame).collect() if s.name == "ticket"]
    assert len(asked) == 3 and len({s.run_id for s in asked}) == 2
    shared = B.compute_shared(asked, B.shared_of(asked[0], B.REGISTRY, whole), whole)
    assert plan(shared).count("FileScan parquet") == 1


def test_a_killed_batch_goes_on_without_doubles(spark, frame, whole, tmp_path, monkeypatch):
    class Killed(BaseException):
        pass

    lines, whole_path, cut_path = run_specs(frame), f"{tmp_path}/whole", f"{tmp_path}/cut"
    B.run_batch(spark, lines, whole, whole_path, batch_id="d1")
    written, noted = [], B.append_run_log
    replace, base = B.replace_run, B.ticket_and_points
    computed = []
    monkeypatch.setattr(B, "ticket_and_points", lambda txn: computed.append(1) or base(txn))

    def replace_some(df, path, insight, run):
        out = replace(df, path, insight, run)
        written.append((insight, run))
        if len(written) in (2, 5):  # the rows are there, the log row is not
            raise Killed
        return out

    monkeypatch.setattr(B, "replace_run", replace_some)
    for _ in range(2):
        with pytest.raises(Killed):
            B.run_batch(spark, lines, whole, cut_path, batch_id="d1")
    assert 0 < len(B.finished_specs(spark, cut_path, "d1")) < 11
    B.run_batch(spark, lines, whole, cut_path, batch_id="d1")
    log = spark.read.parquet(f"{cut_path}/log")
    assert log.count() == 11 and log.select("spec").distinct().count() == 11
    for name in ("clv", "npv", "NPS", "ticket"):
        a, b = (spark.read.parquet(f"{p}/results/name={name}") for p in (whole_path, cut_path))
        assert values(a, *a.columns) == values(b, *a.columns)
    before = len(written)
    assert B.run_batch(spark, lines, whole, cut_path, batch_id="d1").count() == 0 and len(written) == before
    assert B.run_batch(spark, lines, whole, cut_path, batch_id="d2").count() == 11
    assert noted is B.append_run_log


def test_finished_specs_of_a_new_folder(spark, tmp_path):
    assert B.finished_specs(spark, str(tmp_path / "none"), "d1") == set()


def test_dispatch(tables):
    with pytest.raises(LookupError):
        B.dispatch(Row(id="14", name="clv", type="Double"))
    assert B.dispatch(Row(id="77", name="NPS", type="any")) is B.BY_NAME["NPS"]


def test_member_segments_are_added(frame, tables):
    tables["member_segments"] = frame([("a", "s1"), ("a", "s2"), ("z", "s3")], "mobile string, segment string")
    spec = specs(frame, CLV).first()
    assert values(B.compute(spec, tables), "mobile", "segment") == [("a", "s1"), ("a", "s2")]


def test_tags_go_to_results_and_not_to_replies(spark, frame, tables, tmp_path):
    tags = {"r1": {"city": frame([("a", "x"), ("a", "y")], "mobile string, value string")}}
    B.run_batch(spark, specs(frame, CLV, NPS), tables, str(tmp_path), tags=tags)
    assert values(spark.read.parquet(f"{tmp_path}/results/name=clv"), "mobile", "city") == [("a", "y"), ("b", None)]
    assert "city" not in spark.read.parquet(f"{tmp_path}/results/name=NPS").columns


def test_jdbc_options():
    source = SR.Source("jdbc", options={"url": "jdbc:x"}, partition=("id", "1", "9", 4))
    assert SR.jdbc_options(source, "member") == {
        "fetchsize": "10000", "url": "jdbc:x", "dbtable": "member", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "9", "numPartitions": "4"}
    assert SR.jdbc_options(source, "select * from t")["dbtable"] == "(select * from t) AS source_query"
    plain = SR.jdbc_options(SR.Source("jdbc"), "select 1")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    assert SR.keyed_options(SR.Source("kv", options={"a": "b"}), "k", "t") == {"a": "b", "keyspace": "k", "table": "t"}


def test_catalog_source_and_missing_tables(spark, frame, tmp_path):
    frame([("a", 1)], "mobile string, n int").createOrReplaceTempView("feed_view")
    source = SR.Source("catalog")
    assert SR.read_table(spark, source, "feed_view").count() == 1
    assert SR.read_table(spark, source, "select mobile from feed_view where n = 2").count() == 0
    schema = SR.read_table(spark, source, "feed_view").schema
    for missing in (source, SR.Source(base=str(tmp_path))):
        empty = SR.read_or_empty(spark, missing, "no_such_feed", schema)
        assert empty.count() == 0 and empty.columns == ["mobile", "n"]
    with pytest.raises(Exception):
        SR.read_or_empty(spark, source, "select nothing from feed_view", schema)


@pytest.mark.parametrize("keys, parts", [
    ([None] * 30 + [5] * 100 + list(range(60)), 8), (["a'b", "c", None, "ü", "a'b"], 3), ([1, 1, 1], 4), ([None, None], 4), ([], 4),
    ([dt.date(2020, 1, 1) + dt.timedelta(i % 50) for i in range(200)], 5), ([0.5, -1.5, 2.25] * 5, 3)])
def test_splits_cover_every_row_once(spark, keys, parts):
    kind = {str: "string", int: "int", float: "double", dt.date: "date"}[next((type(k) for k in keys if k is not None), int)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"key {kind}, row int")
    df.createOrReplaceTempView("split_view")
    bounds = [r[0] for r in spark.sql(SR.bounds_query("split_view", "key", parts)).collect()]
    assert len(bounds) < parts
    predicates = SR.split_predicates("key", bounds)
    sizes = [df.filter(p).count() for p in predicates]
    seen = sorted(r.row for p in predicates for r in df.filter(p).collect())
    assert seen == list(range(len(keys)))
    filled = [k for k in keys if k is not None]
    if filled:  # no split is larger than its heaviest key and one part
        heaviest = max(filled.count(k) for k in set(filled))
        assert max(sizes[1:]) <= heaviest + len(filled) // parts + 1
    read = SR.read_split(spark, SR.Source("catalog"), "select key, row from split_view", "key", parts)
    assert values(read, "key", "row") == values(df, "key", "row")


@pytest.mark.parametrize("keys", [[None] * 30 + [5] * 100 + list(range(60)), [1, 1, 1], [None]])
def test_cuts_are_those_of_the_query_without_one_task_for_all(spark, monkeypatch, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key int, row int")
    df.createOrReplaceTempView("cut_view")
    want = sorted(r[0] for r in spark.sql(SR.bounds_query("cut_view", "key", 7)).collect())
    assert sorted(SR.bounds(df, "key", 7)) == want
    monkeypatch.setattr(SR, "bounds_query", None)  # its window takes all rows into one task
    assert SR.read_split(spark, SR.Source("catalog"), "cut_view", "key", 4).count() == len(keys)


def test_split_reads_ask_jdbc_for_each_split(spark, monkeypatch, frame):
    asked = {}
    monkeypatch.setattr(SR, "read_table", lambda spark, source, name: frame([(10,), (20,)], "split_key int"))

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    source = SR.Source("jdbc", options={"url": "jdbc:x", "user": "u"}, partition=("a", "0", "9", 3))
    SR.read_split(Session(), source, "select * from feed", "id", 3)
    assert asked == {"url": "jdbc:x", "table": "(select * from feed) AS source_query", "properties": {"fetchsize": "10000", "user": "u"},
                     "predicates": ["id IS NULL", "id < 10", "id >= 10 AND id < 20", "id >= 20"]}
    SR.read_split(Session(), source, "feed", "id", 3)
    assert asked["table"] == "feed"


def test_sources_that_fail_in_their_own_way(spark, frame):
    schema = frame([("a", 1)], "mobile string, n int").schema
    jdbc = SR.Source("jdbc", options={"url": "jdbc:none://nowhere/none"})
    for source, keyspace in ((jdbc, None), (SR.Source("no.such.store"), "feeds")):
        with pytest.warns(UserWarning, match="feed_master"):
            empty = SR.read_or_empty(spark, source, "feed_master", schema, keyspace)
        assert empty.count() == 0 and empty.columns == ["mobile", "n"]


def test_keyed_feeds_of_files(spark, frame, tmp_path):
    df = frame([("a", 1)], "mobile string, n int")
    df.write.parquet(f"{tmp_path}/feeds/master")
    source = SR.Source(base=str(tmp_path))
    assert SR.read_or_empty(spark, source, "master", df.schema, "feeds").count() == 1
    assert SR.read_or_empty(spark, source, "none", df.schema, "feeds").count() == 0


# ---- the store of keyed rows

ROWS = "mobile string, day int, n int"


def store_files(path):
    return {str(f.relative_to(path)) for f in path.rglob("data/**/*.parquet")}


def test_upsert_rewrites_the_touched_buckets_only(spark, frame, tmp_path):
    path = str(tmp_path)
    first = frame([(f"m{i}", 1, i) for i in range(400)] + [(None, 1, -1)], ROWS)
    assert MS.create_store(first, path, ["mobile"], 16) == 1
    before = store_files(tmp_path)
    new = frame([("m7", 2, 70), ("m8", 0, 80), ("fresh", 1, 5), (None, 1, -2), ("m7", 3, 71)], ROWS)
    version, touched = MS.upsert_store(new, path, ["mobile"], "day", 16)
    assert version == 2 and 1 <= len(touched) <= 4
    added = store_files(tmp_path) - before
    assert before <= store_files(tmp_path) and {int(f.split("store_bucket=")[1].split("/")[0]) for f in added} == set(touched)
    got = MS.read_store(spark, path, first.schema)
    want = {**{f"m{i}": (1, i) for i in range(400)}, "m7": (3, 71), "fresh": (1, 5), None: (1, -2)}
    assert {r.mobile: (r.day, r.n) for r in got.collect()} == want and got.count() == len(want)
    assert values(got, "mobile", "day", "n") == values(SW.upsert_latest(first, new, ["mobile"], "day"), "mobile", "day", "n")
    assert MS.read_store(spark, path, first.schema, version=1).count() == 401
    assert MS.upsert_store(new.limit(0), path, ["mobile"], "day", 16) == (2, [])
    assert MS.vacuum(spark, path) == len(touched)
    assert MS.read_store(spark, path, first.schema).count() == len(want)


def test_a_failed_upsert_leaves_the_old_state(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path)
    first = frame([(f"m{i}", 1, i) for i in range(50)], ROWS)
    MS.create_store(first, path, ["mobile"], 4)
    broken = frame([("m1", 2, 9)], ROWS).withColumn("n", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        MS.upsert_store(broken, path, ["mobile"], "day", 4)
    assert values(MS.read_store(spark, path, first.schema), "mobile", "n") == values(first, "mobile", "n")
    (tmp_path / "manifest" / "v-2").mkdir()  # a manifest whose write never ended
    assert MS.read_store(spark, path, first.schema).count() == 50
    assert MS.upsert_store(frame([("m1", 2, 9)], ROWS), path, ["mobile"], "day", 4)[0] == 2
    assert MS.read_store(spark, path, first.schema).filter("mobile = 'm1'").first().n == 9
    with pytest.raises(Exception, match="there is a store"):
        MS.create_store(first, path, ["mobile"], 4)


def test_an_empty_store_is_filled(spark, frame, tmp_path):
    rows = frame([("a", 1, 1)], ROWS)
    MS.create_store(rows.limit(0), str(tmp_path), ["mobile"], 4)
    assert MS.read_store(spark, str(tmp_path), rows.schema).count() == 0
    MS.upsert_store(rows, str(tmp_path), ["mobile"], "day", 4)
    assert values(MS.read_store(spark, str(tmp_path), rows.schema), *rows.columns) == [("a", 1, 1)]


def test_feature_files(frame, spark, tmp_path):
    df = frame([("a", 1.5, None), ("b,c", -2.0, "x y")], "mobile string, n double, t string")
    csv = SR.read_features(spark, SW.write_features(df, str(tmp_path / "csv"), "csv"), df.schema)
    parquet = SR.read_features(spark, SW.write_features(df, str(tmp_path / "pq")))
    assert values(csv, *df.columns) == values(parquet, *df.columns) == values(df, *df.columns)
    SW.write_features(df.limit(1), str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_upsert(frame):
    old = frame([("a", 1, "old"), ("b", 5, "old"), ("c", 2, "old")], "mobile string, at int, v string")
    new = frame([("a", 3, "new"), ("b", 5, "new"), ("d", 1, "new"), ("c", 1, "late")], "mobile string, at int, v string")
    assert values(SW.upsert_latest(old, new, ["mobile"], "at"), "mobile", "v") == [
        ("a", "new"), ("b", "new"), ("c", "old"), ("d", "new")]


def test_append_insight_adds_rows(frame, spark, tmp_path):
    df = frame([("a", "v")], "mobile string, value string").withColumn("insight_id", F.lit("14"))
    for _ in range(2):
        path = SW.append_insight(df, str(tmp_path / "t"))
    assert spark.read.parquet(path).count() == 2


def test_an_empty_rerun_leaves_no_old_rows_and_specs_of_one_id_add_up(spark, frame, tables, tmp_path):
    path = str(tmp_path)
    low, high, none = (CLV.replace("Range,0,100", f"Range,{r}") for r in ("0,15", "16,100", "900,901"))
    assert low != CLV
    B.run_batch(spark, specs(frame, low, high), tables, path)
    folder = f"{path}/results/name=clv"
    assert values(spark.read.parquet(folder), "mobile", "run_id") == [("a", "r1"), ("b", "r1")]
    log = B.run_batch(spark, specs(frame, none), tables, path)
    assert values(log, "status") == [("done",)] and spark.read.parquet(folder).count() == 0
