"""Batch run: insight specs, dispatch, segment restriction, writing, failure isolation, restart.

Insights that look at one member at a time are computed once for all runs: the base rows of every
member in any run, then a row per member, run and spec, from which each spec takes its own. Insights that
learn from their segment, such as replies and recommendations, are computed run by run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.scalars import blend, points_share, ticket_plus_points
from tillsight.operators.aggregates import mean_response, ticket_and_points
from tillsight.operators.filters import stamp_insight
from tillsight.operators.joins import add_segment_columns, add_tags, join_response, restrict_to_segment
from tillsight.operators.sets import segment_members
from tillsight.plans.churn import churn_features, score_churn
from tillsight.plans.feedback import feedback_reply
from tillsight.plans.rules import atv_points, clv, default_value, nps_reply, nps_value
from tillsight.plans.recommend import atv_points_recommend, recommend
from tillsight.sources.writers import append_run_log, replace_run

# The 14 comma-separated fields of a spec, in order.
SPEC_FIELDS = (
    "id", "name", "unused", "type", "start", "end", "unit", "start1", "end1", "unit1",
    "start2", "end2", "group", "run_id",
)
LOG_SCHEMA = "batch_id string, spec string, run_id string, insight_id string, status string, error string"

Insight = Callable[[Mapping[str, DataFrame], Row], DataFrame]


def parse_specs(lines: DataFrame, column: str = "line") -> DataFrame:
    """Typed spec rows from comma-separated text."""
    parts = F.split(column, ",")
    fields = [F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(name) for i, name in enumerate(SPEC_FIELDS)]
    specs = lines.select(*fields).drop("unused")
    numbers = ("start", "end", "start1", "end1", "start2", "end2")
    return specs.withColumns({c: F.col(c).try_cast("double") for c in numbers})


def _value(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["value"] if "value" in tables else default_value(tables["txn"])


def _nps(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    reply = nps_reply(tables["nps"], tables["questions"], tables["questions"].select("language"))
    return reply.select("mobile", F.col("question").alias("value"), "language")


def _feedback(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    options = {"rules": tables["rules"]} if "rules" in tables else {}
    reply = feedback_reply(tables["feedback"], tables["lexicon"], tables["replies"], **options)
    return reply.select("mobile", F.col("message").alias("value"))


def _clv(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    return clv(_value(tables), spec.start, spec.end)


def _nps_value(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    return nps_value(tables["nps"], _value(tables), spec.start, spec.end)


def _atv_points(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    """With factors among the tables the value turns into recommendations, ``end1`` of them."""
    if "users" not in tables:
        return atv_points(tables["txn"], spec.start1, spec.start, spec.end)
    lists = atv_points_recommend(
        tables["txn"], tables["sku"], tables["member"], tables["favourites"], tables["users"], tables["items"],
        spec.start1, spec.start, spec.end, int(spec.end1),
    )
    return lists.select("mobile", F.col("items").alias("value"))


def _churn(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    """Prediction of the saved model in ``churn_model`` at ``churn_asof``, over the last ``start`` days."""
    features = churn_features(tables["txn"], tables["sku"], tables["item"], tables["member"], tables["store"],
                              tables["churn_asof"], int(spec.start))
    scored = score_churn(features, tables["churn_model"])
    return scored.select("mobile", F.col("prediction").alias("value"))


def _recommend(tables: Mapping[str, DataFrame], spec: Row) -> DataFrame:
    """``end1`` items per buyer, from the purchases of the last ``start`` days before ``recommend_asof`` if there is one."""
    window = (tables["recommend_asof"], int(spec.start)) if "recommend_asof" in tables else None
    lists = recommend(tables["sku"], tables["member"], tables["favourites"], tables["users"], tables["items"],
                      int(spec.end1), window=window)
    return lists.select("mobile", F.col("items").alias("value"))


# Insights that look at one member at a time: rows of all members, and what a spec takes of them. The
# columns of the spec stand beside the member's as s_start, s_end and so on.


def _value_base(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _value(tables).select("mobile", F.col("value").cast("bigint").alias("value"))


def _nps_value_base(tables: Mapping[str, DataFrame]) -> DataFrame:
    joined = join_response(mean_response(tables["nps"]), _value(tables))
    return joined.select("mobile", blend("response", "value").alias("value"))


def _reply_base(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _nps(tables, None)


def _ticket_base(tables: Mapping[str, DataFrame]) -> DataFrame:
    if "users" in tables:
        raise NotImplementedError("recommendations learn from their segment")
    return ticket_and_points(tables["txn"])


def _in_range(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("value").between(F.col("s_start"), F.col("s_end")))


def _ticket(rows: DataFrame) -> DataFrame:
    rate = F.col("s_start1")
    chosen = rows.filter(points_share("atv", "available", rate).between(F.col("s_start"), F.col("s_end")))
    return chosen.withColumn("value", ticket_plus_points("atv", "available", rate)).drop("atv", "available")


@dataclass(frozen=True)
class Shared:
    """An insight of single members, computed once for all runs."""

    base: Callable[[Mapping[str, DataFrame]], DataFrame]
    take: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Registration:
    """An insight function, the spec types it may be asked for, and how to share it between runs if it can be."""

    types: tuple[str, ...]
    run: Insight
    shared: Shared | None = None


RANGE = ("Varchar", "Range")
REPLY = Shared(_reply_base, lambda rows: rows)
# Insight ids and the types they are dispatched under.
REGISTRY: dict[str, Registration] = {
    "12": Registration(RANGE, _nps_value, Shared(_nps_value_base, _in_range)),
    "13": Registration(RANGE, _nps, REPLY),
    "14": Registration(RANGE, _clv, Shared(_value_base, _in_range)),
    "16": Registration(("Double",), _atv_points, Shared(_ticket_base, _ticket)),
    "19": Registration(RANGE, _feedback),
}
# Names that select an insight whatever its id and type.
BY_NAME = {"NPS": _nps, "feedback_message": _feedback, "probable_churn": _churn, "recommendation": _recommend}
SHARED_BY_NAME = {"NPS": REPLY}


def dispatch(spec: Row, registry: Mapping[str, Registration] = REGISTRY) -> Insight:
    """Function of a spec, by name first, then by id and type."""
    if spec.name in BY_NAME:
        return BY_NAME[spec.name]
    entry = registry.get(spec.id)
    if entry is None or spec.type not in entry.types:
        raise LookupError(f"no insight {spec.id} of type {spec.type}")
    return entry.run


def shared_of(spec: Row, registry: Mapping[str, Registration], tables: Mapping[str, DataFrame]) -> Shared | None:
    """How the spec's insight is shared between runs, if it is."""
    dispatch(spec, registry)  # an unknown insight fails here
    if spec.name in BY_NAME:
        return SHARED_BY_NAME.get(spec.name)
    found = registry[spec.id].shared
    return None if found is not None and found.base is _ticket_base and "users" in tables else found


def _restricted(tables: Mapping[str, DataFrame], members: DataFrame) -> dict:
    """Tables with the rows of the members; the rule list, models and dates are data, not tables."""
    return {
        name: restrict_to_segment(table, members)
        if isinstance(table, DataFrame) and "mobile" in table.columns and name != "segments" else table
        for name, table in tables.items()
    }


def _finished(result: DataFrame, tables: Mapping[str, DataFrame], insight_name: str) -> DataFrame:
    if "member_segments" in tables:
        result = add_segment_columns(result, tables["member_segments"])
    return result.withColumns({"value": F.col("value").cast("string"), "insight_name": F.lit(insight_name)})


def compute(spec: Row, tables: Mapping[str, DataFrame], registry: Mapping[str, Registration] = REGISTRY,
            tags: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One insight for the members of the run's segments, stamped with insight and run.

    Every insight starts from the base tables; none sees what another one left behind. Tags go to
    the results dispatched by id, not to the replies selected by name.
    """
    result = dispatch(spec, registry)(_restricted(tables, segment_members(tables["segments"], spec.run_id)), spec)
    if spec.name not in BY_NAME:
        result = add_tags(result, tags or {})
    result = _finished(result, tables, spec.name)
    return stamp_insight(result, spec.id, spec.group).withColumn("run_id", F.lit(spec.run_id))


def compute_shared(specs: list[Row], shared: Shared, tables: Mapping[str, DataFrame],
                   tags: Mapping[str, Mapping[str, DataFrame]] | None = None) -> DataFrame:
    """The rows ``compute`` gives for each of the specs of one name and id, from one pass over the base tables.

    Tag columns are those of all runs; a run without one of them has nulls there.
    """
    first, spark = specs[0], tables["segments"].sparkSession
    numbers = ("start", "end", "start1", "end1", "start2", "end2")
    asked = spark.createDataFrame(
        [(s.run_id, i, s.group, *[s[c] for c in numbers]) for i, s in enumerate(specs)],
        "run_id string, spec_no int, insight_group string, " + ", ".join(f"s_{c} double" for c in numbers))
    members = restrict_runs(tables["segments"], [s.run_id for s in specs])
    base = shared.base(_restricted(tables, members.select("mobile").distinct()))
    rows = shared.take(base.join(members, "mobile").join(asked, "run_id"))
    if first.name not in BY_NAME and tags:
        rows = add_run_tags(rows, tags, [s.run_id for s in specs])
    result = _finished(rows, tables, first.name).drop(*[f"s_{c}" for c in numbers], "spec_no")
    return result.withColumn("insight_id", F.lit(first.id))


def restrict_runs(segments: DataFrame, runs: list[str]) -> DataFrame:
    """Distinct (mobile, run_id) of the runs."""
    return segments.filter(F.col("run_id").isin(sorted(set(runs)))).select("mobile", "run_id").distinct()


def add_run_tags(rows: DataFrame, tags: Mapping[str, Mapping[str, DataFrame]], runs: list[str]) -> DataFrame:
    """One column per tag name; a run's rows get the values of the run's own tag tables."""
    names = sorted({name for run in set(runs) for name in tags.get(run, {})})
    for name in names:
        parts = [tags[run][name].select(F.lit(run).alias("run_id"), "mobile", "value")
                 for run in sorted(set(runs)) if name in tags.get(run, {})]
        single = reduce(DataFrame.unionByName, parts).groupBy("run_id", "mobile").agg(F.max("value").alias(name))
        rows = rows.join(single, ["run_id", "mobile"], "left")
    return rows


def spec_key(spec: Row) -> str:
    """Text that tells one spec from all others of a batch."""
    return "|".join("" if value is None else str(value) for value in spec)


def finished_specs(spark: SparkSession, path: str, batch_id: str) -> set[str]:
    """Specs whose rows were written and noted in an earlier attempt of the batch."""
    try:
        log = spark.read.schema(f"{LOG_SCHEMA}, ts timestamp").parquet(f"{path}/log")
        done = log.filter((F.col("batch_id") == batch_id) & (F.col("status") == "done"))
        return {row["spec"] for row in done.select("spec").collect()}  # no more rows than the batch has specs
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def run_batch(spark: SparkSession, specs: DataFrame, tables: Mapping[str, DataFrame], path: str,
              registry: Mapping[str, Registration] = REGISTRY,
              tags: Mapping[str, Mapping[str, DataFrame]] | None = None, batch_id: str | None = None) -> DataFrame:
    """Compute and write every spec, and return the run log.

    The specs are a control list of a few rows, which the driver walks; ``tags`` holds the tag
    tables by run. Specs of one name, id and run are written together. A failing insight leaves a
    log row and the run goes on; running again replaces the rows of the run, also by none.

    A name and id that several runs ask for is computed once for all of them and staged below
    ``path/staging``. With a ``batch_id`` a batch that was killed can be started again: specs noted as done
    are left out, what was staged whole is used, and the rest is written over whatever a
    half-finished write has left.
    """
    log, by_insight = [], {}
    finished = finished_specs(spark, path, batch_id) if batch_id else set()

    def note(members, error=None):
        text = error and (str(error) or type(error).__name__).splitlines()[0]
        rows = [(batch_id, spec_key(s), s.run_id, s.id, "failed" if error else "done", text) for s in members]
        append_run_log(spark.createDataFrame(rows, LOG_SCHEMA).withColumn("ts", F.current_timestamp()), f"{path}/log")
        log.extend(rows)

    for spec in specs.collect():
        if spec_key(spec) not in finished:
            by_insight.setdefault((spec.name, spec.id), []).append(spec)
    for (name, insight_id), members in by_insight.items():
        runs: dict[str, list[Row]] = {}
        for spec in members:
            runs.setdefault(spec.run_id, []).append(spec)
        staged = None
        try:
            shared = shared_of(members[0], registry, tables)
            alike = all(registry[s.id].types == registry[members[0].id].types and s.type in registry[s.id].types
                        for s in members) if name not in BY_NAME else True
            if shared is not None and alike and len(runs) > 1:
                staged = _staged(spark, members, shared, tables, tags, f"{path}/staging", batch_id)
        except Exception:  # found again, spec by spec, below
            staged = None
        for run_id, own in runs.items():
            _write_run(own, staged, tables, registry, (tags or {}).get(run_id), path, note)
    return spark.createDataFrame(log, LOG_SCHEMA).withColumn("ts", F.current_timestamp())


def _staged(spark, specs, shared, tables, tags, path, batch_id) -> DataFrame:
    """The rows of all runs of a shared insight, written by run; those of an earlier attempt if they are whole."""
    result = compute_shared(specs, shared, tables, tags)
    token = batch_id or spark.range(1).select(F.uuid().alias("id")).first()["id"]
    keys = "".join(sorted(spec_key(s) for s in specs))
    folder = f"{path}/batch={quote(token, safe='')}/{quote(specs[0].name, safe='')}-{quote(specs[0].id, safe='')}-{hash_text(keys)}"
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        result.write.mode("overwrite").partitionBy("run_id").parquet(folder)
    return spark.read.schema(result.schema).parquet(folder)


def hash_text(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()[:16]


def _write_run(specs, staged, tables, registry, tags, path, note) -> None:
    """Write the rows of the specs of one name, id and run over what is there, and note each spec."""
    done, result = [], None
    if staged is not None:
        done, result = specs, staged.filter(F.col("run_id") == specs[0].run_id)
        kept = set(tags or {})
        known = {"mobile", "value", "language", "segment", "insight_name", "insight_group", "insight_id", "run_id"}
        result = result.select([c for c in result.columns if c in known or c in kept])
    else:
        for spec in specs:
            try:
                part = compute(spec, tables, registry, tags)
                result = part if result is None else result.unionByName(part, allowMissingColumns=True)
                done.append(spec)
            except Exception as error:  # any insight may fail in its own way; the others must run
                note([spec], error)
    if result is None:
        return
    try:
        replace_run(result, f"{path}/results/name={specs[0].name}", specs[0].id, specs[0].run_id)
    except Exception as error:  # found out only when the rows are computed
        note(done, error)
    else:
        note(done)
