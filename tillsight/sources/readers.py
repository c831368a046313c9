"""Table, key-value and file readers."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from itertools import pairwise

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillsight.session import settle

# The error conditions that mean "no such table".
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@dataclass(frozen=True)
class Source:
    """Where tables live: a format, its options, and for file formats a base folder.

    For JDBC, ``partition`` is (column, lower, upper, parts): without it Spark reads a table
    through one connection.
    """

    format: str = "parquet"
    base: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partition: tuple[str, str, str, int] | None = None
    fetch_size: int = 10000


def is_query(name: str) -> bool:
    """A name with white space is a query, not a table."""
    return len(name.split()) > 1


def jdbc_options(source: Source, name: str) -> dict[str, str]:
    """JDBC options of a table or query read."""
    options = {"fetchsize": str(source.fetch_size), **source.options}
    if source.partition:
        # Spark partitions only table reads, so a query is read as a derived table
        column, lower, upper, parts = source.partition
        options["dbtable"] = f"({name}) AS source_query" if is_query(name) else name
        options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(parts)}
    else:
        options["query" if is_query(name) else "dbtable"] = name
    return options


def bounds_query(name: str, column: str, parts: int) -> str:
    """Query for the keys that cut a table or query into ``parts`` of equal depth: fewer than ``parts`` rows come back."""
    table = f"({name}) AS source_query" if is_query(name) else name
    return (f"SELECT DISTINCT split_key FROM (SELECT {column} AS split_key, row_number() OVER (ORDER BY {column}) AS place, "
            f"count(*) OVER () AS total FROM {table} WHERE {column} IS NOT NULL) AS numbered "
            f"WHERE place > 1 AND floor((place - 1) * {parts} / total) > floor((place - 2) * {parts} / total)")


def literal(value) -> str:
    """A key as SQL text."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, (date, datetime)):
        return f"{'TIMESTAMP' if isinstance(value, datetime) else 'DATE'} '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def split_predicates(column: str, bounds: Iterable) -> list[str]:
    """Conditions that give every row to exactly one split: nulls to one, then the ranges between the sorted bounds.

    A key that holds many rows is a bound once, however often equal depth would cut there, and so
    shares its split with the keys up to the next bound only.
    """
    cuts = [literal(b) for b in sorted(set(bounds))]
    if not cuts:
        return [f"{column} IS NULL", f"{column} IS NOT NULL"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in pairwise(cuts)]
    return [f"{column} IS NULL", f"{column} < {cuts[0]}", *middle, f"{column} >= {cuts[-1]}"]


def bounds(rows: DataFrame, column: str, parts: int) -> list:
    """The keys of ``bounds_query``, found by Spark: no task sees more than a range of the distinct keys.

    A key is a cut if one of its rows, counted in key order, is the first of a part.
    """
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("split_key")).agg(F.count("*").alias("rows"))
    ranged = settle(counts.repartitionByRange("split_key").withColumn("slot", F.spark_partition_id()), "split-keys")
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = ranged.groupBy("slot").agg(F.sum("rows").alias("size"))
    starts = sizes.select("slot", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    total = sizes.agg(F.sum("size")).scalar()
    upto = F.col("start") + F.sum("rows").over(Window.partitionBy("slot").orderBy("split_key"))
    ends = ranged.join(starts, "slot").select("split_key", "rows", upto.alias("end"))
    first, last = F.greatest(F.col("end") - F.col("rows"), F.lit(1)) - 1, F.col("end") - 1
    later = F.floor(last * parts / total) > F.floor(first * parts / total)
    return [row[0] for row in ends.filter(later).select("split_key").collect()]  # fewer than ``parts``


def read_split(spark: SparkSession, source: Source, name: str, column: str, parts: int) -> DataFrame:
    """Read a table or query in splits of about equal depth by a key column, one partition each.

    A JDBC source is asked for the cuts by one bounded query and then runs one query per split; any other is
    read for the cuts by Spark and once more for the rows, with a split's rows in the partition of its number.
    """
    if source.format == "jdbc":
        cuts = [row[0] for row in read_table(spark, source, bounds_query(name, column, parts)).collect()]
        predicates = split_predicates(column, cuts)
        options = {**jdbc_options(Source("jdbc", options=source.options, fetch_size=source.fetch_size), name)}
        table = options.pop("query", None)
        table = f"({table}) AS source_query" if table else options.pop("dbtable")
        return spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)
    predicates = split_predicates(column, bounds(read_table(spark, source, name), column, parts))
    number = F.lit(None).cast("int")
    for i, predicate in enumerate(predicates):
        number = F.when(F.expr(predicate), i).otherwise(number)
    rows = read_table(spark, source, name).withColumn("split_number", number)
    return rows.repartitionByRange(len(predicates), "split_number").drop("split_number")


def read_table(spark: SparkSession, source: Source, name: str) -> DataFrame:
    """Read a table, or for JDBC and catalog sources a query."""
    if source.format == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(source, name)).load()
    if source.format == "catalog":
        return spark.sql(name) if is_query(name) else spark.table(name)
    reader: DataFrameReader = spark.read.format(source.format).options(**source.options)
    return reader.load(f"{source.base}/{name}")


def keyed_options(source: Source, keyspace: str, table: str) -> dict[str, str]:
    """Options of a key-value read."""
    return {**source.options, "keyspace": keyspace, "table": table}


def read_keyed_table(spark: SparkSession, source: Source, keyspace: str, table: str) -> DataFrame:
    """Read a table of a keyspace; file formats hold keyspaces as folders."""
    reader = spark.read.format(source.format)
    if source.base is None:
        return reader.options(**keyed_options(source, keyspace, table)).load()
    return reader.options(**source.options).load(f"{source.base}/{keyspace}/{table}")


def read_features(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Feature table: CSV with a header when a schema is given, Parquet otherwise."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def read_or_empty(spark: SparkSession, source: Source, name: str, schema: StructType, keyspace: str | None = None) -> DataFrame:
    """Read a table, of a keyspace if one is given, or an empty frame of the schema where it cannot be had.

    Files and catalog tables count as missing only where Spark says so. Other sources name a missing
    table in their own ways, so whatever fails there when the table is opened is warned about and taken as missing.
    """
    if source.format == "catalog" and not is_query(name) and not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema)
    try:
        return read_table(spark, source, name) if keyspace is None else read_keyed_table(spark, source, keyspace, name)
    except AnalysisException as error:
        if error.getCondition() not in MISSING and (source.format == "catalog" or source.base is not None):
            raise
        reason = error
    except Exception as error:
        if source.format == "catalog" or source.base is not None:
            raise
        reason = error
    warnings.warn(f"reading {name} as empty: {str(reason).splitlines()[0]}", stacklevel=2)
    return spark.createDataFrame([], schema)
