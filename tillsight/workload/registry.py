"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.session import shared_folder, tune
from tillsight.workload.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that read the same from both engines: bigint, double, text."""

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[cast(field) for field in df.schema])


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function of the views under a name, with SQL where SQL can say it."""

    def register(function: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            shared_folder(spark)
            return portable(function(Views(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, extra)
        return function

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns the engines sum up in different orders.

    Everything else is compared to the last bit, so that no tie in rounding can tell them apart.
    """
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
