"""Registry of queries: a name, a Spark callable, and the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under its own name."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, folder))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def portable(df: DataFrame) -> DataFrame:
    """Result types another SQL engine has too: zone-less times, 64-bit integers, doubles."""

    def plain(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])
