"""Query registry shared by ``__spark_entry__``, ``bench.py`` and the tests.

Each registered query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole given tables.  ``finalize`` gives results a comparable shape: doubles
rounded to 6 places, integral columns as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = sql
        return wrapped
    return deco


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            cols.append(c.cast("bigint").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
