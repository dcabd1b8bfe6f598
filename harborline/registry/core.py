"""Registration of queries and their SQL oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampNTZType, TimestampType

NUDGE = 1e-11

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own (or the given) name, with the SQL that must agree with it."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        key = name or fn.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def shown(df: DataFrame, digits: int = 8, **by_column: int) -> DataFrame:
    """Present a result for comparison: ISO dates and times as text, rounded doubles.

    Sums of doubles differ in their last bits with the order of addition, hence the
    rounding; ``by_column`` overrides the digits of single columns. At 8 digits a mean of
    short decimals can fall exactly between two results, so those get a nudge upwards,
    here and in the SQL.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, DoubleType):
            places = by_column.get(f.name, digits)
            c = F.round(c + NUDGE if places == 8 else c, places)
        out.append(c.alias(f.name))
    return df.select(*out)
