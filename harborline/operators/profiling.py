"""Counts, ranges, breakdowns and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_rate_by(df: DataFrame, key: Column, cols: Sequence[str], key_name: str = "group_key") -> DataFrame:
    """Null count and percentage of each column, per group."""
    total = F.count(F.lit(1))
    measures = [total.alias("total_rows")]
    for c in cols:
        nulls = F.count_if(F.col(c).isNull())
        measures += [nulls.alias(f"{c}_nulls"), (nulls / total * 100).alias(f"{c}_null_pct")]
    return df.groupBy(key.alias(key_name)).agg(*measures).orderBy(key_name)


def value_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once, with their size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def breakdown(df: DataFrame, col: str, count_name: str = "row_count") -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.desc(count_name), F.asc(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` arbitrary rows; the limit stops the scan early."""
    return df.limit(n)


def vendor_kpis(df: DataFrame) -> DataFrame:
    """Dashboard tiles: vendors, orders, and the unweighted mean of delivered rates."""
    return df.agg(
        F.count(F.lit(1)).alias("total_vendors"),
        F.sum("total_orders").alias("total_orders"),
        F.avg("delivered_rate").alias("avg_delivered_rate"),
    )


def run_summary(spark, metrics: Mapping[str, object]) -> DataFrame:
    """A run's key results as one JSON record."""
    return spark.createDataFrame([dict(metrics)]).select(F.to_json(F.struct("*")).alias("summary"))
