"""Silver audit: null, range, drift and duplicate checks as one summary table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.profiling import duplicate_keys

# The columns each silver table must always have.
TRIP_REQUIRED = ("pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id", "delivery_id")
REVIEW_REQUIRED = ("asin", "user_id", "review_ts", "review_id")


def _line(name: str, expected: str, actual: Column, good: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(expected).alias("expected"),
        actual.cast("string").alias("actual"),
        F.when(F.coalesce(good, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def table_checks(
    df: DataFrame,
    table: str,
    required: Sequence[str] = (),
    known_nulls: Mapping[str, int] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Null, known-drift and range checks of one table, all from a single pass."""
    measures, lines = [], []
    nulls = {**{c: 0 for c in required}, **(known_nulls or {})}
    for column, number in nulls.items():
        measures.append(F.count_if(F.col(column).isNull()).alias(f"nulls_{column}"))
        counted = F.col(f"nulls_{column}")
        lines.append(_line(f"{table}.{column} nulls", str(number), counted, counted == number))
    for column, (lo, hi) in (ranges or {}).items():
        measures += [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")]
        least, most = F.col(f"min_{column}"), F.col(f"max_{column}")
        shown = F.concat_ws("-", least.cast("string"), most.cast("string"))
        lines.append(_line(f"{table}.{column} range", f"{lo}-{hi}", shown, (least >= lo) & (most <= hi)))
    return df.agg(*measures).select(F.inline(F.array(*lines)))


def duplicate_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """How many keys occur more than once; none should."""
    repeated = duplicate_keys(df.select(*keys), keys).agg(F.count(F.lit(1)).alias("groups"))
    name = f"{table} duplicate {','.join(keys)}"
    return repeated.select(F.inline(F.array(_line(name, "0", F.col("groups"), F.col("groups") == 0))))


def silver_quality_summary(trips: DataFrame, reviews: DataFrame, enriched: DataFrame, unmatched_expected: int) -> DataFrame:
    """``(check_name, expected, actual, status)`` over the three silver tables."""
    parts = [
        table_checks(trips, "trips", TRIP_REQUIRED),
        table_checks(reviews, "reviews", REVIEW_REQUIRED, ranges={"rating": (1, 5)}),
        table_checks(enriched, "trips_weather", known_nulls={"temp_max_c": unmatched_expected}),
        duplicate_check(trips, "trips", ["delivery_id"]),
        duplicate_check(reviews, "reviews", ["review_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)
