"""Delivery-SLA classification and rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.columns import tier

# Distance bounds in miles, the minutes allowed up to each, and beyond the last.
SLA_MILES = (2, 5, 10)
SLA_MINUTES = (15, 25, 40)
SLA_MINUTES_BEYOND = 60


def with_sla(
    df: DataFrame,
    distance: str = "trip_distance_miles",
    minutes: str = "trip_duration_minutes",
    bounds: Sequence[float] = SLA_MILES,
    budgets: Sequence[int] = SLA_MINUTES,
    beyond: int = SLA_MINUTES_BEYOND,
) -> DataFrame:
    """Add the minutes allowed, whether the trip kept them, and by how much it did not."""
    allowed = tier(distance, bounds, budgets, beyond)
    on_time = F.col(minutes) <= allowed
    return df.withColumns(
        {
            "expected_max_minutes": allowed,
            "is_on_time": on_time,
            "delay_minutes": F.when(~on_time, F.col(minutes) - allowed).otherwise(F.lit(0.0)),
        }
    )


def sla_measures() -> list[Column]:
    """Trip counts, on-time rate, and the mean delay of delayed trips only."""
    trips, on_time, late = F.count(F.lit(1)), F.count_if("is_on_time"), F.count_if(~F.col("is_on_time"))
    return _rates(trips, on_time, late, F.sum(F.when(~F.col("is_on_time"), F.col("delay_minutes"))))


def _rates(trips: Column, on_time: Column, late: Column, late_minutes: Column) -> list[Column]:
    return [
        trips.alias("total_trips"),
        on_time.alias("on_time_trips"),
        late.alias("delayed_trips"),
        F.round(on_time / trips, 4).alias("on_time_rate"),
        F.round(F.try_divide(late_minutes, late), 2).alias("avg_delay_minutes"),
    ]


def sla_summary(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*sla_measures())


# One fine-grained aggregate serves every trip rollup: all of its columns are additive
# (or constant per day), so daily, per-location and per-severity tables are re-sums of it.
DAY_CONSTANTS = ("temp_max_c", "temp_min_c", "precipitation_mm", "snowfall_cm")
AVERAGED = ("fare_amount", "trip_distance_miles", "trip_duration_minutes")


def trip_cube(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Additive trip measures at the grain ``by`` (which includes the trip date)."""
    sums = [F.sum(c).alias(f"sum_{c}") for c in AVERAGED]
    counts = [F.count(c).alias(f"n_{c}") for c in AVERAGED]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if("is_on_time").alias("on_time"),
        F.count_if(~F.col("is_on_time")).alias("late"),
        F.sum("delay_minutes").alias("late_minutes"),
        F.sum("total_amount").alias("revenue"),
        *sums,
        *counts,
        *[F.max(c).alias(c) for c in DAY_CONSTANTS],
    )


def daily_from_cube(cube: DataFrame, date: str = "pickup_date") -> DataFrame:
    averages = [F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(f"avg_{c}") for c in AVERAGED]
    return cube.groupBy(date).agg(
        F.sum("trips").alias("trip_count"),
        *averages,
        F.sum("revenue").alias("total_revenue"),
        *[F.max(c).alias(c) for c in DAY_CONSTANTS],
    )


def sla_from_cube(cube: DataFrame, by: Sequence[str]) -> DataFrame:
    return cube.groupBy(*by).agg(
        *_rates(F.sum("trips"), F.sum("on_time"), F.sum("late"), F.sum("late_minutes"))
    )
