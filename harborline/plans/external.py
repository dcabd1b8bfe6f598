"""Exported gold tables read back through declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from harborline.sources.readers import read_typed

# The declared columns of each exported gold table.
GOLD_SCHEMAS = {
    "daily_delivery_summary": (
        "pickup_date DATE, trip_count BIGINT, avg_fare_amount DOUBLE, total_revenue DOUBLE, "
        "avg_trip_distance_miles DOUBLE, avg_trip_duration_minutes DOUBLE, precipitation_mm DOUBLE, "
        "snowfall_cm DOUBLE, temp_max_c DOUBLE, temp_min_c DOUBLE"
    ),
    "delivery_sla": (
        "pickup_date DATE, pickup_location_id BIGINT, total_trips BIGINT, on_time_trips BIGINT, "
        "delayed_trips BIGINT, on_time_rate DOUBLE, avg_delay_minutes DOUBLE"
    ),
    "weather_delay_impact": (
        "pickup_date DATE, weather_severity STRING, total_trips BIGINT, on_time_trips BIGINT, "
        "delayed_trips BIGINT, on_time_rate DOUBLE, avg_delay_minutes DOUBLE"
    ),
    "review_summary": (
        "category STRING, review_month STRING, review_count BIGINT, avg_rating DOUBLE, verified_purchase_pct DOUBLE"
    ),
    "order_status_current": (
        "order_id STRING, delivery_id STRING, pickup_location_id BIGINT, vendor_id BIGINT, order_value DOUBLE, "
        "current_status STRING, last_event_timestamp TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
    ),
    "demand_forecast": (
        "forecast_date TIMESTAMP_NTZ, actual_trip_count DOUBLE, predicted_trip_count DOUBLE, "
        "predicted_lower_bound DOUBLE, predicted_upper_bound DOUBLE, is_future BOOLEAN"
    ),
}


def read_exported(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One exported gold table under ``base``, with its declared types."""
    return read_typed(spark, f"{base}/{table}", StructType.fromDDL(GOLD_SCHEMAS[table]))
