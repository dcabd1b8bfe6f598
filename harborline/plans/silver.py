"""Silver: rename, derive, validate, quarantine, deduplicate, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.columns import (
    array_count,
    epoch_millis,
    file_stem,
    first_field,
    key_text,
    minutes_between,
    review_valid,
    surrogate_key,
    trip_valid,
)
from harborline.operators.joins import enrich_daily
from harborline.operators.projection import rename_present
from harborline.operators.validity import flag_valid, keep_latest, settle, split_valid
from harborline.sources.readers import explode_parallel_arrays
from harborline.sources.sinks import quarantine, write_table

# Raw trip columns that change their name; the others keep theirs.
TRIP_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "trip_distance": "trip_distance_miles",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type_id",
}


# Output column -> (array in the daily weather payload, type).
WEATHER_FIELDS = {
    "weather_date": ("time", "date"),
    "temp_max_c": ("temperature_2m_max", "double"),
    "temp_min_c": ("temperature_2m_min", "double"),
    "precipitation_mm": ("precipitation_sum", "double"),
    "snowfall_cm": ("snowfall_sum", "double"),
    "windspeed_max_kmh": ("windspeed_10m_max", "double"),
}
_ARRAYS = ", ".join(f"{a}: array<{'string' if t == 'date' else t}>" for a, t in WEATHER_FIELDS.values())
WEATHER_JSON = f"daily struct<{_ARRAYS}>"


def _latest_order(tiebreak: Sequence[str]) -> list[Column]:
    return [F.desc("_ingested_at"), *[F.desc(c) for c in tiebreak]]


# What makes a trip and a review one.
TRIP_KEY = ("vendor_id", "pickup_ts", "pickup_location_id", "dropoff_location_id")
REVIEW_KEY = ("asin", "user_id", "review_ts")


def derive_trips(bronze: DataFrame) -> DataFrame:
    """Delivery names, surrogate key, duration and date."""
    return with_trip_columns(rename_present(bronze, TRIP_NAMES))


def with_trip_columns(named: DataFrame) -> DataFrame:
    """Surrogate key, duration and date from the other columns of a trip.

    Applied again above a shuffle, it spares moving them: the key alone is 64 bytes of random text a row.
    """
    return named.withColumns(
        {
            "delivery_id": surrogate_key(*TRIP_KEY),
            "trip_duration_minutes": minutes_between("pickup_ts", "dropoff_ts"),
            "pickup_date": F.to_date("pickup_ts"),
        }
    )


def trips_flagged(bronze: DataFrame) -> DataFrame:
    return flag_valid(derive_trips(bronze), trip_valid())


def trips_silver(bronze: DataFrame, tiebreak: Sequence[str] = (), null_policy: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``(valid and deduplicated, rejected)`` trips."""
    valid, rejected = split_valid(derive_trips(bronze), trip_valid(), null_policy)
    return with_trip_columns(keep_latest(valid, [key_text(*TRIP_KEY)], _latest_order(tiebreak))), rejected


def weather_days(spark: SparkSession, path: str) -> DataFrame:
    """The daily weather dimension from landed JSON whose arrays run in parallel."""
    landed = spark.read.schema(WEATHER_JSON).option("multiLine", "true").json(path)
    return explode_parallel_arrays(landed, "daily", WEATHER_FIELDS).filter(F.col("weather_date").isNotNull())


def trips_enriched(silver: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with the weather of their pickup day, or NULLs outside its calendar."""
    return enrich_daily(silver, weather, "pickup_date", "weather_date")


def derive_reviews(bronze: DataFrame) -> DataFrame:
    """Timestamp, image fields, surrogate key and category; applied again above a shuffle, it spares moving them."""
    stamped = bronze.withColumn("review_ts", epoch_millis("timestamp"))
    return stamped.withColumns(
        {
            "image_count": array_count("images"),
            "primary_image_url": first_field("images", "large_image_url"),
            "review_id": surrogate_key(*REVIEW_KEY),
            "category": file_stem("_source_file", ".jsonl"),
        }
    )


def with_review_key(reviews: DataFrame) -> DataFrame:
    """The surrogate key from the columns it is made of."""
    return reviews.withColumn("review_id", surrogate_key(*REVIEW_KEY))


def reviews_flagged(bronze: DataFrame) -> DataFrame:
    return flag_valid(derive_reviews(bronze), review_valid())


def reviews_silver(bronze: DataFrame, tiebreak: Sequence[str] = (), null_policy: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``(valid and deduplicated, rejected)`` reviews."""
    valid, rejected = split_valid(derive_reviews(bronze), review_valid(), null_policy)
    return derive_reviews(keep_latest(valid, [key_text(*REVIEW_KEY)], _latest_order(tiebreak))), rejected


def trips_settled(bronze: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Valid and deduplicated trips, and the rejected ones, with their flag, from one pass over bronze."""
    return with_trip_columns(settle(trips_flagged(bronze), [key_text(*TRIP_KEY)], _latest_order(tiebreak)))


def reviews_settled(bronze: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Valid and deduplicated reviews, and the rejected ones, with their flag, from one pass over bronze."""
    return derive_reviews(settle(reviews_flagged(bronze), [key_text(*REVIEW_KEY)], _latest_order(tiebreak)))


def build_silver(
    split: tuple[DataFrame, DataFrame], target: str, rejects: str, partition_by: Sequence[str], fmt: str = "parquet"
) -> tuple[int, int]:
    """Write both sides of a silver split and return their row counts."""
    kept, rejected = split
    return write_table(kept, target, partition_by=partition_by, fmt=fmt), quarantine(rejected, rejects, fmt)
