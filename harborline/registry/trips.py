"""Trip queries: silver, enrichment, gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from harborline.functions.columns import month_in_path
from harborline.operators.joins import match_report, unmatched_keys
from harborline.operators.profiling import duplicate_keys, null_rate_by, sample_rows
from harborline.operators.projection import date_range_counts
from harborline.operators.validity import reconcile_keys
from harborline.plans import gold, inputs, silver
from harborline.registry.core import query, shown
from harborline.registry.sql import TRIPS, day, moment
from harborline.session import scratch_dir
from harborline.sources.readers import read_table
from harborline.sources.sinks import quarantine

PERIOD = (dt.date.fromisoformat(inputs.WEATHER_FIRST_DAY), dt.date.fromisoformat(inputs.WEATHER_LAST_DAY))

_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_ROW = [
    "delivery_id",
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "pickup_date",
    "trip_duration_minutes",
    "trip_distance_miles",
    "passenger_count",
    "fare_amount",
    "total_amount",
    "pickup_location_id",
    "dropoff_location_id",
]
_ROW_SQL = f"""delivery_id, vendor_id, {moment("pickup_ts")} AS pickup_ts, {moment("dropoff_ts")} AS dropoff_ts,
  {day("pickup_date")} AS pickup_date, round(trip_duration_minutes + 1e-11, 8) AS trip_duration_minutes, trip_distance_miles,
  passenger_count, round(fare_amount + 1e-11, 8) AS fare_amount, round(total_amount, 6) AS total_amount,
  pickup_location_id, dropoff_location_id"""
_SLA_SQL = "total_trips, on_time_trips, delayed_trips, on_time_rate, avg_delay_minutes"


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = silver.trips_silver(inputs.raw_trips(spark, sf_dir), inputs.TRIP_TIEBREAK)
    return kept


def enriched_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.trips_enriched(silver_trips(spark, sf_dir), inputs.weather(spark))


def gold_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.in_period(enriched_trips(spark, sf_dir), *PERIOD)


@query(
    TRIPS
    + f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, delivery_id,
  round(trip_duration_minutes + 1e-11, 8) AS trip_duration_minutes, {day("pickup_date")} AS pickup_date FROM derived"""
)
def trip_surrogate_key(spark, sf_dir):
    derived = silver.derive_trips(inputs.raw_trips(spark, sf_dir))
    return shown(derived.select(*_KEY, "delivery_id", "trip_duration_minutes", "pickup_date"))


@query(TRIPS + f"SELECT {_ROW_SQL} FROM flagged WHERE is_valid")
def trip_silver_valid(spark, sf_dir):
    flagged = silver.trips_flagged(inputs.raw_trips(spark, sf_dir))
    return shown(flagged.filter("_is_valid").select(*_ROW), total_amount=6)


@query(TRIPS + f"SELECT {_ROW_SQL} FROM flagged WHERE NOT is_valid")
def trip_silver_rejects(spark, sf_dir):
    _, rejected = silver.trips_silver(inputs.raw_trips(spark, sf_dir))
    target = scratch_dir(spark, "trip-rejects")
    quarantine(rejected.select(*_ROW), target)
    return shown(read_table(spark, target), total_amount=6)


@query(TRIPS + f"SELECT {_ROW_SQL}, l_orderkey, {moment('ingested_at')} AS _ingested_at FROM silver")
def trip_dedup_latest(spark, sf_dir):
    return shown(silver_trips(spark, sf_dir).select(*_ROW, "l_orderkey", "_ingested_at"), total_amount=6)


@query(
    TRIPS
    + f"""SELECT {_ROW_SQL}, temp_max_c, temp_min_c, precipitation_mm, snowfall_cm, windspeed_max_kmh FROM enriched"""
)
def trip_weather_enriched(spark, sf_dir):
    weather = ["temp_max_c", "temp_min_c", "precipitation_mm", "snowfall_cm", "windspeed_max_kmh"]
    return shown(enriched_trips(spark, sf_dir).select(*_ROW, *weather), total_amount=6)


@query(TRIPS + f"SELECT {day('pickup_date')} AS pickup_date, pickup_location_id, {_SLA_SQL} FROM gold_sla")
def sla_by_day_location(spark, sf_dir):
    return shown(gold.delivery_sla(gold_trips(spark, sf_dir)))


@query(
    TRIPS
    + f"""SELECT {day("pickup_date")} AS pickup_date, trip_count, round(avg_fare_amount + 1e-11, 8) AS avg_fare_amount,
  round(avg_trip_distance_miles + 1e-11, 8) AS avg_trip_distance_miles,
  round(avg_trip_duration_minutes + 1e-11, 8) AS avg_trip_duration_minutes, round(total_revenue, 6) AS total_revenue,
  temp_max_c, temp_min_c, precipitation_mm, snowfall_cm FROM gold_daily"""
)
def daily_delivery_summary(spark, sf_dir):
    return shown(gold.daily_summary(gold_trips(spark, sf_dir)), total_revenue=6)


@query(TRIPS + f"SELECT {day('pickup_date')} AS pickup_date, weather_severity, {_SLA_SQL} FROM gold_weather")
def weather_delay_impact(spark, sf_dir):
    return shown(gold.weather_delay_impact(gold_trips(spark, sf_dir)))


_IN_PERIOD = f"pickup_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'"


@query(
    TRIPS
    + f"""SELECT count(*) AS rows_before, count(*) FILTER (WHERE {_IN_PERIOD}) AS rows_after,
  count(*) FILTER (WHERE NOT {_IN_PERIOD}) AS rows_out_of_range FROM enriched"""
)
def out_of_range_counts(spark, sf_dir):
    return date_range_counts(silver_trips(spark, sf_dir), "pickup_date", *PERIOD)


@query(
    TRIPS
    + """SELECT count(*) AS row_count, count(*) FILTER (WHERE temp_max_c IS NULL) AS unmatched_rows,
  round((count(*) FILTER (WHERE temp_max_c IS NULL) / count(*)::DOUBLE * 100) + 1e-11, 8) AS unmatched_pct FROM enriched"""
)
def weather_match_report(spark, sf_dir):
    return shown(match_report(enriched_trips(spark, sf_dir), "temp_max_c"))


@query(TRIPS + f"SELECT DISTINCT {day('pickup_date')} AS pickup_date FROM enriched WHERE temp_max_c IS NULL")
def unmatched_dates(spark, sf_dir):
    return shown(unmatched_keys(enriched_trips(spark, sf_dir), "temp_max_c", "pickup_date"))


def _null_rate(c: str) -> str:
    nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
    return f"{nulls} AS {c}_nulls, round(({nulls} / count(*)::DOUBLE * 100) + 1e-11, 8) AS {c}_null_pct"


_NULLABLE = ["vendor_id", "trip_distance_miles", "passenger_count", "dropoff_location_id"]


@query(
    TRIPS
    + f"""SELECT regexp_extract(source_file, '(\\d{{4}}-\\d{{2}})', 1) AS source_month, count(*) AS total_rows,
  {", ".join(_null_rate(c) for c in _NULLABLE)} FROM raw GROUP BY 1"""
)
def null_rate_by_month(spark, sf_dir):
    named = silver.derive_trips(inputs.raw_trips(spark, sf_dir))
    return shown(null_rate_by(named, month_in_path("_source_file"), _NULLABLE, "source_month"))


@query(
    TRIPS
    + """SELECT count(*) AS input_rows, count(*) FILTER (WHERE is_valid) AS valid_rows,
  count(*) FILTER (WHERE NOT is_valid) AS rejected_rows, (SELECT count(*) FROM silver) AS kept_rows,
  count(*) FILTER (WHERE is_valid) - (SELECT count(*) FROM silver) AS removed_rows,
  round((count(*) FILTER (WHERE NOT is_valid) / count(*)::DOUBLE * 100) + 1e-11, 8) AS reject_rate_pct FROM flagged"""
)
def reject_reconciliation(spark, sf_dir):
    flagged = silver.trips_flagged(inputs.raw_trips(spark, sf_dir))
    return shown(reconcile_keys(flagged, ["delivery_id"]))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    name="duplicate_keys",
)
def duplicate_line_keys(spark, sf_dir):
    return duplicate_keys(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query()
def row_sample(spark, sf_dir):
    """Rows only: which rows an unordered limit returns is not determined."""
    return sample_rows(inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), 250)
