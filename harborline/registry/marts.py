"""Marts and the serving queries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.profiling import distinct_values, vendor_kpis as kpi_tiles
from harborline.operators.projection import serve
from harborline.plans import gold, inputs, marts
from harborline.registry.core import query, shown
from harborline.registry.reviews import silver_reviews
from harborline.registry.sql import ORDER_EVENTS, REVIEWS, TRIPS, day, moment
from harborline.registry.trips import gold_trips
from harborline.streaming.events import newest_per_key, order_updates, parse_events


def staged_trip_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = gold.trip_gold_tables(gold_trips(spark, sf_dir))
    return {
        "daily": marts.stg_daily_delivery_summary(tables["daily_delivery_summary"]),
        "sla": marts.stg_delivery_sla(tables["delivery_sla"]),
        "weather": marts.stg_weather_delay_impact(tables["weather_delay_impact"]),
    }


def daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.int_daily_performance(**staged_trip_tables(spark, sf_dir))


def staged_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_review_summary(gold.review_summary(silver_reviews(spark, sf_dir)))


def order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(inputs.order_event_values(inputs.table(spark, sf_dir, "events")))
    updates = order_updates(events)
    latest = newest_per_key(updates, ["order_id"], "last_event_timestamp", ["delivery_id"])
    return marts.stg_order_status_current(latest)


@query(
    TRIPS
    + f"""SELECT {day("pickup_date")} AS pickup_date, trip_count, round(total_revenue, 6) AS total_revenue,
  precipitation_mm, snowfall_cm, temp_max_c, temp_min_c, sla_total_trips, on_time_trips, delayed_trips,
  round(on_time_rate + 1e-11, 8) AS on_time_rate, round(avg_delay_minutes + 1e-11, 8) AS avg_delay_minutes, weather_severity,
  weather_on_time_rate, weather_avg_delay_minutes FROM daily_perf"""
)
def int_daily_performance(spark, sf_dir):
    return shown(daily_performance(spark, sf_dir), total_revenue=6)


def _corr(x: str, y: str) -> str:
    value = f"corr({x}, {y})"
    return f"round((CASE WHEN isnan({value}) THEN NULL ELSE {value} END) + 1e-11, 8)"


@query(
    TRIPS
    + f""", base AS (
  SELECT avg(avg_delay_minutes) AS delay, avg(on_time_rate) AS rate FROM daily_perf WHERE weather_severity = 'Clear'),
correlations AS (
  SELECT {_corr("precipitation_mm", "avg_delay_minutes")} AS corr_precipitation_delay,
    {_corr("snowfall_cm", "avg_delay_minutes")} AS corr_snowfall_delay,
    {_corr("precipitation_mm", "on_time_rate")} AS corr_precipitation_on_time_rate,
    {_corr("snowfall_cm", "on_time_rate")} AS corr_snowfall_on_time_rate FROM daily_perf),
tiers AS (
  SELECT weather_severity, count(*) AS day_count, CAST(sum(trip_count) AS BIGINT) AS total_trips,
    round((avg(avg_delay_minutes)) + 1e-11, 8) AS avg_delay_minutes, round((avg(on_time_rate)) + 1e-11, 8) AS on_time_rate,
    round((avg(avg_delay_minutes) - any_value(delay)) + 1e-11, 8) AS delay_lift_vs_clear_minutes,
    round((avg(on_time_rate) - any_value(rate)) + 1e-11, 8) AS on_time_rate_delta_vs_clear
  FROM daily_perf, base GROUP BY weather_severity)
SELECT * FROM tiers, correlations"""
)
def mart_weather_delay_correlation(spark, sf_dir):
    mart = marts.mart_weather_delay_correlation(daily_performance(spark, sf_dir))
    return shown(serve(mart, order_by=[F.desc("avg_delay_minutes")]))


_REVIEW_MART = (
    REVIEWS
    + """, staged AS (SELECT *, CAST(left(review_month, 4) AS INT) AS review_year FROM monthly),
lifetime AS (
  SELECT category, CAST(sum(review_count) AS BIGINT) AS lifetime_review_count,
    avg(avg_rating) AS lifetime_avg_rating, avg(verified_purchase_pct) AS lifetime_avg_verified_pct
  FROM staged GROUP BY category),
yearly AS (
  SELECT category, review_year, CAST(sum(review_count) AS BIGINT) AS review_count,
    avg(avg_rating) AS avg_rating, avg(verified_purchase_pct) AS avg_verified_purchase_pct
  FROM staged GROUP BY ALL),
mart AS (
  SELECT category, review_year, review_count, round(avg_rating + 1e-11, 8) AS avg_rating,
    round(avg_verified_purchase_pct + 1e-11, 8) AS avg_verified_purchase_pct, lifetime_review_count,
    round(lifetime_avg_rating + 1e-11, 8) AS lifetime_avg_rating, round(lifetime_avg_verified_pct + 1e-11, 8) AS lifetime_avg_verified_pct,
    round((avg_rating - lifetime_avg_rating) + 1e-11, 8) AS rating_delta_vs_lifetime_avg
  FROM yearly LEFT JOIN lifetime USING (category))
"""
)


@query(_REVIEW_MART + "SELECT * FROM mart")
def mart_review_analytics(spark, sf_dir):
    return shown(marts.mart_review_analytics(staged_reviews(spark, sf_dir)))


@query(_REVIEW_MART + "SELECT * FROM mart WHERE category = 'BUILDING'")
def review_category_trend(spark, sf_dir):
    mart = marts.mart_review_analytics(staged_reviews(spark, sf_dir))
    return shown(serve(mart, F.col("category") == "BUILDING", [F.col("category"), F.col("review_year")]))


@query(REVIEWS + "SELECT DISTINCT category FROM monthly")
def distinct_categories(spark, sf_dir):
    return distinct_values(staged_reviews(spark, sf_dir), "category")


@query(
    REVIEWS
    + """SELECT category, review_month AS review_month_raw, review_month || '-01' AS review_month, review_count,
  avg_rating, verified_purchase_pct FROM monthly"""
)
def stg_review_summary(spark, sf_dir):
    return shown(staged_reviews(spark, sf_dir))


@query(
    ORDER_EVENTS
    + f"""SELECT order_id, delivery_id, pickup_location_id, vendor_id, order_value, current_status,
  {moment("last_event_timestamp")} AS last_event_timestamp FROM status"""
)
def stg_order_status_current(spark, sf_dir):
    return shown(order_status(spark, sf_dir).drop("updated_at"))


@query(
    ORDER_EVENTS
    + f"""SELECT vendor_id, total_orders, delivered_orders, cancelled_orders, round(delivered_rate + 1e-11, 8) AS delivered_rate,
  round(cancelled_rate + 1e-11, 8) AS cancelled_rate, round(avg_order_value + 1e-11, 8) AS avg_order_value,
  round(total_order_value, 4) AS total_order_value, {moment("first_order_timestamp")} AS first_order_timestamp,
  {moment("last_order_timestamp")} AS last_order_timestamp FROM vendors"""
)
def mart_vendor_performance(spark, sf_dir):
    mart = marts.mart_vendor_performance(order_status(spark, sf_dir))
    return shown(serve(mart, order_by=[F.desc("total_orders"), F.asc("vendor_id")]), total_order_value=4)


@query(
    ORDER_EVENTS
    + """SELECT count(*) AS total_vendors, CAST(sum(total_orders) AS BIGINT) AS total_orders,
  round((avg(delivered_rate)) + 1e-11, 8) AS avg_delivered_rate FROM vendors"""
)
def vendor_kpis(spark, sf_dir):
    return shown(kpi_tiles(marts.mart_vendor_performance(order_status(spark, sf_dir))))
