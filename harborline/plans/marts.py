"""Staging models, the intermediate daily model, and the four marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborline.functions.columns import div0, month_start, safe_corr, safe_div
from harborline.operators.contracts import accepted_range, accepted_values, not_null, unique
from harborline.plans.external import GOLD_SCHEMAS

# The allowed classifications.
SEVERITIES = ["Clear", "Rain", "Snow", "Extreme Cold"]
FINAL_STATUSES = ["delivered", "cancelled"]


# --- staging ----------------------------------------------------------------------


def _declared(df: DataFrame, table: str) -> DataFrame:
    return df.select(*StructType.fromDDL(GOLD_SCHEMAS[table]).names)


def stg_daily_delivery_summary(df: DataFrame) -> DataFrame:
    return _declared(df, "daily_delivery_summary")


def stg_delivery_sla(df: DataFrame) -> DataFrame:
    return _declared(df, "delivery_sla")


def stg_weather_delay_impact(df: DataFrame) -> DataFrame:
    return _declared(df, "weather_delay_impact")


def stg_review_summary(df: DataFrame) -> DataFrame:
    """Keeps the month's text and adds it as a date."""
    months = {"review_month_raw": F.col("review_month"), "review_month": month_start("review_month")}
    return _declared(df, "review_summary").withColumns(months)


def stg_order_status_current(df: DataFrame) -> DataFrame:
    return _declared(df, "order_status_current")


def stg_demand_forecast(df: DataFrame) -> DataFrame:
    return _declared(df, "demand_forecast").withColumn("forecast_date", F.col("forecast_date").cast("date"))


def staging_contracts() -> dict[str, list]:
    """The rules each staging model must keep."""
    rate = {"lo": 0, "hi": 1}
    return {
        "stg_daily_delivery_summary": [
            unique("pickup_date"),
            not_null("pickup_date"),
            not_null("trip_count"),
            accepted_range("trip_count", lo=0),
            not_null("total_revenue"),
            accepted_range("total_revenue", lo=0),
        ],
        "stg_delivery_sla": [
            not_null("pickup_date"),
            not_null("pickup_location_id"),
            not_null("total_trips"),
            accepted_range("total_trips", lo=0),
            accepted_range("on_time_rate", **rate),
        ],
        "stg_weather_delay_impact": [
            not_null("pickup_date"),
            not_null("weather_severity"),
            accepted_values("weather_severity", SEVERITIES),
            accepted_range("on_time_rate", **rate),
        ],
        "stg_review_summary": [
            not_null("category"),
            not_null("review_month"),
            accepted_range("avg_rating", lo=1, hi=5),
            accepted_range("verified_purchase_pct", **rate),
        ],
        "stg_order_status_current": [
            unique("order_id"),
            not_null("order_id"),
            not_null("current_status"),
            accepted_values("current_status", FINAL_STATUSES),
            accepted_range("order_value", lo=0),
        ],
        "stg_demand_forecast": [
            unique("forecast_date"),
            not_null("forecast_date"),
            not_null("predicted_trip_count"),
            accepted_range("predicted_trip_count", lo=0),
            not_null("is_future"),
        ],
    }


# --- intermediate and marts -------------------------------------------------------


def int_daily_performance(daily: DataFrame, sla: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily grain: summary, SLA rolled up over locations, and weather impact.

    The delay of a day is the plain mean of its locations' means. ``weather`` must hold
    one row per day (contract ``unique(pickup_date)``), or days fan out.
    """
    by_day = sla.groupBy("pickup_date").agg(
        F.sum("total_trips").alias("sla_total_trips"),
        F.sum("on_time_trips").alias("on_time_trips"),
        F.sum("delayed_trips").alias("delayed_trips"),
        safe_div(F.sum("on_time_trips"), F.sum("total_trips")).alias("on_time_rate"),
        F.avg("avg_delay_minutes").alias("avg_delay_minutes"),
    )
    impact = weather.select(
        "pickup_date",
        "weather_severity",
        F.col("on_time_rate").alias("weather_on_time_rate"),
        F.col("avg_delay_minutes").alias("weather_avg_delay_minutes"),
    )
    summary = daily.select(
        "pickup_date",
        "trip_count",
        "total_revenue",
        "precipitation_mm",
        "snowfall_cm",
        "temp_max_c",
        "temp_min_c",
    )
    return summary.join(by_day, "pickup_date", "left").join(impact, "pickup_date", "left")


def mart_weather_delay_correlation(daily_perf: DataFrame, baseline: str = "Clear") -> DataFrame:
    """Per severity: averages over days, lift against the baseline, and the overall correlations.

    One grouping-sets aggregate yields a row per severity plus the grand total, which
    carries the correlations. Baseline and correlations are then copied onto the severity
    rows by a window over that handful of rows, so no join is needed.
    """
    delay, rate = "avg_delay_minutes", "on_time_rate"
    correlations = {
        "corr_precipitation_delay": ("precipitation_mm", delay),
        "corr_snowfall_delay": ("snowfall_cm", delay),
        "corr_precipitation_on_time_rate": ("precipitation_mm", rate),
        "corr_snowfall_on_time_rate": ("snowfall_cm", rate),
    }
    tiers = daily_perf.groupingSets([["weather_severity"], []], "weather_severity").agg(
        F.grouping_id().alias("_total"),
        F.count(F.lit(1)).alias("day_count"),
        F.sum("trip_count").alias("total_trips"),
        F.avg(delay).alias(delay),
        F.avg(rate).alias(rate),
        *[safe_corr(x, y).alias(name) for name, (x, y) in correlations.items()],
    )
    everything = Window.partitionBy()

    def of_row(cond, col):
        return F.max(F.when(cond, F.col(col))).over(everything)

    is_total, is_base = F.col("_total") == 1, (F.col("_total") == 0) & (F.col("weather_severity") == baseline)
    spread = tiers.withColumns(
        {
            "delay_lift_vs_clear_minutes": F.col(delay) - of_row(is_base, delay),
            "on_time_rate_delta_vs_clear": F.col(rate) - of_row(is_base, rate),
            **{name: of_row(is_total, name) for name in correlations},
        }
    )
    return spread.filter("_total = 0").select(
        "weather_severity",
        "day_count",
        "total_trips",
        delay,
        rate,
        "delay_lift_vs_clear_minutes",
        "on_time_rate_delta_vs_clear",
        *correlations,
    )


def mart_review_analytics(monthly: DataFrame) -> DataFrame:
    """Per category and year, next to the category's lifetime averages over its months.

    Lifetime figures are re-sums of the yearly ones, taken over the few years of each
    category, so the monthly table is aggregated once and never joined to itself.
    """
    yearly = monthly.groupBy("category", F.year("review_month").alias("review_year")).agg(
        F.sum("review_count").alias("review_count"),
        F.avg("avg_rating").alias("avg_rating"),
        F.avg("verified_purchase_pct").alias("avg_verified_purchase_pct"),
        F.sum("avg_rating").alias("_ratings"),
        F.count("avg_rating").alias("_rated"),
        F.sum("verified_purchase_pct").alias("_pcts"),
        F.count("verified_purchase_pct").alias("_with_pct"),
    )
    lifetime = Window.partitionBy("category")
    placed = yearly.withColumns(
        {
            "lifetime_review_count": F.sum("review_count").over(lifetime),
            "lifetime_avg_rating": safe_div(F.sum("_ratings").over(lifetime), F.sum("_rated").over(lifetime)),
            "lifetime_avg_verified_pct": safe_div(F.sum("_pcts").over(lifetime), F.sum("_with_pct").over(lifetime)),
        }
    )
    return placed.select(
        "category",
        "review_year",
        "review_count",
        "avg_rating",
        "avg_verified_purchase_pct",
        "lifetime_review_count",
        "lifetime_avg_rating",
        "lifetime_avg_verified_pct",
        (F.col("avg_rating") - F.col("lifetime_avg_rating")).alias("rating_delta_vs_lifetime_avg"),
    )


def mart_vendor_performance(orders: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    delivered, cancelled = (F.count_if(F.col("current_status") == s) for s in FINAL_STATUSES)
    return orders.groupBy("vendor_id").agg(
        total.alias("total_orders"),
        delivered.alias("delivered_orders"),
        cancelled.alias("cancelled_orders"),
        div0(delivered, total).alias("delivered_rate"),
        div0(cancelled, total).alias("cancelled_rate"),
        F.avg("order_value").alias("avg_order_value"),
        F.sum("order_value").alias("total_order_value"),
        F.min("last_event_timestamp").alias("first_order_timestamp"),
        F.max("last_event_timestamp").alias("last_order_timestamp"),
    )


def mart_demand_forecast(forecast: DataFrame) -> DataFrame:
    """The forecast with each past day's relative error; NULL for future days."""
    actual, predicted = F.col("actual_trip_count"), F.col("predicted_trip_count")
    error = F.when(~F.col("is_future"), F.try_divide(F.abs(actual - predicted), actual))
    return forecast.withColumn("pct_error", error)
