"""End-to-end jobs: each reads stored inputs, writes stored tables, and can be rerun.

They only wire plans, sources and sinks together, for ``spark-submit`` or a notebook.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from harborline.operators.contracts import check, enforce
from harborline.operators.forecast import prepare_series, seasonal_forecast
from harborline.operators.validity import VALID_FLAG
from harborline.plans import bronze, catalogue, forecasting, gold, marts, silver
from harborline.sources.readers import read_table
from harborline.sources.sinks import read_split, write_split, write_table
from harborline.streaming.events import ORDER_KEY, ORDER_TIME, OrderTables, fold_state, parse_events, read_state, run_order_stream
from harborline.streaming.ingest import ingest_json_stream

Period = tuple[dt.date, dt.date]


def trips_job(
    spark: SparkSession,
    landing: str,
    weather: str,
    base: str,
    namespace: str,
    period: Period,
    tiebreak: Sequence[str] = (),
    partition_by: Sequence[str] = ("pickup_date",),
) -> dict[str, int]:
    """Landed trip files and weather JSON to bronze, silver, enriched and the three trip gold tables."""
    bronze.build_trips_bronze(spark, landing, f"{base}/bronze/trips", manifest=f"{base}/manifests/trips")
    settled = silver.trips_settled(read_table(spark, f"{base}/bronze/trips"), tiebreak)
    kept, rejected = write_split(settled, f"{base}/silver/trips", VALID_FLAG, partition_by, derive=silver.with_trip_columns)
    trips = read_split(spark, f"{base}/silver/trips", True, settled.schema)
    joined = silver.trips_enriched(trips, silver.weather_days(spark, weather))
    enriched = write_table(joined, f"{base}/silver/trips_weather", partition_by=partition_by)
    wanted = gold.in_period(read_table(spark, f"{base}/silver/trips_weather"), *period)
    tables = gold.build_gold(gold.trip_gold_tables(wanted), namespace)
    return {"trips": kept, "trip_rejects": rejected, "trips_weather": enriched, **tables}


def reviews_job(spark: SparkSession, landing: str, base: str, namespace: str, tiebreak: Sequence[str] = ()) -> dict[str, int]:
    """Newly landed review lines into bronze; silver and the review summary are rebuilt from it."""
    target = f"{base}/bronze/reviews"
    ingest_json_stream(spark, landing, f"{base}/schemas/reviews", f"{base}/checkpoints/reviews", target)
    settled = silver.reviews_settled(read_table(spark, target), tiebreak)
    kept, rejected = write_split(settled, f"{base}/silver/reviews", VALID_FLAG, ["category"], derive=silver.derive_reviews)
    summary = gold.review_summary(read_split(spark, f"{base}/silver/reviews", True, settled.schema))
    return {"reviews": kept, "review_rejects": rejected, **gold.build_gold({"review_summary": summary}, namespace)}


def orders_job(stream: DataFrame, base: str, namespace: str, tiebreak: Sequence[str] = ()) -> OrderTables:
    """Drain the order stream, fold its state log, and publish the current state as a gold table."""
    tables = run_order_stream(parse_events(stream, corrupt_col="_corrupt_record"), f"{base}/orders", tiebreak)
    spark = stream.sparkSession
    fold_state(spark, tables.state, ORDER_KEY, ORDER_TIME)
    state = read_state(spark, tables.state, ORDER_KEY, ORDER_TIME)
    gold.build_gold({"order_status_current": state}, namespace)
    return tables


def forecast_job(spark: SparkSession, namespace: str, horizon: int = 30) -> DataFrame:
    """Evaluate on a holdout, publish the forecast, and return the run record."""
    series = prepare_series(spark.table(f"{namespace}.daily_delivery_summary"), "pickup_date", "trip_count")
    gold.build_gold({"demand_forecast": seasonal_forecast(series, horizon=horizon)}, namespace)
    return forecasting.run_record(forecasting.evaluate(series, n=horizon), spark.table(f"{namespace}.demand_forecast"))


def marts_job(spark: SparkSession, namespace: str, target: str, strict: bool = True) -> dict[str, DataFrame]:
    """Publish the six staging views and the daily model, check the contracts, and rebuild the five mart tables.

    With ``strict`` a failed contract stops the job before any mart is written.
    """
    views = catalogue.publish_views(spark, namespace, target)
    if strict:
        for model, rules in marts.staging_contracts().items():
            enforce(check(views[model], rules, model))
    return catalogue.publish_tables(spark, target)
