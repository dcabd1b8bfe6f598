"""Forecast queries over the daily demand series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.forecast import (
    fit_seasonal,
    holdout_split,
    naive_baseline,
    predict_seasonal,
    prepare_series,
    seasonal_forecast,
)
from harborline.operators.projection import serve
from harborline.plans import inputs, marts
from harborline.plans.forecasting import evaluate, run_record
from harborline.registry.core import query, shown
from harborline.registry.sql import FORECAST, day
from harborline.session import written_once


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_series(inputs.daily_orders(spark, sf_dir), "ds", "y")


def staged_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The orders are aggregated to days once; fit and prediction then read that table.
    daily = written_once(demand(spark, sf_dir), "daily-demand")
    return marts.stg_demand_forecast(seasonal_forecast(daily))


@query(FORECAST + f"SELECT {day('ds')} AS ds, CAST(y AS BIGINT) AS y, ds IN (SELECT ds FROM holdout) AS is_holdout FROM days")
def forecast_holdout_split(spark, sf_dir):
    train, holdout = holdout_split(written_once(demand(spark, sf_dir), "daily-demand"))
    both = train.withColumn("is_holdout", F.lit(False)).unionByName(holdout.withColumn("is_holdout", F.lit(True)))
    return shown(both)


@query(
    FORECAST
    + f"""SELECT {day("h.ds")} AS ds, CAST(h.y AS BIGINT) AS y, CAST(p.y AS DOUBLE) AS yhat
FROM holdout h LEFT JOIN days p ON p.ds = h.ds - 7"""
)
def forecast_naive_holdout(spark, sf_dir):
    series = written_once(demand(spark, sf_dir), "daily-demand")
    _, holdout = holdout_split(series)
    baseline = naive_baseline(series).join(holdout.select("ds"), "ds", "left_semi")
    return shown(baseline.select("ds", "y", F.col("yhat").cast("double")))


_FORECAST_ROW = f"""{day("forecast_date")} AS forecast_date, actual_trip_count,
  round(predicted_trip_count, 6) AS predicted_trip_count, round(predicted_lower_bound, 6) AS predicted_lower_bound,
  round(predicted_upper_bound, 6) AS predicted_upper_bound, is_future"""


@query(FORECAST + f"SELECT {_FORECAST_ROW} FROM forecast")
def forecast_seasonal(spark, sf_dir):
    forecast = staged_forecast(spark, sf_dir)
    return shown(forecast.withColumn("actual_trip_count", F.col("actual_trip_count").cast("double")), 6)


_MAPE = "round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 6) AS mape, count(abs((y - yhat) / nullif(y, 0))) AS scored_days"


@query(
    FORECAST
    + f""", preds AS (
  SELECT 'seasonal' AS model, h.ds, h.y, level + b * h.t AS yhat FROM holdout h JOIN past_fit USING (wd)
  UNION ALL
  SELECT 'naive', h.ds, h.y, p.y FROM holdout h LEFT JOIN days p ON p.ds = h.ds - 7),
scores AS (SELECT model, {_MAPE}, count(*) - count(yhat) AS unscored_days FROM preds GROUP BY model)
SELECT *, mape < (SELECT mape FROM scores WHERE model = 'naive') AS beats_baseline FROM scores"""
)
def forecast_mape_compare(spark, sf_dir):
    return shown(evaluate(written_once(demand(spark, sf_dir), "daily-demand")), 6)


@query(
    FORECAST
    + f""", preds AS (
  SELECT 'seasonal' AS model, h.ds, h.y, level + b * h.t AS yhat FROM holdout h JOIN past_fit USING (wd)
  UNION ALL
  SELECT 'naive', h.ds, h.y, p.y FROM holdout h LEFT JOIN days p ON p.ds = h.ds - 7),
scores AS (SELECT model, {_MAPE} FROM preds GROUP BY model)
SELECT max(mape) FILTER (WHERE model = 'seasonal') AS model_mape, max(mape) FILTER (WHERE model = 'naive') AS naive_mape,
  max(mape) FILTER (WHERE model = 'seasonal') < max(mape) FILTER (WHERE model = 'naive') AS model_beats_naive,
  (SELECT count(*) FROM forecast) AS output_rows, (SELECT count(*) FROM days) AS historical_rows,
  (SELECT count(*) FROM ahead) AS future_rows FROM scores"""
)
def forecast_run_record(spark, sf_dir):
    series = written_once(demand(spark, sf_dir), "daily-demand")
    return shown(run_record(evaluate(series), seasonal_forecast(series)), 6)


_ERRORS = (
    FORECAST
    + f"""SELECT {_FORECAST_ROW}, round(CASE WHEN NOT is_future
  THEN abs(actual_trip_count - predicted_trip_count) / nullif(actual_trip_count, 0) END, 6) AS pct_error FROM forecast"""
)


def _forecast_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.mart_demand_forecast(staged_forecast(spark, sf_dir))
    return mart.withColumn("actual_trip_count", F.col("actual_trip_count").cast("double"))


@query(_ERRORS)
def mart_demand_forecast(spark, sf_dir):
    return shown(_forecast_mart(spark, sf_dir), 6)


@query(_ERRORS + " WHERE NOT is_future")
def forecast_error_history(spark, sf_dir):
    return shown(serve(_forecast_mart(spark, sf_dir), ~F.col("is_future"), [F.col("forecast_date")]), 6)


# The same model for five series at once: one per order priority.
_PRIORITY_DAYS = """
WITH days AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS t,
    dayofweek(CAST(o_orderdate AS DATE)) AS wd
  FROM orders GROUP BY ALL),
line AS (SELECT series, regr_slope(y, t) AS b FROM days GROUP BY series),
fit AS (SELECT series, wd, avg(y) - any_value(b) * avg(t) AS level, any_value(b) AS b FROM days JOIN line USING (series) GROUP BY ALL)
"""


@query(
    _PRIORITY_DAYS
    + f"""SELECT series, {day("ds")} AS ds, y, round(level + b * t, 6) AS yhat FROM days JOIN fit USING (series, wd)"""
)
def forecast_fit_by_series(spark, sf_dir):
    order = inputs.table(spark, sf_dir, "orders")
    keys = [F.col("o_orderpriority").alias("series"), F.col("o_orderdate").cast("date").alias("ds")]
    daily = written_once(order.groupBy(*keys).agg(F.count(F.lit(1)).alias("y")), "daily-by-priority")
    fitted = predict_seasonal(daily, fit_seasonal(daily, series=["series"]), series=["series"])
    return shown(fitted.select("series", "ds", F.col("y").cast("double"), "yhat"), 6)
