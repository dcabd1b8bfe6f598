"""SQL building blocks shared by the oracles (DuckDB dialect)."""

from __future__ import annotations

from statistics import NormalDist

from harborline.plans.inputs import ORDER_STAGES, WEATHER_FIRST_DAY, WEATHER_LAST_DAY


def half_up(x: str, n: int) -> str:
    """Round half up on the decimal value, the way Spark rounds a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 9)), {n}) AS DOUBLE)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def moment(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


_SECONDS = "'%Y-%m-%d %H:%M:%S'"
_RATES = f"""
  count(*) AS total_trips,
  count(*) FILTER (WHERE is_on_time) AS on_time_trips,
  count(*) FILTER (WHERE NOT is_on_time) AS delayed_trips,
  {half_up("count(*) FILTER (WHERE is_on_time) / count(*)::DOUBLE", 4)} AS on_time_rate,
  {half_up("avg(CASE WHEN NOT is_on_time THEN delay_minutes END)", 2)} AS avg_delay_minutes"""

# Trips: raw -> flagged -> valid, deduplicated -> enriched -> gold.
TRIPS = f"""
WITH raw AS (
  SELECT l_suppkey % 2 + 1 AS vendor_id,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS pickup_ts,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT))
      + to_minutes((l_partkey * 7 + CAST(l_quantity AS BIGINT) * 3) % 200 - 10) AS dropoff_ts,
    CAST(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 50 = 0 THEN 12 ELSE l_linenumber END AS DOUBLE) AS passenger_count,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_quantity / 2 END AS trip_distance_miles,
    CAST(s_nationkey AS BIGINT) AS pickup_location_id,
    CAST(CASE WHEN c_custkey % 301 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS dropoff_location_id,
    CASE WHEN l_partkey % 211 = 0 THEN -1.0::DOUBLE ELSE l_extendedprice / 1000 END AS fare_amount,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
    'trips/' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS source_file,
    l_shipdate AS ingested_at, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey),
derived AS (
  SELECT *, sha256(concat_ws('|', vendor_id::VARCHAR, strftime(pickup_ts, {_SECONDS}),
      pickup_location_id::VARCHAR, dropoff_location_id::VARCHAR)) AS delivery_id,
    date_diff('second', pickup_ts, dropoff_ts) / 60.0::DOUBLE AS trip_duration_minutes,
    CAST(pickup_ts AS DATE) AS pickup_date
  FROM raw),
flagged AS (
  SELECT *, coalesce(pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND dropoff_ts > pickup_ts
      AND trip_duration_minutes BETWEEN 0 AND 180 AND trip_distance_miles BETWEEN 0 AND 200 AND fare_amount >= 0
      AND (passenger_count IS NULL OR passenger_count BETWEEN 0 AND 9)
      AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL, false) AS is_valid
  FROM derived),
silver AS (
  SELECT * FROM flagged WHERE is_valid
  QUALIFY row_number() OVER (PARTITION BY delivery_id ORDER BY ingested_at DESC, l_orderkey DESC,
    l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
calendar AS (
  SELECT CAST(d AS DATE) AS weather_date, dayofyear(d) AS doy
  FROM generate_series(TIMESTAMP '{WEATHER_FIRST_DAY}', TIMESTAMP '{WEATHER_LAST_DAY}', INTERVAL 1 DAY) AS s(d)),
weather AS (
  SELECT weather_date, CAST(doy * 7 % 30 - 4 AS DOUBLE) AS temp_max_c, CAST(doy * 7 % 30 - 12 AS DOUBLE) AS temp_min_c,
    CAST(greatest(0, doy * 37 % 11 - 5) AS DOUBLE) AS precipitation_mm,
    CAST(CASE WHEN doy % 17 = 0 THEN doy % 5 + 1 ELSE 0 END AS DOUBLE) AS snowfall_cm,
    CAST(10 + doy % 23 AS DOUBLE) AS windspeed_max_kmh
  FROM calendar),
enriched AS (SELECT * FROM silver LEFT JOIN weather ON pickup_date = weather_date),
budgeted AS (
  SELECT *, CASE WHEN trip_distance_miles <= 2 THEN 15 WHEN trip_distance_miles <= 5 THEN 25
    WHEN trip_distance_miles <= 10 THEN 40 ELSE 60 END AS expected_max_minutes
  FROM enriched WHERE pickup_date BETWEEN DATE '{WEATHER_FIRST_DAY}' AND DATE '{WEATHER_LAST_DAY}'),
classified AS (
  SELECT *, trip_duration_minutes <= expected_max_minutes AS is_on_time,
    trip_duration_minutes - expected_max_minutes AS delay_minutes,
    CASE WHEN snowfall_cm > 0 THEN 'Snow' WHEN precipitation_mm > 0 THEN 'Rain'
      WHEN temp_min_c < -5 THEN 'Extreme Cold' ELSE 'Clear' END AS weather_severity
  FROM budgeted),
gold_daily AS (
  SELECT pickup_date, count(*) AS trip_count, avg(fare_amount) AS avg_fare_amount,
    avg(trip_distance_miles) AS avg_trip_distance_miles, avg(trip_duration_minutes) AS avg_trip_duration_minutes,
    sum(total_amount) AS total_revenue, any_value(temp_max_c) AS temp_max_c, any_value(temp_min_c) AS temp_min_c,
    any_value(precipitation_mm) AS precipitation_mm, any_value(snowfall_cm) AS snowfall_cm
  FROM classified GROUP BY pickup_date),
gold_sla AS (SELECT pickup_date, pickup_location_id, {_RATES} FROM classified GROUP BY ALL),
gold_weather AS (SELECT pickup_date, weather_severity, {_RATES} FROM classified GROUP BY ALL),
sla_daily AS (
  SELECT pickup_date, CAST(sum(total_trips) AS BIGINT) AS sla_total_trips, CAST(sum(on_time_trips) AS BIGINT) AS on_time_trips,
    CAST(sum(delayed_trips) AS BIGINT) AS delayed_trips,
    sum(on_time_trips)::DOUBLE / nullif(sum(total_trips), 0)::DOUBLE AS on_time_rate, avg(avg_delay_minutes) AS avg_delay_minutes
  FROM gold_sla GROUP BY pickup_date),
daily_perf AS (
  SELECT d.pickup_date, trip_count, total_revenue, precipitation_mm, snowfall_cm, temp_max_c, temp_min_c,
    s.sla_total_trips, s.on_time_trips, s.delayed_trips, s.on_time_rate, s.avg_delay_minutes,
    w.weather_severity, w.on_time_rate AS weather_on_time_rate, w.avg_delay_minutes AS weather_avg_delay_minutes
  FROM gold_daily d LEFT JOIN sla_daily s USING (pickup_date) LEFT JOIN gold_weather w USING (pickup_date))
"""

_IMAGE = "CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 2 END"
REVIEWS = f"""
WITH raw AS (
  SELECT CAST(o_custkey % 997 AS VARCHAR) AS asin, CAST(o_custkey AS VARCHAR) AS user_id,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS rating,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE 'text of ' || o_orderkey END AS text,
    o_orderdate AS review_ts, o_orderstatus = 'F' AS verified_purchase, o_orderkey % 11 AS helpful_vote,
    {_IMAGE} AS image_count, CASE WHEN {_IMAGE} > 0 THEN 'img/' || o_orderkey || '/1' END AS primary_image_url,
    c_mktsegment AS category, o_orderkey % 5 AS ingest_hour, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey),
flagged AS (
  SELECT *, sha256(concat_ws('|', asin, user_id, strftime(review_ts, {_SECONDS}))) AS review_id,
    coalesce(asin IS NOT NULL AND user_id IS NOT NULL AND rating BETWEEN 1 AND 5
      AND review_ts IS NOT NULL AND text IS NOT NULL, false) AS is_valid
  FROM raw),
silver AS (
  SELECT * FROM flagged WHERE is_valid
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY ingest_hour DESC, o_orderkey DESC) = 1),
monthly AS (
  SELECT category, strftime(review_ts, '%Y-%m') AS review_month, count(*) AS review_count,
    {half_up("avg(rating)", 2)} AS avg_rating, {half_up("avg(CAST(verified_purchase AS INT))", 4)} AS verified_purchase_pct
  FROM silver GROUP BY ALL)
"""

_STAGE = " ".join(f"WHEN '{raw}' THEN '{name}'" for raw, name in ORDER_STAGES.items())
ORDER_EVENTS = f"""
WITH history AS (
  SELECT CAST(user_id AS VARCHAR) AS order_id, 'd' || event_id AS delivery_id,
    CASE event_type {_STAGE} ELSE event_type END AS event_type, ts AS event_timestamp,
    user_id % 25 AS pickup_location_id, user_id % 2 + 1 AS vendor_id, value AS order_value
  FROM events),
status AS (
  SELECT order_id, delivery_id, pickup_location_id, vendor_id, order_value,
    event_type AS current_status, event_timestamp AS last_event_timestamp
  FROM history
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC, delivery_id DESC) = 1),
vendors AS (
  SELECT vendor_id, count(*) AS total_orders,
    count(*) FILTER (WHERE current_status = 'delivered') AS delivered_orders,
    count(*) FILTER (WHERE current_status = 'cancelled') AS cancelled_orders,
    count(*) FILTER (WHERE current_status = 'delivered') / count(*)::DOUBLE AS delivered_rate,
    count(*) FILTER (WHERE current_status = 'cancelled') / count(*)::DOUBLE AS cancelled_rate,
    avg(order_value) AS avg_order_value, sum(order_value) AS total_order_value,
    min(last_event_timestamp) AS first_order_timestamp, max(last_event_timestamp) AS last_order_timestamp
  FROM status GROUP BY vendor_id)
"""

# Daily demand series and the trend + weekday model, written out with plain residuals.
_Z80 = NormalDist().inv_cdf(0.9)


def _fit(name: str, days: str) -> str:
    return f"""
{name}_line AS (SELECT regr_slope(y, t) AS b FROM {days}),
{name}_fit AS (SELECT wd, avg(y) - any_value(b) * avg(t) AS level, any_value(b) AS b FROM {days}, {name}_line GROUP BY wd)"""


FORECAST = f"""
WITH series AS (
  SELECT CAST(o_orderdate AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM orders GROUP BY 1),
days AS (SELECT ds, y, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS t, dayofweek(ds) AS wd FROM series),
holdout AS (SELECT * FROM days ORDER BY ds DESC LIMIT 30),
train AS (SELECT * FROM days WHERE ds < (SELECT min(ds) FROM holdout)),
{_fit("full", "days")},
{_fit("past", "train")},
spread AS (SELECT stddev_samp(y - level - b * t) AS sigma FROM days JOIN full_fit USING (wd)),
ahead AS (
  SELECT CAST((SELECT max(ds) FROM days) + CAST(i AS INT) AS DATE) AS ds FROM generate_series(1, 30) AS s(i)),
spine AS (
  SELECT ds, y, t, wd FROM days UNION ALL
  SELECT ds, NULL, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE), dayofweek(ds) FROM ahead),
forecast AS (
  SELECT ds AS forecast_date, y AS actual_trip_count, level + b * t AS predicted_trip_count,
    level + b * t - {_Z80!r} * sigma AS predicted_lower_bound, level + b * t + {_Z80!r} * sigma AS predicted_upper_bound,
    y IS NULL AS is_future
  FROM spine JOIN full_fit USING (wd), spread)
"""
