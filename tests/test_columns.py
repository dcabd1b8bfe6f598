import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from harborline.functions import columns as c


def one(spark, expr, schema, *row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first().x


def test_surrogate_key_is_sha256_of_joined_text(spark):
    ts = dt.datetime(2023, 1, 2, 3, 4)
    got = one(spark, c.surrogate_key("a", "t", "b"), "a bigint, t timestamp, b bigint", 1, ts, 7)
    assert got == hashlib.sha256(b"1|2023-01-02 03:04:00|7").hexdigest()


def test_surrogate_key_skips_nulls_and_so_can_collide(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    keys = [r.k for r in df.select(c.surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] == keys[1] and keys[0] is not None


def test_div0_and_safe_div_differ_on_zero(spark):
    df = spark.createDataFrame([(3, 0), (0, 0), (3, 4), (None, 2)], "a bigint, b bigint")
    got = [tuple(r) for r in df.select(c.div0("a", "b"), c.safe_div("a", "b")).collect()]
    assert got == [(0.0, None), (0.0, None), (0.75, 0.75), (None, None)]


def test_tier_bounds_are_inclusive_and_null_falls_through(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (2.1,), (10.0,), (10.1,), (None,)], "d double")
    got = [r.x for r in df.select(c.tier("d", (2, 5, 10), (15, 25, 40), 60).alias("x")).collect()]
    assert got == [15, 15, 25, 40, 60, 60]


def test_tier_needs_matching_lists():
    with pytest.raises(ValueError):
        c.tier("d", (1, 2), (1,), 0)


@pytest.mark.parametrize(
    "snow, rain, tmin, expected",
    [
        (1.0, 5.0, -20.0, "Snow"),
        (0.0, 5.0, -20.0, "Rain"),
        (0.0, 0.0, -5.1, "Extreme Cold"),
        (0.0, 0.0, -5.0, "Clear"),
        (None, None, None, "Clear"),
        (None, 1.0, None, "Rain"),
    ],
)
def test_weather_severity_priority(spark, snow, rain, tmin, expected):
    schema = "snowfall_cm double, precipitation_mm double, temp_min_c double"
    assert one(spark, c.weather_severity(), schema, snow, rain, tmin) == expected


def test_safe_corr_is_null_for_constants_and_ignores_half_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (None, 99.0, 5.0), (50.0, None, None)],
        "x double, y double, k double",
    )
    got = df.agg(c.safe_corr("x", "y").alias("xy"), c.safe_corr("x", "k").alias("xk")).first()
    assert got.xy == pytest.approx(1.0) and got.xk is None
    assert df.limit(1).agg(c.safe_corr("x", "y").alias("v")).first().v is None


def test_array_helpers_on_null_empty_and_filled(spark):
    schema = "a array<struct<u string, v int>>"
    df = spark.createDataFrame([(None,), ([],), ([("p", 1), ("q", 2)],)], schema)
    got = [tuple(r) for r in df.select(c.array_count("a"), c.first_field("a", "u")).collect()]
    assert got == [(0, None), (0, None), (2, "p")]


def test_paths_and_dates(spark):
    path = "s3://b/raw/Sports.jsonl"
    assert one(spark, c.file_stem("p", ".jsonl"), "p string", path) == "Sports"
    assert one(spark, c.file_stem("p", ".jsonl"), "p string", path + ".bak") == ""
    assert one(spark, c.month_in_path("p"), "p string", "x/trips_2023-07.parquet") == "2023-07"
    assert one(spark, c.month_in_path("p"), "p string", "x/trips.parquet") == ""
    assert one(spark, c.month_start("m"), "m string", "1998-02") == dt.date(1998, 2, 1)
    assert one(spark, c.epoch_millis("m").cast("string"), "m bigint", 1_000_123) == "1970-01-01 00:16:40.123"


def test_minutes_between_counts_whole_seconds(spark):
    a, b = dt.datetime(2023, 1, 1, 0, 0, 0, 900_000), dt.datetime(2023, 1, 1, 0, 1, 30, 100_000)
    assert one(spark, c.minutes_between("a", "b"), "a timestamp, b timestamp", a, b) == 1.5


def test_review_rule_accepts_empty_text_and_rejects_missing(spark):
    schema = "asin string, user_id string, review_ts timestamp, text string, rating double"
    now = dt.datetime(2020, 1, 1)
    assert one(spark, c.review_valid(), schema, "a", "u", now, "", 5.0) is True
    assert one(spark, c.review_valid(), schema, "a", "u", now, None, 5.0) is False
    assert one(spark, c.review_valid(), schema, "a", "u", now, "t", 5.5) is False
    assert one(spark, c.review_valid(), schema, "a", "u", now, "t", None) is None


TRIP = (
    "pickup_ts timestamp, dropoff_ts timestamp, pickup_location_id bigint, dropoff_location_id bigint, "
    "trip_duration_minutes double, trip_distance_miles double, fare_amount double, passenger_count double"
)
T0, T1 = dt.datetime(2023, 1, 1, 10), dt.datetime(2023, 1, 1, 11)


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, True),
        ({"passenger_count": None}, True),
        ({"passenger_count": 10.0}, False),
        ({"trip_duration_minutes": 180.0}, True),
        ({"trip_duration_minutes": 180.5}, False),
        ({"trip_distance_miles": 200.0}, True),
        ({"trip_distance_miles": -0.1}, False),
        ({"trip_distance_miles": None}, None),
        ({"fare_amount": -0.01}, False),
        ({"fare_amount": None}, None),
        ({"dropoff_location_id": None}, False),
        ({"pickup_ts": None}, False),
        ({"dropoff_ts": T0}, False),
    ],
)
def test_trip_rule(spark, change, expected):
    base = dict(
        pickup_ts=T0, dropoff_ts=T1, pickup_location_id=1, dropoff_location_id=2,
        trip_duration_minutes=60.0, trip_distance_miles=3.0, fare_amount=9.0, passenger_count=1.0,
    )
    row = {**base, **change}
    names = [part.split()[0] for part in TRIP.split(", ")]
    assert one(spark, c.trip_valid(), TRIP, *[row[n] for n in names]) is expected


def test_json_path_of_bad_text_is_null(spark):
    got = one(spark, F.get_json_object("p", "$.k").try_cast("bigint"), "p string", "{bad")
    assert got is None
