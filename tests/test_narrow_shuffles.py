"""Keys and other derived columns are made above the shuffles and not moved through them."""

from pyspark.sql import functions as F

from harborline.functions.columns import surrogate_key
from harborline.plans import silver
from harborline.registry import quality
from harborline.sources import sinks


def _bronze_trips(spark):
    rows = [(1, "2024-01-02 03:04:05", 9, 5, 7, 1.0, i, f"f{i}") for i in range(3)] + [(None, "2024-01-02 03:04:05", 9, 5, 7, 1.0, 3, "f3"), (2, None, 9, 5, 7, 1.0, 4, "f4"), (2, None, 9, 5, 7, 1.0, 5, "f5")]
    made = spark.createDataFrame(rows, "VendorID long, at string, minutes int, PULocationID long, DOLocationID long, trip_distance double, n int, _source_file string")
    start = F.to_timestamp("at")
    return made.select(
        "VendorID", start.alias("tpep_pickup_datetime"), (start + F.expr("make_dt_interval(0, 0, minutes)")).alias("tpep_dropoff_datetime"), "PULocationID", "DOLocationID",
        "trip_distance", F.lit(2.0).alias("fare_amount"), F.lit(1.0).alias("passenger_count"), F.lit(0).alias("_ingested_at"), "n", "_source_file",
    )


def test_keys_are_not_shuffled(spark, tmp_path):
    settled = silver.trips_settled(_bronze_trips(spark), ["n"])
    kept, _ = silver.trips_silver(_bronze_trips(spark), ["n"])
    for df in (settled, kept):
        above = df._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[0]
        assert "sha2(" in above  # made again above the shuffle by key
    expected = {(1, 2, True), (None, 3, True), (2, 4, False), (2, 5, False)}
    assert {(r["vendor_id"], r["n"], r["_is_valid"]) for r in settled.collect()} == expected
    again = settled.select("n", "delivery_id", "trip_duration_minutes", "pickup_date")
    made = silver.derive_trips(_bronze_trips(spark)).select(*again.columns).where("n >= 2")
    assert sorted(map(str, again.collect())) == sorted(map(str, made.collect()))
    target = str(tmp_path / "s")
    assert sinks.write_split(settled, target, "_is_valid", ["vendor_id"], derive=silver.with_trip_columns) == (2, 2)
    both = sinks.read_split(spark, target, True, settled.schema).union(sinks.read_split(spark, target, False, settled.schema))
    assert sorted(map(str, both.select(*again.columns).collect())) == sorted(map(str, made.collect()))


def test_quality_summary_stores_no_keys(spark, monkeypatch):
    trips = silver.trips_silver(_bronze_trips(spark), ["n"])[0]
    twice = trips.union(trips.where("n = 2"))
    reviews = spark.createDataFrame([("a", "u", 0, 4.0), ("a", "u", 0, 5.0), ("b", None, 1, 1.0)], "asin string, user_id string, t long, rating double")
    reviews = reviews.withColumn("review_ts", F.timestamp_millis("t")).withColumn("review_id", surrogate_key("asin", "user_id", "review_ts"))
    stored = {}
    monkeypatch.setattr(quality, "silver_trips", lambda *_: twice)
    monkeypatch.setattr(quality, "silver_reviews", lambda *_: reviews)
    monkeypatch.setattr(quality, "written_once", lambda df, name: stored.setdefault(name, df))
    found = {r["check_name"]: (r["actual"], r["status"]) for r in quality.silver_quality_summary(spark, "").collect()}
    assert not {"delivery_id", "review_id"} & {c for df in stored.values() for c in df.columns}
    assert found["trips duplicate delivery_id"] == ("1", "FAIL") and found["reviews duplicate review_id"] == ("1", "FAIL")
    assert found["reviews.user_id nulls"] == ("1", "FAIL") and found["trips.delivery_id nulls"] == ("0", "PASS")
    assert found["reviews.rating range"] == ("1.0-5.0", "PASS") and found["trips_weather.temp_max_c nulls"] == ("3", "FAIL")
