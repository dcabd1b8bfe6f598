"""Adapters: the driver's tables seen as the pipeline's logical inputs.

Only these functions know the driver's tables; every operator and plan works on the
logical schemas. Timestamps are stored without a zone and read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The daily weather calendar covers these days; later trips stay unmatched.
WEATHER_FIRST_DAY = "1995-01-01"
WEATHER_LAST_DAY = "2000-12-31"

# How stream event types map to order lifecycle stages.
ORDER_STAGES = {
    "view": "order_created",
    "signup": "picked_up",
    "click": "in_transit",
    "purchase": "delivered",
    "error": "cancelled",
}

# Columns that make the trip deduplication order total.
TRIP_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def later(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + minutes * 60_000_000)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records under their raw column names, one per line item."""
    order = table(spark, sf_dir, "orders")
    buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    seller = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Order-level columns are computed once per order, below the join with its items.
    placed = order.join(buyer, order.o_custkey == buyer.c_custkey).select(
        "o_orderkey",
        later(F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 1440).alias("tpep_pickup_datetime"),
        F.when(F.col("c_custkey") % 301 != 0, F.col("c_nationkey")).cast("bigint").alias("DOLocationID"),
        F.concat(F.lit("trips/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".parquet")).alias("_source_file"),
    )
    item = table(spark, sf_dir, "lineitem")
    # Items and orders grow together, so they always meet in a shuffle join; file sizes
    # of compressed columns could otherwise talk the planner into broadcasting either.
    joined = item.join(placed.hint("merge"), item.l_orderkey == placed.o_orderkey)
    joined = joined.join(seller, item.l_suppkey == seller.s_suppkey)
    ride = (F.col("l_partkey") * 7 + F.col("l_quantity").cast("bigint") * 3) % 200 - 10
    return joined.select(
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        "tpep_pickup_datetime",
        later(F.col("tpep_pickup_datetime"), ride).alias("tpep_dropoff_datetime"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .when(F.col("l_partkey") % 50 == 0, F.lit(12.0))
        .otherwise(F.col("l_linenumber").cast("double"))
        .alias("passenger_count"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_quantity") / 2).alias("trip_distance"),
        F.col("s_nationkey").cast("bigint").alias("PULocationID"),
        "DOLocationID",
        F.when(F.col("l_partkey") % 211 == 0, F.lit(-1.0))
        .otherwise(F.col("l_extendedprice") / 1000)
        .alias("fare_amount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"),
        "_source_file",
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        *TRIP_TIEBREAK,
    )


def weather(spark: SparkSession) -> DataFrame:
    """The daily weather dimension: one row per calendar day."""
    first, last = F.lit(WEATHER_FIRST_DAY).cast("date"), F.lit(WEATHER_LAST_DAY).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("weather_date"))
    doy = F.dayofyear("weather_date")
    low = (doy * 7 % 30 - 12).cast("double")
    return days.select(
        "weather_date",
        (low + 8).alias("temp_max_c"),
        low.alias("temp_min_c"),
        F.greatest(F.lit(0), doy * 37 % 11 - 5).cast("double").alias("precipitation_mm"),
        F.when(doy % 17 == 0, doy % 5 + 1).otherwise(0).cast("double").alias("snowfall_cm"),
        (doy % 23 + 10).cast("double").alias("windspeed_max_kmh"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product reviews under their raw column names, one per order."""
    order = table(spark, sf_dir, "orders")
    buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = order.join(buyer, order.o_custkey == buyer.c_custkey)
    key = F.col("o_orderkey")

    def image(n: int):
        url = F.concat(F.lit("img/"), key.cast("string"), F.lit(f"/{n}"))
        small = F.concat(url, F.lit("/small"))
        return F.struct(
            F.lit("IMAGE").alias("attachment_type"),
            url.alias("large_image_url"),
            small.alias("medium_image_url"),
            small.alias("small_image_url"),
        )

    none = F.filter(F.array(image(1)), lambda _: F.lit(False))
    images = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 3 == 0, none)
        .when(key % 3 == 1, F.array(image(1)))
        .otherwise(F.array(image(1), image(2)))
    )
    # Few products per customer, so that some customers review one twice on a day.
    return joined.select(
        (F.col("o_custkey") % 997).cast("string").alias("asin"),
        (F.col("o_custkey") % 97).cast("string").alias("parent_asin"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(key % 89 != 0, F.substring("o_orderpriority", 1, 1).cast("double")).alias("rating"),
        F.concat(F.lit("title "), key.cast("string")).alias("title"),
        F.when(key % 83 != 0, F.concat(F.lit("text of "), key.cast("string"))).alias("text"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        (key % 11).alias("helpful_vote"),
        (F.col("o_orderstatus") == "F").alias("verified_purchase"),
        images.alias("images"),
        F.concat(F.lit("reviews/"), F.col("c_mktsegment"), F.lit(".jsonl")).alias("_source_file"),
        F.timestamp_add("HOUR", key % 5, F.lit("2001-09-01").cast("timestamp")).alias("_ingested_at"),
        key.alias("o_orderkey"),
    )


def order_event_values(events: DataFrame) -> DataFrame:
    """Batch or streaming ``events`` as keyed-bus messages: JSON in a binary ``value``."""
    stage = F.col("event_type")
    for raw, name in ORDER_STAGES.items():
        stage = F.when(F.col("event_type") == raw, F.lit(name)).otherwise(stage)
    body = F.struct(
        F.col("user_id").cast("string").alias("order_id"),
        F.concat(F.lit("d"), F.col("event_id").cast("string")).alias("delivery_id"),
        stage.alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        (F.col("user_id") % 25).alias("pickup_location_id"),
        (F.col("user_id") % 2 + 1).alias("vendor_id"),
        F.col("value").alias("order_value"),
    )
    return events.select(F.to_json(body).cast("binary").alias("value"))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day: the demand series."""
    order = table(spark, sf_dir, "orders")
    return order.groupBy(F.col("o_orderdate").cast("date").alias("ds")).agg(F.count(F.lit(1)).alias("y"))
