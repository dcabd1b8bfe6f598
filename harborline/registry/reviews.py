"""Review queries: silver, summaries, nested fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.columns import array_count
from harborline.operators.profiling import value_range
from harborline.operators.projection import nested_fields
from harborline.operators.validity import VALID_FLAG
from harborline.plans import gold, inputs, silver
from harborline.registry.core import query, shown
from harborline.registry.sql import REVIEWS, moment
from harborline.session import scratch_dir
from harborline.sources.sinks import read_split, write_split

_ROW = ["review_id", "asin", "user_id", "category", "review_ts", "rating", "text", "verified_purchase", "helpful_vote"]
_IMAGES = ["image_count", "primary_image_url"]


def silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = silver.reviews_silver(inputs.raw_reviews(spark, sf_dir), ["o_orderkey"])
    return kept


@query(
    REVIEWS
    + f"""SELECT review_id, asin, user_id, category, {moment("review_ts")} AS review_ts, rating, text,
  verified_purchase, helpful_vote, image_count, primary_image_url FROM silver"""
)
def review_silver_valid(spark, sf_dir):
    """Writes the silver table partitioned by category and its rejects in one job, then reads the valid side back."""
    target = scratch_dir(spark, "reviews")
    settled = silver.reviews_settled(inputs.raw_reviews(spark, sf_dir), ["o_orderkey"]).select(*_ROW, *_IMAGES, VALID_FLAG)
    write_split(settled, target, VALID_FLAG, ["category"], derive=silver.with_review_key)
    return shown(read_split(spark, target, True, settled.schema).select(*_ROW, *_IMAGES))


@query(REVIEWS + "SELECT o_orderkey, image_count, primary_image_url FROM raw")
def review_nested_images(spark, sf_dir):
    """Array-of-struct access over NULL, empty and filled arrays."""
    derived = silver.derive_reviews(inputs.raw_reviews(spark, sf_dir))
    return derived.select("o_orderkey", "image_count", "primary_image_url")


@query(REVIEWS + "SELECT * FROM monthly")
def review_summary(spark, sf_dir):
    return gold.review_summary(silver_reviews(spark, sf_dir))


@query(REVIEWS + "SELECT min(rating) AS min_value, max(rating) AS max_value FROM silver")
def rating_range(spark, sf_dir):
    return value_range(silver_reviews(spark, sf_dir), "rating")


_IMAGE_TYPE = (
    "array<struct<attachment_type:string,large_image_url:string,medium_image_url:string,small_image_url:string>>"
)


@query(
    REVIEWS
    + f"""SELECT 'embeddings' AS table_name, 'embedding' AS column_name, 'array<float>' AS data_type, count(*) AS row_count,
  count(*) FILTER (WHERE embedding IS NULL) AS null_rows, CAST(sum(len(embedding)) AS BIGINT) AS elements FROM embeddings
UNION ALL
SELECT 'reviews', 'images', '{_IMAGE_TYPE}', count(*), count(*) FILTER (WHERE o_orderkey % 7 = 0),
  CAST(sum(image_count) AS BIGINT) FROM raw"""
)
def schema_report(spark, sf_dir):
    """Every nested column of two tables, with how full it is."""
    frames = {"embeddings": inputs.table(spark, sf_dir, "embeddings"), "reviews": inputs.raw_reviews(spark, sf_dir)}
    profiled = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(column).isNull()).alias("null_rows"),
            F.sum(array_count(column)).alias("elements"),
        ).select(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(dtype.simpleString()).alias("data_type"),
            "row_count",
            "null_rows",
            "elements",
        )
        for name, df in frames.items()
        for column, dtype in nested_fields(df.schema)
    ]
    return reduce(DataFrame.unionByName, profiled)
