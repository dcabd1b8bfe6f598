"""Bronze: trips from drifting Parquet; reviews come through ``streaming.ingest``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.columns import month_in_path
from harborline.operators.profiling import null_rate_by
from harborline.sources.readers import read_drifting_parquet
from harborline.sources.sinks import write_table

# Raw trip columns whose numeric or timestamp type differs between files.
TRIP_CASTS = {
    "VendorID": "bigint",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
}


def trips_bronze(spark: SparkSession, source: str, manifest: str | None = None) -> DataFrame:
    unioned = read_drifting_parquet(spark, source, TRIP_CASTS, manifest=manifest)
    return unioned.withColumn("_ingested_at", F.current_timestamp())


def build_trips_bronze(spark: SparkSession, source: str, target: str, fmt: str = "parquet", manifest: str | None = None) -> DataFrame:
    """Full reprocess of the landed files; returns the per-month null report.

    With ``manifest`` the files' schemas are kept there, so a rerun opens the footers of new files only.
    """
    write_table(trips_bronze(spark, source, manifest), target, replace_schema=True, fmt=fmt)
    written = spark.read.format(fmt).load(target)
    return null_rate_by(written, month_in_path("_source_file"), ["VendorID", "PULocationID"], "source_month")
