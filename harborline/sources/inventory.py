"""Inventories of landed files: listings kept on storage, and what changed since the last one.

A listing is a frame; it is compared with the stored one by a join on Spark, so no list of files passes through the
driver. An inventory is stored as generations: a new one is complete or not there at all, and the one before it stays for
whoever still reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.sources import folders

FILE = "path string, size long, modified timestamp"


def listing(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """``(path, size, modified)`` of the files under ``path``, at any depth. Their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    return files.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _generation(spark: SparkSession, store: str) -> int:
    """The newest complete generation of a store, or -1."""
    complete = (int(n) for n in reversed(folders.names(spark, store)) if n.isdigit() and folders.exists(spark, f"{store}/{n}/_SUCCESS"))
    return next(complete, -1)


def stored(spark: SparkSession, store: str, schema: str = FILE) -> DataFrame:
    """The inventory last published at ``store``; an empty one before the first."""
    last = _generation(spark, store)
    return spark.read.schema(schema).parquet(f"{store}/{last:012d}") if last >= 0 else spark.createDataFrame([], schema)


def publish(inventory: DataFrame, store: str) -> None:
    """Store an inventory as the next generation. One publisher of a store runs at a time."""
    spark = inventory.sparkSession
    last = _generation(spark, store)
    inventory.write.mode("overwrite").parquet(f"{store}/{last + 1:012d}")
    for name in folders.names(spark, store):
        if name.isdigit() and int(name) < last:
            folders.remove(spark, f"{store}/{name}")


def difference(now: DataFrame, before: DataFrame) -> DataFrame:
    """``(path, change, size, modified)`` of files that are ``new``, ``changed`` (size or time) or ``gone``."""
    old = before.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    both = now.select("path", "size", "modified").join(old, "path", "full")
    change = (
        F.when(F.col("_modified").isNull(), "new")
        .when(F.col("modified").isNull(), "gone")
        .when((F.col("size") != F.col("_size")) | (F.col("modified") != F.col("_modified")), "changed")
    )
    sizes = [F.coalesce("size", "_size").alias("size"), F.coalesce("modified", "_modified").alias("modified")]
    return both.select("path", change.alias("change"), *sizes).where("change is not null")


def landed_since(spark: SparkSession, path: str, store: str, suffix: str = "") -> DataFrame:
    """The new and changed files under ``path`` since the inventory at ``store`` was published."""
    return difference(listing(spark, path, suffix), stored(spark, store)).where("change <> 'gone'")
