"""Batch sinks: tables, partitioned writes, rejects, exports and DDL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from harborline.sources.readers import read_table


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_schema: bool = False,
    fmt: str = "parquet",
) -> int:
    """Write to a path or catalog table and return the row count read back from it.

    A partitioned write is rebalanced on its partition columns: rows of one value end
    up in few files, and adaptive execution splits a value that dominates the table.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = out.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return read_table(df.sparkSession, target, fmt).count()


def quarantine(df: DataFrame, target: str, fmt: str = "parquet") -> int:
    """Keep rejected rows, unpartitioned, for audit."""
    return write_table(df, target, fmt=fmt)


#: The folder level that keeps valid and rejected rows apart in a table written by ``write_split``.
SPLIT = "is_valid"


def write_split(settled: DataFrame, target: str, flag: str, partition_by: Sequence[str] = (), fmt: str = "parquet", derive: Callable[[DataFrame], DataFrame] | None = None) -> tuple[int, int]:
    """Write kept and rejected rows in one job, each under its own folder, and return their counts.

    The input is computed once: the counts are observed while it is written. ``read_split`` reads one side.
    Columns that ``derive`` computes from the others are computed once more above the rebalancing shuffle and not moved through it.
    """
    out = settled.withColumnRenamed(flag, SPLIT)
    seen = Observation()
    kept = F.col(SPLIT)
    observed = out.observe(seen, F.count_if(kept).alias("kept"), F.count_if(~kept).alias("rejected"))
    dealt = observed.hint("rebalance", kept, *[F.col(c) for c in partition_by])
    writer = (derive(dealt) if derive else dealt).write
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")  # keys in hexadecimal take half the room
    writer.format(fmt).mode("overwrite").partitionBy(SPLIT, *partition_by).save(target)
    return seen.get["kept"], seen.get["rejected"]


def read_split(spark: SparkSession, target: str, kept: bool, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The kept or the rejected rows of a split table, empty where there are none. ``schema`` is that of the rows written."""
    fields = [f for f in schema.fields if f.name not in (SPLIT, "_is_valid")]
    full = StructType([*fields, StructField(SPLIT, BooleanType())])
    return spark.read.format(fmt).schema(full).load(target).where(F.col(SPLIT) == kept).drop(SPLIT)


def export_tables(spark: SparkSession, names: Sequence[str], base: str) -> DataFrame:
    """Copy catalog tables to plain Parquet and report the rows written to each.

    Rows are observed during the write, so no table is scanned a second time.
    """
    written = []
    for name in names:
        short = name.split(".")[-1]
        seen = Observation()
        spark.table(name).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/{short}")
        written.append((short, seen.get["n"]))
    return spark.createDataFrame(written, "table_name string, exported_rows bigint")


def ensure_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet", location: str | None = None) -> None:
    """Create the namespace and an empty table unless they exist."""
    if "." in name:
        ensure_namespace(spark, name.rsplit(".", 1)[0], location)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}")


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """Publish a model: staging and intermediate as views, marts as tables."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    return df.sparkSession.table(name)
