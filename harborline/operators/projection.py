"""Projections, casts and filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from harborline.functions.columns import ColumnLike, as_column


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns of ``mapping`` that exist; skip the others."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def cast_columns(df: DataFrame, casts: Mapping[str, DataType | str]) -> DataFrame:
    """Cast the columns of ``casts`` that exist."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})


def with_audit(df: DataFrame) -> DataFrame:
    """Add ``_source_file`` and ``_ingested_at`` to a file scan (before any union)."""
    return df.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()}
    )


def project(df: DataFrame, outputs: Mapping[str, ColumnLike]) -> DataFrame:
    return df.select([as_column(c).alias(name) for name, c in outputs.items()])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def nested_fields(schema: StructType) -> list[tuple[str, DataType]]:
    """Top-level array and struct columns of a schema."""
    return [(f.name, f.dataType) for f in schema.fields if isinstance(f.dataType, (ArrayType, StructType))]


def _in_range(col: str, start: dt.date, end: dt.date) -> Column:
    # Typed DATE literals, so that a partition column can prune and a file column push down.
    return F.col(col).between(F.lit(start), F.lit(end))


def date_range(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose date lies in ``[start, end]``."""
    return df.filter(_in_range(col, start, end))


def date_range_counts(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows before the filter, after it, and filtered out – in one pass."""
    kept = F.count_if(_in_range(col, start, end))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("rows_before"), kept.alias("rows_after"), (total - kept).alias("rows_out_of_range")
    )


def with_is_future(df: DataFrame, actual: str) -> DataFrame:
    return df.withColumn("is_future", F.col(actual).isNull())


def serve(df: DataFrame, where: Column | None = None, order_by: Sequence[Column] = ()) -> DataFrame:
    """A read query for a dashboard: optional equality filter, then a presentation sort."""
    selected = df if where is None else df.filter(where)
    return selected.orderBy(*order_by) if order_by else selected
