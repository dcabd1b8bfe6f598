"""Enrichment joins and match-rate checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def bounded_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring that it is within both bounds.

    The measurement stops at ``max_rows + 1`` rows and sizes them as JSON text. A larger
    frame comes back unmarked and is joined by shuffle, where adaptive execution splits
    skewed partitions.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    measured = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(size, F.lit(0)).alias("bytes"))
    found = measured.first()
    if found.rows <= max_rows and found.bytes <= max_bytes:
        return F.broadcast(df)
    return df


def enrich_daily(
    fact: DataFrame,
    dim: DataFrame,
    fact_date: str = "pickup_date",
    dim_date: str = "weather_date",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left-join a daily dimension onto a fact table and drop the dimension's key.

    Below the bound the fact is never shuffled, so a day that dominates it is harmless.
    """
    small = bounded_broadcast(dim, max_rows)
    return fact.join(small, fact[fact_date] == dim[dim_date], "left").drop(dim[dim_date])


def match_report(df: DataFrame, probe_col: str) -> DataFrame:
    """After a left join: rows, unmatched rows and their percentage, in one pass."""
    rows, unmatched = F.count(F.lit(1)), F.count_if(F.col(probe_col).isNull())
    return df.agg(
        rows.alias("row_count"),
        unmatched.alias("unmatched_rows"),
        (F.coalesce(F.try_divide(unmatched, rows), F.lit(0.0)) * 100).alias("unmatched_pct"),
    )


def unmatched_keys(df: DataFrame, probe_col: str, key: str | Sequence[str]) -> DataFrame:
    """Distinct join keys that found no partner."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.filter(F.col(probe_col).isNull()).select(*keys).distinct().orderBy(*keys)
