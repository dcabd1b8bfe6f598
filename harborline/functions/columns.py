"""``Column`` builders. Everything here stays in JVM expressions (no UDFs)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# How a path names its month, and (before a suffix) its file.
MONTH_PATTERN = r"(\d{4}-\d{2})"
STEM_PATTERN = r"([^/]+)"


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys, strings, paths ---------------------------------------------------------


def key_text(*parts: ColumnLike, sep: str = "|") -> Column:
    """The text that ``surrogate_key`` is a hash of: shorter, and equal where the key is."""
    return F.concat_ws(sep, *[as_column(p).cast("string") for p in parts])


def surrogate_key(*parts: ColumnLike, sep: str = "|") -> Column:
    """Deterministic SHA-256 key over the text of ``parts``.

    ``concat_ws`` skips NULLs, so the key is never NULL and two rows that differ only in
    which part is NULL can share it; pair it with a validity rule on the parts.
    """
    return F.sha2(key_text(*parts, sep=sep), 256)


def file_stem(path: ColumnLike, suffix: str) -> Column:
    """Base name of a file path without ``suffix``; ``''`` if the path does not end so."""
    return F.regexp_extract(as_column(path), STEM_PATTERN + re.escape(suffix) + "$", 1)


def month_in_path(path: ColumnLike) -> Column:
    """First ``yyyy-MM`` found in a path; ``''`` if there is none."""
    return F.regexp_extract(as_column(path), MONTH_PATTERN, 1)


# --- dates ------------------------------------------------------------------------


def minutes_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Minutes from ``start`` to ``end``, at whole-second resolution."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))) / F.lit(60.0)


def epoch_millis(c: ColumnLike) -> Column:
    return F.timestamp_millis(as_column(c))


def month_key(ts: ColumnLike) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM")


def month_start(key: ColumnLike) -> Column:
    """``yyyy-MM`` text to the first day of that month."""
    return F.to_date(F.concat(as_column(key), F.lit("-01")))


# --- guarded maths ----------------------------------------------------------------


def div0(a: ColumnLike, b: ColumnLike) -> Column:
    """``a / b``, and 0 when ``b`` is 0."""
    a, b = as_column(a), as_column(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def safe_div(a: ColumnLike, b: ColumnLike) -> Column:
    """``a / b``, and NULL when ``b`` is 0."""
    return F.try_divide(as_column(a), as_column(b))


def safe_corr(x: ColumnLike, y: ColumnLike) -> Column:
    """Pearson correlation over rows where both sides are set; NULL if either is constant."""
    x, y = as_column(x), as_column(y)
    paired_x, paired_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(paired_x) * F.stddev_pop(paired_y)
    return F.try_divide(F.covar_pop(x, y), spread)


# --- conditionals -----------------------------------------------------------------


def tier(c: ColumnLike, bounds: Sequence[float], values: Sequence, default) -> Column:
    """``values[i]`` for the first bound with ``c <= bounds[i]``, else ``default``."""
    if len(bounds) != len(values) or not bounds:
        raise ValueError("tier needs as many values as bounds, and at least one")
    c, expr = as_column(c), None
    for bound, value in zip(bounds, values):
        expr = F.when(c <= bound, F.lit(value)) if expr is None else expr.when(c <= bound, F.lit(value))
    return expr.otherwise(F.lit(default))


def weather_severity(
    snow: ColumnLike = "snowfall_cm",
    rain: ColumnLike = "precipitation_mm",
    tmin: ColumnLike = "temp_min_c",
    cold: float = -5,
) -> Column:
    """Snow outranks Rain, which outranks Extreme Cold; anything else is Clear."""
    return (
        F.when(as_column(snow) > 0, "Snow")
        .when(as_column(rain) > 0, "Rain")
        .when(as_column(tmin) < cold, "Extreme Cold")
        .otherwise("Clear")
    )


# --- arrays -----------------------------------------------------------------------


def array_count(c: ColumnLike) -> Column:
    """Array length, with NULL counted as 0."""
    return F.coalesce(F.size(as_column(c)), F.lit(0))


def first_field(array: ColumnLike, field: str) -> Column:
    """``field`` of the first struct of an array; NULL for a NULL or empty array."""
    return F.get(as_column(array), F.lit(0)).getField(field)


# --- validity predicates ----------------------------------------------------------


def trip_valid(
    max_minutes: float = 180, max_miles: float = 200, min_fare: float = 0, max_passengers: float = 9
) -> Column:
    """Row-level trip rule; NULL when a bounded measure is NULL (see ``split_valid``)."""
    passengers = F.col("passenger_count")
    rules = [
        F.col("pickup_ts").isNotNull(),
        F.col("dropoff_ts").isNotNull(),
        F.col("pickup_location_id").isNotNull(),
        F.col("dropoff_location_id").isNotNull(),
        F.col("dropoff_ts") > F.col("pickup_ts"),
        F.col("trip_duration_minutes").between(0, max_minutes),
        F.col("trip_distance_miles").between(0, max_miles),
        F.col("fare_amount") >= min_fare,
        passengers.isNull() | passengers.between(0, max_passengers),
    ]
    return all_of(rules)


def review_valid(lo: float = 1, hi: float = 5) -> Column:
    """Row-level review rule; an empty text is valid, a missing one is not."""
    present = [F.col(c).isNotNull() for c in ("asin", "user_id", "review_ts", "text")]
    return all_of([*present, F.col("rating").between(lo, hi)])


def all_of(rules: Sequence[Column]) -> Column:
    combined = rules[0]
    for rule in rules[1:]:
        combined = combined & rule
    return combined
