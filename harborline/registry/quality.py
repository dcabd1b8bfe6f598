"""Contract and audit queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import contracts
from harborline.operators.validity import VALID_FLAG
from harborline.plans import inputs, marts, silver
from harborline.plans.audit import REVIEW_REQUIRED, TRIP_REQUIRED
from harborline.plans.audit import silver_quality_summary as quality_summary
from harborline.registry.core import query, shown
from harborline.registry.forecasts import staged_forecast
from harborline.registry.marts import order_status, staged_reviews, staged_trip_tables
from harborline.registry.reviews import silver_reviews
from harborline.registry.sql import FORECAST, ORDER_EVENTS, REVIEWS, TRIPS
from harborline.registry.trips import enriched_trips, silver_trips
from harborline.session import scratch_dir, written_once
from harborline.sources.sinks import read_split, write_split

# One oracle statement per rule; tables are named as in each block's common table expressions.
_TABLES = {
    "stg_daily_delivery_summary": "gold_daily",
    "stg_delivery_sla": "gold_sla",
    "stg_weather_delay_impact": "gold_weather",
    "stg_review_summary": "review_monthly",
    "stg_order_status_current": "status",
    "stg_demand_forecast": "forecast",
}


def _blocks() -> str:
    """All shared blocks in one WITH; review names are prefixed where trips use them too."""
    reviews = REVIEWS.strip().removeprefix("WITH ")
    for name in ("raw", "flagged", "silver", "monthly"):
        for before, after in ((f"{name} AS (", f"review_{name} AS ("), (f"FROM {name}", f"FROM review_{name}")):
            reviews = reviews.replace(before, after)
    blocks = [TRIPS, reviews, ORDER_EVENTS, FORECAST]
    return "WITH " + ",\n".join(b.strip().removeprefix("WITH ") for b in blocks)


def _status(failing: str) -> str:
    return f"CASE WHEN {failing} = 0 THEN 'PASS' ELSE 'FAIL' END"


def _rule_sql(model: str, column: str, rule: str, failing: str | None) -> str:
    table = _TABLES[model]
    if failing is None:
        source = f"(SELECT count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column})"
        count = "count(*) FILTER (WHERE n > 1)"
    else:
        source, count = table, f"count(*) FILTER (WHERE {failing})"
    return (
        f"SELECT '{model}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"{count} AS failing_rows, {_status(count)} AS status FROM {source}"
    )


_RULES = [
    ("stg_daily_delivery_summary", "pickup_date", "unique", None),
    ("stg_daily_delivery_summary", "pickup_date", "not_null", "pickup_date IS NULL"),
    ("stg_daily_delivery_summary", "trip_count", "not_null", "trip_count IS NULL"),
    ("stg_daily_delivery_summary", "trip_count", "accepted_range", "trip_count < 0"),
    ("stg_daily_delivery_summary", "total_revenue", "not_null", "total_revenue IS NULL"),
    ("stg_daily_delivery_summary", "total_revenue", "accepted_range", "total_revenue < 0"),
    ("stg_delivery_sla", "pickup_date", "not_null", "pickup_date IS NULL"),
    ("stg_delivery_sla", "pickup_location_id", "not_null", "pickup_location_id IS NULL"),
    ("stg_delivery_sla", "total_trips", "not_null", "total_trips IS NULL"),
    ("stg_delivery_sla", "total_trips", "accepted_range", "total_trips < 0"),
    ("stg_delivery_sla", "on_time_rate", "accepted_range", "on_time_rate NOT BETWEEN 0 AND 1"),
    ("stg_weather_delay_impact", "pickup_date", "not_null", "pickup_date IS NULL"),
    ("stg_weather_delay_impact", "weather_severity", "not_null", "weather_severity IS NULL"),
    (
        "stg_weather_delay_impact",
        "weather_severity",
        "accepted_values",
        "weather_severity NOT IN ('Clear', 'Rain', 'Snow', 'Extreme Cold')",
    ),
    ("stg_weather_delay_impact", "on_time_rate", "accepted_range", "on_time_rate NOT BETWEEN 0 AND 1"),
    ("stg_review_summary", "category", "not_null", "category IS NULL"),
    ("stg_review_summary", "review_month", "not_null", "review_month IS NULL"),
    ("stg_review_summary", "avg_rating", "accepted_range", "avg_rating NOT BETWEEN 1 AND 5"),
    ("stg_review_summary", "verified_purchase_pct", "accepted_range", "verified_purchase_pct NOT BETWEEN 0 AND 1"),
    ("stg_order_status_current", "order_id", "unique", None),
    ("stg_order_status_current", "order_id", "not_null", "order_id IS NULL"),
    ("stg_order_status_current", "current_status", "not_null", "current_status IS NULL"),
    (
        "stg_order_status_current",
        "current_status",
        "accepted_values",
        "current_status NOT IN ('delivered', 'cancelled')",
    ),
    ("stg_order_status_current", "order_value", "accepted_range", "order_value < 0"),
    ("stg_demand_forecast", "forecast_date", "unique", None),
    ("stg_demand_forecast", "forecast_date", "not_null", "forecast_date IS NULL"),
    ("stg_demand_forecast", "predicted_trip_count", "not_null", "predicted_trip_count IS NULL"),
    ("stg_demand_forecast", "predicted_trip_count", "accepted_range", "predicted_trip_count < 0"),
    ("stg_demand_forecast", "is_future", "not_null", "is_future IS NULL"),
]


def contract_rows(spark, sf_dir) -> DataFrame:
    trips = staged_trip_tables(spark, sf_dir)
    frames = {
        "stg_daily_delivery_summary": trips["daily"],
        "stg_delivery_sla": trips["sla"],
        "stg_weather_delay_impact": trips["weather"],
        "stg_review_summary": staged_reviews(spark, sf_dir),
        "stg_order_status_current": order_status(spark, sf_dir),
        "stg_demand_forecast": staged_forecast(spark, sf_dir),
    }
    rules = marts.staging_contracts()
    return reduce(DataFrame.unionByName, [contracts.check(frames[m], rules[m], m) for m in frames])


_CONTRACTS = _blocks() + ", results AS (" + "\nUNION ALL\n".join(_rule_sql(*r) for r in _RULES) + ")\n"


@query(_CONTRACTS + "SELECT * FROM results")
def contract_results(spark, sf_dir):
    return contract_rows(spark, sf_dir)


@query(
    _CONTRACTS
    + """SELECT count(*) AS checks, count(*) FILTER (WHERE status <> 'PASS') AS failed_checks,
  CASE WHEN count(*) FILTER (WHERE status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM results"""
)
def contract_verdict(spark, sf_dir):
    return contracts.verdict(contract_rows(spark, sf_dir))


_NULL_CHECKED = list(TRIP_REQUIRED)


@query(
    TRIPS
    + "\nUNION ALL\n".join(
        f"""SELECT 'trips' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows,
  round((count(*) FILTER (WHERE {c} IS NULL) * 100 / count(*)::DOUBLE) + 1e-11, 8) AS null_pct,
  {_status(f"count(*) FILTER (WHERE {c} IS NULL)")} AS status FROM silver"""
        for c in _NULL_CHECKED
    )
)
def silver_null_report(spark, sf_dir):
    return shown(contracts.null_report(silver_trips(spark, sf_dir), _NULL_CHECKED, "trips"))


@query(
    REVIEWS
    + """SELECT 'reviews' AS table_name, 'rating' AS column_name, min(rating) AS min_value, max(rating) AS max_value,
  CASE WHEN min(rating) >= 1 AND max(rating) <= 5 THEN 'PASS' ELSE 'FAIL' END AS status FROM silver"""
)
def rating_range_check(spark, sf_dir):
    return contracts.range_check(silver_reviews(spark, sf_dir), "rating", 1, 5, "reviews")


def _expected_sql(table: str, check: str, expected: str, actual: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, ({expected}) AS expected, ({actual}) AS actual,
  ({actual}) - ({expected}) AS mismatch, CASE WHEN ({actual}) = ({expected}) THEN 'PASS' ELSE 'FAIL' END AS status"""


@query(
    TRIPS
    + "\nUNION ALL\n".join(
        [
            _expected_sql("trips_raw", "row_count", "SELECT count(*) FROM lineitem", "SELECT count(*) FROM raw"),
            _expected_sql("trips_enriched", "row_count", "SELECT count(*) FROM lineitem", "SELECT count(*) FROM silver"),
            _expected_sql("trips_enriched", "temp_max_c_nulls", "SELECT 0::BIGINT", "SELECT count(*) FROM enriched WHERE temp_max_c IS NULL"),
        ]
    )
)
def expected_counts(spark, sf_dir):
    """Row and null counts against known numbers; the landed row count is the expectation here."""
    landed = inputs.table(spark, sf_dir, "lineitem").count()  # answered from file footers
    raw = contracts.expect_count(inputs.raw_trips(spark, sf_dir), landed, "trips_raw")
    enriched = enriched_trips(spark, sf_dir)
    return raw.unionByName(contracts.expectations(enriched, "trips_enriched", rows=landed, nulls={"temp_max_c": 0}))


@query(
    TRIPS
    + """SELECT 'trips' AS table_name, count(*) AS row_count FROM silver
UNION ALL SELECT 'trip_rejects', count(*) FROM flagged WHERE NOT is_valid"""
)
def table_row_counts(spark, sf_dir):
    settled = silver.trips_settled(inputs.raw_trips(spark, sf_dir), inputs.TRIP_TIEBREAK)
    sides = {"trips": F.col(VALID_FLAG), "trip_rejects": ~F.col(VALID_FLAG)}
    counted = settled.agg(*[F.count_if(side).alias(name) for name, side in sides.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.col(name).alias("row_count")) for name in sides])))


@query(
    TRIPS
    + """SELECT 'trips' AS table_name, count(*) AS written_rows, count(*) AS observed_rows, count(DISTINCT vendor_id) AS folders FROM silver
UNION ALL SELECT 'trip_rejects', count(*), count(*), count(DISTINCT vendor_id) FROM flagged WHERE NOT is_valid"""
)
def trip_split_write(spark, sf_dir):
    """Valid and rejected trips written by one job over one read of bronze, and their counts as observed on the way."""
    target = scratch_dir(spark, "trip-split")
    settled = silver.trips_settled(inputs.raw_trips(spark, sf_dir), inputs.TRIP_TIEBREAK)
    observed = write_split(settled, target, VALID_FLAG, ["vendor_id"], derive=silver.with_trip_columns)
    sides = []
    for name, kept, n in zip(("trips", "trip_rejects"), (True, False), observed, strict=True):
        side = read_split(spark, target, kept, settled.schema)
        sides.append(side.agg(F.lit(name).alias("table_name"), F.count("*").alias("written_rows"), F.lit(n).cast("long").alias("observed_rows"), F.count_distinct("vendor_id").alias("folders")))
    return sides[0].unionByName(sides[1])


def _quality_sql(name: str, expected: str, actual: str, good: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{expected}' AS expected, CAST({actual} AS VARCHAR) AS actual, "
        f"CASE WHEN {good} THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"
    )


def _null_sql(table: str, column: str, source: str, expected: int = 0) -> str:
    nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
    return _quality_sql(f"{table}.{column} nulls", str(expected), nulls, f"{nulls} = {expected}", source)


def _repeated_sql(table: str, key: str, source: str) -> str:
    groups = f"(SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"
    return _quality_sql(f"{table} duplicate {key}", "0", "count(*)", "count(*) = 0", groups)


@query(
    _blocks()
    + "\n"
    + "\nUNION ALL\n".join(
        [_null_sql("trips", c, "silver") for c in TRIP_REQUIRED]
        + [_null_sql("reviews", c, "review_silver") for c in REVIEW_REQUIRED]
        + [
            _quality_sql(
                "reviews.rating range",
                "1-5",
                "printf('%.1f-%.1f', min(rating), max(rating))",
                "min(rating) >= 1 AND max(rating) <= 5",
                "review_silver",
            ),
            _null_sql("trips_weather", "temp_max_c", "enriched"),
            _repeated_sql("trips", "delivery_id", "silver"),
            _repeated_sql("reviews", "review_id", "review_silver"),
        ]
    )
)
def silver_quality_summary(spark, sf_dir):
    # keys and other derived columns are computed where they are read, and not stored
    stored = dict.fromkeys([*silver.TRIP_KEY, *TRIP_REQUIRED])
    trips = silver.with_trip_columns(written_once(silver_trips(spark, sf_dir).select(*[c for c in stored if c != "delivery_id"]), "silver-trips"))
    stored = dict.fromkeys([*silver.REVIEW_KEY, *REVIEW_REQUIRED, "rating"])
    reviews = written_once(silver_reviews(spark, sf_dir).select(*[c for c in stored if c != "review_id"]), "silver-reviews")
    reviews = silver.with_review_key(reviews)
    enriched = silver.trips_enriched(trips, inputs.weather(spark))
    return quality_summary(trips, reviews, enriched, 0)
