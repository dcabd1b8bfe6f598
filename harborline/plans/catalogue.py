"""The models in the catalogue: staging and intermediate as persistent views, marts as tables read through them.

A view holds no data and is resolved when it is read, so a mart scans the gold tables only, with the columns and filters it needs,
and follows them when they are overwritten. Each model names what it reads; views and tables are made in that order.
"""

from __future__ import annotations

from collections.abc import Iterable
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from harborline.plans import marts
from harborline.plans.external import GOLD_SCHEMAS
from harborline.sources.sinks import ensure_namespace, materialize

#: Expressions that stand for a declared column, or beside it.
_STAGED = {
    "review_summary": {"review_month": "to_date(concat(review_month, '-01')) AS review_month, review_month AS review_month_raw"},
    "demand_forecast": {"forecast_date": "CAST(forecast_date AS DATE) AS forecast_date"},
}

_DAILY = """
SELECT d.pickup_date, d.trip_count, d.total_revenue, d.precipitation_mm, d.snowfall_cm, d.temp_max_c, d.temp_min_c,
  s.sla_total_trips, s.on_time_trips, s.delayed_trips, s.on_time_rate, s.avg_delay_minutes,
  w.weather_severity, w.on_time_rate AS weather_on_time_rate, w.avg_delay_minutes AS weather_avg_delay_minutes
FROM {here}.stg_daily_delivery_summary d
LEFT JOIN (
  SELECT pickup_date, sum(total_trips) AS sla_total_trips, sum(on_time_trips) AS on_time_trips, sum(delayed_trips) AS delayed_trips,
    try_divide(sum(on_time_trips), sum(total_trips)) AS on_time_rate, avg(avg_delay_minutes) AS avg_delay_minutes
  FROM {here}.stg_delivery_sla GROUP BY pickup_date) s ON d.pickup_date = s.pickup_date
LEFT JOIN {here}.stg_weather_delay_impact w ON d.pickup_date = w.pickup_date"""


VIEWS = (*(f"stg_{table}" for table in GOLD_SCHEMAS), "int_daily_performance")

#: Table: the view it is built from, and how.
TABLES = {
    "mart_daily_performance": ("int_daily_performance", lambda daily: daily),
    "mart_weather_delay_correlation": ("int_daily_performance", marts.mart_weather_delay_correlation),
    "mart_review_analytics": ("stg_review_summary", marts.mart_review_analytics),
    "mart_vendor_performance": ("stg_order_status_current", marts.mart_vendor_performance),
    "mart_demand_forecast": ("stg_demand_forecast", marts.mart_demand_forecast),
}

NEEDS = {name: () for name in VIEWS} | {name: (source,) for name, (source, _) in TABLES.items()}
NEEDS["int_daily_performance"] = ("stg_daily_delivery_summary", "stg_delivery_sla", "stg_weather_delay_impact")


def view_text(name: str, gold: str, here: str) -> str:
    """The query of a view over the gold tables of one namespace and the views of another."""
    if name == "int_daily_performance":
        return _DAILY.format(here=here)
    table = name.removeprefix("stg_")
    own = _STAGED.get(table, {})
    columns = ", ".join(own.get(column, column) for column in StructType.fromDDL(GOLD_SCHEMAS[table]).names)
    return f"SELECT {columns} FROM {gold}.{table}"


def build_order(wanted: Iterable[str] | None = None) -> list[str]:
    """The wanted models (by default all) and what they need, each after what it reads."""
    found, ahead = {}, list(NEEDS if wanted is None else wanted)
    while ahead:
        name = ahead.pop()
        if name not in found:
            found[name] = NEEDS[name]
            ahead.extend(NEEDS[name])
    return list(TopologicalSorter(found).static_order())


def publish_views(spark: SparkSession, gold: str, target: str, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Create or replace the views among the wanted models and what those need. The gold tables they read must exist."""
    ensure_namespace(spark, target)
    names = [name for name in build_order(wanted) if name in VIEWS]
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {target}.{name} AS {view_text(name, gold, target)}")
    return {name: spark.table(f"{target}.{name}") for name in names}


def publish_tables(spark: SparkSession, target: str, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Rebuild the marts among the wanted models from the views of ``target``."""
    built = {}
    for name in build_order(wanted):
        if name in TABLES:
            source, model = TABLES[name]
            built[name] = materialize(model(spark.table(f"{target}.{source}")), f"{target}.{name}", "table")
    return built


def publish(spark: SparkSession, gold: str, target: str, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Views, then tables."""
    wanted = None if wanted is None else list(wanted)
    return publish_views(spark, gold, target, wanted) | publish_tables(spark, target, wanted)
