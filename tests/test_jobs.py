"""The jobs end to end, from landed files to marts, against the registered queries."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborline import jobs
from harborline.operators.contracts import ContractViolation
from harborline.plans import catalogue, gold, inputs, marts
from harborline.plans.external import GOLD_SCHEMAS
from harborline.registry.core import QUERIES, shown
from harborline.registry.trips import PERIOD
from harborline.streaming.events import event_source
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    raw = inputs.raw_trips(spark, SMALL).drop("_source_file", "_ingested_at")
    # Newest shipping date first is what the registered query deduplicates by.
    raw = raw.join(spark.read.parquet(f"{SMALL}/lineitem.parquet").select(*inputs.TRIP_TIEBREAK, "l_shipdate"), list(inputs.TRIP_TIEBREAK))
    raw.filter("l_linenumber < 4").coalesce(1).write.parquet(str(base / "trips" / "trips_2023-01"))
    late = raw.filter("l_linenumber >= 4").withColumn("VendorID", F.col("VendorID").cast("double"))
    late.coalesce(1).write.parquet(str(base / "trips" / "trips_2023-02"))
    days = inputs.weather(spark).orderBy("weather_date").collect()
    daily = {
        "time": [str(d.weather_date) for d in days],
        "temperature_2m_max": [d.temp_max_c for d in days],
        "temperature_2m_min": [d.temp_min_c for d in days],
        "precipitation_sum": [d.precipitation_mm for d in days],
        "snowfall_sum": [d.snowfall_cm for d in days],
        "windspeed_10m_max": [d.windspeed_max_kmh for d in days],
    }
    (base / "weather.json").write_text(json.dumps({"latitude": 1.0, "daily": daily}, indent=1))
    (base / "reviews").mkdir()
    reviews = inputs.raw_reviews(spark, SMALL).drop("_ingested_at")
    for (category,) in reviews.select("_source_file").distinct().collect():
        lines = reviews.filter(F.col("_source_file") == category).drop("_source_file").toJSON().collect()
        (base / "reviews" / category.split("/")[-1]).write_text("\n".join(lines) + "\n")
    events = inputs.order_event_values(spark.read.parquet(f"{SMALL}/events.parquet"))
    events.coalesce(1).write.parquet(str(base / "events"))
    return base


def same(rows, got, expected, **digits):
    columns = expected.columns
    assert rows(shown(got.select(*columns), **digits)) == rows(expected)


def test_all_jobs(spark, landed, rows):
    base, space = str(landed / "lake"), "job_gold"
    order = ["l_shipdate", *inputs.TRIP_TIEBREAK]
    # A folder per day would be a few thousand tiny files here.
    counts = jobs.trips_job(
        spark, str(landed / "trips"), str(landed / "weather.json"), base, space, PERIOD, order, partition_by=["vendor_id"]
    )
    assert counts["trips"] == counts["trips_weather"] == QUERIES["trip_dedup_latest"](spark, SMALL).count()
    assert counts["trip_rejects"] == QUERIES["trip_silver_rejects"](spark, SMALL).count()
    same(rows, spark.table(f"{space}.delivery_sla"), QUERIES["sla_by_day_location"](spark, SMALL))

    jobs.reviews_job(spark, str(landed / "reviews"), base, space, ["o_orderkey"])
    again = jobs.reviews_job(spark, str(landed / "reviews"), base, space, ["o_orderkey"])
    # A rerun without new files ingests nothing and rebuilds the same tables.
    assert again["reviews"] == QUERIES["review_silver_valid"](spark, SMALL).count()

    jobs.orders_job(event_source(spark, "files", {"path": str(landed / "events")}), base, space, ["delivery_id"])
    same(rows, spark.table(f"{space}.order_status_current"), QUERIES["stream_current_state"](spark, SMALL))

    record = jobs.forecast_job(spark, space).first()
    days = spark.table(f"{space}.daily_delivery_summary").count()
    assert (record.historical_rows, record.future_rows, record.output_rows) == (days, 30, days + 30)

    with pytest.raises(ContractViolation, match="current_status"):  # some orders are still under way
        jobs.marts_job(spark, space, "job_marts")
    built = jobs.marts_job(spark, space, "job_marts", strict=False)
    same(rows, built["mart_daily_performance"], QUERIES["int_daily_performance"](spark, SMALL), total_revenue=6)
    same(rows, built["mart_vendor_performance"], QUERIES["mart_vendor_performance"](spark, SMALL), total_order_value=4)
    assert built["mart_weather_delay_correlation"].count() == 4
    assert built["mart_demand_forecast"].filter("pct_error IS NOT NULL").count() == days
    assert {t.name: t.tableType for t in spark.catalog.listTables("job_marts") if not t.isTemporary} == {
        name: "VIEW" if name in catalogue.VIEWS else "MANAGED" for name in catalogue.NEEDS
    }
    for name in ("review_summary", "demand_forecast", "order_status_current"):
        same(rows, spark.table(f"job_marts.stg_{name}"), shown(getattr(marts, f"stg_{name}")(spark.table(f"{space}.{name}"))))


def test_views_stand_between_gold_and_marts(spark, tmp_path):
    tables = {
        name: spark.createDataFrame([], StructType.fromDDL(ddl)) for name, ddl in GOLD_SCHEMAS.items() if name in ("delivery_sla", "weather_delay_impact")
    }
    first = dt.date(2023, 1, 1)
    tables["daily_delivery_summary"] = spark.createDataFrame([(first, 3, 1.0, 2.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0)], GOLD_SCHEMAS["daily_delivery_summary"])
    gold.build_gold(tables, "views_gold", str(tmp_path / "gold"))
    views = catalogue.publish_views(spark, "views_gold", "views_models", ["mart_daily_performance"])
    assert list(views)[-1] == "int_daily_performance" and len(views) == 4  # made after what it reads, and nothing else
    assert catalogue.build_order()[-1] in catalogue.TABLES
    daily = spark.table("views_models.int_daily_performance")
    assert daily.dtypes == marts.int_daily_performance(*[spark.table(f"views_gold.{t}") for t in ("daily_delivery_summary", "delivery_sla", "weather_delay_impact")]).dtypes
    plan = daily.select("pickup_date", "trip_count", "sla_total_trips")._jdf.queryExecution().executedPlan().toString()
    # one scan a gold table and none between the views; columns are pruned through both layers
    assert plan.count("FileScan") <= 3 and "total_revenue" not in plan
    assert [r.trip_count for r in daily.collect()] == [3]
    gold.build_gold({"daily_delivery_summary": tables["daily_delivery_summary"].withColumn("trip_count", F.lit(8).cast("long"))}, "views_gold")
    assert [r.trip_count for r in spark.table("views_models.int_daily_performance").collect()] == [8]
    again = catalogue.publish(spark, "views_gold", "views_models", ["mart_daily_performance"])
    assert again["mart_daily_performance"].count() == 1
