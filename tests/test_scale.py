"""Plans and results when one key holds a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from harborline.operators.joins import enrich_daily
from harborline.operators.validity import keep_latest
from harborline.plans import gold, inputs, silver
from harborline.sources.sinks import write_table
from harborline.registry.core import QUERIES
from tests.conftest import SMALL


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark, tmp_path):
    """The small tables with a third of all items on one order and one supplier."""
    for name in ("orders", "customer", "supplier"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    item = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    hot = F.col("l_partkey") % 3 == 0
    item = item.withColumns(
        {"l_orderkey": F.when(hot, 7).otherwise(F.col("l_orderkey")), "l_suppkey": F.when(hot, 1).otherwise(F.col("l_suppkey"))}
    )
    item.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_adaptive_execution_splits_the_hot_order(spark, skewed, settings):
    settings(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="10k",
    )
    kept, _ = silver.trips_silver(inputs.raw_trips(spark, skewed), inputs.TRIP_TIEBREAK)
    assert "skew=true" in final_plan(kept)


def test_silver_is_whole_and_unique_under_skew(spark, skewed):
    flagged = silver.trips_flagged(inputs.raw_trips(spark, skewed))
    kept, rejected = silver.trips_silver(inputs.raw_trips(spark, skewed), inputs.TRIP_TIEBREAK)
    total = spark.read.parquet(f"{skewed}/lineitem.parquet").count()
    valid = flagged.filter("_is_valid")
    assert valid.count() + rejected.count() == total
    assert kept.count() == valid.select("delivery_id").distinct().count()


def test_one_key_for_all_rows_still_yields_one_row(spark):
    df = spark.range(20_000, numPartitions=8).select(F.floor(F.col("id") / 1e9).alias("k"), "id")
    kept = keep_latest(df, ["k"], [F.desc("id")])
    assert [tuple(r) for r in kept.collect()] == [(0, 19_999)]
    metrics = [line for line in final_plan(kept).splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in metrics) and any("Final" in line for line in metrics)


def test_hot_partition_is_split_into_several_files(spark, tmp_path, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="8k")
    df = spark.range(40_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("hot").alias("p"))
    target = str(tmp_path / "t")
    assert write_table(df, target, partition_by=["p"]) == 40_000
    files = spark.read.parquet(target).select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1


def test_fact_is_not_shuffled_for_a_daily_dimension(spark):
    fact = spark.range(1000).select("id", F.date_add(F.lit("1996-01-01").cast("date"), F.floor(F.col("id") / 1e9).cast("int")).alias("d"))
    plan = final_plan(enrich_daily(fact, inputs.weather(spark), "d", "weather_date"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_aggregates_combine_before_the_shuffle(spark):
    plan = QUERIES["weather_delay_impact"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange hashpartitioning(pickup_date")


def test_no_query_plans_a_cartesian_or_nested_loop_join(spark):
    for name in ("mart_review_analytics", "mart_vendor_performance", "vendor_kpis", "reject_reconciliation", "unmatched_dates"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_build_gold_writes_and_counts(spark):
    frames = {"a_table": spark.range(4), "b_table": spark.range(2)}
    assert gold.build_gold(frames, "gold_build") == {"a_table": 4, "b_table": 2}
    assert gold.build_gold({"a_table": spark.range(1)}, "gold_build") == {"a_table": 1}
