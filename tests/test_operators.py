import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.operators import contracts as ct
from harborline.operators import joins, profiling, projection, sla, validity
from harborline.operators.validity import flag_valid, keep_latest, reconcile, reconcile_keys, split_valid
from harborline.plans import gold
from harborline.sources import sinks


# --- validity ---------------------------------------------------------------------


def test_split_keeps_every_row_unless_told_otherwise(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None)], "id int, v double")
    cond = F.col("v") < 10
    good, bad = split_valid(df, cond)
    assert rows(good.select("id")) == [(1,)] and rows(bad.select("id")) == [(2,), (3,)]
    good, bad = split_valid(df, cond, "drop")
    assert rows(good.select("id")) == [(1,)] and rows(bad.select("id")) == [(2,)]
    with pytest.raises(ValueError):
        split_valid(df, cond, "other")


def test_keep_latest_is_deterministic_with_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 9), ("b", 0, 0), (None, 1, 1)], "k string, t int, n int")
    kept = keep_latest(df, ["k"], [F.desc("t"), F.desc("n")])
    assert rows(kept) == sorted([("a", 2, 9), ("b", 0, 0), (None, 1, 1)], key=repr)
    with pytest.raises(ValueError):
        keep_latest(df, ["k"], [])


def test_keep_latest_cuts_each_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_latest(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, plan


def test_reconcile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), ("c", -1.0)], "k string, v double")
    flagged = flag_valid(df, F.col("v") > 0)
    kept = keep_latest(flagged.filter("_is_valid"), ["k"], [F.desc("v")])
    got = reconcile(flagged, kept).first()
    assert (got.input_rows, got.valid_rows, got.rejected_rows, got.kept_rows, got.removed_rows) == (4, 2, 2, 1, 1)
    assert got.reject_rate_pct == 50.0
    assert reconcile_keys(flagged, ["k"]).first() == got
    assert tuple(reconcile_keys(flagged.limit(0), ["k"]).first()) == (0, 0, 0, 0, 0, None)


# --- projection -------------------------------------------------------------------


def test_rename_present_and_lower_names(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID int, Other int")
    assert projection.rename_present(df, {"VendorID": "vendor_id", "Absent": "x"}).columns == ["vendor_id", "Other"]
    assert projection.lower_names(df).columns == ["vendorid", "other"]


def test_cast_columns_ignores_absent(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert projection.cast_columns(df, {"a": "bigint", "b": "int"}).dtypes == [("a", "bigint")]


def test_project_and_nested_fields(spark):
    df = spark.createDataFrame([(1, [2], (3,))], "a int, b array<int>, c struct<d int>")
    assert projection.project(df, {"x": "a", "y": F.lit(1)}).columns == ["x", "y"]
    assert [n for n, _ in projection.nested_fields(df.schema)] == ["b", "c"]


def test_date_range_is_inclusive_and_counts_what_it_drops(spark, rows):
    days = [dt.date(2022, 12, 31), dt.date(2023, 1, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    span = (dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    assert projection.date_range(df, "d", *span).count() == 2
    assert tuple(projection.date_range_counts(df, "d", *span).first()) == (5, 2, 3)


def test_date_filter_prunes_partitions(spark, tmp_path):
    df = spark.range(30).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    df.write.partitionBy("d").parquet(str(tmp_path / "t"))
    read = projection.date_range(spark.read.parquet(str(tmp_path / "t")), "d", dt.date(2023, 1, 5), dt.date(2023, 1, 6))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and read.count() == 2


def test_is_future_flag(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "y double")
    assert [r.is_future for r in projection.with_is_future(df, "y").collect()] == [False, True]


# --- joins ------------------------------------------------------------------------


def test_enrich_daily_broadcasts_within_the_bound_only(spark, rows):
    fact = spark.range(10).select("id", F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    dim = spark.range(5).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("w"), F.lit(1.0).alias("t"))
    small = joins.enrich_daily(fact, dim, "d", "w")
    assert small.columns == ["id", "d", "t"] and small.count() == 10
    assert tuple(joins.match_report(small, "t").first()) == (10, 5, 50.0)
    assert joins.unmatched_keys(small, "t", "d").count() == 5
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.enrich_daily(fact, dim, "d", "w", max_rows=4)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_broadcast_is_bounded_by_bytes_too(spark):
    wide = spark.range(3).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(joins.bounded_broadcast(wide, 3)) and not hinted(joins.bounded_broadcast(wide, 2))
    assert not hinted(joins.bounded_broadcast(wide, 3, max_bytes=2000))


def test_match_report_of_nothing_is_zero(spark):
    assert tuple(joins.match_report(spark.createDataFrame([], "t double"), "t").first()) == (0, 0, 0.0)


# --- SLA --------------------------------------------------------------------------

TRIPS = [
    # day, location, miles, minutes
    ("2023-01-01", 1, 2.0, 15.0),
    ("2023-01-01", 1, 2.0, 16.0),
    ("2023-01-01", 1, 11.0, 70.0),
    ("2023-01-01", 2, 5.0, 25.0),
    ("2023-01-02", 1, 1.0, 20.0),
]


def trips(spark):
    base = spark.createDataFrame(TRIPS, "d string, pickup_location_id bigint, trip_distance_miles double, trip_duration_minutes double")
    return base.select(
        F.col("d").cast("date").alias("pickup_date"), "pickup_location_id", "trip_distance_miles", "trip_duration_minutes",
        F.lit(10.0).alias("fare_amount"), F.lit(12.5).alias("total_amount"),
        F.lit(3.0).alias("temp_max_c"), F.lit(-6.0).alias("temp_min_c"),
        F.when(F.col("d") == "2023-01-02", 1.0).otherwise(0.0).alias("precipitation_mm"), F.lit(0.0).alias("snowfall_cm"),
    )


def test_sla_summary(spark, rows):
    got = rows(gold.delivery_sla(trips(spark)))
    assert got == [
        (dt.date(2023, 1, 1), 1, 3, 1, 2, 0.3333, 5.5),
        (dt.date(2023, 1, 1), 2, 1, 1, 0, 1.0, None),
        (dt.date(2023, 1, 2), 1, 1, 0, 1, 0.0, 5.0),
    ]


def test_cube_rollups_equal_the_direct_aggregates(spark, rows):
    tables = gold.trip_gold_tables(trips(spark))
    direct = {
        "daily_delivery_summary": gold.daily_summary(trips(spark)),
        "delivery_sla": gold.delivery_sla(trips(spark)),
        "weather_delay_impact": gold.weather_delay_impact(trips(spark)),
    }
    for name, expected in direct.items():
        assert rows(tables[name].select(*expected.columns)) == rows(expected), name


def test_null_distance_gets_the_widest_budget(spark):
    df = spark.createDataFrame([(None, 61.0)], "trip_distance_miles double, trip_duration_minutes double")
    got = sla.with_sla(df).first()
    assert (got.expected_max_minutes, got.is_on_time, got.delay_minutes) == (60, False, 1.0)


# --- profiling --------------------------------------------------------------------


def test_profiling_helpers(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3), ("a", 1)], "k string, v int")
    assert rows(profiling.null_rate_by(df, F.col("k"), ["v"])) == [("a", 3, 1, pytest.approx(100 / 3)), ("b", 1, 0, 0.0)]
    assert tuple(profiling.value_range(df, "v").first()) == (1, 3)
    assert rows(profiling.duplicate_keys(df, ["k", "v"])) == [("a", 1, 2)]
    assert rows(profiling.row_counts({"x": df, "y": df.limit(1)})) == [("x", 4), ("y", 1)]
    assert [tuple(r) for r in profiling.breakdown(df, "k").collect()] == [("a", 3), ("b", 1)]
    assert rows(profiling.distinct_values(df, "k")) == [("a",), ("b",)]
    assert profiling.sample_rows(df, 2).count() == 2
    assert profiling.run_summary(spark, {"a": 1, "b": "x"}).first().summary == '{"a":1,"b":"x"}'


# --- contracts --------------------------------------------------------------------


def test_contract_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (None, None), (7, "a")], "n int, s string")
    rules = [
        ct.not_null("n"), ct.unique("n"), ct.accepted_range("n", lo=1, hi=5), ct.accepted_values("s", ["a", "b"]),
        ct.accepted_range("n", lo=1, inclusive=False),
    ]
    got = {(r.column_name, r.rule, r.failing_rows, r.status) for r in ct.check(df, rules, "t").collect()}
    assert got == {
        ("n", "not_null", 2, "FAIL"),
        ("n", "unique", 1, "FAIL"),
        ("n", "accepted_range", 1, "FAIL"),
        ("s", "accepted_values", 1, "FAIL"),
        ("n", "accepted_range", 2, "FAIL"),
    }


def test_row_rules_share_one_pass(spark):
    df = spark.range(10).withColumn("v", F.col("id"))
    plan = ct.check(df, [ct.not_null("id"), ct.not_null("v"), ct.accepted_range("v", lo=0)], "t")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_expectations_and_verdict(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    count = ct.expect_count(df, 3, "t")
    assert tuple(count.first()) == ("t", "row_count", 3, 2, -1, "FAIL")
    nulls = ct.expect_null_count(df, "n", 1, "t")
    assert nulls.first().status == "PASS"
    one_pass = ct.expectations(df, "t", rows=3, nulls={"n": 1})
    assert [r.status for r in one_pass.collect()] == ["FAIL", "PASS"]
    audit = ct.row_count_audit([("t", df, 2), ("u", df, 5)])
    assert [(r.table_name, r.mismatch, r.status) for r in audit.collect()] == [("t", 0, "PASS"), ("u", -3, "FAIL")]
    both = count.unionByName(nulls)
    assert tuple(ct.verdict(both).first()) == (2, 1, "FAIL")
    ct.enforce(nulls)
    with pytest.raises(ct.ContractViolation):
        ct.enforce(both)
    assert ct.null_report(df, ["n"], "t").first().null_pct == 50.0
    assert ct.range_check(df, "n", 1, 5, "t").first().status == "PASS"
    assert ct.range_check(df.filter("n > 5"), "n", 1, 5, "t").first().status == "FAIL"


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from harborline.session import scratch_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        scratch_dir(cluster, "x")
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_unique_and_row_rules_share_one_scan(spark, tmp_path):
    rows = [(1, "a", 5), (1, "b", None), (2, "a", -1), (None, "a", 5), (None, None, 5), (3, "c", 5), (3, "c", 5)]
    spark.createDataFrame(rows, "k int, g string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [ct.unique("k"), ct.not_null("v"), ct.unique(["k", "g"]), ct.accepted_range("v", 0), ct.unique("v"), ct.not_null("k")]
    for some in (rules, rules[:2], rules[1:2], rules[:1]):
        checked = ct.check(df, some, "t")
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        got = {(r.column_name, r.rule): (r.failing_rows, r.status) for r in checked.collect()}
        want = {("k", "unique"): (2, "FAIL"), ("v", "not_null"): (1, "FAIL"), ("k,g", "unique"): (1, "FAIL"), ("v", "accepted_range"): (1, "FAIL"), ("v", "unique"): (1, "FAIL"), ("k", "not_null"): (2, "FAIL")}
        assert got == {(r.column, r.name): want[r.column, r.name] for r in some}
    assert {r.failing_rows for r in ct.check(df.limit(0), rules, "t").collect()} == {0}


def test_settling_equals_the_two_way_split(spark, rows):
    data = [(i % 5, i % 3, i, i % 4 != 0) for i in range(40)] + [(None, 1, 99, True), (None, 0, 98, False), (None, 0, 98, False)]
    df = spark.createDataFrame(data, "k int, g int, v int, ok boolean")
    flagged = validity.flag_valid(df, F.col("ok"))
    settled = validity.settle(flagged, ["k", "g"], [F.desc("v")])
    valid, rejected = validity.split_valid(df, F.col("ok"))
    assert rows(settled.filter("_is_valid").drop("_is_valid")) == rows(validity.keep_latest(valid, ["k", "g"], [F.desc("v")]))
    assert rows(settled.filter("NOT _is_valid").drop("_is_valid")) == rows(rejected)


def test_split_write_reads_its_input_once(spark, tmp_path, rows):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("part")).mapInArrow(seen, "id long, part string")
    flagged = validity.flag_valid(df, F.col("id") % 4 != 0)
    assert sinks.write_split(flagged, str(tmp_path / "s"), "_is_valid", ["part"]) == (15, 5)
    assert calls.value == 20
    for kept in (True, False):
        got = rows(sinks.read_split(spark, str(tmp_path / "s"), kept, flagged.schema).select("id", "part"))
        assert got == sorted(((i, str(i % 3)) for i in range(20) if (i % 4 != 0) == kept), key=repr)
    assert sinks.write_split(flagged.filter("_is_valid"), str(tmp_path / "v"), "_is_valid") == (15, 0)
    assert sinks.read_split(spark, str(tmp_path / "v"), False, flagged.schema).count() == 0
