import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from harborline.plans import bronze
from harborline.sources import readers, sinks


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


# --- drift ------------------------------------------------------------------------


@pytest.fixture
def drifting(spark, tmp_path):
    base = tmp_path / "landing"
    one = spark.createDataFrame([(1, 10), (2, None)], "VendorID bigint, v bigint")
    two = spark.createDataFrame([(3.0, 1.5, 0.5)], "VendorID double, v double, airport_fee double")
    three = spark.createDataFrame([(11, 4)], "v bigint, VendorID bigint")  # same shape as the first, other order
    for name, df in (("trips_2023-01", one), ("trips_2023-02", two), ("trips_2023-03", three)):
        df.coalesce(1).write.parquet(str(base / name))
    return str(base)


def test_files_that_disagree_fail_in_one_plain_read(spark, drifting):
    with pytest.raises(Exception):
        spark.read.option("recursiveFileLookup", "true").schema("VendorID bigint, v bigint").parquet(drifting).collect()


def test_drifting_files_are_cast_and_united(spark, drifting, rows):
    df = readers.read_drifting_parquet(spark, drifting, {"VendorID": "bigint"})
    assert dict(df.dtypes)["VendorID"] == "bigint" and dict(df.dtypes)["v"] == "double"
    assert rows(df.select("VendorID", "v", "airport_fee")) == sorted(
        [(1, 10.0, None), (2, None, None), (3, 1.5, 0.5), (4, 11.0, None)], key=repr
    )
    assert df.filter(F.col("_source_file").contains("2023-02")).count() == 1


def test_the_plan_has_one_scan_per_schema(spark, drifting):
    df = readers.read_drifting_parquet(spark, drifting, {"VendorID": "bigint"})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_list_files_is_sorted_and_filtered(spark, drifting, tmp_path):
    (tmp_path / "landing" / "note.txt").write_text("x")
    found = readers.list_files(spark, drifting, ".parquet")
    assert len(found) == 3 and found == sorted(found)
    assert not any(f.endswith(".txt") for f in found)


def test_bronze_build_reports_null_rates_per_month(spark, drifting, tmp_path):
    base = spark.read.parquet(drifting + "/trips_2023-01").select(
        "VendorID", F.lit(None).cast("bigint").alias("PULocationID"), F.lit("2023-01-01").cast("timestamp_ntz").alias("tpep_pickup_datetime")
    )
    base.coalesce(1).write.parquet(str(tmp_path / "in" / "trips_2023-05"))
    report = bronze.build_trips_bronze(spark, str(tmp_path / "in"), str(tmp_path / "bronze"))
    assert tuple(report.first()) == ("2023-05", 2, 0, 0.0, 2, 100.0)
    written = dict(spark.read.parquet(str(tmp_path / "bronze")).dtypes)
    assert written["tpep_pickup_datetime"] == "timestamp" and written["_ingested_at"] == "timestamp"


# --- JSON -------------------------------------------------------------------------

SCHEMA = StructType([StructField("id", LongType()), StructField("v", DoubleType()), StructField("s", StringType())])


def test_rescue_keeps_unknown_mistyped_and_broken(spark):
    lines = [
        '{"id": 1, "v": 2.5, "s": "x"}',
        '{"id": 2, "extra": {"a": [1]}, "v": null}',
        '{"id": "three", "v": 1.0, "s": "y"}',
        "{broken",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n int, value string")
    got = {r.n: r for r in readers.rescue_json(df, "value", SCHEMA).collect()}
    assert (got[0].id, got[0].v, got[0].s, got[0]._rescued_data) == (1, 2.5, "x", None)
    assert got[1].id == 2 and json.loads(json.loads(got[1]._rescued_data)["extra"]) == {"a": [1]}
    assert got[2].id is None and got[2].v == 1.0 and json.loads(got[2]._rescued_data) == {"id": "three"}
    assert json.loads(got[3]._rescued_data) == {"_corrupt_record": "{broken"}
    assert got[4]._rescued_data is None
    report = readers.rescued_report(readers.rescue_json(df, "value", SCHEMA)).first()
    assert tuple(report) == (3, 60.0)
    assert readers.rescued_sample(readers.rescue_json(df, "value", SCHEMA), 2).count() == 2


def test_schema_is_inferred_once_and_persisted(spark, tmp_path):
    write_lines(tmp_path / "src" / "a.jsonl", ['{"a": 1, "b": "x"}'])
    first = readers.infer_json_schema(spark, str(tmp_path / "src"), str(tmp_path / "schema"))
    write_lines(tmp_path / "src" / "b.jsonl", ['{"a": 1, "b": "x", "c": true}'])
    assert readers.infer_json_schema(spark, str(tmp_path / "src"), str(tmp_path / "schema")) == first
    assert readers.saved_schema(spark, str(tmp_path / "none")) is None


def test_parallel_arrays(spark, rows):
    body = '{"daily": {"time": ["2023-01-01", "2023-01-02"], "temperature_2m_max": [1.5, null], "short": [9]}}'
    shape = "daily struct<time: array<string>, temperature_2m_max: array<double>, short: array<int>>"
    df = spark.createDataFrame([("city", body)], "place string, body string")
    parsed = df.select("place", F.from_json("body", shape)["daily"].alias("daily"))
    got = readers.explode_parallel_arrays(
        parsed, "daily", {"weather_date": ("time", "date"), "temp_max_c": ("temperature_2m_max", "double"), "k": ("short", "int")}
    )
    assert [(r.place, str(r.weather_date), r.temp_max_c, r.k) for r in got.orderBy("weather_date").collect()] == [
        ("city", "2023-01-01", 1.5, 9), ("city", "2023-01-02", None, None)
    ]


# --- typed reads and sinks --------------------------------------------------------


def test_typed_read_inventory_and_peek(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "2.5", "2023-01-01", "drop")], "A string, B string, D string, X string").write.parquet(path)
    schema = StructType([StructField("a", LongType()), StructField("b", DoubleType()), StructField("d", DateType())])
    df = readers.read_typed(spark, path, schema)
    assert df.dtypes == [("a", "bigint"), ("b", "double"), ("d", "date")] and df.count() == 1
    files = readers.file_inventory(spark.read.parquet(path)).collect()
    assert len(files) >= 1 and all(f.size > 0 and f.path.endswith(".parquet") for f in files)
    assert json.loads(readers.peek_raw(spark.read.parquet(path)).first().value)["X"] == "drop"
    assert "X" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_refresh_sees_replaced_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert readers.sql_over_path(spark, path).first().row_count == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    readers.refresh(spark, path)
    assert readers.read_table(spark, path).count() == 5
    spark.range(2).write.mode("overwrite").saveAsTable("refreshed")
    readers.refresh(spark, "refreshed")
    assert readers.read_table(spark, "refreshed").count() == 2


def test_partitioned_write_counts_back_and_prunes(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("p"))
    target = str(tmp_path / "t")
    assert sinks.write_table(df, target, partition_by=["p"]) == 100
    plan = spark.read.parquet(target).filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert sinks.write_table(df.limit(7), target, replace_schema=True) == 7


def test_hot_partition_values_are_rebalanced(spark, tmp_path):
    df = spark.range(1000).select("id", F.lit("hot").alias("p"))
    logical = df.hint("rebalance", F.col("p"))._jdf.queryExecution().analyzed().toString()
    assert "RebalancePartitions" in logical


def test_export_observes_rows_and_tables_are_idempotent(spark, tmp_path, rows):
    sinks.ensure_namespace(spark, "gold_test")
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    sinks.ensure_table(spark, "gold_test.empty_one", schema)
    sinks.ensure_table(spark, "gold_test.empty_one", schema)
    assert spark.table("gold_test.empty_one").count() == 0
    sinks.write_table(spark.range(6).select(F.col("id").alias("a")), "gold_test.six")
    got = sinks.export_tables(spark, ["gold_test.six", "gold_test.empty_one"], str(tmp_path / "x"))
    assert rows(got) == [("empty_one", 0), ("six", 6)]
    assert spark.read.parquet(str(tmp_path / "x" / "six")).count() == 6


def test_materialize_kinds(spark):
    df = spark.range(3)
    assert sinks.materialize(df, "as_view").count() == 3
    assert sinks.materialize(df, "as_table", "table").count() == 3
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "cube")


def test_rows_to_df_uses_the_given_schema(spark):
    df = readers.rows_to_df(spark, [(1, 2.0, None)], SCHEMA)
    assert df.schema == SCHEMA and df.count() == 1


def test_declared_gold_schemas_cover_the_staging_models(spark, tmp_path):
    from harborline.plans import external, marts

    for name, ddl in external.GOLD_SCHEMAS.items():
        spark.createDataFrame([], ddl).coalesce(1).write.parquet(str(tmp_path / name))
        staged = getattr(marts, f"stg_{name}")(external.read_exported(spark, str(tmp_path), name))
        assert staged.count() == 0
    assert dict(staged.dtypes)["forecast_date"] == "date"


def test_footer_reader_travels_without_this_package(tmp_path):
    """Executors may not have the package on their path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(readers._footer_reader()))
    code = "import pickle, sys; f = pickle.load(open('f.pkl', 'rb')); assert 'harborline' not in sys.modules; print(callable(f))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin"})
    assert done.stdout.strip() == "True", done.stderr


def test_nested_misfits_are_rescued_under_their_paths(spark):
    schema = StructType.fromDDL("a int, s struct<x:int,d:struct<y:int>>, items array<struct<u:string,n:int>>")
    lines = [
        ('{"a":1,"s":{"x":2,"d":{"y":3}},"items":[{"u":"p","n":1}]}',),
        ('{"a":"no","s":{"x":"bad","z":9,"d":{"y":1,"q":5}},"items":[{"u":"p","n":1},{"n":"bad","k":7}],"new":4}',),
    ]
    out = readers.rescue_json(spark.createDataFrame(lines, "value string"), "value", schema).collect()
    rescued = [json.loads(r["_rescued_data"]) if r["_rescued_data"] else None for r in out]
    assert rescued[0] is None
    assert rescued[1] == {"a": "no", "new": "4", "s.x": "bad", "s.z": "9", "s.d.q": "5", "items[1].n": "bad", "items[1].k": "7"}


def test_late_columns_of_any_file_are_seen(spark, tmp_path):
    for i in range(6):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / f"f{i}.jsonl").write_text(json.dumps({"a": i, f"k{i}": 1}) + "\n")
    found = readers.infer_json_schema(spark, str(tmp_path / "src"), str(tmp_path / "schema"))
    assert set(found.names) == {"a", *(f"k{i}" for i in range(6))}


def test_footer_schemes():
    uri = readers.footer_uri()
    assert uri("file:/a/b") == "file:///a/b" and uri("file:///a/b") == "file:///a/b"
    assert uri("s3a://bucket/k") == "s3://bucket/k" and uri("hdfs://n:1/k") == "hdfs://n:1/k"
    with pytest.raises(ValueError, match="dbfs"):
        uri("dbfs:/a")


def test_partition_columns_of_a_layout_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    out = readers.read_drifting_parquet(spark, path, {})
    assert {(r["id"], r["p"]) for r in out.collect()} == {(0, 0), (1, 1), (2, 0), (3, 1)}
