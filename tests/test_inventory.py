"""Inventories: what changed, whose footers are read, and which lines a schema is inferred from."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from harborline.sources import inventory, readers


def touch_back(path, stat):
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def changes(spark, path, store):
    rows = inventory.difference(inventory.listing(spark, path), inventory.stored(spark, store)).collect()
    return sorted((r.path.rsplit("/", 1)[-1], r.change) for r in rows)


def test_difference_of_listings(spark, tmp_path):
    src, store = tmp_path / "src", str(tmp_path / "store")
    (src / "deep").mkdir(parents=True)
    for name in ("a", "b", "deep/c"):
        (src / name).write_text(name)
    assert changes(spark, str(src), store) == [("a", "new"), ("b", "new"), ("c", "new")]
    inventory.publish(inventory.listing(spark, str(src)), store)
    assert changes(spark, str(src), store) == []
    (src / "a").unlink()
    (src / "b").write_text("longer")
    (src / "d e").write_text("d")
    assert changes(spark, str(src), store) == [("a", "gone"), ("b", "changed"), ("d e", "new")]
    assert sorted(r.change for r in inventory.landed_since(spark, str(src), store).collect()) == ["changed", "new"]
    for _ in range(4):
        inventory.publish(inventory.listing(spark, str(src)), store)
    assert len([n for n in os.listdir(store) if n.isdigit()]) == 2


def test_an_unfinished_inventory_is_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    one = spark.createDataFrame([("f", 1, None)], inventory.FILE)
    inventory.publish(one, store)
    one.write.parquet(f"{store}/{1:012d}")
    os.remove(f"{store}/{1:012d}/_SUCCESS")
    assert inventory.stored(spark, store).count() == 1
    inventory.publish(one.union(one), store)
    assert inventory.stored(spark, store).count() == 2


def land(spark, path, *columns, n=3):
    spark.range(n).select(*columns).coalesce(1).write.parquet(str(path))


def test_a_rerun_reads_the_footers_of_new_files_only(spark, tmp_path, rows):
    src, store = tmp_path / "src", str(tmp_path / "shapes")
    land(spark, src / "one", F.col("id").alias("v"))
    land(spark, src / "two", F.col("id").cast("double").alias("v"), F.lit("x").alias("w"))
    assert readers.read_drifting_parquet(spark, str(src), {"v": "bigint"}, manifest=store).count() == 6
    # spoil a known file without a sign of it: its footer must not be opened again
    (part,) = (src / "one").glob("*.parquet")
    whole, stat = part.read_bytes(), part.stat()
    part.write_bytes(b"x" * len(whole))
    touch_back(part, stat)
    land(spark, src / "three", F.col("id").alias("v"), n=2)
    shapes = readers.file_shapes(spark, str(src), manifest=store)
    assert sorted((r.path.split("/")[-2], r.shape, r.is_read) for r in shapes.collect()) == [
        ("one", "v:int64", False), ("three", "v:int64", True), ("two", "v:double;w:string", False)
    ]
    part.write_bytes(whole)
    touch_back(part, stat)
    df = readers.read_drifting_parquet(spark, str(src), {"v": "bigint"}, manifest=store)
    assert rows(df.select("v", "w")) == sorted([(i, None) for i in (0, 1, 2, 0, 1)] + [(i, "x") for i in range(3)], key=repr)
    assert not [r for r in readers.file_shapes(spark, str(src), manifest=store).collect() if r.is_read]


@pytest.mark.parametrize("layout", ["nested", "partitioned", "mixed"])
def test_the_driver_gets_folders_not_files(spark, tmp_path, layout, rows):
    src = tmp_path / "src"
    name = {"nested": "y{0}/m{1}", "partitioned": "y={0}/m={1}", "mixed": "y{0}/m={1}"}[layout]
    for y in (1, 2):
        for m in (1, 2):
            for part in range(2):  # several files a folder
                kind = F.col("id").cast("int") if (y, m, part) == (2, 2, 1) else F.col("id") if y == 1 else F.col("id").cast("double")
                df = spark.range(2).select(kind.alias("v")).coalesce(1)
                df.write.mode("append").parquet(str(src / name.format(y, m)))
    (src / "notes.txt").write_text("no table")
    shapes = readers.file_shapes(spark, str(src))
    units, found = readers._units(shapes, f"file:{src}")
    got = {}
    for r in units.collect():
        got.setdefault(r.shape, []).append(r.unit.removeprefix(f"file:{src}/"))
    assert found == layout
    assert sorted(got["v:int64"]) == {"nested": ["y1"], "partitioned": ["y=1"], "mixed": ["y1/m=1", "y1/m=2"]}[layout]
    assert name.format(2, 1) in got["v:double"] and len(got["v:double"]) == 2 and len(got["v:int32"]) == 1
    df = readers.read_drifting_parquet(spark, str(src), {"v": "bigint"})
    assert df.count() == 16 and df.agg(F.sum("v")).first()[0] == 8
    wanted = {"nested": set(), "partitioned": {"y", "m"}, "mixed": {"m"}}[layout]
    assert set(df.columns) == {"v", "_source_file"} | wanted


def test_files_that_land_during_a_read_wait_for_the_next(spark, tmp_path):
    src = tmp_path / "src"
    land(spark, src / "a", F.col("id").alias("v"))
    shapes = readers.file_shapes(spark, str(src))
    assert shapes.count() == 1
    df = readers.read_drifting_parquet(spark, str(src), {})
    time.sleep(0.05)
    land(spark, src / "b", F.col("id").cast("double").alias("v"))
    assert df.count() == 3


def write_lines(path, *objects):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((o if isinstance(o, str) else json.dumps(o)) + "\n" for o in objects))


def test_evolution_reads_unseen_files_only(spark, tmp_path):
    src, schema = tmp_path / "src", str(tmp_path / "schema")
    write_lines(src / "one.jsonl", {"a": 1})
    assert readers.evolve_json_schema(spark, str(src), schema).names == ["a"]
    stat = (src / "one.jsonl").stat()
    write_lines(src / "one.jsonl", {"g": 1})  # same size and time: nothing may notice
    touch_back(src / "one.jsonl", stat)
    time.sleep(0.05)
    write_lines(src / "d e+f" / "two.jsonl", {"a": "x", "b": {"c": [1, 2.5], "d e": None}, "A": 2}, "{broken", "3")
    got = readers.evolve_json_schema(spark, str(src), schema)
    assert got.simpleString() == "struct<a:bigint,b:struct<c:array<double>,d e:string>>"
    # a file that comes late with an old time is new all the same, and its neighbours in time are not read
    write_lines(src / "late+1 %.jsonl", {"l": True})
    touch_back(src / "late+1 %.jsonl", stat)
    got = readers.evolve_json_schema(spark, str(src), schema)
    assert got.names == ["a", "b", "l"] and got["l"].dataType.simpleString() == "boolean"
    assert readers.evolve_json_schema(spark, str(src), schema) == got


def test_merged_types(spark):
    lines = ['{"i": 1, "n": 1, "t": "x", "z": null, "VOID": 1, "o": {"VARIANT": [{"k": 1}]}}', '{"i": 2, "n": 1.5, "t": 3, "big": 123456789012345678901234}', "[1]", ""]
    got = readers.merged_json_schema(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {f.name: f.dataType.simpleString() for f in got.fields} == {
        "i": "bigint", "n": "double", "t": "string", "z": "string", "VOID": "bigint", "o": "struct<VARIANT:array<struct<k:bigint>>>", "big": "decimal(38,0)"
    }
    assert readers.merged_json_schema(spark.createDataFrame([], "value string")).fields == []
