import datetime as dt
import json
import random

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from harborline.streaming import events as ev
from harborline.streaming.ingest import ingest_json_stream

BASE = dt.datetime(2024, 1, 1)


def message(order, number, minutes, status="picked_up", value=1.0):
    return json.dumps(
        {
            "order_id": order, "delivery_id": f"d{number}", "event_type": status,
            "event_timestamp": (BASE + dt.timedelta(minutes=minutes)).isoformat(),
            "pickup_location_id": 1, "vendor_id": 2, "order_value": value,
        }
    )


def land(spark, path, messages):
    df = spark.createDataFrame([(m.encode(),) for m in messages], "value binary")
    df.coalesce(1).write.mode("append").parquet(path)


def run_state(spark, src, base):
    source = ev.event_source(spark, "files", {"path": src, "maxFilesPerTrigger": "1"})
    ev.run_order_stream(ev.parse_events(source, corrupt_col="_corrupt_record"), base, ["delivery_id"])


def state(spark, base):
    df = ev.read_state(spark, f"{base}/state", ["order_id"], "last_event_timestamp")
    return {r.order_id: (r.delivery_id, r.current_status) for r in df.collect()}


def test_parse_turns_bad_messages_into_null_rows(spark):
    df = spark.createDataFrame([(message("o", 1, 0).encode(),), (b"{oops",), (b'{"order_id":"p","event_timestamp":"never"}',)], "value binary")
    got = ev.parse_events(df).collect()
    assert got[0].event_timestamp == BASE and got[0].order_id == "o"
    assert got[1].order_id is None and got[2].order_id == "p" and got[2].event_timestamp is None
    good, dead = ev.split_dead_letters(ev.parse_events(df), ["order_id"], "event_timestamp")
    assert good.count() == 1 and dead.count() == 2


def test_out_of_order_batches_and_ties(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path)
    land(spark, src, [message("a", 1, 10, "in_transit"), message("a", 0, 5), message("b", 2, 3, "delivered")])
    run_state(spark, src, base)
    assert state(spark, base) == {"a": ("d1", "in_transit"), "b": ("d2", "delivered")}
    # Older than the state, equal to it, newer, new, and unusable messages.
    land(spark, src, [message("a", 3, 7, "order_created"), message("b", 9, 3, "cancelled"), message("c", 4, 1), "{bad"])
    run_state(spark, src, base)
    assert state(spark, base) == {"a": ("d1", "in_transit"), "b": ("d2", "delivered"), "c": ("d4", "picked_up")}
    land(spark, src, [message("a", 5, 11, "delivered")])
    run_state(spark, src, base)
    assert state(spark, base)["a"] == ("d5", "delivered")
    history = ev.read_history(spark, f"{base}/history")
    assert history.count() == 8 and history.filter("order_id IS NULL").count() == 1
    dead = ev.read_history(spark, f"{base}/dead_letters").collect()
    assert [r._corrupt_record for r in dead] == ["{bad"]


def test_upserts_equal_a_sequential_merge(spark, tmp_path, rows):
    rng = random.Random(11)
    target, merged = str(tmp_path / "state"), {}
    for batch_id in range(6):
        events = [(f"k{rng.randrange(8)}", rng.randrange(12), batch_id * 100 + i) for i in range(rng.randrange(1, 15))]
        newest = {}
        for key, ts, number in events:
            newest[key] = max(newest.get(key, (-1, -1)), (ts, number))
        for key, (ts, number) in newest.items():
            if key not in merged or ts > merged[key][0]:
                merged[key] = (ts, number)
        df = spark.createDataFrame(events, "k string, ts int, n int")
        ev.upsert_latest(spark, target, df, ["k"], "ts", ["n"], batch_id)
        if batch_id == 3:  # a retried batch changes nothing
            ev.upsert_latest(spark, target, df, ["k"], "ts", ["n"], batch_id)
    expected = sorted(((k, ts, n) for k, (ts, n) in merged.items()), key=repr)
    assert rows(ev.read_state(spark, target, ["k"], "ts").select("k", "ts", "n")) == expected
    compact = str(tmp_path / "compact")
    ev.compact_state(spark, target, compact, ["k"], "ts")
    assert spark.read.parquet(compact).count() == len(expected)
    ev.upsert_latest(spark, compact, spark.createDataFrame([("k0", -5, 1), ("new", 0, 1)], "k string, ts int, n int"), ["k"], "ts", ["n"], 6)
    after = rows(ev.read_state(spark, compact, ["k"], "ts").select("k", "ts", "n"))
    assert after == sorted([*expected, ("new", 0, 1)], key=repr)


def folder_count(path):
    return sum(1 for p in path.rglob("*") if p.is_dir())


def test_folding_equals_a_sequential_merge_and_stays_bounded(spark, tmp_path, rows):
    rng = random.Random(5)
    target, merged, counts = tmp_path / "state", {}, []
    for batch_id in range(20):
        events = [(f"k{rng.randrange(9)}", rng.randrange(15), batch_id * 100 + i) for i in range(rng.randrange(1, 9))]
        newest = {}
        for key, ts, number in events:
            newest[key] = max(newest.get(key, (-1, -1)), (ts, number))
        for key, (ts, number) in newest.items():
            if key not in merged or ts > merged[key][0]:
                merged[key] = (ts, number)
        df = spark.createDataFrame(events, "k string, ts int, n int")
        ev.upsert_latest(spark, str(target), df, ["k"], "ts", ["n"], batch_id)
        ev.fold_state(spark, str(target), ["k"], "ts")
        counts.append(folder_count(target))
        if batch_id % 6 == 5:
            got = rows(ev.read_state(spark, str(target), ["k"], "ts").select("k", "ts", "n"))
            assert got == sorted(((k, t, n) for k, (t, n) in merged.items()), key=repr)
    assert max(counts[4:]) == counts[4] and ev.manifest(spark, str(target)).generation == 19
    assert ev.fold_state(spark, str(target), ["k"], "ts").generation == 19  # nothing waits


def test_a_fold_that_died_and_a_covered_batch_that_comes_again(spark, tmp_path, rows):
    target = str(tmp_path / "state")

    def put(batch_id, *events):
        ev.upsert_latest(spark, target, spark.createDataFrame(list(events), "k string, ts int, n int"), ["k"], "ts", ["n"], batch_id)

    def current():
        return rows(ev.read_state(spark, target, ["k"], "ts").select("k", "ts", "n"))

    put(0, ("a", 5, 1))
    put(1, ("a", 5, 2), ("b", 1, 3))
    assert ev.fold_state(spark, target, ["k"], "ts", least_batches=3).generation == -1
    first = ev.fold_state(spark, target, ["k"], "ts")
    assert (first.generation, first.covered) == (0, {"direct": 1})
    # rows of a next generation without its manifest: nobody reads them, and the next fold replaces them
    spark.createDataFrame([("x", 99, 9)], "k string, ts int, n int").write.parquet(f"{target}/_generations/{1:012d}/rows")
    put(1, ("a", 5, 2), ("b", 1, 3))
    assert current() == [("a", 5, 1), ("b", 1, 3)]
    put(2, ("a", 4, 4), ("b", 2, 5))
    assert ev.fold_state(spark, target, ["k"], "ts").generation == 1
    assert current() == [("a", 5, 1), ("b", 2, 5)]


def test_one_read_for_all_sinks_and_a_sink_that_fails_once(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path)
    for first in (0, 10):
        land(spark, src, [message(f"o{i}", i, i) for i in range(first, first + 10)])
    source = ev.event_source(spark, "files", {"path": src, "maxFilesPerTrigger": "1"})
    calls, broken = [], [True]

    def one(batch, batch_id):
        calls.append(("one", batch_id))
        ev.append_history(batch, batch_id, f"{base}/one")

    def two(batch, batch_id):
        calls.append(("two", batch_id))
        if batch_id == 1 and broken:
            broken.clear()
            raise RuntimeError("sink is away")
        ev.append_history(batch, batch_id, f"{base}/two")

    drain = lambda: ev.drain_once(ev.parse_events(source), f"{base}/chk", f"{base}/commits", {"one": one, "two": two})
    with pytest.raises(StreamingQueryException):
        drain()
    assert ev.read_history(spark, f"{base}/one").count() == 20 and ev.read_history(spark, f"{base}/two").count() == 10
    query = drain()
    assert calls == [("one", 0), ("two", 0), ("one", 1), ("two", 1), ("two", 1)]
    for table in ("one", "two"):
        assert sorted(r.delivery_id for r in ev.read_history(spark, f"{base}/{table}").collect()) == sorted(f"d{i}" for i in range(20))
    assert sum(p.numInputRows for p in query.recentProgress) == 10  # the second batch, read once for the sink that lacked it
    land(spark, src, [message("z", 99, 1)])
    query = drain()
    assert calls[5:] == [("one", 2), ("two", 2)] and sum(p.numInputRows for p in query.recentProgress) == 1


def test_callers_outside_a_stream_can_name_themselves(spark, tmp_path):
    target = str(tmp_path / "h")
    for name in ("left", "right"):
        ev.append_history(spark.range(2), 0, target, stream=name)
    assert ev.read_history(spark, target).count() == 4


def test_empty_batches_write_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "k string, ts int")
    ev.append_history(empty, 0, str(tmp_path / "h"))
    ev.upsert_latest(spark, str(tmp_path / "s"), empty, ["k"], "ts")
    assert not (tmp_path / "h").exists() and not (tmp_path / "s").exists()


def test_retried_history_batch_is_not_duplicated(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        ev.append_history(df, 3, str(tmp_path / "h"))
    assert ev.read_history(spark, str(tmp_path / "h")).count() == 5


def test_a_second_checkpoint_replaces_nothing(spark, tmp_path):
    target = str(tmp_path / "history")
    for name, number in (("one", 1), ("two", 2)):
        land(spark, str(tmp_path / name), [message("a", number, number)])
        source = ev.event_source(spark, "files", {"path": str(tmp_path / name)})
        sink = lambda batch, batch_id: ev.append_history(batch, batch_id, target)
        for _ in range(2):
            ev.fan_out(ev.parse_events(source), {str(tmp_path / f"checkpoint-{name}"): sink})
    assert sorted(r.delivery_id for r in ev.read_history(spark, target).collect()) == ["d1", "d2"]


def test_state_store_variant_ignores_batch_order(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [message("a", 1, 10, "delivered")])
    land(spark, src, [message("a", 2, 4, "picked_up"), message("b", 3, 1), "{bad"])
    stream = ev.order_updates(ev.parse_events(ev.event_source(spark, "files", {"path": src, "maxFilesPerTrigger": "1"})))
    current = ev.current_state(stream.drop("updated_at"), ["order_id"], "last_event_timestamp", ["delivery_id"])
    writer = current.writeStream.outputMode("complete").format("memory").queryName("orders_now")
    ev.run_available_now(writer)
    got = {r.order_id: r.delivery_id for r in spark.table("orders_now").collect()}
    assert got == {"a": "d1", "b": "d3"}


def test_reconciliation(spark):
    raw = spark.range(10)
    current = spark.createDataFrame([("a",), ("b",)], "order_id string")
    assert ev.stream_reconciliation(raw, current, "order_id", 10, 2).first().status == "PASS"
    assert ev.stream_reconciliation(raw, current, "order_id", 9, 2).first().status == "FAIL"
    doubled = current.unionByName(current)
    assert ev.stream_reconciliation(raw, doubled, "order_id", 10, 2).first().status == "FAIL"


def test_merge_statement_guards_on_newer():
    sql = ev.merge_statement("t1", "u1", ["a", "b"], "ts")
    assert "t.`a` = s.`a` AND t.`b` = s.`b`" in sql and "s.`ts` > t.`ts`" in sql
    with pytest.raises(ValueError):
        ev.event_source(None, "carrier-pigeon", {})


def test_kafka_needs_its_connector(spark):
    with pytest.raises((AnalysisException, StreamingQueryException)) as error:
        ev.event_source(spark, "kafka", {"kafka.bootstrap.servers": "none:9092", "subscribe": "x"})
    assert "kafka" in str(error.value).lower()


def test_json_ingest_reads_each_file_once_and_rescues_new_keys(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    paths = [str(tmp_path / p) for p in ("src", "schema", "checkpoint", "table")]
    (src / "Sports.jsonl").write_text('{"asin": "a", "rating": 5.0}\n{"asin": "b", "rating": 4.0}\n')
    ingest_json_stream(spark, *paths)
    ingest_json_stream(spark, *paths)
    (src / "Auto.jsonl").write_text('{"asin": "c", "rating": "bad", "new": 1}\n')
    ingest_json_stream(spark, *paths)
    got = {r.asin: r for r in spark.read.parquet(paths[3]).collect()}
    assert set(got) == {"a", "b", "c"} and spark.read.parquet(paths[3]).count() == 3
    assert json.loads(got["c"]._rescued_data) == {"rating": "bad", "new": "1"} and got["c"].rating is None
    assert got["a"]._source_file.endswith("Sports.jsonl") and got["a"]._ingested_at is not None


def test_json_ingest_can_evolve_its_schema(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    paths = [str(tmp_path / p) for p in ("src", "schema", "checkpoint", "table")]
    (src / "one.jsonl").write_text('{"asin": "a", "rating": 5.0}\n')
    ingest_json_stream(spark, *paths, evolve=True)
    (src / "two.jsonl").write_text('{"asin": "b", "rating": "bad", "votes": 3}\n')
    ingest_json_stream(spark, *paths, evolve=True)
    table = spark.read.option("mergeSchema", "true").parquet(paths[3])
    got = {r.asin: (r.rating, r.votes, r._rescued_data) for r in table.collect()}
    assert got == {"a": (5.0, None, None), "b": (None, 3, '{"rating":"bad"}')}
    assert dict(table.dtypes)["rating"] == "double"
