"""Streaming queries over the events table, read in place as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.contracts import enforce
from harborline.operators.profiling import breakdown
from harborline.plans import inputs
from harborline.registry.core import query, shown
from harborline.registry.sql import ORDER_EVENTS, moment
from harborline.session import scratch_dir
from harborline.sources import folders
from harborline.streaming import events as ev
from harborline.streaming.state import Manifest


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of bus messages, without staging a copy of it."""
    schema = inputs.table(spark, sf_dir, "events").schema
    # A pattern, because a stream over one plain file is refused; it also fits a folder of files.
    files = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return inputs.order_event_values(files)


def drain(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Run the order stream into history and current state; return both tables."""
    parsed = ev.parse_events(event_stream(spark, sf_dir))
    tables = ev.run_order_stream(parsed, scratch_dir(spark, "orders"), ["delivery_id"])
    return ev.read_history(spark, tables.history), ev.read_state(spark, tables.state, ev.ORDER_KEY, ev.ORDER_TIME)


@query(
    ORDER_EVENTS
    + f"""SELECT order_id, delivery_id, event_type, {moment("event_timestamp")} AS event_timestamp,
  pickup_location_id, vendor_id, order_value FROM history"""
)
def stream_history(spark, sf_dir):
    history, _ = drain(spark, sf_dir)
    return shown(history)


_STATUS = f"""SELECT order_id, delivery_id, pickup_location_id, vendor_id, order_value, current_status,
  {moment("last_event_timestamp")} AS last_event_timestamp FROM status"""


@query(ORDER_EVENTS + _STATUS)
def stream_current_state(spark, sf_dir):
    _, state = drain(spark, sf_dir)
    return shown(state.drop("updated_at"))


@query(ORDER_EVENTS + _STATUS)
def stream_state_store(spark, sf_dir):
    """The same state as a streaming aggregate; every update batch keeps its changed keys."""
    base = scratch_dir(spark, "state-store")
    updates = ev.order_updates(ev.parse_events(event_stream(spark, sf_dir))).drop("updated_at")
    current = ev.current_state(updates, ev.ORDER_KEY, ev.ORDER_TIME, ["delivery_id"])

    def keep_changes(batch: DataFrame, batch_id: int) -> None:
        ev.append_history(batch, batch_id, f"{base}/changes")

    writer = current.writeStream.outputMode("update").foreachBatch(keep_changes)
    ev.run_available_now(writer.option("checkpointLocation", f"{base}/_chk"))
    changes = ev.read_history(spark, f"{base}/changes")
    return shown(ev.newest_per_key(changes, ev.ORDER_KEY, ev.ORDER_TIME, ["delivery_id"]))


@query(
    ORDER_EVENTS
    + f"""SELECT '{{"order_id":"' || order_id || '","dele' AS _corrupt_record FROM history
WHERE CAST(substr(delivery_id, 2) AS BIGINT) % 101 = 0"""
)
def stream_dead_letters(spark, sf_dir):
    """Every 101st message cut short on the way: it must end up whole among the dead letters."""
    number = F.get_json_object(F.col("value").cast("string"), "$.delivery_id")
    text = F.col("value").cast("string")
    cut = F.concat(F.substring_index(text, ",", 1), F.lit(',"dele'))
    damaged = F.when(F.substring(number, 2, 20).cast("bigint") % 101 == 0, cut).otherwise(text)
    messages = event_stream(spark, sf_dir).select(damaged.cast("binary").alias("value"))
    parsed = ev.parse_events(messages, corrupt_col="_corrupt_record")
    tables = ev.run_order_stream(parsed, scratch_dir(spark, "damaged"), ["delivery_id"])
    return ev.read_history(spark, tables.dead_letters).select("_corrupt_record")


@query(ORDER_EVENTS + "SELECT current_status, count(*) AS order_count FROM status GROUP BY current_status")
def stream_status_breakdown(spark, sf_dir):
    _, state = drain(spark, sf_dir)
    return breakdown(state, "current_status", "order_count")


@query(
    ORDER_EVENTS
    + """SELECT (SELECT count(*) FROM history) AS raw_rows, (SELECT count(*) FROM events) AS expected_rows,
  (SELECT count(*) FROM status) AS state_rows, (SELECT count(DISTINCT order_id) FROM status) AS distinct_keys,
  (SELECT count(DISTINCT user_id) FROM events) AS expected_keys, 'PASS' AS status"""
)
def stream_reconciliation(spark, sf_dir):
    history, state = drain(spark, sf_dir)
    expected = inputs.table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("k")
    ).first()
    totals = ev.stream_reconciliation(history, state, "order_id", expected.n, expected.k)
    enforce(totals)
    return totals


#: The part of the day whose events land first, second, third and last: each brings days that earlier ones have passed.
_ARRIVAL = (2, 0, 3, 1)


def bus_drains(spark: SparkSession, sf_dir: str) -> tuple[ev.OrderTables, list, Manifest]:
    """Land the events in four parts, out of order and with the day as their time; drain and fold after two and after all four.

    A drain takes a quarter of the files at a time, so that it has several micro-batches. All events of an order
    in one part lie in one file. Returns the tables, the progress of each micro-batch and the last manifest.
    """
    base = scratch_dir(spark, "bus")
    tables = ev.OrderTables(f"{base}/history", f"{base}/state", f"{base}/dead_letters")
    arrival = F.get(F.array(*[F.lit(i) for i in _ARRIVAL]), F.floor(F.hour("ts") / 6).cast("int"))
    parts = inputs.table(spark, sf_dir, "events").select(F.date_trunc("day", "ts").alias("ts"), arrival.alias("arrival"), "user_id", "event_id", "event_type", "value")
    progress, folded = [], None
    for drained in ((0, 1), (2, 3)):
        for i in drained:
            inputs.order_event_values(parts.where(F.col("arrival") == i).repartition("user_id")).write.mode("append").parquet(f"{base}/bus")
        files = sum(name.endswith(".parquet") for name in folders.names(spark, f"{base}/bus"))
        source = ev.event_source(spark, "files", {"path": f"{base}/bus", "maxFilesPerTrigger": str(max(1, files // 4))})
        query = ev.drain_once(ev.parse_events(source), f"{base}/checkpoint", f"{base}/commits", ev.order_sinks(tables, ["delivery_id"]))
        progress.append([p for p in query.recentProgress if p.numInputRows])
        folded = ev.fold_state(spark, tables.state, ev.ORDER_KEY, ev.ORDER_TIME)
    return tables, progress, folded


_DAILY = """WITH landed AS (
  SELECT CAST(user_id AS VARCHAR) AS order_id, 'd' || event_id AS delivery_id, date_trunc('day', ts) AS last_event_timestamp,
    [2, 0, 3, 1][hour(ts) // 6 + 1] AS arrival, value AS order_value FROM events)
"""


@query(
    _DAILY
    + f"""SELECT order_id, delivery_id, {moment("last_event_timestamp")} AS last_event_timestamp, order_value FROM landed
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY last_event_timestamp DESC, arrival, delivery_id DESC) = 1"""
)
def stream_state_across_batches(spark, sf_dir):
    """Newest state over micro-batches out of order: newer days win, and on equal ones the batch that came first."""
    tables, _, _ = bus_drains(spark, sf_dir)
    return shown(ev.read_state(spark, tables.state, ev.ORDER_KEY, ev.ORDER_TIME).select("order_id", "delivery_id", ev.ORDER_TIME, "order_value"))


@query(
    """SELECT count(*) AS read_rows, count(*) AS history_rows, count(DISTINCT user_id) AS state_rows,
  true AS several_batches, CAST(1 AS BIGINT) AS generation, true AS log_bounded FROM events"""
)
def stream_admission_report(spark, sf_dir):
    """Each event read once for all sinks, in several micro-batches; after two folds only the last drain's batches are left."""
    tables, progress, folded = bus_drains(spark, sf_dir)
    left = [n for s in folders.names(spark, tables.state) if s.startswith(ev.STREAM) for n in folders.names(spark, f"{tables.state}/{s}") if n.startswith(ev.BATCH)]
    state = ev.read_state(spark, tables.state, ev.ORDER_KEY, ev.ORDER_TIME)
    return ev.read_history(spark, tables.history).agg(F.count("*").alias("history_rows")).select(
        F.lit(sum(p.numInputRows for drain in progress for p in drain)).cast("long").alias("read_rows"),
        "history_rows",
        F.lit(state.count()).cast("long").alias("state_rows"),
        F.lit(sum(map(len, progress)) >= 3).alias("several_batches"),
        F.lit(folded.generation).cast("long").alias("generation"),
        F.lit(len(left) <= len(progress[-1])).alias("log_bounded"),
    )
