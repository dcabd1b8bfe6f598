"""Order-event streams: parse, keep full history, maintain current state per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from harborline.operators.validity import keep_latest
from harborline.sources import folders
from harborline.streaming.state import BATCH, STREAM, compact_state, fold_state, manifest, read_state

__all__ = ["compact_state", "fold_state", "manifest", "read_state"]

# The order event, one JSON object per message.
ORDER_EVENT = StructType(
    [
        StructField("order_id", StringType()),
        StructField("delivery_id", StringType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("pickup_location_id", LongType()),
        StructField("vendor_id", LongType()),
        StructField("order_value", DoubleType()),
    ]
)

# What identifies an order, and what orders its states.
ORDER_KEY = ("order_id",)
ORDER_TIME = "last_event_timestamp"


# --- source and parsing -----------------------------------------------------------


def event_source(spark: SparkSession, kind: str, options: Mapping[str, str]) -> DataFrame:
    """A stream with a binary ``value`` column.

    ``kafka`` starts at the earliest offsets and tolerates lost offsets unless the
    options say otherwise (it needs the Kafka connector on the class path). ``files``
    reads Parquet files that hold such a column, from the folder in ``path``.
    """
    if kind == "kafka":
        defaults = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**{**defaults, **options}).load()
    if kind == "files":
        reading = {k: v for k, v in options.items() if k != "path"}
        return spark.readStream.schema("value binary").options(**reading).parquet(options["path"])
    raise ValueError(f"kind must be 'kafka' or 'files', not {kind!r}")


def parse_events(
    df: DataFrame,
    schema: StructType = ORDER_EVENT,
    ts_col: str | None = "event_timestamp",
    corrupt_col: str | None = None,
) -> DataFrame:
    """Binary JSON to typed columns; ``ts_col`` becomes a timestamp.

    A message that cannot be parsed becomes a row of NULLs, or of what could be read of
    it; with ``corrupt_col`` its text is kept there. See ``split_dead_letters``.
    """
    options = {}
    if corrupt_col:
        schema = StructType([*schema.fields, StructField(corrupt_col, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    event = F.from_json(F.col("value").cast("string"), schema, options).alias("event")
    typed = df.select(event).select("event.*")
    return typed if ts_col is None else typed.withColumn(ts_col, F.try_to_timestamp(F.col(ts_col)))


def split_dead_letters(df: DataFrame, keys: Sequence[str], order_col: str) -> tuple[DataFrame, DataFrame]:
    """``(usable, dead letters)``: a state update needs every key part and a timestamp."""
    usable = F.col(order_col).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return df.filter(usable), df.filter(~usable)


# --- running ----------------------------------------------------------------------


def run_available_now(writer: DataStreamWriter) -> StreamingQuery:
    """Drain what is available, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def fan_out(stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], None]]) -> list[StreamingQuery]:
    """Drain one stream into several sinks, each with its own checkpoint and progress."""
    running = [
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        for checkpoint, sink in sinks.items()
    ]
    for query in running:
        query.awaitTermination()
    return running


def stream_name(spark: SparkSession, otherwise: str = "direct") -> str:
    """The running query, whose id its checkpoint keeps; outside a stream the name that the caller gives."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or otherwise


def drain_once(stream: DataFrame, checkpoint: str, commits: str, sinks: Mapping[str, Callable[[DataFrame, int], None]]) -> StreamingQuery:
    """Drain one stream into several sinks from a single read of its source.

    Each micro-batch is read and parsed once, kept, and given to the sinks in turn. A sink that is done leaves a marker with the
    stream and the batch under ``commits``. Where a later one fails, the batch comes again after the restart, and
    those that have their marker skip it. A sink that dies before its marker sees its batch twice, so it has to
    replace what it wrote for that batch, as the sinks here do. Only the newest marker of a sink is kept.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, sink in sinks.items():
                done = f"{commits}/{name}/{STREAM}={stream_name(spark)}"
                if folders.exists(spark, f"{done}/{BATCH}={batch_id}"):
                    continue
                sink(batch, batch_id)
                folders.touch(spark, f"{done}/{BATCH}={batch_id}")
                folders.remove(spark, f"{done}/{BATCH}={batch_id - 1}")
        finally:
            batch.unpersist()

    return run_available_now(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint))


# --- history ----------------------------------------------------------------------


def batch_folder(spark: SparkSession, target: str, batch_id: int, stream: str = "direct") -> str:
    """The folder of a micro-batch.

    Batch numbers start anew with each checkpoint, so the folder also names the running
    query, whose id its checkpoint keeps: no other checkpoint can write into it. Callers outside a stream
    that share a target name themselves by ``stream``.
    """
    return f"{target}/{STREAM}={stream_name(spark, stream)}/{BATCH}={batch_id}"


def append_history(batch: DataFrame, batch_id: int, target: str, stream: str = "direct") -> None:
    """Append a micro-batch unchanged; a retried batch replaces its own folder.

    Empty batches leave nothing behind. A new checkpoint on the same target adds what it
    reads and replaces nothing.
    """
    if batch.isEmpty():
        return
    batch.write.mode("overwrite").parquet(batch_folder(batch.sparkSession, target, batch_id, stream))


def read_history(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", target).parquet(target).drop(STREAM, BATCH)


# --- current state ----------------------------------------------------------------


def order_updates(events: DataFrame) -> DataFrame:
    """Events in the shape of the order state table, stamped with the processing time."""
    return events.select(
        "order_id",
        "delivery_id",
        "pickup_location_id",
        "vendor_id",
        "order_value",
        F.col("event_type").alias("current_status"),
        F.col("event_timestamp").alias("last_event_timestamp"),
        F.current_timestamp().alias("updated_at"),
    )


def newest_per_key(updates: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    return keep_latest(updates, keys, [F.desc(order_col), *[F.desc(c) for c in tiebreak]])


def merge_statement(target: str, source: str, keys: Sequence[str], order_col: str) -> str:
    """The MERGE that applies one update per key, newer timestamps only."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (
        f"MERGE INTO {target} t USING {source} s ON {on} "
        f"WHEN MATCHED AND s.`{order_col}` > t.`{order_col}` THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )


def upsert_latest(
    spark: SparkSession,
    target: str,
    updates: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tiebreak: Sequence[str] = (),
    batch_id: int = 0,
    fmt: str = "parquet",
    stream: str = "direct",
) -> None:
    """Apply one micro-batch of updates to a keyed state table.

    A key is inserted if absent and replaced only by a strictly newer ``order_col``;
    rows without a key or timestamp are left out. A table format with MERGE is updated
    in place. On Parquet the batch's winners are appended as one folder per batch, which
    costs only the batch, and ``read_state`` resolves each key: strictly newer wins, and
    on a tie the earlier batch stays. That is the result of merging batch by batch.
    Running a batch again replaces its own folder, so a retry changes nothing.
    """
    if updates.isEmpty():
        return
    usable, _ = split_dead_letters(updates, keys, order_col)
    winners = newest_per_key(usable, keys, order_col, tiebreak)
    if fmt == "delta":
        view = f"updates_{batch_id}"
        winners.createOrReplaceTempView(view)
        winners.sparkSession.sql(merge_statement(target, view, keys, order_col))
        winners.sparkSession.catalog.dropTempView(view)
    elif fmt == "parquet":
        winners.write.mode("overwrite").parquet(batch_folder(spark, target, batch_id, stream))
    else:
        raise ValueError(f"no upsert for format {fmt!r}")


def current_state(stream: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Current state as a streaming aggregate kept in Spark's state store.

    Unlike ``upsert_latest``, a tie goes to the larger ``tiebreak``, whatever its batch.
    Use it with the ``update`` or ``complete`` output mode.
    """
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(order_col, *tiebreak)).alias("_newest")
    usable, _ = split_dead_letters(stream, keys, order_col)
    return usable.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


@dataclass(frozen=True)
class OrderTables:
    """Where an order stream keeps its three tables."""

    history: str
    state: str
    dead_letters: str


def run_order_stream(stream: DataFrame, base: str, tiebreak: Sequence[str] = ()) -> OrderTables:
    """Drain parsed order events into history, current state and dead letters under ``base``.

    History keeps every event. Events without a key or time cannot change a state and go
    to the dead letters. The source is read once for the three.
    """
    tables = OrderTables(f"{base}/history", f"{base}/state", f"{base}/dead_letters")
    drain_once(stream, f"{base}/_checkpoints/orders", f"{base}/_commits", order_sinks(tables, tiebreak))
    return tables


def order_sinks(tables: OrderTables, tiebreak: Sequence[str] = ()) -> dict[str, Callable[[DataFrame, int], None]]:
    """The three tables as sinks of one stream of parsed order events."""

    def history(batch: DataFrame, batch_id: int) -> None:
        append_history(batch, batch_id, tables.history)

    def dead_letters(batch: DataFrame, batch_id: int) -> None:
        append_history(split_dead_letters(batch, ORDER_KEY, "event_timestamp")[1], batch_id, tables.dead_letters)

    def state(batch: DataFrame, batch_id: int) -> None:
        usable, _ = split_dead_letters(batch, ORDER_KEY, "event_timestamp")
        upsert_latest(batch.sparkSession, tables.state, order_updates(usable), ORDER_KEY, ORDER_TIME, tiebreak, batch_id)

    return {"history": history, "dead_letters": dead_letters, "state": state}


# --- reconciliation ---------------------------------------------------------------


def stream_reconciliation(raw: DataFrame, state: DataFrame, key: str, expected_rows: int, expected_keys: int) -> DataFrame:
    """One row: history and state totals against what was expected.

    Each side is one aggregate; ``status`` works with ``contracts.enforce``.
    """
    zero = F.lit(0).cast("bigint")
    history = raw.agg(F.count(F.lit(1)).alias("raw_rows")).withColumns({"state_rows": zero, "distinct_keys": zero})
    current = state.agg(
        F.count(F.lit(1)).alias("state_rows"), F.count_distinct(key).alias("distinct_keys")
    ).withColumn("raw_rows", zero)
    totals = history.unionByName(current).agg(*[F.sum(c).alias(c) for c in history.columns])
    good = (
        (F.col("raw_rows") == expected_rows)
        & (F.col("distinct_keys") == expected_keys)
        & (F.col("state_rows") == F.col("distinct_keys"))
    )
    return totals.select(
        "raw_rows",
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        "state_rows",
        "distinct_keys",
        F.lit(expected_keys).cast("bigint").alias("expected_keys"),
        F.when(good, "PASS").otherwise("FAIL").alias("status"),
    )
