"""A keyed state table on plain Parquet: a log of micro-batches, folded into generations.

Each micro-batch leaves its winners in a folder of the log. ``fold_state`` resolves the last generation and the
log behind it to one row a key, writes that as the next generation, and then its manifest: the batches it
covers, by stream. Readers take the newest generation whose manifest is complete and the batches it does not cover, so
a fold that dies leaves no trace but files nobody reads, and running it again is safe. On equal times a folded row
ranks before the log, and the log by batch: that is the result of merging batch by batch.

A fold deletes what the generation before the last needed; a reader that started from the last manifest still finds all
its files. So a table holds two generations and the batches of two folds at most, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from harborline.operators.validity import keep_latest
from harborline.sources import folders

BATCH = "batch_id"
STREAM = "stream_id"
_FOLDED = "_in_log"


@dataclass(frozen=True)
class Manifest:
    """A generation, and for each stream the last batch that it covers."""

    generation: int = -1
    covered: dict[str, int] = field(default_factory=dict)

    def behind(self) -> Column:
        """Which batches of the log are not covered; a filter on partition columns, so the others are not listed as input."""
        newer = [(F.col(STREAM) == s) & (F.col(BATCH) > b) for s, b in sorted(self.covered.items())]
        unknown = ~F.col(STREAM).isin(*self.covered) if self.covered else F.lit(True)
        return reduce(lambda a, b: a | b, newer, unknown)


def _rows(target: str, generation: int) -> str:
    return f"{target}/_generations/{generation:012d}/rows"


def _manifest(target: str, generation: int) -> str:
    return f"{target}/_generations/{generation:012d}/manifest"


def manifest(spark: SparkSession, target: str) -> Manifest:
    """The newest complete one."""
    for name in reversed(folders.names(spark, f"{target}/_generations")):
        path = _manifest(target, int(name))
        if folders.exists(spark, f"{path}/_SUCCESS"):
            rows = spark.read.schema("stream string, batch long").parquet(path).collect()  # one for each stream
            return Manifest(int(name), {r.stream: r.batch for r in rows})
    return Manifest()


def _log(spark: SparkSession, target: str, schema: StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", target)
    if schema is not None:  # a log that was folded whole has no file to tell its schema
        reader = reader.schema(StructType([*schema.fields, StructField(STREAM, StringType()), StructField(BATCH, LongType())]))
    return reader.parquet(target)


def _resolved(spark: SparkSession, target: str, keys: Sequence[str], order_col: str, known: Manifest, upto: Manifest | None = None) -> DataFrame:
    old = spark.read.parquet(_rows(target, known.generation)) if known.generation >= 0 else None
    log = _log(spark, target, old.schema if old is not None else None).where(known.behind())
    if upto is not None:
        log = log.where(~upto.behind())
    log = log.withColumn(_FOLDED, F.lit(1))
    if old is not None:
        folded = old.withColumns({STREAM: F.lit(None).cast("string"), BATCH: F.lit(None).cast("long"), _FOLDED: F.lit(0)})
        log = log.unionByName(folded, allowMissingColumns=True)
    order = [F.desc(order_col), F.asc(_FOLDED), F.asc(BATCH), F.asc(STREAM)]
    return keep_latest(log, keys, order).drop(STREAM, BATCH, _FOLDED)


def read_state(spark: SparkSession, target: str, keys: Sequence[str], order_col: str) -> DataFrame:
    """The current row of every key: a strictly newer one wins, and on a tie the earlier batch stays."""
    return _resolved(spark, target, keys, order_col, manifest(spark, target))


def fold_state(spark: SparkSession, target: str, keys: Sequence[str], order_col: str, least_batches: int = 1) -> Manifest:
    """Fold the log into a new generation of one row a key, once ``least_batches`` batches wait.

    Later batches still apply. A fold rewrites all keys, so a large state with small batches folds every so many of
    them. Run it between drains, or as the last sink of one. One fold of a table runs at a time.
    """
    known = manifest(spark, target)
    schema = spark.read.parquet(_rows(target, known.generation)).schema if known.generation >= 0 else None
    if not any(n.startswith(f"{STREAM}=") for n in folders.names(spark, target)):
        return known
    waiting = _log(spark, target, schema).where(known.behind()).groupBy(STREAM).agg(F.max(BATCH).alias("batch"), F.count_distinct(BATCH).alias("n"))
    found = waiting.collect()  # one row for each stream
    if sum(r.n for r in found) < max(1, least_batches):
        return known
    new = Manifest(known.generation + 1, known.covered | {r[STREAM]: r.batch for r in found})
    folders.remove(spark, f"{target}/_generations/{new.generation:012d}")  # what a fold that died may have left
    _resolved(spark, target, keys, order_col, known, new).write.parquet(_rows(target, new.generation))
    covered = spark.createDataFrame(sorted(new.covered.items()), "stream string, batch long")
    covered.coalesce(1).write.parquet(_manifest(target, new.generation))
    _prune(spark, target, known)
    return new


def _prune(spark: SparkSession, target: str, last: Manifest) -> None:
    """Delete what no reader of the generation ``last`` or a later one needs."""
    for name in folders.names(spark, f"{target}/_generations"):
        if int(name) < last.generation:
            folders.remove(spark, f"{target}/_generations/{name}")
    for stream, batch in last.covered.items():
        for name in folders.names(spark, f"{target}/{STREAM}={stream}"):
            if name.startswith(f"{BATCH}=") and int(name.removeprefix(f"{BATCH}=")) <= batch:
                folders.remove(spark, f"{target}/{STREAM}={stream}/{name}")


def compact_state(spark: SparkSession, target: str, new_target: str, keys: Sequence[str], order_col: str) -> None:
    """Rewrite a state table as one row per key, at a new location, where it ranks before all batches."""
    read_state(spark, target, keys, order_col).write.parquet(f"{new_target}/{STREAM}=compacted/{BATCH}=-1")
