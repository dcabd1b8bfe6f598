"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cpus: str | int = "*", conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own session."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, the storage all executors share.

    A local session without that setting uses a folder in its warehouse; a cluster session
    without it is an error, because a machine-local folder would be invisible to the
    other executors and lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used where several branches share one expensive result: the branches then read a
    columnar table instead of each recomputing the lineage, and a lost executor costs
    a re-read only.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
