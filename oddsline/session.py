"""Session helpers: defaults, time zone and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: For a session that runs batch jobs.  Adaptive execution merges partitions by their measured
#: size but doesn't raise their number, so the start has to suit the largest input.
BATCH_OPTIONS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m"}
#: For a session that runs the live job: the partitions of stream state stay for good, and
#: three queries with little state share a short trigger.
STREAM_OPTIONS = {"spark.sql.shuffle.partitions": "24"}


def build_session(app_name: str = "oddsline", master: str | None = None,
                  **options: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``options`` override them.

    The number of shuffle partitions is the caller's: ``BATCH_OPTIONS``, ``STREAM_OPTIONS``
    or what suits a test.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update(options)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: all feeds carry UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share.

    It lies below ``spark.checkpoint.dir``. Only where that is unset it lies below the
    warehouse, which every session has and a cluster shares; never in a folder of one
    machine.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, also if executors are lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
