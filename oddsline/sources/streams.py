"""Streaming sources. All give a ``value`` column or the columns of the given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming.readwriter import DataStreamReader


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """Messages of a topic; needs the Spark Kafka package on the class path.

    ``min_partitions`` splits hot topic partitions into several tasks.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting))
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def _admitting(reader: DataStreamReader, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    """How much of a backlog one micro-batch takes: so many files, or bytes; a file at least."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader if max_bytes is None else reader.option("maxBytesPerTrigger", max_bytes)


def text_stream(spark: SparkSession, path: str, max_files: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """Lines of the text files of a folder, oldest file first."""
    return _admitting(spark.readStream.format("text"), max_files, max_bytes).load(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType,
                 max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Rows of the Parquet files of a folder or glob, oldest file first.

    A single file has to be given as a glob: a plain path must be a folder.
    """
    return _admitting(spark.readStream.schema(schema), max_files, max_bytes).parquet(path)
