"""Message logs as streams of ``(value BINARY, timestamp TIMESTAMP)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayflux import schemas


def kafka_log(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
              **options: str) -> DataFrame:
    """One topic.  Needs the Kafka connector on the class path.

    Useful options at scale: ``maxOffsetsPerTrigger`` bounds a batch, ``minPartitions`` splits a
    topic partition that holds most of the traffic over several tasks.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting))
    return reader.options(**options).load()


def file_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same envelope from files that arrive in a folder."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
