"""Batch and streaming writes of stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.query import StreamingQuery

from wayflux.sources import LAKE_FORMAT


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    fmt: str = LAKE_FORMAT, touched_only: bool = False,
                    rebalance: bool = False) -> None:
    """Replace a table with its schema, or with ``touched_only`` just the partitions in ``df``.

    ``rebalance`` gathers the rows of a partition before the write and splits partitions that are
    large, so that neither a day with most of the rows nor a task with rows of every day decides
    the file sizes.  Leave it off where the input is laid out by the same columns.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


@dataclass(frozen=True)
class Load:
    """What a write stored: its rows and, for tables laid out by a column, the values it had."""

    rows: int
    parts: frozenset = frozenset()


def load_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = LAKE_FORMAT,
               touched_only: bool = False, rebalance: bool = False) -> Load:
    """``overwrite_table`` that tells what it wrote.

    The write counts its own rows as they pass, so nothing is read again.  The count stands behind the
    last shuffle: tasks that are repeated for a lost executor count once.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    seen, counts = Observation(), [F.count(F.lit(1)).alias("rows")]
    if partition_by:
        counts.append(F.collect_set(partition_by[0]).alias("parts"))
    overwrite_table(df.observe(seen, *counts), path, partition_by, fmt, touched_only)
    return Load(seen.get.get("rows") or 0, frozenset(seen.get.get("parts") or ()))


def drop_days(spark: SparkSession, path: str, column: str, days: Sequence[date],
              fmt: str = LAKE_FORMAT) -> None:
    """Remove whole days of a table that is laid out by them; days that it does not have are no error."""
    if fmt == "delta":
        listed = ", ".join(f"DATE'{day:%Y-%m-%d}'" for day in days)
        if days:
            spark.sql(f"DELETE FROM delta.`{path}` WHERE `{column}` IN ({listed})")
        return
    for day in days:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day:%Y-%m-%d}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def append_table(df: DataFrame, path: str, fmt: str = LAKE_FORMAT) -> Load:
    """Add rows and tell how many."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format(fmt).mode("append").save(path)
    return Load(seen.get.get("rows") or 0)


def with_trigger(writer: DataStreamWriter, available_now: bool,
                 interval: str | None = None) -> DataStreamWriter:
    """Drain what is there and stop, or run on: at an interval or as fast as batches finish."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def append_stream(stream: DataFrame, path: str, checkpoint: str,
                  partition_by: Sequence[str] = (), fmt: str = LAKE_FORMAT,
                  available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Append a stream to a table; the checkpoint makes every batch count once."""
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, available_now, interval).start()
