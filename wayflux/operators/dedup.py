"""One row per key, in batch and on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
_ROW = "_row"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; give enough columns to leave no ties that differ.

    A ``row_number() = 1`` filter is planned with a rank limit *before* the shuffle: each map task
    sends one row per key, so a key that holds a third of all rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def _first_of_each(keys: Sequence[str]):
    """Per Arrow batch, the rows that hold a key for the first time."""
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch.select(list(keys))])
            rows = rows.append_column(_ROW, pa.array(np.arange(batch.num_rows)))
            firsts = rows.group_by(list(keys), use_threads=False).aggregate([(_ROW, "min")])
            if firsts.num_rows == batch.num_rows:
                yield batch
            else:
                yield batch.take(firsts[f"{_ROW}_min"].combine_chunks())
    return thin


def thin_copies(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop copies that lie close together, without state and without a shuffle.

    Streams have no partial step before the deduplication shuffle, so all copies of a key would
    meet in one task.  Here a key keeps at most one row per Arrow batch of its source task, which
    shrinks a key that fills a third of the input by some thousand times.
    """
    return stream.mapInArrow(_first_of_each(keys), stream.schema)


def dedup_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str,
                 thin: bool = True) -> DataFrame:
    """Drop repeated keys and rows later than the watermark; state ends with the watermark.

    ``thin`` guards against keys with very many copies.  It holds no state, so it can be switched
    between runs of the same checkpoint.
    """
    if thin:
        stream = thin_copies(stream, keys)
    return stream.withWatermark(event_time, delay).dropDuplicates(list(keys))
