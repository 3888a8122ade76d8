"""Bronze: messages decoded and flattened, original text kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux import schemas


def decode(log: DataFrame) -> DataFrame:
    """Payload as text, broker time under its own name."""
    return log.select(F.col("value").cast("string").alias("raw_json"),
                      F.col("timestamp").alias("kafka_timestamp"))


def parse(messages: DataFrame) -> DataFrame:
    """Fields of the event beside the text.

    Unknown keys stay in the text only; text that does not parse gives NULL fields.
    """
    event = F.from_json("raw_json", schemas.EVENT)
    return messages.select("*", event.alias("event")).select(*messages.columns, "event.*")


def bronze(log: DataFrame) -> DataFrame:
    return parse(decode(log))
