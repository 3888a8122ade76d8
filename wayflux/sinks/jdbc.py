"""Staging load over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

CHUNK_ROWS = 5000


def jdbc_options(url: str, table: str, connections: int, **properties: str) -> dict[str, str]:
    """Truncate and load: the table is created when absent and keeps its declaration otherwise."""
    return {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(CHUNK_ROWS),
            "numPartitions": str(connections), **properties}


def write_jdbc(df: DataFrame, url: str, table: str, connections: int = 8,
               **properties: str) -> int:
    """Replace the rows of a warehouse table and tell how many were sent.  ``connections`` bounds the
    parallel writers."""
    options, seen = jdbc_options(url, table, connections, **properties), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format("jdbc").mode("overwrite").options(**options).save()
    return seen.get.get("rows") or 0
