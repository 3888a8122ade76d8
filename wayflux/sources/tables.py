"""Stored tables, seeds and literals.

Tables are Parquet folders by default.  ``fmt="delta"`` uses Delta Lake where its package is on
the class path; nothing else in the library depends on the format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAKE_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = LAKE_FORMAT) -> DataFrame:
    """Snapshot of a table; fails at once when the path is missing."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = LAKE_FORMAT) -> bool:
    """Whether something was stored under the path."""
    try:
        read_table(spark, path, T.StructType([T.StructField("any", T.StringType())]), fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST"):
            return False
        raise
    return True


def stream_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = LAKE_FORMAT,
                 max_files: int | None = None) -> DataFrame:
    """An append-only table as a stream: its whole history first, then what is added.

    ``max_files`` bounds a batch.  Behind a watermark set it only where files arrive in event-time
    order: a backlog cut otherwise makes rows late that one batch would keep.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "delta":
        reader = reader.option("startingVersion", 0)
    else:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, typed by the contract of the table it stands in for."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A table written down in the code.

    It is exploded from one row of literals, so the optimizer knows that it is small and joins
    broadcast it; createDataFrame would hand over an RDD of unknown size.
    """
    def struct(row: tuple) -> Column:
        return F.struct(*[F.lit(value).cast(f.dataType).alias(f.name)
                          for f, value in zip(schema.fields, row)])

    return spark.range(1).select(F.inline(F.array(*[struct(row) for row in rows])))


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              bounds: tuple[str, str] | None = None, partitions: int = 1,
              **properties: str) -> DataFrame:
    """A warehouse table over JDBC, in ``partitions`` range scans over ``column`` if given."""
    options = jdbc_scan_options(url, table, column, bounds, partitions, **properties)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_scan_options(url: str, table: str, column: str | None = None,
                      bounds: tuple[str, str] | None = None, partitions: int = 1,
                      **properties: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **properties}
    if column and bounds:
        options.update(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1],
                       numPartitions=str(partitions))
    return options
