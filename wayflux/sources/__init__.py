"""Scans: message logs, stored tables (snapshot or stream), seeds, literals and JDBC."""

from wayflux.sources.logs import file_log, kafka_log
from wayflux.sources.tables import (
    LAKE_FORMAT, literal_table, read_jdbc, read_seed, read_table, stream_table, table_exists)

__all__ = ["LAKE_FORMAT", "file_log", "kafka_log", "literal_table", "read_jdbc", "read_seed",
           "read_table", "stream_table", "table_exists"]
