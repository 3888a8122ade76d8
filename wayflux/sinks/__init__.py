"""Writers: stored tables, append streams, JDBC and the catalog."""

from wayflux.sinks.catalog import (
    create_bi_views, create_database, create_mart_views, register_movable, register_table, row_counts,
    switch_tables, table_location)
from wayflux.sinks.jdbc import write_jdbc
from wayflux.sinks.tables import (
    Load, append_stream, append_table, drop_days, load_table, overwrite_table)

__all__ = ["Load", "append_stream", "append_table", "create_bi_views", "create_database",
           "create_mart_views", "drop_days", "load_table", "overwrite_table", "register_movable",
           "register_table", "row_counts", "switch_tables", "table_location", "write_jdbc"]
