"""Catalog: databases, external tables, and the views that BI tools and reports read."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux import schemas
from wayflux.plans import warehouse
from wayflux.sources import LAKE_FORMAT

# ---- Fixed values: the BI contract, (stored column, BI column, BI type). ------------------------
BI_FACT = (
    ("vehicle_id", "vehicle_id", "STRING"),
    ("road_id", "road_id", "STRING"),
    ("city_zone", "city_zone", "STRING"),
    ("speed_int", "speed", "DOUBLE"),
    ("congestion_level", "congestion_level", "INT"),
    ("event_ts", "event_time", "TIMESTAMP"),
    ("peak_flag", "peak_flag", "STRING"),
    ("speed_band", "speed_band", "STRING"),
    ("weather", "weather", "STRING"),
    ("date", "event_date", "DATE"),
    ("hour", "event_hour", "INT"),
)
BI_ZONE = (("city_zone", "city_zone", "STRING"), ("zone_type", "zone_type", "STRING"),
           ("traffic_risk", "traffic_risk", "STRING"))
BI_ROAD = (("road_id", "road_id", "STRING"), ("road_type", "road_type", "STRING"),
           ("speed_limit", "speed_limit", "INT"))
# -------------------------------------------------------------------------------------------------

BI_VIEWS = {
    "bi_fact_traffic": ("fact_traffic", BI_FACT),
    "bi_dim_zone": ("dim_zone", BI_ZONE),
    "bi_dim_road": ("dim_road", BI_ROAD),
}


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def register_table(spark: SparkSession, database: str, table: str, location: str,
                   fmt: str = LAKE_FORMAT, partitioned: bool = False) -> None:
    """An external table over stored files; the files stay where they are."""
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{location}'")
    if partitioned and fmt != "delta":
        spark.sql(f"MSCK REPAIR TABLE {name}")


# Whether Spark keeps the partitions of a table in the catalog, each with a folder of its own.
_LISTED_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def register_movable(spark: SparkSession, database: str, table: str, location: str,
                     fmt: str = LAKE_FORMAT) -> None:
    """An external table that ``switch_tables`` can point elsewhere.

    Its partitions are found below its folder when it is read, not listed in the catalog, so they all
    follow the folder at once.
    """
    before = spark.conf.get(_LISTED_PARTITIONS)
    spark.conf.set(_LISTED_PARTITIONS, "false")
    try:
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` USING {fmt} LOCATION '{location}'")
    finally:
        spark.conf.set(_LISTED_PARTITIONS, before)


def switch_tables(spark: SparkSession, database: str, locations: Mapping[str, str],
                  fmt: str = LAKE_FORMAT) -> None:
    """Point tables to new folders, which have to be written by then; missing tables are registered.

    Nothing is copied or removed: a reader that began on an old folder ends on it.
    """
    for table, location in locations.items():
        if spark.catalog.tableExists(f"`{database}`.`{table}`"):
            spark.sql(f"ALTER TABLE `{database}`.`{table}` SET LOCATION '{location}'")
        else:
            register_movable(spark, database, table, location, fmt)


def table_location(spark: SparkSession, database: str, table: str) -> str | None:
    """The folder of a registered table."""
    if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").where("col_name = 'Location'")
    return told.first()["data_type"]


def _create_view(spark: SparkSession, database: str, view: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS {query}")


def create_bi_views(spark: SparkSession, database: str) -> None:
    """Views with the names and types BI tools rely on."""
    for view, (table, contract) in BI_VIEWS.items():
        columns = ", ".join(f"CAST(`{stored}` AS {sql_type}) AS `{name}`"
                            for stored, name, sql_type in contract)
        _create_view(spark, database, view, f"SELECT {columns} FROM `{database}`.`{table}`")


def create_mart_views(spark: SparkSession, database: str) -> None:
    """The star as reports know it, on top of the marts."""
    sources = {
        "fact_traffic": ("", schemas.STAGED_FACT, warehouse.EVENTS),
        "dim_zone": ("DISTINCT", schemas.DIM_ZONE, warehouse.LOCATIONS),
        "dim_road": ("DISTINCT", schemas.DIM_ROAD, warehouse.LOCATIONS),
    }
    for view, (quantifier, contract, table) in sources.items():
        columns = ", ".join(f"`{name}`" for name in contract.names)
        query = f"SELECT {quantifier} {columns} FROM `{database}`.`{table}`"
        _create_view(spark, database, view, query)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` of every table; counts come from file footers where possible."""
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
               for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)
