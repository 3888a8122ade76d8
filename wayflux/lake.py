"""Where the tables of one lake live, and typed access to them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wayflux import schemas
from wayflux.plans import contracts, rollups, staging, warehouse
from wayflux.sources import LAKE_FORMAT, read_table, stream_table, table_exists

BRONZE, SILVER = "traffic_bronze", "traffic_silver"
ZONE, ROAD, FACT = "dim_zone", "dim_road", "fact_traffic"
CHECK_HISTORY, LOAD_HISTORY = "check_history", "load_history"

_SCHEMAS = {
    BRONZE: schemas.BRONZE,
    SILVER: schemas.SILVER_STORED,
    ZONE: schemas.DIM_ZONE,
    ROAD: schemas.DIM_ROAD,
    FACT: schemas.FACT,
    **staging.CONTRACTS,
    warehouse.LOCATIONS: schemas.DIM_LOCATIONS,
    warehouse.EVENTS: schemas.FCT_EVENTS,
    rollups.TRAFFIC_DAILY: schemas.TRAFFIC_DAILY,
    contracts.CHECK_PARTS: schemas.CHECK_PARTS,
    CHECK_HISTORY: schemas.CHECK_HISTORY,
    LOAD_HISTORY: schemas.LOAD_HISTORY,
}

# Tables with rows of single days are stored by day, histories by run; the rest are single folders.
PARTITIONS = {
    SILVER: (schemas.EVENT_DATE,),
    FACT: ("date",),
    staging.STG_FACT: ("date",),
    warehouse.EVENTS: ("date",),
    rollups.TRAFFIC_DAILY: ("date",),
    contracts.CHECK_PARTS: ("date",),
    CHECK_HISTORY: ("run",),
    LOAD_HISTORY: ("run",),
}


@dataclass(frozen=True)
class Lake:
    """A root folder, on storage that every executor can reach, and the format of its tables.

    ``elsewhere`` gives the path of tables that belong to another lake.
    """

    spark: SparkSession
    root: str
    fmt: str = LAKE_FORMAT
    elsewhere: Mapping[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return self.elsewhere.get(table, f"{self.root}/{table}")

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/_streams/{table}"

    def has(self, table: str) -> bool:
        return table_exists(self.spark, self.path(table), self.fmt)

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), _SCHEMAS[table], self.fmt)

    def stream(self, table: str, max_files: int | None = None) -> DataFrame:
        return stream_table(self.spark, self.path(table), _SCHEMAS[table], self.fmt, max_files)

    def gold(self) -> dict[str, DataFrame]:
        """Gold tables under the names of the staging tables they feed."""
        return {staging.STG_ZONE: self.read(ZONE), staging.STG_ROAD: self.read(ROAD),
                staging.STG_FACT: self.read(FACT)}

    def staging(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in staging.CONTRACTS}

    def marts(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in (warehouse.LOCATIONS, warehouse.EVENTS)}
