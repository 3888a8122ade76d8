"""Warehouse marts on the staging tables, and the compatibility views over the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux import schemas
from wayflux.functions import surrogate_key
from wayflux.operators import Link, enrich
from wayflux.plans.staging import STG_FACT, STG_ROAD, STG_ZONE

LOCATIONS, EVENTS = "dim_locations", "fct_traffic_events"


def _location_key():
    return surrogate_key(F.col("city_zone"), F.col("road_id")).alias("location_id")


def dim_locations(staging: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (zone, road) pair that occurs in the fact, with the attributes of both."""
    pairs = staging[STG_FACT].select("city_zone", "road_id").distinct()
    located = enrich(pairs, [Link(staging[STG_ZONE], "city_zone"),
                             Link(staging[STG_ROAD], "road_id")])
    keyed = located.select(_location_key(), *located.columns)
    return keyed.select(*schemas.DIM_LOCATIONS.names)


def fct_traffic_events(staging: Mapping[str, DataFrame]) -> DataFrame:
    """The staged fact with the event key and the key of its location.  Narrow, no shuffle."""
    event_key = surrogate_key(F.col("vehicle_id"), F.col("event_ts")).alias("event_id")
    return staging[STG_FACT].select(event_key, _location_key(), *schemas.STAGED_FACT.names)


def marts(staging: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {LOCATIONS: dim_locations(staging), EVENTS: fct_traffic_events(staging)}


def fact_view(events: DataFrame) -> DataFrame:
    """The fact as it was before the keys were added."""
    return events.select(*schemas.STAGED_FACT.names)


def zone_view(locations: DataFrame) -> DataFrame:
    return locations.select(*schemas.DIM_ZONE.names).distinct()


def road_view(locations: DataFrame) -> DataFrame:
    return locations.select(*schemas.DIM_ROAD.names).distinct()
