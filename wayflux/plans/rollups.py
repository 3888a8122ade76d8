"""Daily rollups: the events mart as partial sums, from which all reports without single events are read.

A day has at most hours x zones x roads x weathers x bands x peaks rows, however many events it
holds, and depends on nothing but its own events, so a touched day is rolled up again alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wayflux import schemas
from wayflux.operators import roll_up

TRAFFIC_DAILY = "agg_traffic_daily"

_KEYS = ("date", "hour", "city_zone", "road_id", "weather", "speed_band", "peak_flag")


def traffic_daily(events: DataFrame) -> DataFrame:
    """Partial sums of events by day and by everything that a report groups or filters by.

    Members are kept as stored, NULL included; reports fill in their labels.
    """
    rolled = roll_up(events, _KEYS, counted=("vehicle_id",), summed=("speed_int", "congestion_level"))
    return rolled.select(*schemas.TRAFFIC_DAILY.names)
