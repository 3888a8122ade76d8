"""Report queries over the warehouse views."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux import domain, schemas
from wayflux.functions import clip, first_match, whole_number
from wayflux.operators import (
    Link, average, breakdown, count_of, enrich, is_rollup, rows, rows_where, share, star_breakdown)
from wayflux.sources import literal_table

# Traffic count and the two means, as every breakdown shows them.
_TRAFFIC = (count_of("vehicle_id"), average("speed_int", "avg_speed"),
            average("congestion_level", "avg_congestion"))
_TRAFFIC_1DP = (count_of("vehicle_id"), average("speed_int", "avg_speed", digits=1),
                average("congestion_level", "avg_congestion", digits=1))

# The columns that readers of the zone summary and of the feed rely on.
_ZONE_KEYS = ("city_zone", "zone_type", "traffic_risk", "lat", "lon")
_FEED = ("event_ts", "vehicle_id", "city_zone", "road_id", "road_type", "speed_int",
         "congestion_level", "weather", "traffic_risk", "peak_label")
_DEGREE_DECIMALS = 6
_NUMBERS = ("hour", "peak_flag")
_KPIS = (rows(), average("speed_int", "avg_speed"), average("congestion_level", "avg_congestion"))
_MEASURES = ("speed_int", "congestion_level")


# ---- report frame -------------------------------------------------------------------------------

def zone_positions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, domain.ZONE_POSITIONS, schemas.ZONE_POSITION)


def report_events(fact: DataFrame) -> DataFrame:
    """Fact with report types (zoned timestamp, plain numbers, no NULL peak flag) and labels.

    Enough for every report that shows no dimension attribute, without any join.  The fact may be its
    daily rollup, which has the same keys and no single event.
    """
    columns = {name: _number(fact, name) for name in _NUMBERS}
    columns["peak_flag"] = F.coalesce(columns["peak_flag"], F.lit(0))
    if not is_rollup(fact):
        columns |= {name: _number(fact, name, "double") for name in _MEASURES}
        columns["event_ts"] = F.col("event_ts").try_cast("timestamp")
    columns["date"] = F.col("date").try_cast("date")
    columns["speed_band"] = F.coalesce("speed_band", F.lit(domain.UNKNOWN))
    columns["weather"] = F.coalesce("weather", F.lit(domain.UNKNOWN))
    columns["peak_label"] = peak_label(columns["peak_flag"])
    return fact.withColumns(columns)


def _number(fact: DataFrame, name: str, fractional: str = "int") -> Column:
    """INT where the column is stored as whole numbers; measures keep a fraction that is stored."""
    whole = isinstance(fact.schema[name].dataType, T.IntegralType)
    return F.col(name).try_cast("int") if whole else (
        whole_number(F.col(name)) if fractional == "int" else F.col(name).try_cast(fractional))


def peak_label(peak: Column) -> Column:
    return first_match([(label, peak == value) for value, label in domain.PEAK_LABELS.items()],
                       domain.OTHER_PEAK_LABEL)


def report_links(spark: SparkSession, zones: DataFrame, roads: DataFrame) -> list[Link]:
    """The dimensions of a report; a NULL key meets a NULL member."""
    return [Link(zones, "city_zone", null_safe=True), Link(roads, "road_id", null_safe=True),
            Link(zone_positions(spark), "city_zone", null_safe=True)]


def report_frame(fact: DataFrame, zones: DataFrame, roads: DataFrame) -> DataFrame:
    """Every event with its zone, road and position, missing labels filled."""
    return enrich(report_events(fact), report_links(fact.sparkSession, zones, roads))


# ---- filters ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Selection:
    """What a reader chose; an empty list or a missing date does not restrict.  One date of the two
    leaves the range open on the other side."""

    dates: tuple[date | None, date | None] | None = None
    zones: Sequence[str] = ()
    roads: Sequence[str] = ()
    weather: Sequence[str] = ()
    peak: Sequence[str] = ()


def _weather_in(chosen: Sequence[str]) -> Column:
    stored = F.col("weather").isin(list(chosen))
    return stored | F.col("weather").isNull() if domain.UNKNOWN in chosen else stored


def _peak_in(chosen: Sequence[str]) -> Column:
    flag = F.col("peak_flag")
    known = domain.PEAK_LABELS.items()
    condition = flag.isin([value for value, label in known if label in chosen])
    if domain.PEAK_LABELS[0] in chosen:
        condition = condition | flag.isNull()
    if domain.OTHER_PEAK_LABEL in chosen:
        condition = condition | (flag.isNotNull() & ~flag.isin([value for value, _ in known]))
    return condition


def select_events(fact: DataFrame, selection: Selection) -> DataFrame:
    """The chosen events, judged on the stored columns.

    Labels are filled in later, so each choice is put in terms of what is stored: that way all of
    them reach the scan (days as partitions, the rest as row-group filters).  The result equals
    filtering the report frame.
    """
    first, last = selection.dates or (None, None)
    if first:
        fact = fact.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        fact = fact.where(F.col("date") <= F.lit(last).cast("date"))
    if selection.zones:
        fact = fact.where(F.col("city_zone").isin(list(selection.zones)))
    if selection.roads:
        fact = fact.where(F.col("road_id").isin(list(selection.roads)))
    if selection.weather:
        fact = fact.where(_weather_in(selection.weather))
    if selection.peak:
        fact = fact.where(_peak_in(selection.peak))
    return fact


def filter_options(frame: DataFrame) -> DataFrame:
    """``(column, option)``: the members to choose from, and the first and last date.

    One scan: rows are reduced to their distinct combinations before they are unpivoted, and the
    same aggregation keeps every member but only both ends of the dates.
    """
    members = ["city_zone", "road_id", "weather", "peak_label"]
    seen = frame.select(*members, F.col("date").cast("string").alias("date")).distinct()
    long = seen.unpivot([], [*members, "date"], "column", "option").where(F.col("option").isNotNull())
    member = F.when(F.col("column") != "date", F.col("option"))
    ends = long.groupBy("column", member.alias("member")).agg(
        F.min("option").alias("first"), F.max("option").alias("last"))

    def pair(column: Column, option: str) -> Column:
        return F.struct(column.alias("column"), F.col(option).alias("option"))

    listed = F.when(F.col("column") == "date", F.array(
        pair(F.lit("date_from"), "first"), pair(F.lit("date_to"), "last"))).otherwise(
        F.array(pair(F.col("column"), "first")))
    return ends.select(F.inline(listed))


def default_zone(frame: DataFrame) -> str | None:
    """First zone in sort order, the one an explorer opens with."""
    return frame.agg(F.min("city_zone")).first()[0]


def focus(frame: DataFrame, zone: str) -> DataFrame:
    return frame.where(F.col("city_zone") == zone)


def has_rows(frame: DataFrame) -> bool:
    """Whether a report has anything to show."""
    return not frame.isEmpty()


# ---- overview -----------------------------------------------------------------------------------

def _share_of(condition: Column) -> Column:
    """Percentage of all rows; a NULL condition counts as not met."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100


def kpi_overview(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count(F.lit(1)).alias("events"),
        F.avg("speed_int").alias("avg_speed"),
        F.avg("congestion_level").alias("avg_congestion"),
        _share_of(F.col("peak_flag") == 1).alias("peak_share"),
        _share_of(F.col("traffic_risk") == "HIGH").alias("high_risk_share"))


def kpi_overview_of(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """The same figures from the star: partial sums by zone are joined, not events."""
    events, rolled = report_events(fact), is_rollup(fact)
    parts = events.groupBy("city_zone").agg(
        *[c for m in _KPIS for c in m.partials(rolled)], rows_where(events, F.lit(True)).alias("n"),
        rows_where(events, F.col("peak_flag") == 1).alias("peak"))
    parts = enrich(parts, [Link(zones, "city_zone", null_safe=True)])
    total = F.sum("n").cast("double")

    def part(n: Column) -> Column:
        return F.try_divide(F.sum(n), total) * 100

    return parts.agg(
        *[m.final() for m in _KPIS], part(F.col("peak")).alias("peak_share"),
        part(F.when(F.col("traffic_risk") == "HIGH", F.col("n")).otherwise(0)).alias("high_risk_share"))


def _busiest_first(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("events"), *[F.asc_nulls_last(t) for t in ties])


def zone_summary(fact: DataFrame, zones: DataFrame, roads: DataFrame) -> DataFrame:
    """Zones with position, busiest first.  Aggregated before the dimensions are joined."""
    links = report_links(fact.sparkSession, zones, roads)
    links = [link for link in links if link.fact_key == "city_zone"]
    found = star_breakdown(report_events(fact), links, _ZONE_KEYS, _TRAFFIC_1DP)
    return _busiest_first(found, "city_zone")


def map_markers(zone_rows: DataFrame) -> DataFrame:
    """Radius and colour of each zone on the map."""
    level = F.coalesce("avg_congestion", F.lit(0.0))
    slope, low, high = domain.MARKER_RED
    top, drop, least, most = domain.MARKER_GREEN
    return zone_rows.withColumns({
        "radius": F.greatest(F.coalesce("events", F.lit(0)), F.lit(1)) * domain.MARKER_RADIUS,
        "red": clip(level * slope, float(low), float(high)),
        "green": clip(top - level * drop, float(least), float(most)),
        "blue": F.lit(domain.MARKER_BLUE),
    })


def map_centre(zone_rows: DataFrame) -> DataFrame:
    """Mean position over zones, whatever their traffic."""
    return zone_rows.agg(average("lat", "latitude", decimals=_DEGREE_DECIMALS).direct(),
                         average("lon", "longitude", decimals=_DEGREE_DECIMALS).direct())


def hourly_pulse(frame: DataFrame) -> DataFrame:
    return breakdown(frame, ["hour"], [rows()]).orderBy(F.asc_nulls_last("hour"))


def road_summary(fact: DataFrame, zones: DataFrame, roads: DataFrame) -> DataFrame:
    """Roads, busiest first.  Aggregated before the dimension is joined."""
    links = report_links(fact.sparkSession, zones, roads)
    links = [link for link in links if link.fact_key == "road_id"]
    found = star_breakdown(report_events(fact), links, ("road_id", "road_type"), _TRAFFIC_1DP)
    return _busiest_first(found, "road_id", "road_type")


def top_roads(road_rows: DataFrame, count: int = 10) -> DataFrame:
    return road_rows.limit(count)


def weather_impact(frame: DataFrame) -> DataFrame:
    return _busiest_first(breakdown(frame, ["weather"], _TRAFFIC), "weather")


def speed_mix(frame: DataFrame) -> DataFrame:
    """Speed bands with their part of all events.  Bands are few by definition."""
    counted = breakdown(frame, ["speed_band"], [rows()])
    return _busiest_first(share(counted, "events", "share"), "speed_band")


def feed(frame: DataFrame, limit: int | None = None) -> DataFrame:
    """Events, newest first.  With a limit only the top rows are kept while sorting."""
    newest = frame.orderBy(F.desc_nulls_last("event_ts"), F.asc_nulls_last("vehicle_id"))
    newest = newest.select(*_FEED)
    return newest.limit(limit) if limit else newest


# ---- zone and road explorer ---------------------------------------------------------------------

def zone_kpis(zone_frame: DataFrame) -> DataFrame:
    return breakdown(zone_frame, [], _KPIS)


def zone_road_mix(zone_frame: DataFrame) -> DataFrame:
    mix = breakdown(zone_frame, ["road_id", "road_type"], _TRAFFIC)
    return _busiest_first(mix, "road_id", "road_type")


def zone_road_mix_of(zone_fact: DataFrame, roads: DataFrame) -> DataFrame:
    """The same from the fact of one zone; roads are joined to partial sums."""
    link = Link(roads, "road_id", null_safe=True)
    mix = star_breakdown(report_events(zone_fact), [link], ("road_id", "road_type"), _TRAFFIC)
    return _busiest_first(mix, "road_id", "road_type")


def zone_weather_mix(zone_frame: DataFrame) -> DataFrame:
    return weather_impact(zone_frame)


def zone_hourly(zone_frame: DataFrame) -> DataFrame:
    return hourly_pulse(zone_frame)


def zone_road_matrix(frame: DataFrame) -> DataFrame:
    """Events per zone and road in long form."""
    return breakdown(frame, ["city_zone", "road_id"], [rows()])


def road_names(roads: DataFrame) -> list[str]:
    """Members of the road dimension in order: the columns of a heatmap."""
    return [row[0] for row in roads.select("road_id").where("road_id is not null").distinct()
            .orderBy("road_id").collect()]


def zone_road_heatmap(matrix: DataFrame, roads: Sequence[str]) -> DataFrame:
    """The matrix with one column per listed road; a pair without events is NULL.

    The list comes from the dimension, so the pivot needs no scan of its own to learn its columns.
    """
    return matrix.groupBy("city_zone").pivot("road_id", list(roads)).sum("events")


def road_leaderboard(road_mix: DataFrame) -> DataFrame:
    return road_mix.orderBy(F.desc_nulls_last("events"), F.desc_nulls_last("avg_congestion"),
                            F.asc_nulls_last("road_id"))
