"""Reports on ten events with every gap there can be; expected figures were reckoned by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import physical_plan, values
from wayflux import schemas
from wayflux.plans import reports

# number: vehicle, road, zone, speed, congestion, time, peak flag, band, hour, weather, date
EVENTS = {
    1: ("V1", "R100", "CBD", 10, 1, "2024-01-01 08:00", 0, "LOW", 8, "RAIN", "2024-01-01"),
    2: ("V2", "R100", "CBD", 45, 2, "2024-01-01 18:00", 1, "MEDIUM", 18, None, "2024-01-01"),
    3: (None, "R300", "CBD", 90, 3, "2024-01-02 18:30", 1, "HIGH", 18, "FOG", "2024-01-02"),
    4: ("V3", "R300", "AIRPORT", None, 5, "2024-01-02 09:00", None, None, 9, "RAIN", "2024-01-02"),
    5: ("V4", "R9", "AIRPORT", 50, None, "2024-01-03 10:00", 2, "MEDIUM", None, "RAIN", "2024-01-03"),
    6: ("V5", None, None, 20, 4, "2024-01-03 11:00", 0, "LOW", 11, None, "2024-01-03"),
    7: ("V6", "R100", "HARBOUR", 60, 1, "2024-01-04 12:00", 0, "MEDIUM", 12, "FOG", "2024-01-04"),
    8: ("V7", "R300", "SUBURB", 80, 5, "2024-01-05 20:00", 1, "HIGH", 20, "CLEAR", "2024-01-05"),
    9: ("V8", "R100", "CBD", None, None, "2024-01-05 07:00", 0, None, 7, "CLEAR", None),
    10: ("V9", "R9", "CBD", 30, 2, "2024-01-06 06:00", 0, "MEDIUM", 6, "RAIN", "2024-01-06"),
}
NUMBER = {datetime.fromisoformat(row[5]): n for n, row in EVENTS.items()}


def typed(row):
    return (*row[:5], datetime.fromisoformat(row[5]), *row[6:10],
            row[10] and date.fromisoformat(row[10]))


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    fact = spark.createDataFrame([typed(r) for r in EVENTS.values()], schemas.STAGED_FACT)
    fact.write.partitionBy("date").parquet(f"{root}/fact")
    zones = [("CBD", "Commercial", "HIGH"), ("AIRPORT", "TRANSIT HUB", "HIGH"),
             ("SUBURB", "Residential", "LOW"), (None, None, None)]
    roads = [("R100", "Highway", 100), ("R300", "City Road", 60), (None, None, None)]
    spark.createDataFrame(zones, schemas.DIM_ZONE).write.parquet(f"{root}/zones")
    spark.createDataFrame(roads, schemas.DIM_ROAD).write.parquet(f"{root}/roads")
    return (spark.read.schema(schemas.STAGED_FACT).parquet(f"{root}/fact"),
            spark.read.parquet(f"{root}/zones"), spark.read.parquet(f"{root}/roads"))


@pytest.fixture(scope="module")
def frame(star):
    return reports.report_frame(*star)


def listed(df, *columns):
    """Rows in the order of the report, fractions to six digits."""
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in row)
            for row in (df.select(*columns) if columns else df).collect()]


def numbers(df):
    return sorted(NUMBER[r.event_ts] for r in df.select("event_ts").collect())


def test_frame(frame):
    found = {NUMBER[r.event_ts]: r for r in frame.collect()}
    assert sorted(found) == list(range(1, 11)) and dict(frame.dtypes)["event_ts"] == "timestamp"
    shown = ("zone_type", "traffic_risk", "road_type", "speed_limit", "lat", "lon", "peak_flag",
             "peak_label", "weather", "speed_band")
    assert [tuple(found[n][c] for c in shown) for n in (1, 4, 5, 6, 7)] == [
        ("Commercial", "HIGH", "Highway", 100, 51.5076, -0.1278, 0, "Off-Peak", "RAIN", "LOW"),
        ("TRANSIT HUB", "HIGH", "City Road", 60, 51.47, -0.4543, 0, "Off-Peak", "RAIN", "UNKNOWN"),
        ("TRANSIT HUB", "HIGH", None, None, 51.47, -0.4543, 2, "Unknown", "RAIN", "MEDIUM"),
        (None, None, None, None, None, None, 0, "Off-Peak", "UNKNOWN", "LOW"),
        (None, None, "Highway", 100, None, None, 0, "Off-Peak", "FOG", "MEDIUM")]


def test_numbers_that_are_stored_as_text_or_with_fractions(star):
    fact = star[0].where("vehicle_id = 'V1'").drop("speed_int", "hour", "congestion_level")
    loose = fact.withColumns({"speed_int": F.lit("12.5"), "hour": F.lit("12.5"), "congestion_level": F.lit(2.0)})
    row = reports.report_events(loose).first()
    assert (row.speed_int, row.hour, row.congestion_level) == (12.5, None, 2.0)


def test_kpis(star, frame):
    expected = [(10, 48.125, 2.875, 30.0, 70.0)]
    assert listed(reports.kpi_overview(frame)) == listed(reports.kpi_overview_of(*star[:2])) == expected


ZONES = [("CBD", "Commercial", "HIGH", 51.5076, -0.1278, 4, 43.8, 2.0),
         ("AIRPORT", "TRANSIT HUB", "HIGH", 51.47, -0.4543, 2, 50.0, 5.0),
         ("HARBOUR", None, None, None, None, 1, 60.0, 1.0),
         ("SUBURB", "Residential", "LOW", 51.5484, -0.1982, 1, 80.0, 5.0),
         (None, None, None, None, None, 1, 20.0, 4.0)]


def test_zone_summary_busiest_first(star):
    assert listed(reports.zone_summary(*star)) == ZONES


def test_road_summary_and_top(star):
    roads = [("R100", "Highway", 4, 38.3, 1.3), ("R300", "City Road", 2, 85.0, 4.3),
             ("R9", None, 2, 40.0, 2.0), (None, None, 1, 20.0, 4.0)]
    assert listed(reports.road_summary(*star)) == roads
    top = reports.top_roads(reports.road_summary(*star), 2)
    assert listed(top) == roads[:2] and "TakeOrderedAndProject" in physical_plan(top)


def test_small_breakdowns_in_their_orders(frame):
    assert listed(reports.weather_impact(frame)) == [
        ("RAIN", 4, 30.0, 2.666667), ("CLEAR", 2, 80.0, 5.0), ("UNKNOWN", 2, 32.5, 3.0),
        ("FOG", 1, 75.0, 2.0)]
    assert listed(reports.hourly_pulse(frame)) == [
        (6, 1), (7, 1), (8, 1), (9, 1), (11, 1), (12, 1), (18, 2), (20, 1), (None, 1)]
    assert listed(reports.speed_mix(frame), "speed_band", "events", "share") == [
        ("MEDIUM", 4, 0.4), ("HIGH", 2, 0.2), ("LOW", 2, 0.2), ("UNKNOWN", 2, 0.2)]


def test_matrix_and_heatmap(frame):
    matrix = reports.zone_road_matrix(frame)
    assert set(listed(matrix)) == {
        ("CBD", "R100", 3), ("CBD", "R300", 1), ("CBD", "R9", 1), ("AIRPORT", "R300", 1),
        ("AIRPORT", "R9", 1), (None, None, 1), ("HARBOUR", "R100", 1), ("SUBURB", "R300", 1)}
    wide = reports.zone_road_heatmap(matrix, ["R100", "R300"]).where("city_zone = 'CBD'").first()
    assert (wide.R100, wide.R300) == (3, 1)


def test_markers_and_centre(star):
    zones = reports.zone_summary(*star)
    assert listed(reports.map_markers(zones), "city_zone", "radius", "red", "green", "blue") == [
        ("CBD", 1400, 84.0, 170.0, 105), ("AIRPORT", 700, 210.0, 95.0, 105),
        ("HARBOUR", 350, 42.0, 195.0, 105), ("SUBURB", 350, 210.0, 95.0, 105),
        (None, 350, 168.0, 120.0, 105)]
    assert listed(reports.map_centre(zones)) == [(51.508667, -0.2601)]


def test_focus_zone(star, frame):
    assert reports.default_zone(frame) == reports.default_zone(star[1]) == "AIRPORT"
    part, fact = reports.focus(frame, "AIRPORT"), reports.focus(star[0], "AIRPORT")
    mix = [("R300", "City Road", 1, None, 5.0), ("R9", None, 1, 50.0, None)]
    assert listed(reports.zone_road_mix(part)) == listed(reports.zone_road_mix_of(fact, star[2])) == mix
    assert listed(reports.road_leaderboard(reports.zone_road_mix_of(fact, star[2]))) == mix
    for events in (part, reports.report_events(fact)):
        assert listed(reports.zone_kpis(events)) == [(2, 50.0, 5.0)]
        assert listed(reports.zone_weather_mix(events)) == [("RAIN", 2, 50.0, 5.0)]
        assert listed(reports.zone_hourly(events)) == [(9, 1), (None, 1)]


def test_feed(frame):
    newest = [10, 8, 9, 7, 6, 5, 3, 4, 2, 1]
    assert [NUMBER[r.event_ts] for r in reports.feed(frame).collect()] == newest
    top = reports.feed(frame, limit=7)
    assert [NUMBER[r.event_ts] for r in top.collect()] == newest[:7]
    assert "TakeOrderedAndProject" in physical_plan(top)


WHOLE_CHOICE = reports.Selection(
    dates=(date(2024, 1, 1), date(2024, 1, 6)), zones=["CBD"], weather=["FOG", "UNKNOWN"], peak=["Peak"])


@pytest.mark.parametrize("choice, kept", [
    (reports.Selection(), list(range(1, 11))),
    (reports.Selection(dates=(date(2024, 1, 2), date(2024, 1, 4))), [3, 4, 5, 6, 7]),
    (reports.Selection(dates=(date(2024, 1, 4), None)), [7, 8, 10]),
    (reports.Selection(dates=(None, date(2024, 1, 1))), [1, 2]),
    (reports.Selection(dates=("2024-01-04", None)), [7, 8, 10]),
    (reports.Selection(zones=["CBD", "HARBOUR"], roads=["R100"]), [1, 2, 7, 9]),
    (reports.Selection(weather=["UNKNOWN"]), [2, 6]), (reports.Selection(weather=["RAIN"]), [1, 4, 5, 10]),
    (reports.Selection(peak=["Off-Peak"]), [1, 4, 6, 7, 9, 10]),
    (reports.Selection(peak=["Unknown", "Peak"]), [2, 3, 5, 8]), (WHOLE_CHOICE, [2, 3])])
def test_selection(star, choice, kept):
    assert numbers(reports.select_events(star[0], choice)) == kept


def test_selection_reaches_the_scan(star):
    fact, zones, roads = star
    got = reports.report_frame(reports.select_events(fact, WHOLE_CHOICE), zones, roads)
    plan = physical_plan(got.select("vehicle_id", "traffic_risk"), "formatted")
    scan = [part for part in plan.split("\n\n") if "Scan parquet" in part and "vehicle_id" in part][0]
    lines = {line.split(":")[0]: line for line in scan.splitlines() if ":" in line}
    assert "date" in lines["PartitionFilters"]
    for column in ("city_zone", "weather", "peak_flag"):
        assert column in lines["PushedFilters"]
    assert "speed_int" not in lines["ReadSchema"]


def test_report_joins_are_broadcast(star):
    plan = physical_plan(reports.report_frame(*star))
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    assert "Python" not in plan and "ExistingRDD" not in plan


def test_plans_join_only_what_they_show(star):
    fact, zones, roads = star
    part = reports.focus(fact, "CBD")
    for report in (reports.zone_kpis, reports.zone_weather_mix, reports.zone_hourly):
        assert "Join" not in physical_plan(report(reports.report_events(part)))
    for plan in (physical_plan(reports.kpi_overview_of(fact, zones)),
                 physical_plan(reports.zone_road_mix_of(part, roads))):
        lines = plan.splitlines()
        join = next(k for k, line in enumerate(lines) if "Join" in line)
        assert plan.count("BroadcastHashJoin") == 1
        assert any("HashAggregate" in line for line in lines[join + 1:])  # below, so before the join
    assert physical_plan(reports.filter_options(reports.report_events(fact))).count("FileScan") == 1


def test_filter_options(star):
    assert set(values(reports.filter_options(reports.report_events(star[0])))) == {
        *[("city_zone", z) for z in ("CBD", "AIRPORT", "HARBOUR", "SUBURB")],
        *[("road_id", r) for r in ("R100", "R300", "R9")],
        *[("weather", w) for w in ("RAIN", "UNKNOWN", "FOG", "CLEAR")],
        *[("peak_label", p) for p in ("Peak", "Off-Peak", "Unknown")],
        ("date_from", "2024-01-01"), ("date_to", "2024-01-06")}


def test_empty_input(star):
    fact, zones, roads = star
    nothing = reports.report_frame(fact.where(F.lit(False)), zones, roads)
    assert not reports.has_rows(nothing)
    assert reports.kpi_overview(nothing).first().events == 0
    assert listed(reports.kpi_overview_of(fact.where(F.lit(False)), zones)) == [(0, None, None, None, None)]
    assert reports.zone_summary(fact.where(F.lit(False)), zones, roads).count() == 0
    assert reports.filter_options(nothing).count() == 0
    assert reports.default_zone(nothing) is None
