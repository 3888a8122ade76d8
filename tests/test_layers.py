"""Bronze, silver, gold and the marts on small inputs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import bronze_rows, envelope, event, physical_plan, ts, values
from wayflux import schemas
from wayflux.domain import MemberRule, SilverRules, StarRules
from wayflux.plans import gold, silver, staging, warehouse
from wayflux.plans.bronze import bronze
from wayflux.sources import read_seed, read_table

AS_OF = "2024-01-25 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def test_parse_keeps_text_and_ignores_unknown_keys(spark):
    drifted = {**event(), "road_condition": "GOOD"}
    rows = bronze(envelope(spark, [drifted])).collect()
    assert rows[0].vehicle_id == "V1" and '"road_condition": "GOOD"' in rows[0].raw_json
    assert rows[0].kafka_timestamp == ts("2024-01-01 00:00:00")
    assert bronze(envelope(spark, [drifted])).columns == schemas.BRONZE.names


@pytest.mark.parametrize("change, speed, level", [
    ({"speed": 85}, "85", 3), ({"speed": 85.5}, "85.5", 3), ({"speed": "FAST"}, "FAST", 3),
    ({"speed": None}, None, 3), ({"congestion_level": 3.5}, "50", None),
    ({"congestion_level": "4"}, "50", None)])
def test_parse_types(spark, change, speed, level):
    row = bronze(envelope(spark, [event(**change)])).first()
    assert (row.speed, row.congestion_level) == (speed, level)


@pytest.mark.parametrize("text", ['{"raw": "###CORRUPTED_EVENT###"}', "no json at all", "", "[1]"])
def test_unreadable_text_gives_null_fields(spark, text):
    row = bronze(envelope(spark, [text])).first()
    assert row.raw_json == text and row.vehicle_id is None and row.event_time is None


def test_flags_first_match_wins(spark):
    marked = '{"note": "CORRUPTED"}'
    rows = bronze_rows(spark, [
        event(vehicle=None, at=None, raw_json=marked), event(at=None, raw_json=marked),
        event(raw_json=marked), event()])
    got = [r.dq_flag for r in silver.judge(rows, as_of()).collect()]
    assert got == ["MISSING_VEHICLE", "MISSING_TIME", "CORRUPTED_JSON", "OK"]


def test_validity_boundaries(spark):
    rows = bronze_rows(spark, [
        event(speed=s, at=at) for s, at in [
            ("0", "2024-01-25 00:10:00"), ("160", "2024-01-25 00:10:00.000001"), ("161", "never"),
            ("-1", None), ("FAST", "2024-01-24"), ("85.5", "2024-01-24T10:00:00+00:00")]])
    got = [(r.speed_valid, r.time_valid) for r in silver.judge(rows, as_of()).collect()]
    assert got == [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)]


def test_silver_contract_and_features(spark):
    rows = bronze_rows(spark, [event("V1", "2024-01-01 17:59:00", speed="29"),
                               event("V2", "2024-01-01 21:00:00", speed="70")])
    out = silver.silver(rows, as_of())
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER]
    assert values(out, "vehicle_id", "hour", "peak_flag", "speed_band", "dq_flag") == [
        ("V1", 17, 1, "LOW", "OK"), ("V2", 21, 0, "HIGH", "OK")]


def test_silver_keeps_first_arrival(spark):
    rows = bronze_rows(spark, [
        event(speed="10", kafka_timestamp=ts("2024-01-01 12:00:00")),
        event(speed="20", kafka_timestamp=ts("2024-01-01 11:00:00")),
        event(speed="FAST", kafka_timestamp=ts("2024-01-01 10:00:00"))])
    assert values(silver.silver(rows, as_of()), "speed_int") == [(20,)]


def test_silver_rules_are_parameters(spark):
    rules = SilverRules(dq_rules=(("NO_ROAD", "road_id IS NULL"),), speed_range=(0, 40),
                        speed_bands=((20, "SLOW"),), top_band="FAST")
    rows = bronze_rows(spark, [event("V1", road_id=None), event("V2"), event("V3", speed="25")])
    assert values(silver.silver(rows, as_of(), rules), "vehicle_id", "speed_band") == [
        ("V3", "FAST")]


def silver_table(spark, rows):
    return silver.silver(bronze_rows(spark, rows), as_of())


def test_star(spark):
    table = silver_table(spark, [
        event("V1"), event("V2", city_zone="HARBOUR", road_id="R300"),
        event("V3", city_zone=None, road_id=None)])
    star = gold.star(table)
    assert values(star.zone) == [("CBD", "Commercial", "HIGH"), ("HARBOUR", "Residential", "LOW")]
    assert values(star.road) == [("R100", "Highway", 100), ("R300", "City Road", 60)]
    assert star.fact.columns == schemas.FACT.names
    assert star.fact.count() == 3 and star.fact.first().date == date(2024, 1, 1)


def test_fact_needs_key_and_drops_copies(spark):
    table = silver_table(spark, [event("V1")])
    blank = table.withColumn("vehicle_id", F.lit(None).cast("string"))
    copy = table.withColumn("weather", F.lit("STORM"))
    fact = gold.fact_traffic(table.union(blank).union(copy))
    assert values(fact, "vehicle_id", "weather") == [("V1", "CLEAR")]


def test_star_rules_are_parameters(spark):
    rules = StarRules(zone={"size": MemberRule({"CBD": 5}, 1)})
    assert values(gold.dim_zone(silver_table(spark, [event()]), rules)) == [("CBD", 5)]


def staging_tables(spark):
    fact = spark.createDataFrame(
        [("V1", "R100", "CBD"), ("V2", "R100", "CBD"), ("V3", "R300", "NOWHERE")],
        "vehicle_id STRING, road_id STRING, city_zone STRING")
    rest = [f for f in schemas.STAGED_FACT if f.name not in fact.columns]
    fact = fact.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])
    fact = fact.withColumn("event_ts", F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"))
    zones = spark.createDataFrame([("CBD", "Commercial", "HIGH")], schemas.DIM_ZONE)
    roads = spark.createDataFrame([("R100", "Highway", 100), ("R300", "City Road", 60)],
                                  schemas.DIM_ROAD)
    return {staging.STG_FACT: fact, staging.STG_ZONE: zones, staging.STG_ROAD: roads}


def test_locations_keep_pairs_without_zone(spark):
    got = values(warehouse.dim_locations(staging_tables(spark)), "city_zone", "zone_type",
                 "road_id", "speed_limit")
    assert got == [("CBD", "Commercial", "R100", 100), ("NOWHERE", None, "R300", 60)]


def test_marts_and_views_keep_the_contracts(spark):
    marts = warehouse.marts(staging_tables(spark))
    assert marts[warehouse.EVENTS].columns == schemas.FCT_EVENTS.names
    assert marts[warehouse.LOCATIONS].columns == schemas.DIM_LOCATIONS.names
    assert warehouse.fact_view(marts[warehouse.EVENTS]).columns == schemas.STAGED_FACT.names
    assert warehouse.zone_view(marts[warehouse.LOCATIONS]).count() == 2
    assert warehouse.road_view(marts[warehouse.LOCATIONS]).count() == 2
    assert "Exchange" not in physical_plan(marts[warehouse.EVENTS])


def test_seeds_are_typed_by_the_contract(spark, tmp_path):
    (tmp_path / "fact.csv").write_text(
        ",".join(schemas.STAGED_FACT.names) + "\n"
        "1,R100,CBD,85,4,2024-01-01 08:00:00,1,HIGH,8,CLEAR,2024-01-01\n"
        "2,R200,SUBURB,,1,2024-01-01 14:00:00.5,0,LOW,14,,2024-01-01\n")
    seed = read_seed(spark, str(tmp_path / "fact.csv"), schemas.STAGED_FACT)
    first, second = sorted(seed.collect(), key=lambda r: r.vehicle_id)
    assert (first.vehicle_id, first.speed_int, first.date) == ("1", 85, date(2024, 1, 1))
    assert second.speed_int is None and second.event_ts == ts("2024-01-01 14:00:00.500000")


def test_missing_table_fails_at_once(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "nothing"), schemas.FACT)
