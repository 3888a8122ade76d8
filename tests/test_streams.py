"""Streaming layers with chosen files per batch."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bronze_rows, envelope, event, files, physical_plan, ts, values
from wayflux import schemas
from wayflux.lake import BRONZE, FACT, ROAD, SILVER, ZONE, Lake
from wayflux.operators import dedup_stream
from wayflux.plans import gold, silver
from wayflux.session import STATE_STORE_SETTINGS
from wayflux.sinks import Load, append_stream, append_table, create_bi_views, create_database
from wayflux.sources import file_log, stream_table
from wayflux.streaming import (
    jobs, refresh_star, rewrite_star, star_of, start_bronze, start_gold, start_silver, switch_star)

KEY = ["vehicle_id", "event_ts"]


def as_of():
    return F.lit("2024-01-25 00:00:00").cast("timestamp")


def deliver(lake, rows):
    """One more file of bronze."""
    append_table(bronze_rows(lake.spark, rows).coalesce(1), lake.path(BRONZE))


def drain_silver(lake, **options):
    start_silver(lake, as_of(), available_now=True, **options).awaitTermination()
    return lake.read(SILVER)


def test_bronze_stream_keeps_everything_once(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    payloads = [event("V1"), event("V2", speed=85), "###CORRUPTED_EVENT###",
                '{"raw": "###CORRUPTED_EVENT###"}', {**event("V3"), "road_condition": "BAD"}]
    append_table(envelope(spark, payloads), log)
    start_bronze(lake, file_log(spark, log), available_now=True).awaitTermination()
    assert lake.read(BRONZE).count() == 5
    append_table(envelope(spark, [event("V4")]), log)
    start_bronze(lake, file_log(spark, log), available_now=True).awaitTermination()
    found = lake.read(BRONZE)
    assert found.count() == 6 and found.where("vehicle_id is null").count() == 2
    assert found.where("vehicle_id = 'V2'").first().speed == "85"
    assert found.where("raw_json like '%road_condition%'").count() == 1


@pytest.mark.parametrize("thin", [True, False])
def test_silver_stream_equals_batch(spark, lake, thin):
    rows = [event(f"V{i % 7}", f"2024-01-0{1 + i % 3} 1{i % 10}:00:00", speed=str(i * 9))
            for i in range(60)] + [event("V1", speed="FAST"), event(None), event("V9", at="soon"),
                                   event("V8", at="2024-02-01 00:00:00"),
                                   event("V7", raw_json="CORRUPTED")]
    deliver(lake, rows + rows)
    got = drain_silver(lake, thin=thin)
    batch = silver.silver(lake.read(BRONZE), as_of())
    assert values(got, *KEY) == values(batch, *KEY)
    assert got.drop(schemas.EVENT_DATE).columns == schemas.SILVER.names


def test_files_of_a_day_are_bounded_in_a_batch(spark, lake):
    hot = [event(f"V{i}", f"2024-01-01 {i % 24:02d}:00:00") for i in range(400)]
    deliver(lake, hot + [event(f"V{i}", f"2024-01-{2 + i % 20:02d} 01:00:00") for i in range(40)])
    got = drain_silver(lake, files_per_day=2)
    assert got.count() == 440
    for day in range(1, 22):
        found = files(got.where(f"event_date = '2024-01-{day:02d}'"))
        assert 1 <= len(found) <= 2
        assert day > 1 or len(found) == 2


def test_stream_resumes_without_repeats(spark, lake):
    deliver(lake, [event("V1"), event("V2")])
    assert drain_silver(lake).count() == 2
    assert drain_silver(lake).count() == 2
    deliver(lake, [event("V1"), event("V3")])
    assert values(drain_silver(lake), "vehicle_id") == [("V1",), ("V2",), ("V3",)]


def test_thinning_can_change_between_runs(spark, lake):
    deliver(lake, [event("V1")] * 3)
    drain_silver(lake, thin=True)
    deliver(lake, [event("V1"), event("V2"), event("V2")])
    drain_silver(lake, thin=False)
    deliver(lake, [event("V2"), event("V3")])
    assert values(drain_silver(lake, thin=True), "vehicle_id") == [("V1",), ("V2",), ("V3",)]


def test_watermark_edge(spark, lake):
    deliver(lake, [event("V1", "2024-01-01 10:00:00")])
    drain_silver(lake)
    deliver(lake, [event("late", "2024-01-01 09:44:59"), event("edge", "2024-01-01 09:45:00"),
                   event("kept", "2024-01-01 09:45:00.000001")])
    assert values(drain_silver(lake), "vehicle_id") == [("V1",), ("kept",)]


def test_bad_rows_do_not_move_the_watermark(spark, lake):
    deliver(lake, [event("V1", "2024-01-01 10:00:00"),
                   event("bad", "2024-01-01 23:00:00", speed="FAST")])
    drain_silver(lake)
    deliver(lake, [event("V2", "2024-01-01 09:50:00")])
    assert values(drain_silver(lake), "vehicle_id") == [("V1",), ("V2",)]


def late_deliveries():
    """Five deliveries an hour apart; every seventh reading comes one delivery late."""
    start = datetime(2024, 1, 1)
    return [(f"V{i % 9}", start + timedelta(minutes=i), i // 60 + (1 if i % 7 == 0 else 0))
            for i in range(300)]


def kept_with_lag(lag):
    """Set oracle: a delivery is judged by the newest reading of deliveries up to N - lag."""
    found, rows = set(), late_deliveries()
    for delivery in range(6):
        seen = [t for _, t, d in rows if d <= delivery - lag]
        limit = max(seen) - timedelta(minutes=15) if seen else datetime.min
        found |= {(v, t) for v, t, d in rows if d == delivery and t > limit}
    return found


@pytest.mark.parametrize("thin", [True, False])
@pytest.mark.parametrize("one_run, lag", [(False, 1), (True, 2)])
def test_late_rows(spark, tmp_path, one_run, lag, thin):
    root, payload = str(tmp_path), "vehicle_id STRING, event_ts TIMESTAMP"
    schema = spark.createDataFrame([], payload).schema
    options = {"max_files": 1} if one_run else {}

    def drain():
        kept = dedup_stream(stream_table(spark, f"{root}/log", schema, **options), KEY,
                            "event_ts", "15 minutes", thin)
        append_stream(kept, f"{root}/kept", f"{root}/checkpoint",
                      available_now=True).awaitTermination()

    for delivery in range(6):
        rows = [(v, t) for v, t, d in late_deliveries() if d == delivery]
        append_table(spark.createDataFrame(rows, payload).coalesce(1), f"{root}/log")
        if not one_run:
            drain()
    if one_run:
        drain()
    got = {(r.vehicle_id, r.event_ts) for r in spark.read.parquet(f"{root}/kept").collect()}
    assert got == kept_with_lag(lag)


def test_rocksdb_state(spark, lake):
    before = {key: spark.conf.get(key, None) for key in STATE_STORE_SETTINGS}
    for key, value in STATE_STORE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        deliver(lake, [event("V1"), event("V1"), event("V2")])
        drain_silver(lake)
        deliver(lake, [event("V2"), event("V3")])
        assert values(drain_silver(lake), "vehicle_id") == [("V1",), ("V2",), ("V3",)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def silver_part(spark, rows):
    return silver.with_event_date(silver.silver(bronze_rows(spark, rows), as_of()))


def store_silver(lake, rows):
    silver_part(lake.spark, rows).write.mode("append").partitionBy(schemas.EVENT_DATE).parquet(
        lake.path(SILVER))


DELIVERIES = [
    [event("V1", "2024-01-01 10:00:00"), event("V2", "2024-01-02 10:00:00")],
    [event("V3", "2024-01-02 11:00:00", city_zone="HARBOUR"),
     event("V2", "2024-01-02 10:00:00")],
    [event("V4", "2024-01-03 11:00:00", road_id="R300", city_zone=None)],
]


def stored_star(lake):
    return [values(lake.read(name)) for name in (ZONE, ROAD, FACT)]


@pytest.mark.parametrize("incremental", [True, False])
def test_gold_follows_silver(spark, lake, incremental):
    for rows in DELIVERIES:
        store_silver(lake, rows)
        start_gold(lake, incremental).awaitTermination()
        expected = gold.star(lake.read(SILVER))
        assert stored_star(lake) == [values(expected.zone), values(expected.road),
                                     values(expected.fact)]
    before = stored_star(lake)
    start_gold(lake, incremental).awaitTermination()
    assert stored_star(lake) == before


def test_refresh_repeated_changes_nothing(spark, lake):
    store_silver(lake, DELIVERIES[0])
    rewrite_star(lake, lake.read(SILVER))
    store_silver(lake, DELIVERIES[1])
    batch = silver_part(spark, DELIVERIES[1])
    refresh_star(lake, lake.read(SILVER), batch)
    once = stored_star(lake)
    refresh_star(lake, lake.read(SILVER), batch)
    assert stored_star(lake) == once
    rebuilt = Lake(spark, lake.root + "-rebuilt", elsewhere={SILVER: lake.path(SILVER)})
    rewrite_star(rebuilt, lake.read(SILVER))
    assert stored_star(rebuilt) == once


def test_refresh_leaves_other_days_alone(spark, lake):
    store_silver(lake, DELIVERIES[0])
    rewrite_star(lake, lake.read(SILVER))
    untouched = files(lake.read(FACT).where("date = '2024-01-01'"))
    store_silver(lake, DELIVERIES[1])
    refresh_star(lake, lake.read(SILVER), silver_part(spark, DELIVERIES[1]))
    assert files(lake.read(FACT).where("date = '2024-01-01'")) == untouched


def test_refresh_reads_the_touched_days_only(spark, lake, monkeypatch):
    for rows in DELIVERIES:
        store_silver(lake, rows)
    rewrite_star(lake, lake.read(SILVER))
    plans = []
    monkeypatch.setattr(jobs, "load_table", lambda df, *args, **kwargs: plans.append(
        physical_plan(df, "formatted")) or Load(1, frozenset([date(2024, 1, 2)])))
    refresh_star(lake, lake.read(SILVER), silver_part(spark, DELIVERIES[1]))
    filters = [line for line in plans[0].splitlines() if "PartitionFilters" in line]
    assert "2024-01-02" in filters[0] and "2024-01-01" not in filters[0]


def test_empty_silver_writes_nothing(spark, lake):
    silver_part(spark, []).write.parquet(lake.path(SILVER))
    start_gold(lake).awaitTermination()
    assert not lake.has(FACT)


def test_kafka_time_is_kept(spark, lake, tmp_path):
    append_table(envelope(spark, [event()], "2024-01-05 06:07:08"), str(tmp_path / "log"))
    start_bronze(lake, file_log(spark, str(tmp_path / "log")),
                 available_now=True).awaitTermination()
    assert lake.read(BRONZE).first().kafka_timestamp == ts("2024-01-05 06:07:08")


def test_a_star_is_switched_as_one(spark, lake, monkeypatch):
    database = "switch_test"
    create_database(spark, database, lake.path("_db"))
    store_silver(lake, DELIVERIES[0])
    switch_star(lake, database, lake.read(SILVER))
    create_bi_views(spark, database)
    names = (ZONE, ROAD, FACT)

    def seen():
        return [values(spark.table(f"{database}.{t}")) for t in names] + [values(spark.table(f"{database}.bi_fact_traffic"))]

    old, places = seen(), star_of(lake, database).elsewhere
    store_silver(lake, DELIVERIES[1])
    kept, written = jobs.overwrite_table, []

    def fails(df, path, *args, **kwargs):
        if FACT in path:
            raise OSError("no space")
        written.append(path)
        kept(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "overwrite_table", fails)
    with pytest.raises(OSError):
        switch_star(lake, database, lake.read(SILVER))
    assert len(written) == 2 and seen() == old and star_of(lake, database).elsewhere == places
    monkeypatch.setattr(jobs, "overwrite_table", kept)
    built = switch_star(lake, database, lake.read(SILVER))
    rewrite_star(lake, lake.read(SILVER))
    wanted = [values(lake.read(t)) for t in names]
    assert seen()[:3] == wanted == [values(star_of(lake, database).read(t)) for t in names] != old[:3]
    assert [values(built.read(t)) for t in names] == wanted
    assert all(Lake(spark, lake.root, elsewhere=places).has(t) for t in names)
    day = spark.table(f"{database}.{FACT}").where("date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(date" in physical_plan(day, "formatted")
