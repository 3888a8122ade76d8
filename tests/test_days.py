"""What is kept of each day: rollups, check parts, histories, counts of loads, days that vanish."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import bronze_rows, event, files, physical_plan, values
from wayflux import __main__ as cli
from wayflux import publish
from wayflux.lake import CHECK_HISTORY, FACT, LOAD_HISTORY, PARTITIONS, ROAD, SILVER, ZONE
from wayflux.operators import average, breakdown, count_of, is_rollup, roll_up, rows, star_breakdown, Link
from wayflux.plans import contracts, reports, rollups, silver, staging, warehouse
from wayflux.sinks import append_table, drop_days, load_table, overwrite_table
from wayflux.streaming import refresh_star, start_gold

DAYS = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
ROWS = [event("V1"), event("V2", "2024-01-02 18:00:00", city_zone="SUBURB", road_id="R300"),
        event("V3", "2024-01-02 19:00:00", weather="HAIL"), event("V4", "2024-01-03 07:00:00", weather="SNOW", speed="10"),
        event("V5", "2024-01-03 07:30:00", weather="HAIL", speed="90", congestion_level=None)]


def deliver(lake, given):
    """More rows of silver, with gold and publication behind them."""
    as_of = F.lit("2024-01-25 00:00:00").cast("timestamp")
    clean = silver.silver(bronze_rows(lake.spark, given), as_of)
    silver.with_event_date(clean).write.mode("append").partitionBy(*PARTITIONS[SILVER]).parquet(lake.path(SILVER))
    start_gold(lake).awaitTermination()
    publish.start_publish(lake).awaitTermination()


def spoil(lake, table, day):
    """Make a day of a table unreadable."""
    for path in Path(f"{lake.path(table)}/date={day}").glob("*.parquet"):
        path.write_bytes(b"nothing that a reader could read")
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def report(df):
    return values(df.select("model", "column_name", "test", "failures", "status"))


# ---- rollups ------------------------------------------------------------------------------------

def test_rollup_answers_what_the_rows_answer(spark):
    frame = spark.createDataFrame(
        [(k % 3 if k % 5 else None, k % 2, k if k % 7 else None, -k) for k in range(200)], "a INT, b INT, x INT, y INT")
    rolled = roll_up(frame, ["a", "b"], counted=["b"], summed=["x", "y"])
    again = rolled.where("b = 0").unionAll(rolled.where("b = 1"))
    measures = [rows("n"), count_of("x", "n_x"), average("x", "mean_x"), average("y", "mean_y", digits=1),
                average("x", "mean_2", digits=1, decimals=2)]
    assert is_rollup(rolled) and not is_rollup(frame)
    for keys in ([], ["a"], ["b"], ["a", "b"]):
        assert values(breakdown(rolled, keys, measures)) == values(breakdown(frame, keys, measures)) \
            == values(breakdown(again, keys, measures))
    dim = spark.createDataFrame([(0, "zero"), (0, "null"), (1, "one"), (None, "none")], "a INT, name STRING")
    for compact in (False, True):
        links = [Link(dim, "a", null_safe=True), Link(dim.toDF("a", "other"), "b", "a", compact=compact)]
        assert values(star_breakdown(rolled, links, ["name", "other"], measures)) == values(
            star_breakdown(frame, links, ["name", "other"], measures))
    assert values(breakdown(rolled.limit(0), [], measures)) == values(breakdown(frame.limit(0), [], measures))


def test_every_report_reads_the_rollup_and_not_the_events(spark, lake):
    deliver(lake, ROWS)
    marts = lake.marts()
    chosen = [reports.Selection(), reports.Selection(zones=["CBD"], weather=["HAIL"]),
              reports.Selection(dates=(DAYS[1], None), peak=["Peak"]), reports.Selection(roads=["R9"])]
    for name in (*cli.REPORTS, *cli.ZONE_REPORTS):
        for selection in chosen:
            got = cli.run_report(lake, name, selection, zone="CBD")
            assert values(got) == values(cli.run_report(lake, name, selection, "CBD", marts)), (name, selection)
            plan = physical_plan(got, "formatted")
            assert (rollups.TRAFFIC_DAILY in plan) == (name not in cli.EVENT_REPORTS), name
            assert (warehouse.EVENTS in plan) == (name in cli.EVENT_REPORTS), name


def test_filters_prune_days_of_the_rollup(spark, lake):
    deliver(lake, ROWS)
    got = cli.run_report(lake, "hourly_pulse", reports.Selection(dates=(DAYS[1], DAYS[1]), zones=["SUBURB"]))
    assert values(got) == [(18, 1)]
    plan = physical_plan(got, "formatted")
    assert re.search(r"PartitionFilters: \[.*date", plan) and re.search(r"PushedFilters: \[.*city_zone", plan)


def test_a_day_has_no_more_rows_than_combinations(spark, lake):
    deliver(lake, [event(f"V{k}", f"2024-01-01 10:{k % 60:02}:{k // 60:02}", city_zone=["CBD", "SUBURB"][k % 2]) for k in range(500)])
    assert values(lake.read(rollups.TRAFFIC_DAILY), "city_zone", "rows_n") == [("CBD", 250), ("SUBURB", 250)]


# ---- checks by day ------------------------------------------------------------------------------

def broken(spark, lake):
    """Marts with every kind of failure, some of them spread over days."""
    deliver(lake, ROWS)
    events = lake.read(warehouse.EVENTS)
    twice = events.unionAll(events.where("vehicle_id in ('V1', 'V4')")).unionAll(events.where("vehicle_id = 'V1'"))
    odd = twice.withColumns({
        "location_id": F.when(F.col("vehicle_id") == "V5", "gone").when(F.col("vehicle_id") != "V3", F.col("location_id")),
        "speed_band": F.when(F.col("vehicle_id") == "V2", "FAST").otherwise(F.col("speed_band")),
        "vehicle_id": F.when(F.col("vehicle_id") != "V4", F.col("vehicle_id"))})
    undated = odd.where("vehicle_id = 'V2'").withColumns({
        "date": F.lit(None).cast("date"), "event_ts": F.lit(None).cast("timestamp_ntz"), "event_id": F.lit("undated")})
    locations = lake.read(warehouse.LOCATIONS)
    return {warehouse.EVENTS: odd.unionByName(undated), warehouse.LOCATIONS: locations.unionAll(locations.limit(1))}


def test_parts_of_days_merge_to_the_report(spark, lake):
    models = broken(spark, lake)
    whole = contracts.check_report(models)
    assert {r.test for r in whole.where("status = 'fail'").collect()} == {"unique", "not_null", "accepted_values", "relationships"}
    parts = contracts.check_parts(models)
    assert report(contracts.merged_report(parts, models)) == report(whole)
    one_by_one = [contracts.check_parts({warehouse.EVENTS: models[warehouse.EVENTS].where(F.col("date").eqNullSafe(F.lit(day)))})
                  for day in (*DAYS, None)]
    joined = one_by_one[0].unionAll(one_by_one[1]).unionAll(one_by_one[2]).unionAll(one_by_one[3])
    assert report(contracts.merged_report(joined, models)) == report(whole)
    fewer = {**models, warehouse.LOCATIONS: models[warehouse.LOCATIONS].where("city_zone = 'CBD'")}
    assert report(contracts.merged_report(parts, fewer)) == report(contracts.check_report(fewer))
    none = {name: df.limit(0) for name, df in models.items()}
    assert report(contracts.merged_report(contracts.check_parts(none), none)) == report(contracts.check_report(none))


def test_parts_hold_no_personal_data(spark, lake):
    models = broken(spark, lake)
    named = tuple(c if c.name != warehouse.EVENTS else contracts.ModelContract(c.name, tuple(
        contracts.ColumnContract(x.name, accepted=("V1",) if x.pii else x.accepted, pii=x.pii, not_null=x.not_null)
        for x in c.columns)) for c in contracts.CONTRACTS)
    parts = contracts.check_parts(models, named)
    assert parts.where("column_name = 'vehicle_id' and test = 'accepted_values'").count() >= 3
    assert not [r for r in parts.collect() if r.value and re.fullmatch("V[0-9]", r.value)]
    assert report(contracts.merged_report(parts, models, named)) == report(contracts.check_report(models, named))


def test_one_touched_day_reads_only_that_day(spark, lake):
    deliver(lake, ROWS)
    for table in (FACT, staging.STG_FACT, warehouse.EVENTS):
        for day in DAYS[:2]:
            spoil(lake, table, day)
    with pytest.raises(Exception):
        contracts.check_report(lake.marts()).collect()
    before = {t: files(lake.read(t).where(F.col("date") < DAYS[2])) for t in (rollups.TRAFFIC_DAILY, contracts.CHECK_PARTS)}
    deliver(lake, [event("V6", "2024-01-03 20:00:00", weather="FROGS")])
    merged = {(r.column_name, r.test): r.failures for r in publish.merged_checks(lake).where("failures > 0").collect()}
    assert merged == {("weather", "accepted_values"): 3, ("congestion_level", "not_null"): 1}
    assert cli.run_report(lake, "kpi_overview").first().events == 6
    for table, old in before.items():
        assert files(lake.read(table).where(F.col("date") < DAYS[2])) == old


# ---- histories ----------------------------------------------------------------------------------

def test_histories_add_runs_and_repeat_none(spark, lake):
    deliver(lake, ROWS[:1])
    deliver(lake, [])
    deliver(lake, ROWS)
    history = lake.read(CHECK_HISTORY)
    runs = sorted(r.run for r in history.select("run").distinct().collect())
    assert len(runs) == 2 and history.count() == 2 * 28
    failures = {r.run: r.failures for r in history.where("column_name = 'weather' and test = 'accepted_values'").collect()}
    assert [failures[r] for r in runs] == [0, 2]
    loads = {(r.run, r.table): r.rows for r in lake.read(LOAD_HISTORY).collect()}
    assert loads[runs[0], warehouse.EVENTS] == 1 and loads[runs[1], staging.STG_FACT] == 5
    assert loads[runs[1], warehouse.LOCATIONS] == 1 and loads[runs[1], rollups.TRAFFIC_DAILY] == 5
    publish.log_checks(lake, runs[1], publish.merged_checks(lake))
    publish.log_loads(lake, runs[1], {warehouse.EVENTS: 5})
    assert lake.read(CHECK_HISTORY).count() == 2 * 28
    assert lake.read(LOAD_HISTORY).where(F.col("run") == runs[1]).count() == 1
    assert sorted(r.run for r in lake.read(LOAD_HISTORY).select("run").distinct().collect()) == runs


def test_a_batch_that_is_repeated_counts_once(spark, lake):
    """The checkpoint forgets the commit of the last batch, as after a crash behind its writes."""
    deliver(lake, ROWS)
    commits = Path(lake.checkpoint(warehouse.EVENTS)) / "commits"
    for path in (commits / "0", commits / ".0.crc"):
        path.unlink()
    publish.start_publish(lake).awaitTermination()
    assert lake.read(CHECK_HISTORY).count() == 28 and lake.read(warehouse.EVENTS).count() == 5
    assert lake.read(LOAD_HISTORY).where("table = 'fct_traffic_events'").count() == 1


def test_loads_count_what_they_wrote(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) date")
    path = str(tmp_path / "t")
    load = load_table(df, path, ["date"], rebalance=True)
    assert load.rows == 1000 and load.parts == set(DAYS)
    load = load_table(df.where("id < 1"), path, ["date"], touched_only=True)
    assert load.rows == 1 and load.parts == {DAYS[0]} and spark.read.parquet(path).count() == 667
    assert load_table(df.limit(0), path, ["date"], touched_only=True).rows == 0
    assert load_table(df, str(tmp_path / "u")).rows == append_table(df, str(tmp_path / "u")).rows == 1000


# ---- days that vanish ---------------------------------------------------------------------------

def test_a_removed_day_leaves_no_rows(spark, lake):
    deliver(lake, ROWS)
    fact = spark.createDataFrame(lake.read(FACT).where(F.col("date") != DAYS[1]).collect(), lake.read(FACT).schema)
    overwrite_table(fact, lake.path(FACT), PARTITIONS[FACT])
    publish.publish_days(lake, DAYS[1:])
    tables = (staging.STG_FACT, warehouse.EVENTS, rollups.TRAFFIC_DAILY, contracts.CHECK_PARTS)
    for table in tables:
        assert {r.date for r in lake.read(table).collect()} == {DAYS[0], DAYS[2]}, table
    kept = {t: values(lake.read(t)) for t in (*tables, warehouse.LOCATIONS)}
    assert len(kept[warehouse.LOCATIONS]) == 1
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    assert {t: values(lake.read(t)) for t in kept} == kept


def test_gold_loses_a_day_without_facts(spark, lake):
    deliver(lake, ROWS)
    refresh_star(lake, lake.read(SILVER).where("vehicle_id <> 'V1'"), lake.read(SILVER))
    assert {r.date for r in lake.read(FACT).collect()} == set(DAYS[1:])
    refresh_star(lake, lake.read(SILVER), lake.read(SILVER))
    assert lake.read(FACT).count() == 5


def test_dropping_days_that_are_not_there_is_no_error(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.sql("select 1 a, date'2024-01-01' date"), path, ["date"])
    drop_days(spark, path, "date", DAYS[1:])
    assert spark.read.parquet(path).count() == 1
    drop_days(spark, path, "date", DAYS)
    assert not list(Path(path).glob("date=*"))


def test_changed_attributes_replace_the_locations(spark, lake):
    deliver(lake, ROWS)
    roads = lake.read(ROAD).withColumn("speed_limit", F.lit(30))
    overwrite_table(spark.createDataFrame(roads.collect(), roads.schema), lake.path(ROAD))
    publish.publish_days(lake, DAYS[:1])
    assert {r.speed_limit for r in lake.read(warehouse.LOCATIONS).collect()} == {30}


# ---- command line -------------------------------------------------------------------------------

def test_publish_command_loads_touched_days(spark, lake, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    deliver(lake, ROWS)
    spoil(lake, FACT, DAYS[0])
    as_of = F.lit("2024-01-25 00:00:00").cast("timestamp")
    more = silver.silver(bronze_rows(spark, [event("V9", "2024-01-02 09:00:00")]), as_of)
    silver.with_event_date(more).write.mode("append").partitionBy(*PARTITIONS[SILVER]).parquet(lake.path(SILVER))
    cli.main(["gold", "--lake", lake.root])
    cli.main(["publish", "--lake", lake.root])
    assert "fct_traffic_events: 3 rows loaded" in capsys.readouterr().out
    cli.main(["publish", "--lake", lake.root])
    assert "loaded" not in capsys.readouterr().out
    spoiled = [lake.read(t).count() for t in (staging.STG_FACT, warehouse.EVENTS)]
    assert spoiled == [6, 6]


def test_publish_rebuild_loads_everything(spark, lake, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    deliver(lake, ROWS)
    cli.main(["publish", "--lake", lake.root, "--rebuild"])
    out = capsys.readouterr().out
    assert "stg_fact_traffic: 5 rows loaded" in out and "agg_traffic_daily: 5 rows loaded" in out


def test_heatmap_columns_come_from_the_dimension(spark, lake):
    deliver(lake, ROWS)
    got = cli.run_report(lake, "zone_road_heatmap")
    assert got.columns == ["city_zone", "R100", "R300"]
    assert values(got) == [("CBD", 4, None), ("SUBURB", None, 1)]
    assert reports.road_names(lake.read(ROAD)) == ["R100", "R300"] and lake.has(ZONE)


def test_switched_gold_is_published(spark, lake, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    as_of = F.lit("2024-01-25 00:00:00").cast("timestamp")
    clean = silver.silver(bronze_rows(spark, ROWS), as_of)
    silver.with_event_date(clean).write.partitionBy(*PARTITIONS[SILVER]).parquet(lake.path(SILVER))
    common = ["--lake", lake.root, "--switch", "--database", "cli_switch"]
    cli.main(["gold", *common])
    assert not lake.has(FACT) and spark.table(f"cli_switch.{FACT}").count() == 5
    cli.main(["publish", *common])
    assert "fct_traffic_events: 5 rows loaded" in capsys.readouterr().out
    assert lake.read(warehouse.EVENTS).count() == 5
