"""Staging loads, marts, catalog, the chain and the command line."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import bronze_rows, envelope, event, files, values
from wayflux import __main__ as cli
from wayflux import publish, schemas, session
from wayflux.lake import BRONZE, FACT, PARTITIONS, ROAD, SILVER, ZONE, Lake
from wayflux.plans import contracts, reports, silver, staging, warehouse
from wayflux.session import pin_zone, shared_folder, work_path
from wayflux.sinks import (
    append_table, create_bi_views, create_database, create_mart_views, overwrite_table,
    register_table, row_counts)
from wayflux.sinks.jdbc import jdbc_options
from wayflux.sources import file_log, literal_table
from wayflux.sources.tables import jdbc_scan_options
from wayflux.streaming import rewrite_star, start_gold


def as_of():
    return F.lit("2024-01-25 00:00:00").cast("timestamp")


ROWS = [event("V1"), event("V2", "2024-01-02 18:00:00", city_zone="SUBURB", road_id="R300"),
        event("V3", "2024-01-02 19:00:00", weather="RAIN")]


def build(lake, rows=ROWS):
    clean = silver.silver(bronze_rows(lake.spark, rows), as_of())
    overwrite_table(silver.with_event_date(clean), lake.path(SILVER), PARTITIONS[SILVER])
    rewrite_star(lake, lake.read(SILVER))
    return lake


def test_normalise_turns_bad_values_into_null(spark):
    loose = spark.createDataFrame(
        [("1", "R100", "CBD", "12", "x", "2024-01-01 08:00:00", "2024-01-01", "extra"),
         ("2", "R100", "CBD", "12.5", "3", "later", "2024-13-01", "extra")],
        "vehicle_id STRING, road_id STRING, city_zone STRING, speed_int STRING,"
        " congestion_level STRING, event_ts STRING, date STRING, other STRING")
    for name in ("peak_flag", "speed_band", "hour", "weather"):
        loose = loose.withColumn(name, F.lit("7"))
    got = staging.normalise(loose, schemas.STAGED_FACT)
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.STAGED_FACT]
    assert values(got, "vehicle_id", "speed_int", "congestion_level", "date") == [
        ("1", 12, None, date(2024, 1, 1)), ("2", None, 3, None)]
    assert got.where("vehicle_id = '2'").first().event_ts is None


def test_load_replaces_rows(spark, lake):
    build(lake)
    for _ in range(2):
        publish.load_staging(lake.gold(), publish.lake_writer(lake))
    assert values(row_counts(lake.staging())) == [
        ("stg_dim_road", 2), ("stg_dim_zone", 2), ("stg_fact_traffic", 3)]


def test_violation_leaves_staging_alone(spark, lake):
    build(lake)
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    broken = lake.gold()
    broken[staging.STG_FACT] = broken[staging.STG_FACT].withColumn(
        "road_id", F.when(F.col("vehicle_id") != "V1", F.col("road_id")))
    with pytest.raises(staging.ConstraintViolation, match="stg_fact_traffic.road_id: 1 NULLs"):
        publish.load_staging(broken, publish.lake_writer(lake))
    assert values(lake.staging()[staging.STG_FACT], "vehicle_id") == [("V1",), ("V2",), ("V3",)]


def test_missing_gold_fails(spark, lake):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish.load_staging(lake.gold(), publish.lake_writer(lake))


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/warehouse", "analytics.stg_dim_zone", 4, user="u")
    assert options == {"url": "jdbc:postgresql://db/warehouse", "dbtable": "analytics.stg_dim_zone",
                       "truncate": "true", "batchsize": "5000", "numPartitions": "4", "user": "u"}


def test_jdbc_scan_options():
    plain = jdbc_scan_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t"}
    split = jdbc_scan_options("jdbc:x", "t", "date", ("2024-01-01", "2024-02-01"), 31)
    assert split["partitionColumn"] == "date" and split["numPartitions"] == "31"


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3).toDF("a"), path)
    overwrite_table(spark.range(2).selectExpr("id b", "'x' c"), path)
    assert spark.read.parquet(path).columns == ["b", "c"] and spark.read.parquet(path).count() == 2


def test_hot_day_is_split_over_files(spark, tmp_path):
    """A day with most of the rows does not end in one task."""
    df = spark.range(0, 400000, 1, 4).selectExpr(
        "id", "sha2(cast(id as string), 256) text",
        "date_add(date'2024-01-01', if(id % 10 = 0, 1, 0)) d")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        overwrite_table(df, str(tmp_path / "t"), ["d"], rebalance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 400000
    assert len(files(stored.where("d = '2024-01-01'"))) >= 4


def test_marts_from_staging(spark, lake):
    build(lake)
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    marts = lake.marts()
    assert values(marts[warehouse.LOCATIONS], "city_zone", "zone_type", "road_id") == [
        ("CBD", "Commercial", "R100"), ("SUBURB", "Residential", "R300")]
    fact = warehouse.fact_view(marts[warehouse.EVENTS])
    assert values(fact) == values(lake.staging()[staging.STG_FACT])


def test_catalog_and_views(spark, lake):
    build(lake)
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    create_database(spark, "bi_test", lake.path("_bi"))
    for name in (FACT, ZONE, ROAD):
        register_table(spark, "bi_test", name, lake.path(name), partitioned=name in PARTITIONS)
        register_table(spark, "bi_test", name, lake.path(name), partitioned=name in PARTITIONS)
    create_bi_views(spark, "bi_test")
    bi = spark.table("bi_test.bi_fact_traffic")
    assert dict(bi.dtypes) == {
        "vehicle_id": "string", "road_id": "string", "city_zone": "string", "speed": "double",
        "congestion_level": "int", "event_time": "timestamp", "peak_flag": "string",
        "speed_band": "string", "weather": "string", "event_date": "date", "event_hour": "int"}
    assert values(bi, "vehicle_id", "speed", "peak_flag") == [
        ("V1", 50.0, "0"), ("V2", 50.0, "1"), ("V3", 50.0, "1")]
    assert spark.table("bi_test.bi_dim_zone").count() == 2
    assert spark.table("bi_test.bi_dim_road").count() == 2
    create_database(spark, "marts_test", lake.path("_marts"))
    for name in (warehouse.LOCATIONS, warehouse.EVENTS):
        register_table(spark, "marts_test", name, lake.path(name), partitioned=name in PARTITIONS)
    create_mart_views(spark, "marts_test")
    assert spark.table("marts_test.fact_traffic").columns == schemas.FACT.names
    assert spark.table("marts_test.fact_traffic").count() == 3
    assert values(spark.table("marts_test.dim_zone")) == values(lake.read(ZONE))
    assert values(spark.table("marts_test.dim_road")) == values(lake.read(ROAD))


def test_chain_runs_and_resumes(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    append_table(envelope(spark, [*ROWS, ROWS[0], "junk", event("V9", speed="FAST")]), log)
    for more, facts in (([], 3), ([event("V5", "2024-01-02 19:30:00", weather="FOG")], 4)):
        if more:
            append_table(envelope(spark, more), log)
        result = publish.run_chain(lake, file_log(spark, log), as_of())
        counts = dict(values(result.counts))
        assert counts[BRONZE] == 6 + len(more)
        assert counts[SILVER] == counts[FACT] == counts[warehouse.EVENTS] == facts
        assert counts[warehouse.LOCATIONS] == 2
        assert result.checks.count() == 28
        assert result.checks.where("status = 'fail'").isEmpty()


def test_reports_by_name(spark, lake):
    build(lake)
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    for name in (*cli.REPORTS, *cli.ZONE_REPORTS):
        assert not cli.run_report(lake, name).isEmpty(), name
    chosen = reports.Selection(zones=["SUBURB"])
    assert cli.run_report(lake, "kpi_overview", chosen).first().events == 1
    assert cli.run_report(lake, "zone_kpis", zone="SUBURB").first().events == 1


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    """Every command in order, on the running session."""
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    log, root = str(tmp_path / "log"), str(tmp_path / "lake")
    append_table(envelope(spark, ROWS), log)
    common = ["--lake", root]
    cli.main(["bronze", *common, "--messages", log, "--available-now"])
    for command in ("silver", "gold", "publish", "marts", "check"):
        cli.main([command, *common, "--available-now"])
    cli.main(["catalog", *common, "--database", "cli_test"])
    cli.main(["report", *common, "--name", "zone_summary", "--zones", "CBD"])
    cli.main(["chain", *common, "--messages", log])
    out = capsys.readouterr().out
    assert "Commercial" in out and "relationships" in out
    assert spark.table("cli_test.bi_fact_traffic").count() == 3
    assert spark.table("cli_test_marts.fact_traffic").count() == 3


def test_literal_table_is_typed_and_small(spark):
    from wayflux import domain
    places = literal_table(spark, domain.ZONE_POSITIONS, schemas.ZONE_POSITION)
    assert values(places) == sorted(domain.ZONE_POSITIONS)
    assert [f.dataType for f in places.schema] == [f.dataType for f in schemas.ZONE_POSITION]


def test_work_paths_follow_the_session(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_path(spark, "x") != work_path(spark, "x")


class FakeSession:
    """A session whose cluster names no shared folder."""

    def __init__(self, master):
        self.master, self.folder, self.conf, self.sparkContext = master, None, self, self

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://somewhere:7077"))


def test_a_local_session_gets_one_folder():
    session = FakeSession("local[2]")
    assert shared_folder(session) == shared_folder(session) != ""


def test_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    assert pin_zone(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_lake_tables_elsewhere(spark, lake):
    build(lake)
    other = Lake(spark, lake.root + "-other", elsewhere={SILVER: lake.path(SILVER)})
    assert other.read(SILVER).count() == 3 and not other.has(FACT)


def deliver(lake, rows):
    """More rows of silver, with gold and publication behind them."""
    clean = silver.silver(bronze_rows(lake.spark, rows), as_of())
    silver.with_event_date(clean).write.mode("append").partitionBy(*PARTITIONS[SILVER]).parquet(lake.path(SILVER))
    start_gold(lake).awaitTermination()
    publish.start_publish(lake).awaitTermination()


def test_publication_rewrites_touched_days_only(spark, lake):
    deliver(lake, ROWS)
    tables = (staging.STG_FACT, warehouse.EVENTS)
    untouched = {t: files(lake.read(t).where("date = '2024-01-01'")) for t in tables}
    deliver(lake, [event("V7", "2024-01-02 08:00:00", city_zone="AIRPORT")])
    for t in tables:
        assert files(lake.read(t).where("date = '2024-01-01'")) == untouched[t] and lake.read(t).count() == 4
    publish.publish_days(lake, [date(2024, 1, 2)])  # repeated
    grown = {name: values(df) for name, df in lake.marts().items()}
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    assert {name: values(df) for name, df in lake.marts().items()} == grown
    assert lake.read(warehouse.LOCATIONS).count() == 3


def test_violation_in_touched_days_replaces_nothing(spark, lake):
    deliver(lake, ROWS)
    deliver_error = [event("V8", "2024-01-03 08:00:00", road_id=None)]
    clean = silver.silver(bronze_rows(spark, deliver_error), as_of())
    silver.with_event_date(clean).write.mode("append").partitionBy(*PARTITIONS[SILVER]).parquet(lake.path(SILVER))
    start_gold(lake).awaitTermination()
    with pytest.raises(staging.ConstraintViolation):
        publish.publish_days(lake, [date(2024, 1, 3)])
    assert lake.read(staging.STG_FACT).count() == lake.read(warehouse.EVENTS).count() == 3


def test_chain_stops_on_a_failed_check(spark, lake, tmp_path, capsys, monkeypatch):
    log = str(tmp_path / "log")
    append_table(envelope(spark, [*ROWS, event("V9", weather="HAIL")]), log)
    with pytest.raises(publish.ChecksFailed, match="fct_traffic_events.weather accepted_values: 1"):
        publish.run_chain(lake, file_log(spark, log), as_of())
    result = publish.run_chain(lake, file_log(spark, log), as_of(), stop_on_failure=False)
    assert result.checks.where("status = 'fail'").count() == 1
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    with pytest.raises(SystemExit) as stopped:
        cli.main(["chain", "--lake", lake.root, "--messages", log])
    assert stopped.value.code == 1 and "HAIL" not in capsys.readouterr().out


def test_results_are_whole_or_said_to_be_partial(spark, lake, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    build(lake, [event(f"V{i}", f"2024-01-0{1 + i % 3} 10:00:00") for i in range(150)])
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    out = str(tmp_path / "feed")
    feed = ["report", "--lake", lake.root, "--name", "feed"]
    cli.main([*feed, "--out", out])
    assert spark.read.parquet(out).count() == 150
    cli.main(feed)
    assert "only the first 100 rows" in capsys.readouterr().out
    cli.main([*feed, "--rows", "150"])
    shown = capsys.readouterr().out
    assert "only the first" not in shown and "V149" in shown
    kpis = ["report", "--lake", lake.root, "--name", "kpi_overview", "--out", out]
    for bound, events in ((["--date-from", "2024-01-02"], 100), (["--date-to", "2024-01-01"], 50)):
        cli.main([*kpis, *bound])
        assert spark.read.parquet(out).first().events == events


@pytest.mark.parametrize("arguments", [
    ["report"], ["bronze"], ["chain"], ["bronze", "--kafka", "h:1", "--kafka-option", "oops"]])
def test_argument_errors(arguments, capsys):
    with pytest.raises(SystemExit) as stopped:
        cli.main([arguments[0], "--lake", "/nowhere", *arguments[1:]])
    assert stopped.value.code == 2


def test_marts_carry_their_flags(spark, lake):
    build(lake)
    publish.load_staging(lake.gold(), publish.lake_writer(lake))
    publish.build_marts(lake)
    register = contracts.stored_register(spark, {c.name: lake.path(c.name) for c in contracts.CONTRACTS})
    assert values(register.where("pii"), "model", "column_name") == [("fct_traffic_events", "vehicle_id")]
    assert values(contracts.model_register(spark), "model", "gdpr_pii") == [
        ("dim_locations", False), ("fct_traffic_events", True)]


def test_cluster_sessions_start_wide_and_keep_state_in_rocksdb(monkeypatch):
    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, name):
            return self

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            return None

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.build_session("x")
    assert "RocksDB" in seen["spark.sql.streaming.stateStore.providerClass"]
    assert int(seen[session.INITIAL_WIDTH_SETTING]) >= 1000
    seen.clear()
    session.build_session("x", "local[2]", rocksdb_state=False)
    assert session.INITIAL_WIDTH_SETTING not in seen and not any("stateStore" in k for k in seen)
