"""Command line jobs, one per layer, for python or as the main module of a spark-submit.

    python -m wayflux bronze  --lake ROOT --kafka HOST:PORT --topic NAME
    python -m wayflux silver  --lake ROOT
    python -m wayflux gold    --lake ROOT [--rebuild]
    python -m wayflux publish --lake ROOT [--rebuild | --jdbc-url URL --schema NAME]
    python -m wayflux marts   --lake ROOT
    python -m wayflux check   --lake ROOT
    python -m wayflux catalog --lake ROOT --database NAME
    python -m wayflux report  --lake ROOT --name zone_summary
    python -m wayflux chain   --lake ROOT --messages PATH
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux import publish
from wayflux.lake import FACT, LOAD_HISTORY, PARTITIONS, ROAD, SILVER, ZONE, Lake
from wayflux.plans import contracts, reports, rollups, staging, warehouse
from wayflux.session import build_session
from wayflux.sinks import (
    create_bi_views, create_database, create_mart_views, register_table, row_counts)
from wayflux.sources import LAKE_FORMAT, file_log, kafka_log, read_jdbc
from wayflux.streaming import star_of, start_bronze, start_gold, start_silver, switch_star


def _log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.kafka:
        options = dict(option.split("=", 1) for option in args.kafka_option)
        return kafka_log(spark, args.kafka, args.topic, args.starting, **options)
    return file_log(spark, args.messages, args.log_files)


def _views(marts: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    locations = marts[warehouse.LOCATIONS]
    return (warehouse.fact_view(marts[warehouse.EVENTS]), warehouse.zone_view(locations),
            warehouse.road_view(locations))


def _events(report: Callable[[DataFrame], DataFrame]):
    return lambda fact, zones, roads: report(reports.report_events(fact))


def _frame(report: Callable[[DataFrame], DataFrame]):
    return lambda fact, zones, roads: report(reports.report_frame(fact, zones, roads))


REPORTS = {
    "kpi_overview": lambda fact, zones, roads: reports.kpi_overview_of(fact, zones),
    "zone_summary": reports.zone_summary,
    "map_markers": lambda *star: reports.map_markers(reports.zone_summary(*star)),
    "hourly_pulse": _events(reports.hourly_pulse),
    "top_roads": lambda *star: reports.top_roads(reports.road_summary(*star)),
    "weather_impact": _events(reports.weather_impact),
    "speed_mix": _events(reports.speed_mix),
    "feed": _frame(reports.feed),
    "zone_road_matrix": _events(reports.zone_road_matrix),
    "zone_road_heatmap": lambda fact, zones, roads: reports.zone_road_heatmap(
        reports.zone_road_matrix(reports.report_events(fact)), reports.road_names(roads)),
    "filter_options": _events(reports.filter_options),
}

#: These show single events.
EVENT_REPORTS = {"feed"}


# Reports on one zone, the first one unless --zone names another.
def _zone_events(report: Callable[[DataFrame], DataFrame]):
    return lambda fact, roads: report(reports.report_events(fact))


ZONE_REPORTS = {
    "zone_kpis": _zone_events(reports.zone_kpis),
    "zone_road_mix": reports.zone_road_mix_of,
    "zone_weather_mix": _zone_events(reports.zone_weather_mix),
    "zone_hourly": _zone_events(reports.zone_hourly),
    "road_leaderboard": lambda *star: reports.road_leaderboard(reports.zone_road_mix_of(*star)),
}


def _selection(args: argparse.Namespace) -> reports.Selection:
    return reports.Selection((args.date_from, args.date_to), args.zones, args.roads, args.weather,
                             args.peak)


def run_report(lake: Lake, name: str, selection: reports.Selection = reports.Selection(),
               zone: str | None = None, marts: dict[str, DataFrame] | None = None) -> DataFrame:
    """A report by name over the marts of a lake, or over those given.

    Reports that show no single event read the daily rollup of the lake where it has one.
    """
    whole, zones, roads = _views(marts or lake.marts())
    if marts is None and name not in EVENT_REPORTS and lake.has(rollups.TRAFFIC_DAILY):
        whole = lake.read(rollups.TRAFFIC_DAILY)
    fact = reports.select_events(whole, selection)
    if name in REPORTS:
        return REPORTS[name](fact, zones, roads)
    # The zones of the dimension are those of the whole fact, so only a filter needs a scan for them.
    zone = zone or reports.default_zone(zones if selection == reports.Selection() else fact)
    return ZONE_REPORTS[name](reports.focus(fact, zone), roads)


def _show(df: DataFrame, args: argparse.Namespace) -> None:
    """All rows to a table with --out; else the first ones, saying so when there are more."""
    if args.out:
        df.write.format(args.format).mode("overwrite").save(args.out)
        return
    df.limit(args.rows).show(args.rows, truncate=False)
    if not df.offset(args.rows).isEmpty():
        print(f"only the first {args.rows} rows are shown; use --rows or --out for more")


def _marts(lake: Lake, args: argparse.Namespace) -> dict[str, DataFrame] | None:
    """With --jdbc-url the marts built on staging in the warehouse; else those of the lake."""
    return warehouse.marts(_jdbc_staging(lake, args)) if args.jdbc_url else None


def _jdbc_staging(lake: Lake, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {name: read_jdbc(lake.spark, args.jdbc_url, f"{args.schema}.{name}")
            for name in staging.CONTRACTS}


def _run_bronze(lake: Lake, args: argparse.Namespace) -> None:
    start_bronze(lake, _log(lake.spark, args), args.available_now,
                 args.interval).awaitTermination()


def _run_silver(lake: Lake, args: argparse.Namespace) -> None:
    start_silver(lake, thin=not args.no_thin, max_files=args.max_files,
                 available_now=args.available_now, interval=args.interval,
                 files_per_day=args.files_per_day).awaitTermination()


def _run_gold(lake: Lake, args: argparse.Namespace) -> None:
    """Touched days, or with --rebuild everything; with --switch in new folders that the catalog points to
    when all are written."""
    if args.switch:
        create_database(lake.spark, args.database, lake.path("_catalog"))
        switch_star(lake, args.database, lake.read(SILVER))
        return
    start_gold(lake, incremental=not args.rebuild).awaitTermination()


def _run_publish(lake: Lake, args: argparse.Namespace) -> None:
    """Touched days of staging and marts, from a checkpoint; --rebuild or a warehouse: everything."""
    lake = star_of(lake, args.database) if args.switch else lake
    if args.jdbc_url:
        write = publish.jdbc_writer(args.jdbc_url, args.schema, args.connections)
        _show_loads(publish.load_staging(lake.gold(), write))
    elif args.rebuild:
        _show_loads(publish.load_staging(lake.gold(), publish.lake_writer(lake)) | publish.build_marts(lake))
    else:
        query = publish.start_publish(lake)
        query.awaitTermination()
        if any(progress["numInputRows"] for progress in query.recentProgress):
            runs = lake.read(LOAD_HISTORY).where(F.col("run").startswith(query.id))
            last = runs.agg(F.max("run")).first()[0]
            _show_loads({r["table"]: r["rows"] for r in runs.where(F.col("run") == last).collect()})


def _show_loads(loaded: dict[str, int]) -> None:
    for table, rows in loaded.items():
        print(f"{table}: {rows} rows loaded")


def _run_marts(lake: Lake, args: argparse.Namespace) -> None:
    publish.build_marts(lake, _jdbc_staging(lake, args) if args.jdbc_url else None)


def _run_check(lake: Lake, args: argparse.Namespace) -> None:
    marts = _marts(lake, args) or lake.marts()
    report = contracts.check_report(marts).persist()
    _show(report, args)
    if not report.where("status = 'fail'").isEmpty():
        samples = contracts.failure_samples(marts)
        samples.show(samples.count(), truncate=False)  # a few for each check
        sys.exit(1)


def _run_catalog(lake: Lake, args: argparse.Namespace) -> None:
    spark = lake.spark
    create_database(spark, args.database, lake.path("_catalog"))
    for table in (FACT, ZONE, ROAD):
        register_table(spark, args.database, table, lake.path(table), lake.fmt,
                       table in PARTITIONS)
    create_bi_views(spark, args.database)
    marts = f"{args.database}_marts"
    create_database(spark, marts, lake.path("_catalog_marts"))
    for table in (warehouse.LOCATIONS, warehouse.EVENTS):
        register_table(spark, marts, table, lake.path(table), lake.fmt, table in PARTITIONS)
    create_mart_views(spark, marts)
    row_counts({t: spark.table(f"{args.database}.{t}") for t in (FACT, ZONE, ROAD)}).show()


def _run_report(lake: Lake, args: argparse.Namespace) -> None:
    _show(run_report(lake, args.name, _selection(args), args.zone, _marts(lake, args)), args)


def _run_chain(lake: Lake, args: argparse.Namespace) -> None:
    try:
        result = publish.run_chain(lake, _log(lake.spark, args), incremental=not args.rebuild,
                                   stop_on_failure=not args.keep_going)
    except publish.ChecksFailed as failed:
        print(failed, file=sys.stderr)
        sys.exit(1)
    result.counts.show(100, truncate=False)  # a row for each table
    _show(result.checks, args)


COMMANDS = {"bronze": _run_bronze, "silver": _run_silver, "gold": _run_gold,
            "publish": _run_publish, "marts": _run_marts, "check": _run_check,
            "catalog": _run_catalog, "report": _run_report, "chain": _run_chain}


def parser() -> argparse.ArgumentParser:
    found = argparse.ArgumentParser(prog="wayflux")
    found.add_argument("command", choices=COMMANDS)
    found.add_argument("--lake", required=True, help="root folder of the tables")
    found.add_argument("--format", default=LAKE_FORMAT, help="parquet, or delta if installed")
    log = found.add_argument_group("message log")
    log.add_argument("--kafka", help="bootstrap servers")
    log.add_argument("--topic", default="traffic-topic")
    log.add_argument("--starting", default="latest")
    log.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE",
                     help="e.g. maxOffsetsPerTrigger=1000000 or kafka.security.protocol=SSL")
    log.add_argument("--messages", help="folder of message files instead of Kafka")
    log.add_argument("--log-files", type=int, help="message files per batch")
    stream = found.add_argument_group("streams")
    stream.add_argument("--available-now", action="store_true", help="drain and stop")
    stream.add_argument("--interval", help="time between batches, e.g. '30 seconds'")
    stream.add_argument("--max-files", type=int, help="files per batch of the silver stream; a backlog "
                        "that is cut makes rows late that one batch would keep")
    stream.add_argument("--files-per-day", type=int, default=8, help="of one day in a silver batch")
    stream.add_argument("--no-thin", action="store_true", help="no dropping of copies before the shuffle")
    stream.add_argument("--shuffle-partitions", type=int, help="fixed by the first start of a stream")
    stream.add_argument("--rocksdb-state", action=argparse.BooleanOptionalAction, default=True)
    stream.add_argument("--rebuild", action="store_true", help="gold, publish, chain: everything, not touched days")
    stream.add_argument("--switch", action="store_true", help="gold: rebuild in new folders and point the "
                        "tables of --database there; publish: read the star from them")
    target = found.add_argument_group("publication")
    target.add_argument("--jdbc-url")
    target.add_argument("--schema", default="analytics")
    target.add_argument("--connections", type=int, default=8)
    target.add_argument("--database", default="mobility")
    shown = found.add_argument_group("results of report, check and chain")
    shown.add_argument("--out", help="write the whole result as a table here")
    shown.add_argument("--rows", type=int, default=100, help="rows shown on the console")
    chain = found.add_argument_group("chain")
    chain.add_argument("--keep-going", action="store_true", help="do not stop on a failed check")
    report = found.add_argument_group("reports")
    report.add_argument("--name", choices=[*REPORTS, *ZONE_REPORTS])
    report.add_argument("--zone", help="zone of a drill-down report")
    report.add_argument("--date-from")
    report.add_argument("--date-to")
    for choice in ("zones", "roads", "weather", "peak"):
        report.add_argument(f"--{choice}", nargs="*", default=[])
    return found


def main(argv: Sequence[str] | None = None) -> None:
    found = parser()
    args = found.parse_args(argv)
    if args.command == "report" and not args.name:
        found.error("report needs --name")
    if args.command in ("bronze", "chain") and not (args.kafka or args.messages):
        found.error(f"{args.command} needs --kafka or --messages")
    if any("=" not in option for option in args.kafka_option):
        found.error("--kafka-option needs NAME=VALUE")
    spark = build_session(f"wayflux-{args.command}", shuffle_partitions=args.shuffle_partitions,
                          rocksdb_state=args.rocksdb_state)
    COMMANDS[args.command](Lake(spark, args.lake.rstrip("/"), args.format), args)


if __name__ == "__main__":
    main()
