"""Publication: gold to staging, staging to marts, and the chain over all layers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wayflux import schemas
from wayflux.lake import (
    BRONZE, CHECK_HISTORY, FACT, LOAD_HISTORY, PARTITIONS, ROAD, SILVER, ZONE, Lake)
from wayflux.plans import contracts, rollups, staging, warehouse
from wayflux.sinks import (
    Load, append_table, drop_days, load_table, overwrite_table, row_counts, write_jdbc)
from wayflux.sinks.tables import with_trigger
from wayflux.streaming import start_bronze, start_gold, start_silver

#: Stores a staging table under its name and tells how many rows it loaded.
StagingWriter = Callable[[str, DataFrame], int]
#: Tables that follow the days of the fact.
_DAILY = (staging.STG_FACT, warehouse.EVENTS, rollups.TRAFFIC_DAILY, contracts.CHECK_PARTS)


def _load(lake: Lake, name: str, df: DataFrame, touched_only: bool = False,
          rebalance: bool = False) -> Load:
    return load_table(df, lake.path(name), PARTITIONS.get(name, ()), lake.fmt, touched_only, rebalance)


def lake_writer(lake: Lake) -> StagingWriter:
    """Staging as stored tables of the lake."""
    return lambda name, df: _load(lake, name, df).rows


def jdbc_writer(url: str, schema: str, connections: int = 8, **properties: str) -> StagingWriter:
    """Staging as tables of a warehouse database."""
    return lambda name, df: write_jdbc(df, url, f"{schema}.{name}", connections, **properties)


def load_staging(gold: Mapping[str, DataFrame], write: StagingWriter) -> dict[str, int]:
    """Check the constraints of every table, then replace them one by one; rows loaded by table.

    A violation leaves all staging tables as they were.  A crash between two of them leaves some new
    and some old; with Parquet a reader can also meet the moment in which one is replaced.
    """
    tables = staging.staged(gold)
    staging.check_not_null(tables)
    return {name: write(name, df) for name, df in tables.items()}


def build_marts(lake: Lake, tables: Mapping[str, DataFrame] | None = None,
                models=contracts.CONTRACTS) -> dict[str, int]:
    """Materialise the marts from staging (of the lake unless given), then what is kept of each of their
    days; rows loaded by table.  The fact is laid out by day already, so it is written without a shuffle."""
    loaded = {name: _load(lake, name, _described(name, df)).rows
              for name, df in warehouse.marts(tables or lake.staging()).items()}
    return loaded | build_daily(lake, models)


def build_daily(lake: Lake, models=contracts.CONTRACTS) -> dict[str, int]:
    """The daily rollup and the check parts of the whole events mart."""
    events = lake.read(warehouse.EVENTS)
    rolled = _load(lake, rollups.TRAFFIC_DAILY, rollups.traffic_daily(events), rebalance=True)
    _load(lake, contracts.CHECK_PARTS, contracts.check_parts({warehouse.EVENTS: events}, models), rebalance=True)
    return {rollups.TRAFFIC_DAILY: rolled.rows}


def _described(name: str, df: DataFrame) -> DataFrame:
    return contracts.describe(df, next(c for c in contracts.CONTRACTS if c.name == name))


def publish_days(lake: Lake, days: Sequence[date], models=contracts.CONTRACTS) -> dict[str, int]:
    """Bring staging, marts, rollup and check parts up to date with the gold facts of ``days``; rows
    loaded by table, as the writes count them.

    Only these days are read, checked and replaced, after all of them have passed.  A day without facts
    loses its partition in every table.  The dimensions are small and replaced as a whole; locations are
    read off the rollup.  Repeating it changes nothing.  The first publication loads everything.
    """
    if not all(map(lake.has, (warehouse.LOCATIONS, *_DAILY))):
        return load_staging(lake.gold(), lake_writer(lake)) | build_marts(lake, models=models)
    touched = F.col("date").isin(list(days))
    gold = lake.gold()
    tables = staging.staged({**gold, staging.STG_FACT: gold[staging.STG_FACT].where(touched)})
    staging.check_not_null(tables)
    loads = {name: _load(lake, name, df, touched_only=name == staging.STG_FACT) for name, df in tables.items()}
    stored = lake.staging()
    stored[staging.STG_FACT] = stored[staging.STG_FACT].where(touched)
    events = _described(warehouse.EVENTS, warehouse.fct_traffic_events(stored))
    loads[warehouse.EVENTS] = _load(lake, warehouse.EVENTS, events, touched_only=True)
    mine = lake.read(warehouse.EVENTS).where(touched)
    loads[rollups.TRAFFIC_DAILY] = _load(lake, rollups.TRAFFIC_DAILY, rollups.traffic_daily(mine),
                                         touched_only=True, rebalance=True)
    _load(lake, contracts.CHECK_PARTS, contracts.check_parts({warehouse.EVENTS: mine}, models),
          touched_only=True, rebalance=True)
    gone = sorted(set(days) - loads[staging.STG_FACT].parts)
    for table in _DAILY:
        drop_days(lake.spark, lake.path(table), *PARTITIONS[table], gone, lake.fmt)
    loads[warehouse.LOCATIONS] = _refresh_locations(lake)
    return {name: load.rows for name, load in loads.items()}


def _refresh_locations(lake: Lake) -> Load:
    """Locations of the pairs in the rollup: new ones are appended; where one went or changed its
    attributes, the table is replaced."""
    tables = lake.staging()
    tables[staging.STG_FACT] = lake.read(rollups.TRAFFIC_DAILY)
    found = _described(warehouse.LOCATIONS, warehouse.dim_locations(tables))
    known = lake.read(warehouse.LOCATIONS)
    if not known.exceptAll(found).isEmpty():
        return _load(lake, warehouse.LOCATIONS, found)
    new = found.exceptAll(known)
    return Load(0) if new.isEmpty() else append_table(new, lake.path(warehouse.LOCATIONS), lake.fmt)


# ---- what was loaded and checked, run by run ----------------------------------------------------

def merged_checks(lake: Lake, models=contracts.CONTRACTS) -> DataFrame:
    """The check report from stored parts of days; the events mart is not read."""
    locations = {warehouse.LOCATIONS: lake.read(warehouse.LOCATIONS)}
    return contracts.merged_report(lake.read(contracts.CHECK_PARTS), locations, models)


def log_checks(lake: Lake, run: str, report: DataFrame) -> None:
    """Add a check report to the history.  A run that is logged again replaces its own rows only."""
    rows = report.withColumns({"checked_at": F.current_timestamp(), "run": F.lit(run)})
    _load(lake, CHECK_HISTORY, rows.coalesce(1), touched_only=True)


def log_loads(lake: Lake, run: str, loaded: Mapping[str, int]) -> None:
    """Add the rows that a run loaded to the history, in the same way."""
    rows = lake.spark.createDataFrame(list(loaded.items()), "table STRING, rows BIGINT")
    rows = rows.withColumns({"loaded_at": F.current_timestamp(), "run": F.lit(run)})
    _load(lake, LOAD_HISTORY, rows.coalesce(1), touched_only=True)


def start_publish(lake: Lake, incremental: bool = True, available_now: bool = True,
                  models=contracts.CONTRACTS) -> StreamingQuery:
    """Follow silver behind gold, from a checkpoint of its own, and publish the days of each batch
    (``incremental=False``: everything).  Each batch is a run in the histories of checks and loads,
    named by stream and batch, so a batch that is repeated after a crash counts once."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        here = replace(lake, spark=batch.sparkSession)
        if incremental:
            day = F.col(schemas.EVENT_DATE)
            days = [row[0] for row in batch.where(day.isNotNull()).select(day).distinct().collect()]
            loaded = publish_days(here, days, models) if days else {}
        else:
            loaded = {} if batch.isEmpty() else (
                load_staging(here.gold(), lake_writer(here)) | build_marts(here, models=models))
        if loaded:
            stream = here.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            run = f"{stream}-{batch_id:09d}"
            log_loads(here, run, loaded)
            log_checks(here, run, merged_checks(here, models))

    marks = lake.stream(SILVER).select(schemas.EVENT_DATE)
    writer = (marks.writeStream.outputMode("append").foreachBatch(on_batch)
              .option("checkpointLocation", lake.checkpoint(warehouse.EVENTS)))
    return with_trigger(writer, available_now).start()


class ChecksFailed(RuntimeError):
    """The chain ran through, but what it built breaks its promises."""


@dataclass(frozen=True)
class ChainResult:
    counts: DataFrame
    checks: DataFrame


CHECKS = "check_report"


def run_chain(lake: Lake, log: DataFrame, as_of: Column | None = None,
              incremental: bool = True, stop_on_failure: bool = True) -> ChainResult:
    """Drain the log through every layer and report row counts and data checks.

    Each step resumes from its checkpoint, so the chain can be run again at any time.  The check report
    is merged from the parts of all days, of which only touched ones were computed, and stored in the
    lake; a failed check raises unless ``stop_on_failure`` is off.
    """
    start_bronze(lake, log, available_now=True).awaitTermination()
    start_silver(lake, as_of, available_now=True).awaitTermination()
    start_gold(lake, incremental).awaitTermination()
    start_publish(lake, incremental).awaitTermination()
    marts = lake.marts()
    tables = {name: lake.read(name) for name in (BRONZE, SILVER, ZONE, ROAD, FACT)}
    tables.update(lake.staging())
    tables.update(marts)
    if not lake.has(contracts.CHECK_PARTS):
        build_daily(lake)
    overwrite_table(merged_checks(lake).coalesce(1), lake.path(CHECKS), fmt=lake.fmt)
    report = lake.spark.read.format(lake.fmt).load(lake.path(CHECKS))
    failed = report.where("status = 'fail'").collect() if stop_on_failure else []
    if failed:
        raise ChecksFailed("; ".join(
            f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed))
    return ChainResult(row_counts(tables), report)
