"""Streaming jobs: each layer follows the one before it from its own checkpoint."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wayflux import schemas
from wayflux.domain import SILVER_RULES, STAR_RULES, MemberRule, SilverRules, StarRules
from wayflux.lake import BRONZE, FACT, PARTITIONS, ROAD, SILVER, ZONE, Lake
from wayflux.plans import bronze as bronze_plan
from wayflux.plans import gold as gold_plan
from wayflux.plans import silver as silver_plan
from wayflux.sinks import (
    append_stream, append_table, drop_days, load_table, overwrite_table, switch_tables, table_location)
from wayflux.sinks.tables import with_trigger

# What the gold layer needs to know about new silver rows.
_BATCH_MARKS = (schemas.EVENT_DATE, "city_zone", "road_id")


def start_bronze(lake: Lake, log: DataFrame, available_now: bool = False,
                 interval: str | None = None) -> StreamingQuery:
    """Follow a message log.  Narrow: nothing is shuffled on the way to the table."""
    return append_stream(bronze_plan.bronze(log), lake.path(BRONZE), lake.checkpoint(BRONZE),
                         fmt=lake.fmt, available_now=available_now, interval=interval)


def start_silver(lake: Lake, as_of: Column | None = None, rules: SilverRules = SILVER_RULES,
                 thin: bool = True, max_files: int | None = None, available_now: bool = False,
                 interval: str | None = None, files_per_day: int = 8) -> StreamingQuery:
    """Follow bronze; stored by day for the layers behind it.

    One shuffle by event key for the deduplication, a second one that gathers the kept rows of a day:
    a batch writes at most ``files_per_day`` files of each day whatever the shuffle width, and a
    day that holds most rows is still shared by that many tasks.
    """
    rows = silver_plan.silver_stream(lake.stream(BRONZE, max_files), as_of, rules, thin)
    rows = silver_plan.with_event_date(rows)
    part = F.pmod(F.xxhash64("vehicle_id", "event_ts"), F.lit(files_per_day))
    return append_stream(rows.repartition(schemas.EVENT_DATE, part), lake.path(SILVER),
                         lake.checkpoint(SILVER), PARTITIONS[SILVER], lake.fmt,
                         available_now, interval)


def rewrite_star(lake: Lake, silver: DataFrame, rules: StarRules = STAR_RULES) -> None:
    """Build all gold tables from a silver snapshot.

    Nothing is cached: the dimensions read one column each, the fact the ten it needs.
    """
    star = gold_plan.star(silver, rules)
    overwrite_table(star.zone, lake.path(ZONE), fmt=lake.fmt)
    overwrite_table(star.road, lake.path(ROAD), fmt=lake.fmt)
    overwrite_table(star.fact, lake.path(FACT), PARTITIONS[FACT], lake.fmt, rebalance=True)


def star_of(lake: Lake, database: str) -> Lake:
    """The lake with its star where the catalog says that it is."""
    found = {t: table_location(lake.spark, database, t) for t in (ZONE, ROAD, FACT)}
    return replace(lake, elsewhere={**lake.elsewhere, **{t: at for t, at in found.items() if at}})


def switch_star(lake: Lake, database: str, silver: DataFrame, rules: StarRules = STAR_RULES) -> Lake:
    """Build all gold tables in new folders, and point the tables of ``database`` there when all three
    are written.  Returns the lake with the new star.

    A build that fails leaves readers of the tables on the old star, whole.  Old folders stay, for those
    who still read them and to go back to.
    """
    version = uuid.uuid4().hex[:12]
    fresh = {t: f"{lake.root}/{t}-{version}" for t in (ZONE, ROAD, FACT)}
    built = replace(lake, elsewhere={**lake.elsewhere, **fresh})
    rewrite_star(built, silver, rules)
    switch_tables(lake.spark, database, fresh, lake.fmt)
    return built


def _add_members(lake: Lake, table: str, batch: DataFrame, member: str,
                 attributes: Mapping[str, MemberRule]) -> None:
    """Append the members a dimension does not have yet; repeating a batch adds nothing."""
    members = gold_plan.member_dimension(batch, member, attributes)
    if not lake.has(table):
        overwrite_table(members, lake.path(table), fmt=lake.fmt)
        return
    members = members.join(lake.read(table).select(member), member, "left_anti")
    if not members.isEmpty():
        append_table(members, lake.path(table), lake.fmt)


def refresh_star(lake: Lake, silver: DataFrame, batch: DataFrame,
                 rules: StarRules = STAR_RULES) -> None:
    """Bring gold up to date with a batch that was appended to silver.

    Copies of a reading share its day, so only the days in the batch can change.  They are built
    again from all of silver for these days and replace them; running a batch twice is harmless.
    A day that has no fact left, as after a rule change, loses its partition.  The batch is read once,
    for its distinct days and members.
    """
    marks = batch.select(*_BATCH_MARKS).distinct().persist()
    day = F.col(schemas.EVENT_DATE)
    # One value per calendar day, so the list is short whatever the batch holds.  As literals the
    # days prune the partitions of silver; a join against them would scan all of it.
    days = [row[0] for row in marks.select(day).where(day.isNotNull()).distinct().collect()]
    touched = silver.where(day.isin(days))
    written = load_table(gold_plan.fact_traffic(touched, rules), lake.path(FACT), PARTITIONS[FACT],
                         lake.fmt, touched_only=True, rebalance=True)
    drop_days(lake.spark, lake.path(FACT), *PARTITIONS[FACT], sorted(set(days) - written.parts), lake.fmt)
    _add_members(lake, ZONE, marks, "city_zone", rules.zone)
    _add_members(lake, ROAD, marks, "road_id", rules.road)
    marks.unpersist()


def start_gold(lake: Lake, incremental: bool = True, rules: StarRules = STAR_RULES,
               available_now: bool = True) -> StreamingQuery:
    """Follow silver; every batch with rows leaves a star that matches all of silver.

    ``incremental=False`` rebuilds the whole star each time, as needed after a rule change.  The
    batch only tells what changed, so no other column of it is read.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        here = replace(lake, spark=batch.sparkSession)
        if incremental:
            refresh_star(here, here.read(SILVER), batch, rules)
        else:
            rewrite_star(here, here.read(SILVER), rules)

    marks = lake.stream(SILVER).select(*_BATCH_MARKS)
    writer = (marks.writeStream.outputMode("append").foreachBatch(on_batch)
              .option("checkpointLocation", lake.checkpoint(FACT)))
    return with_trigger(writer, available_now).start()
