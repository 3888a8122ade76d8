"""Every query by name, bound to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import traffic
from fixtures.layers import Layers, layers
from fixtures.oracle import LATE_FILES
from wayflux import publish, schemas
from wayflux.domain import LATENESS
from wayflux.lake import BRONZE, CHECK_HISTORY, FACT, LOAD_HISTORY, PARTITIONS, ROAD, SILVER, ZONE, Lake
from wayflux.operators import Link, average, count_of, dedup_stream, star_breakdown
from wayflux.plans import contracts, gold, reports, rollups, silver, staging, warehouse
from wayflux.session import pin_zone, work_path
from wayflux.sinks import (
    append_stream, append_table, create_bi_views, create_database, overwrite_table, register_table, row_counts)
from wayflux.sources import file_log, read_seed, stream_table
from wayflux.streaming import ProgressLog, start_bronze, start_gold, start_silver, switch_star

Query = Callable[[SparkSession, str], DataFrame]

SELECTION = reports.Selection(
    dates=(date(2024, 1, 5), date(2024, 1, 20)), zones=["CBD", "AIRPORT", "TECHPARK"],
    roads=["R100", "R300"], weather=["RAIN", "UNKNOWN"], peak=["Off-Peak", "Unknown"])


SINCE = reports.Selection(dates=(date(2024, 1, 12), None))


# ---- layers -------------------------------------------------------------------------------------

def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, work_path(spark, "bronze-stream"))
    log = file_log(spark, layers(spark, sf_dir).messages())
    start_bronze(lake, log, available_now=True).awaitTermination()
    return lake.read(BRONZE)


def dq_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = silver.judge(layers(spark, sf_dir).bronze(), traffic.as_of())
    return judged.groupBy("dq_flag", "speed_valid", "time_valid").agg(
        F.count(F.lit(1)).alias("events"))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(layers(spark, sf_dir).bronze(), traffic.as_of())


def _run_silver(spark: SparkSession, sf_dir: str, thin: bool) -> DataFrame:
    """The silver stream over the stored bronze table, into a lake of its own."""
    here = layers(spark, sf_dir)
    here.bronze()
    lake = Lake(spark, work_path(spark, "silver-stream"),
                elsewhere={BRONZE: here.lake.path(BRONZE)})
    start_silver(lake, traffic.as_of(), thin=thin, available_now=True).awaitTermination()
    return lake.read(SILVER).select(*schemas.SILVER.names)


def silver_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_silver(spark, sf_dir, thin=True)


def silver_stream_unthinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_silver(spark, sf_dir, thin=False)


def _late_deliveries(spark: SparkSession, sf_dir: str, thin: bool = True) -> str:
    """Some rows arrive one delivery late; one run per delivery, all on one checkpoint.  The folder has
    the kept rows, the checkpoint, and what the batches did."""
    pin_zone(spark)
    events = traffic.table(spark, sf_dir, "events")
    total = events.agg((F.max("event_id") + 1).alias("total")).first()["total"]
    readings = events.select(
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        (F.floor(F.col("event_id") * LATE_FILES / total)
         + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)).alias("delivery"))
    root = work_path(spark, "late")
    readings.write.partitionBy("delivery").parquet(f"{root}/deliveries")
    deliveries = spark.read.parquet(f"{root}/deliveries")
    payload = _READING
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        for delivery in range(LATE_FILES + 1):
            arrived = deliveries.where(F.col("delivery") == delivery).drop("delivery")
            append_table(arrived, f"{root}/log")
            kept = dedup_stream(stream_table(spark, f"{root}/log", payload),
                                ["vehicle_id", "event_ts"], "event_ts", LATENESS, thin)
            query = append_stream(kept, f"{root}/kept", f"{root}/checkpoint", available_now=True)
            query.awaitTermination()
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
    return root


_READING = T.StructType([T.StructField("vehicle_id", T.StringType()), T.StructField("event_ts", T.TimestampType())])


def silver_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the deliveries leave."""
    return spark.read.schema(_READING).parquet(f"{_late_deliveries(spark, sf_dir)}/kept")


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, rows dropped as late, state and watermark after each delivery."""
    root = _late_deliveries(spark, sf_dir, thin=False)
    runs = spark.read.schema(schemas.STREAM_PROGRESS).parquet(f"{root}/progress").groupBy("run_id").agg(
        F.min("at").alias("at"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", "batch_id").alias("state_rows"), F.max("watermark").alias("watermark"))
    place = F.row_number().over(Window.orderBy("at"))  # a row for each run
    return runs.select((place - 1).alias("delivery"), "input_rows", "late_rows", "state_rows", "watermark")


def dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the deduplication still holds after the last delivery, read from its state store."""
    root = _late_deliveries(spark, sf_dir)
    return spark.read.format("statestore").load(f"{root}/checkpoint").select("key.vehicle_id", "key.event_ts")


def gold_dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_zone(layers(spark, sf_dir).silver())


def gold_dim_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_road(layers(spark, sf_dir).silver())


def gold_fact_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_traffic(layers(spark, sf_dir).silver())


def gold_stream_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star from the silver table in one batch."""
    here = layers(spark, sf_dir)
    here.silver()
    lake = Lake(spark, work_path(spark, "gold-stream"),
                elsewhere={SILVER: here.lake.path(SILVER)})
    start_gold(lake, incremental=False).awaitTermination()
    return row_counts({name: lake.read(name) for name in (ZONE, ROAD, FACT)})


def gold_stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver arrives in two parts that share their days; gold follows after each."""
    stored = layers(spark, sf_dir).silver()
    lake = Lake(spark, work_path(spark, "gold-stream"))
    early = F.coalesce(F.col("congestion_level") % 2 == 0, F.lit(False))
    for part in (stored.where(early), stored.where(~early)):
        (part.hint("rebalance", schemas.EVENT_DATE).write.mode("append")
         .partitionBy(schemas.EVENT_DATE).parquet(lake.path(SILVER)))
        start_gold(lake, incremental=True).awaitTermination()
    return lake.read(FACT)


def gold_switched_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as readers of the catalog see it after a star of some days gave way to one of all."""
    here = layers(spark, sf_dir)
    stored = here.silver()
    lake = Lake(spark, work_path(spark, "gold-switch"))
    database = f"{here.database}_switch"
    create_database(spark, database, lake.path("_database"))
    for rows in (stored.where(F.dayofmonth(schemas.EVENT_DATE) % 2 == 0), stored):
        switch_star(lake, database, rows)
    return spark.table(f"{database}.{FACT}").select(*schemas.FACT.names)


def gold_rebuild_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a whole rebuild of the star writes it."""
    here = layers(spark, sf_dir)
    here.silver()
    lake = Lake(spark, work_path(spark, "gold-stream"), elsewhere={SILVER: here.lake.path(SILVER)})
    start_gold(lake, incremental=False).awaitTermination()
    return lake.read(FACT)


def _published_twice(spark: SparkSession, sf_dir: str, models=contracts.CONTRACTS) -> Lake:
    """Silver arrives in two parts that share their days, and some days come with the second part
    only; gold and publication follow each."""
    stored = layers(spark, sf_dir).silver()
    lake = Lake(spark, work_path(spark, "publish-stream"))
    early = F.coalesce(F.col("congestion_level") % 2 == 0, F.lit(False)) & (
        F.dayofmonth(schemas.EVENT_DATE) % 5 != 0)
    for part in (stored.where(early), stored.where(~early)):
        (part.hint("rebalance", schemas.EVENT_DATE).write.mode("append")
         .partitionBy(schemas.EVENT_DATE).parquet(lake.path(SILVER)))
        start_gold(lake, incremental=True).awaitTermination()
        publish.start_publish(lake, models=models).awaitTermination()
    return lake


def publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events mart after two publications."""
    return _published_twice(spark, sf_dir).read(warehouse.EVENTS)


def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).rollup()


def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rollup after two publications, of which each rolled up its own days."""
    return _published_twice(spark, sf_dir).read(rollups.TRAFFIC_DAILY)


def _run_number() -> Column:
    return F.dense_rank().over(Window.orderBy("run")).alias("run")  # a few rows for each run


#: The events contract with shorter lists, so that clean marts fail it by numbers that tell runs apart.
STRICT = tuple(replace(c, columns=tuple(
    replace(x, accepted={"weather": ("RAIN",), "speed_band": ("HIGH",)}.get(x.name, x.accepted))
    for x in c.columns)) for c in contracts.CONTRACTS)


def dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks of two publications found, run by run."""
    history = _published_twice(spark, sf_dir, STRICT).read(CHECK_HISTORY)
    return history.select(_run_number(), "model", "column_name", "test", "failures", "status")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that two publications loaded into each table, as their writes counted them."""
    return _published_twice(spark, sf_dir).read(LOAD_HISTORY).select(_run_number(), "table", "rows")


#: After a change of rules a tenth of the days, by their last digit, has no facts any more.
def _published_without_some_days(spark: SparkSession, sf_dir: str) -> Lake:
    here = layers(spark, sf_dir)
    here.gold()
    lake = Lake(spark, work_path(spark, "publish-removed"),
                elsewhere={ZONE: here.lake.path(ZONE), ROAD: here.lake.path(ROAD)})
    fact = here.lake.read(FACT)
    days = [r[0] for r in fact.select("date").distinct().collect()]
    overwrite_table(fact, lake.path(FACT), PARTITIONS[FACT])
    publish.publish_days(lake, days)
    kept = F.dayofmonth("date") % 10 != 4
    overwrite_table(fact.where(kept), lake.path(FACT), PARTITIONS[FACT])
    publish.publish_days(lake, [day for day in days if day.day % 2 == 0])
    return lake


def publish_removed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by day of all tables that follow the days of the fact."""
    lake = _published_without_some_days(spark, sf_dir)
    tables = {name: lake.read(name) for name in (staging.STG_FACT, warehouse.EVENTS)}
    parts = [df.groupBy("date").agg(F.count(F.lit(1)).alias("rows")) for df in tables.values()]
    rolled = lake.read(rollups.TRAFFIC_DAILY).groupBy("date").agg(F.sum("rows_n").alias("rows"))
    checked = lake.read(contracts.CHECK_PARTS).where("test = 'relationships'").groupBy("date").agg(
        F.sum("rows").alias("rows"))
    named = zip((*tables, rollups.TRAFFIC_DAILY, contracts.CHECK_PARTS), (*parts, rolled, checked))
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("table"), "date", "rows") for name, df in named])


def mart_dim_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_locations(layers(spark, sf_dir).staging())


def mart_fct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.fct_traffic_events(layers(spark, sf_dir).staging())


def _view(name: str) -> Query:
    return lambda spark, sf_dir: layers(spark, sf_dir).view(name)


# ---- publication and catalog --------------------------------------------------------------------

def publish_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged(layers(spark, sf_dir).gold())[staging.STG_FACT]


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load staging twice, as a second load must replace the first, and read it back."""
    lake = Lake(spark, work_path(spark, "staging"))
    for _ in range(2):
        publish.load_staging(layers(spark, sf_dir).gold(), publish.lake_writer(lake))
    return row_counts(lake.staging())


def _staging_table(name: str) -> Query:
    """A staging table after two loads."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = Lake(spark, work_path(spark, "staging"))
        for _ in range(2):
            publish.load_staging(layers(spark, sf_dir).gold(), publish.lake_writer(lake))
        return lake.staging()[name]
    return query


def publish_normalise_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers among the values of all events, stored as text and as doubles."""
    value = F.col("value").cast("double")
    value = F.when(F.col("event_id") % 3 == 0, F.floor(value).cast("double")).otherwise(value)
    loose = traffic.table(spark, sf_dir, "events").select(
        "event_id", value.cast("string").alias("as_text"), value.alias("as_double"))
    contract = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("as_text", T.IntegerType()),
                             T.StructField("as_double", T.IntegerType())])
    return staging.normalise(loose, contract)


def _bi_catalog(spark: SparkSession, sf_dir: str) -> str:
    here = layers(spark, sf_dir)
    here.gold()
    database = f"{here.database}_bi"
    create_database(spark, database, here.lake.path("_bi_database"))
    for name in (FACT, ZONE, ROAD):
        register_table(spark, database, name, here.lake.path(name), partitioned=name == FACT)
    create_bi_views(spark, database)
    return database


def _bi_view(name: str) -> Query:
    return lambda spark, sf_dir: spark.table(f"{_bi_catalog(spark, sf_dir)}.{name}")


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _bi_catalog(spark, sf_dir)
    return row_counts({name: spark.table(f"{database}.{name}") for name in (FACT, ZONE, ROAD)})


def seed_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts on staging tables that come as CSV."""
    root = work_path(spark, "seeds")
    for name, df in layers(spark, sf_dir).staging().items():
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        text.write.option("header", True).csv(f"{root}/{name}")
    seeds = {name: read_seed(spark, f"{root}/{name}", contract)
             for name, contract in staging.CONTRACTS.items()}
    return warehouse.fct_traffic_events(seeds)


def full_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, work_path(spark, "chain"))
    log = file_log(spark, layers(spark, sf_dir).messages())
    return publish.run_chain(lake, log, traffic.as_of()).counts


def full_chain_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events mart at the end of the chain."""
    lake = Lake(spark, work_path(spark, "chain"))
    publish.run_chain(lake, file_log(spark, layers(spark, sf_dir).messages()), traffic.as_of())
    return lake.read(warehouse.EVENTS)


def full_chain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check report that the chain stores."""
    lake = Lake(spark, work_path(spark, "chain"))
    return publish.run_chain(lake, file_log(spark, layers(spark, sf_dir).messages()), traffic.as_of()).checks


def mart_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data flags as the stored marts carry them."""
    here = layers(spark, sf_dir)
    here.marts()
    return contracts.stored_register(spark, {c.name: here.lake.path(c.name) for c in contracts.CONTRACTS})


# ---- reports ------------------------------------------------------------------------------------

def _frame(here: Layers, selection: reports.Selection | None = None) -> DataFrame:
    fact, zones, roads = here.star_views()
    if selection:
        fact = reports.select_events(fact, selection)
    return reports.report_frame(fact, zones, roads)


def _on_frame(report: Callable[[DataFrame], DataFrame], gaps: bool = False,
              selection: reports.Selection | None = None) -> Query:
    return lambda spark, sf_dir: report(_frame(layers(spark, sf_dir, gaps), selection))


def _on_events(report: Callable[[DataFrame], DataFrame], gaps: bool = False) -> Query:
    """Reports that need neither single events nor dimension attributes read the rollup alone."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(reports.report_events(layers(spark, sf_dir, gaps).rollup()))
    return query


def _on_star(report: Callable[..., DataFrame], gaps: bool = False) -> Query:
    return lambda spark, sf_dir: report(*layers(spark, sf_dir, gaps).rolled_star())


def _on_focus(report: Callable[[DataFrame, DataFrame], DataFrame], gaps: bool = False) -> Query:
    """A report on the rollup of the default zone, with the road dimension for those that show it."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, zones, roads = layers(spark, sf_dir, gaps).rolled_star()
        return report(reports.focus(fact, reports.default_zone(zones)), roads)
    return query


def _zone_events(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_focus(lambda fact, roads: report(reports.report_events(fact)))


def nation_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nations and priorities with most order lines."""
    return scale_star(spark, sf_dir).orderBy(F.desc("events"), "nation", "priority").limit(10)


def zone_road_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones by roads; the columns are the members of the road dimension."""
    here = layers(spark, sf_dir)
    matrix = reports.zone_road_matrix(reports.report_events(here.rollup()))
    return reports.zone_road_heatmap(matrix, reports.road_names(here.view("dim_road")))


def _whole(frame: DataFrame) -> DataFrame:
    return frame


# ---- data checks --------------------------------------------------------------------------------

def _clean_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return layers(spark, sf_dir).marts()


def _broken_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Marts of the variant with gaps, where one zone lost its locations and a road came twice."""
    models = layers(spark, sf_dir, gaps=True).marts()
    known = models[warehouse.LOCATIONS].where(~F.col("city_zone").eqNullSafe("SUBURB"))
    twice = known.unionAll(known.where(F.col("road_id") == "R100"))
    return {**models, warehouse.LOCATIONS: twice}


def _by_day(broken: bool = False) -> Query:
    """The check report merged from the stored parts of days."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = (_broken_models if broken else _clean_models)(spark, sf_dir)
        parts = layers(spark, sf_dir, gaps=broken).lake.read(contracts.CHECK_PARTS)
        return contracts.merged_report(parts, {warehouse.LOCATIONS: models[warehouse.LOCATIONS]})
    return query


def _on_models(check: Callable[[dict[str, DataFrame]], DataFrame], broken: bool = False) -> Query:
    models = _broken_models if broken else _clean_models
    return lambda spark, sf_dir: check(models(spark, sf_dir))


# ---- the same operators on another star ---------------------------------------------------------

def scale_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by region, nation and priority, over a chain of four dimensions."""
    table = {name: traffic.table(spark, sf_dir, name)
             for name in ("lineitem", "orders", "customer", "nation", "region")}
    links = [
        Link(table["orders"].select("o_orderkey", "o_custkey",
                                    F.col("o_orderpriority").alias("priority")),
             "l_orderkey", "o_orderkey"),
        Link(table["customer"].select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey",
             compact=True),
        Link(table["nation"].select("n_nationkey", "n_regionkey",
                                    F.col("n_name").alias("nation")),
             "c_nationkey", "n_nationkey", compact=True),
        Link(table["region"].select("r_regionkey", F.col("r_name").alias("region")),
             "n_regionkey", "r_regionkey"),
    ]
    measures = [count_of("l_orderkey"),
                average("l_quantity", "avg_quantity", digits=1, decimals=2),
                average("l_extendedprice", "avg_price", digits=1, decimals=2)]
    return star_breakdown(table["lineitem"], links, ["region", "nation", "priority"], measures)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_parse": bronze_parse,
        "dq_flag_counts": dq_flag_counts,
        "silver_clean": silver_clean,
        "silver_stream_dedup": silver_stream_dedup,
        "silver_stream_unthinned": silver_stream_unthinned,
        "silver_stream_late": silver_stream_late,
        "stream_progress": stream_progress,
        "dedup_state": dedup_state,
        "gold_dim_zone": gold_dim_zone,
        "gold_dim_road": gold_dim_road,
        "gold_fact_traffic": gold_fact_traffic,
        "gold_stream_rebuild": gold_stream_rebuild,
        "gold_stream_incremental": gold_stream_incremental,
        "mart_dim_locations": mart_dim_locations,
        "mart_fct_events": mart_fct_events,
        "view_fact": _view("fact_traffic"),
        "view_zone": _view("dim_zone"),
        "view_road": _view("dim_road"),
        "publish_normalise": publish_normalise,
        "publish_roundtrip": publish_roundtrip,
        "bi_fact": _bi_view("bi_fact_traffic"),
        "bi_zone": _bi_view("bi_dim_zone"),
        "bi_road": _bi_view("bi_dim_road"),
        "row_counts": table_counts,
        "report_frame": _on_frame(_whole),
        "report_frame_gaps": _on_frame(_whole, gaps=True),
        "filter_options": _on_events(reports.filter_options),
        "filter_options_gaps": _on_events(reports.filter_options, gaps=True),
        "report_filtered": _on_frame(_whole, selection=SELECTION),
        "report_filtered_gaps": _on_frame(_whole, gaps=True, selection=SELECTION),
        "report_since": _on_frame(_whole, selection=SINCE),
        "kpi_overview": _on_star(lambda fact, zones, roads: reports.kpi_overview_of(fact, zones)),
        "kpi_overview_gaps": _on_star(
            lambda fact, zones, roads: reports.kpi_overview_of(fact, zones), gaps=True),
        "zone_summary": _on_star(reports.zone_summary),
        "zone_summary_gaps": _on_star(reports.zone_summary, gaps=True),
        "map_markers": _on_star(lambda *star: reports.map_markers(reports.zone_summary(*star))),
        "map_centre": _on_star(lambda *star: reports.map_centre(reports.zone_summary(*star))),
        "hourly_pulse": _on_events(reports.hourly_pulse),
        "road_summary": _on_star(reports.road_summary),
        "road_summary_gaps": _on_star(reports.road_summary, gaps=True),
        "road_summary_top10": _on_star(
            lambda *star: reports.top_roads(reports.road_summary(*star))),
        "weather_impact": _on_events(reports.weather_impact),
        "weather_impact_gaps": _on_events(reports.weather_impact, gaps=True),
        "speed_mix": _on_events(reports.speed_mix),
        "feed": _on_frame(reports.feed),
        "zone_kpis": _zone_events(reports.zone_kpis),
        "zone_road_mix": _on_focus(reports.zone_road_mix_of),
        "zone_road_mix_gaps": _on_focus(reports.zone_road_mix_of, gaps=True),
        "zone_weather_mix": _zone_events(reports.zone_weather_mix),
        "zone_hourly": _zone_events(reports.zone_hourly),
        "zone_road_matrix": _on_events(reports.zone_road_matrix),
        "zone_road_heatmap": zone_road_heatmap,
        "rollup_daily": rollup_daily,
        "rollup_incremental": rollup_incremental,
        "road_leaderboard": _on_focus(
            lambda *star: reports.road_leaderboard(reports.zone_road_mix_of(*star))),
        "dq_report": _on_models(contracts.check_report),
        "dq_report_broken": _on_models(contracts.check_report, broken=True),
        "dq_samples_broken": _on_models(contracts.failure_samples, broken=True),
        "dq_report_by_day": _by_day(),
        "dq_report_by_day_broken": _by_day(broken=True),
        "dq_history": dq_history,
        "seed_marts": seed_marts,
        "full_chain": full_chain,
        "full_chain_marts": full_chain_marts,
        "full_chain_checks": full_chain_checks,
        "gold_rebuild_fact": gold_rebuild_fact,
        "gold_switched_fact": gold_switched_fact,
        "publish_incremental": publish_incremental,
        "publish_removed_day": publish_removed_day,
        "load_counts": load_counts,
        "publish_normalise_loose": publish_normalise_loose,
        "staging_roundtrip_fact": _staging_table(staging.STG_FACT),
        "staging_roundtrip_zone": _staging_table(staging.STG_ZONE),
        "staging_roundtrip_road": _staging_table(staging.STG_ROAD),
        "mart_metadata": mart_metadata,
        "mart_freshness": _on_models(lambda models: contracts.freshness(models, traffic.as_of())),
        "mart_freshness_gaps": _on_models(lambda models: contracts.freshness(models, traffic.as_of()), broken=True),
        "nation_top10": nation_top10,
        "scale_star": scale_star,
    }
    for key, check in (("dq_unique", contracts.unique_checks),
                       ("dq_not_null", contracts.not_null_checks),
                       ("dq_accepted_values", contracts.accepted_checks),
                       ("dq_relationships", contracts.relation_checks)):
        found[key] = _on_models(check)
        found[f"{key}_broken"] = _on_models(check, broken=True)
    return found
