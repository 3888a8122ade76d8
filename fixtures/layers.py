"""Layers derived from the test tables, stored once per application in the shared folder.

Each query of the entry module reads the layer below it, as it would in a running lake.
"""

from __future__ import annotations

from functools import lru_cache
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import traffic
from wayflux import publish, schemas
from wayflux.lake import BRONZE, FACT, PARTITIONS, ROAD, SILVER, ZONE, Lake
from wayflux.plans import bronze as bronze_plan
from wayflux.plans import gold as gold_plan
from wayflux.plans import silver as silver_plan
from wayflux.plans import rollups, staging, warehouse
from wayflux.session import pin_zone, work_path
from wayflux.sinks import create_database, create_mart_views, overwrite_table, register_table
from wayflux.streaming import rewrite_star

ENVELOPE = "messages"


class Layers:
    """One lake per test directory, every layer built when first asked for.

    ``gaps`` gives the variant with missing members and repeated readings, whose marts break
    their contracts on purpose; staging would refuse it, so marts are built from gold types.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, gaps: bool):
        self.spark, self.sf_dir, self.gaps = spark, sf_dir, gaps
        self.lake = Lake(spark, work_path(spark, "gaps" if gaps else "layers"))
        self.database = f"wayflux_{crc32(self.lake.root.encode()):08x}"
        self._done: set[str] = set()

    def _once(self, step) -> None:
        if step.__name__ not in self._done:
            step()
            self._done.add(step.__name__)

    def _write(self, df: DataFrame, table: str, rebalance: bool = False) -> None:
        overwrite_table(df, self.lake.path(table), PARTITIONS.get(table, ()), rebalance=rebalance)

    # -- steps ------------------------------------------------------------------------------------

    def _messages(self) -> None:
        self._write(traffic.envelope(self.spark, self.sf_dir, self.gaps), ENVELOPE)

    def _bronze(self) -> None:
        log = traffic.envelope(self.spark, self.sf_dir, self.gaps)
        self._write(bronze_plan.bronze(log), BRONZE)

    def _silver(self) -> None:
        bronze = self.bronze()
        if self.gaps:
            clean = silver_plan.keep_clean(silver_plan.judge(bronze, traffic.as_of()))
            rows = silver_plan.add_features(clean)
        else:
            rows = silver_plan.silver(bronze, traffic.as_of())
        self._write(silver_plan.with_event_date(rows), SILVER, rebalance=True)

    def _gold(self) -> None:
        silver = self.silver()
        if self.gaps:
            fact = silver.withColumn("date", F.to_date("event_ts"))
            self._write(gold_plan.dim_zone(silver), ZONE)
            self._write(gold_plan.dim_road(silver), ROAD)
            self._write(fact.select(*schemas.FACT.names), FACT, rebalance=True)
        else:
            rewrite_star(self.lake, silver)

    def _staging(self) -> None:
        if self.gaps:
            for name, df in staging.staged(self.gold()).items():
                self._write(df, name)
        else:
            publish.load_staging(self.gold(), publish.lake_writer(self.lake))

    def _marts(self) -> None:
        publish.build_marts(self.lake, self.staging())

    def _catalog(self) -> None:
        self.marts()
        create_database(self.spark, self.database, self.lake.path("_database"))
        for name in (warehouse.LOCATIONS, warehouse.EVENTS):
            register_table(self.spark, self.database, name, self.lake.path(name),
                           partitioned=name in PARTITIONS)
        create_mart_views(self.spark, self.database)

    # -- layers -----------------------------------------------------------------------------------

    def messages(self) -> str:
        """Path of the stored message files."""
        self._once(self._messages)
        return self.lake.path(ENVELOPE)

    def bronze(self) -> DataFrame:
        self._once(self._bronze)
        return self.lake.read(BRONZE)

    def silver(self) -> DataFrame:
        self._once(self._silver)
        return self.lake.read(SILVER)

    def gold(self) -> dict[str, DataFrame]:
        self._once(self._gold)
        return self.lake.gold()

    def staging(self) -> dict[str, DataFrame]:
        self._once(self._staging)
        return self.lake.staging()

    def marts(self) -> dict[str, DataFrame]:
        self._once(self._marts)
        return self.lake.marts()

    def rollup(self) -> DataFrame:
        """The daily rollup of the events mart."""
        self._once(self._marts)
        return self.lake.read(rollups.TRAFFIC_DAILY)

    def view(self, name: str) -> DataFrame:
        """A compatibility view of the catalog."""
        self._once(self._catalog)
        return self.spark.table(f"{self.database}.{name}")

    def star_views(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.view("fact_traffic"), self.view("dim_zone"), self.view("dim_road")

    def rolled_star(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The star of reports without single events: the rollup stands in for the fact."""
        return self.rollup(), self.view("dim_zone"), self.view("dim_road")


@lru_cache(maxsize=None)
def _cached(application: str, spark: SparkSession, sf_dir: str, gaps: bool) -> Layers:
    return Layers(spark, sf_dir, gaps)


def layers(spark: SparkSession, sf_dir: str, gaps: bool = False) -> Layers:
    pin_zone(spark)
    return _cached(spark.sparkContext.applicationId, spark, sf_dir.rstrip("/"), gaps)
