"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Every hour(), to_date() and text form of a timestamp depends on the zone, so it is pinned.
ZONE_SETTING = "spark.sql.session.timeZone"
SESSION_ZONE = "UTC"

CHECKPOINT_DIR_SETTING = "spark.checkpoint.dir"

# Batch settings.  The shuffle width is a start value: AQE merges small partitions towards the
# advisory size and splits skewed ones, so it should be high on a cluster, never tuned per query.
CLUSTER_SETTINGS = {
    ZONE_SETTING: SESSION_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}

# AQE merges downwards only, so batch shuffles of a cluster start with this many partitions.
INITIAL_WIDTH_SETTING, INITIAL_WIDTH = (
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4000")

# State that outgrows executor memory belongs in RocksDB; the changelog keeps commits small.
STATE_STORE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
                  rocksdb_state: bool = True, **settings: str) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit when not given.

    State is kept in RocksDB unless told otherwise.  On a cluster batch jobs start wide and AQE merges
    what is small; that leaves the width of stream state alone.  ``shuffle_partitions`` is worth setting for streams: a stateful query keeps the number it was
    first started with, so choose it for the largest expected state.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = dict(CLUSTER_SETTINGS)
    if rocksdb_state:
        chosen.update(STATE_STORE_SETTINGS)
    if not (master or "").startswith("local") and not shuffle_partitions:
        chosen[INITIAL_WIDTH_SETTING] = INITIAL_WIDTH
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    chosen.update(settings)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_zone(spark: SparkSession) -> SparkSession:
    """Set the session zone on a session that somebody else built."""
    if spark.conf.get(ZONE_SETTING) != SESSION_ZONE:
        spark.conf.set(ZONE_SETTING, SESSION_ZONE)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local-mode session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR_SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wayflux-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_folder(spark)}/wayflux/{label}-{uuid.uuid4().hex[:12]}"
