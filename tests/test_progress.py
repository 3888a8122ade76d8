"""Late rows are counted, and state behind the watermark is gone."""

import pytest
from pyspark.sql import functions as F

from helpers import ts
from wayflux.operators import dedup_stream
from wayflux.sinks import append_stream, append_table
from wayflux.sources import stream_table
from wayflux.streaming import ProgressLog

SCHEMA = "vehicle_id STRING, event_ts TIMESTAMP"
KEY = ["vehicle_id", "event_ts"]


def run(spark, root, given, thin=True, log=None):
    append_table(spark.createDataFrame([(v, ts(t)) for v, t in given], SCHEMA).coalesce(1), f"{root}/log")
    schema = spark.createDataFrame([], SCHEMA).schema
    kept = dedup_stream(stream_table(spark, f"{root}/log", schema), KEY, "event_ts", "15 minutes", thin)
    query = append_stream(kept, f"{root}/kept", f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    if log:
        log.wait(query)
    return query


DELIVERIES = [[("V1", "2024-01-01 10:00:00"), ("V2", "2024-01-01 10:10:00"), ("V2", "2024-01-01 10:10:00")],
              [("V3", "2024-01-01 11:00:00"), ("V4", "2024-01-01 10:50:00"), ("V5", "2024-01-01 09:00:00")],
              [("V6", "2024-01-01 10:44:00"), ("V6", "2024-01-01 10:44:00"), ("V7", "2024-01-01 10:46:00")]]


@pytest.fixture
def log(spark, tmp_path):
    found = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(found)
    yield found
    spark.streams.removeListener(found)


def test_late_rows_are_counted(spark, tmp_path, log):
    queries = [run(spark, tmp_path, rows, thin=False, log=log) for rows in DELIVERIES]
    found = spark.read.parquet(log.path)
    by_run = {r.run_id: r for r in found.groupBy("run_id").agg(
        F.sum("input_rows").alias("n"), F.sum("late_rows").alias("late"), F.max("watermark").alias("mark")).collect()}
    got = [by_run[str(q.runId)] for q in queries]
    assert [(r.n, r.late) for r in got] == [(3, 0), (3, 1), (3, 2)]
    assert got[1].mark == got[2].mark == ts("2024-01-01 10:45:00")
    assert found.groupBy("run_id", "batch_id").count().where("count > 1").isEmpty()
    assert found.select("query_id").distinct().count() == 1


@pytest.mark.parametrize("thin", [True, False])
def test_state_behind_the_watermark_is_gone(spark, tmp_path, thin):
    held = []
    for rows in DELIVERIES:
        run(spark, tmp_path, rows, thin)
        state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint").select("key.*")
        held.append(sorted(r.vehicle_id for r in state.collect()))
    assert held == [["V1", "V2"], ["V3", "V4"], ["V3", "V4", "V7"]]


def test_rows_are_gathered_before_they_are_stored(spark, tmp_path, log):
    run(spark, tmp_path, DELIVERIES[0], log=log)
    batches = spark.read.parquet(log.path).count()
    assert batches >= 1 and len(spark.read.parquet(log.path).inputFiles()) == 1


def test_waiting_for_another_query_ends(spark, tmp_path, log):
    query = run(spark, tmp_path, DELIVERIES[0], log=log)

    class Unknown:
        runId = "never"

    with pytest.raises(TimeoutError):
        log.wait(Unknown(), 0.2)
    log.wait(query)
