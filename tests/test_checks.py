"""Data checks pass on clean marts and fail on broken ones; personal data is never shown."""

from pyspark.sql import functions as F

from helpers import physical_plan, values
from wayflux import schemas
from wayflux.operators import checks
from wayflux.plans import contracts, warehouse


def models(spark, events, locations=None):
    locations = locations or [("L1", "CBD", "Commercial", "HIGH", "R100", "Highway", 100)]
    columns = ["event_id", "location_id", "vehicle_id", "weather"]
    fct = spark.createDataFrame(events, "event_id STRING, location_id STRING, vehicle_id STRING,"
                                        " weather STRING")
    filled = {"speed_band": "LOW", "road_id": "R100", "city_zone": "CBD"}
    rest = [F.lit(filled.get(f.name)).cast(f.dataType).alias(f.name) if f.name in filled
            else F.lit("1").cast("int").alias(f.name) if f.dataType == schemas.INT
            else F.lit("2024-01-01").cast(f.dataType).alias(f.name)
            for f in schemas.FCT_EVENTS if f.name not in columns]
    fct = fct.select(*columns, *rest).select(*schemas.FCT_EVENTS.names)
    return {warehouse.LOCATIONS: spark.createDataFrame(locations, schemas.DIM_LOCATIONS),
            warehouse.EVENTS: fct}


CLEAN = [("e1", "L1", "V1", "RAIN"), ("e2", "L1", "V2", "FOG")]
BROKEN = CLEAN + [("e1", "L9", None, "HAIL"), ("e3", None, "V3", "HAIL"), ("e4", "L9", "V4", None),
                  (None, "L1", "V5", "SNOW"), (None, "L1", "V6", "RAIN")]


def test_contract_has_28_checks(spark):
    report = contracts.check_report(models(spark, CLEAN))
    assert report.columns == ["model", "column_name", "test", "failures", "status"]
    counts = {r.test: r["count"] for r in report.groupBy("test").count().collect()}
    assert counts == {"unique": 2, "not_null": 20, "accepted_values": 5, "relationships": 1}
    assert report.where("status <> 'pass' or failures <> 0").count() == 0


def test_broken_marts_fail(spark):
    report = contracts.check_report(models(spark, BROKEN))
    failed = {(r.column_name, r.test): r.failures for r in report.where("failures > 0").collect()}
    assert failed == {
        ("event_id", "unique"): 1, ("event_id", "not_null"): 2, ("location_id", "not_null"): 1,
        ("vehicle_id", "not_null"): 1, ("weather", "not_null"): 1,
        ("weather", "accepted_values"): 2, ("location_id", "relationships"): 2}
    assert {r.status for r in report.where("failures > 0").collect()} == {"fail"}


def test_samples_leave_personal_data_out(spark):
    samples = contracts.failure_samples(models(spark, BROKEN))
    found = values(samples.where(F.col("model") == warehouse.EVENTS).drop("model"))
    assert ("weather", "accepted_values", "HAIL") in found
    assert ("event_id", "unique", "e1") in found
    assert ("weather", "not_null", "e4") in found
    assert ("location_id", "relationships", "L9") in found
    assert all(column != "vehicle_id" for column, _, _ in found)
    assert not any(str(value).startswith("V") for _, _, value in found)


def test_samples_are_limited_and_ranked_before_the_shuffle(spark):
    many = [(f"e{i:03}", "L1", f"V{i}", f"W{i:03}") for i in range(50)]
    samples = contracts.failure_samples(models(spark, many), limit=3)
    assert values(samples.select("sample")) == [("W000",), ("W001",), ("W002",)]
    assert "row_number(), 3, Partial" in physical_plan(samples)


def test_samples_of_clean_marts_are_empty(spark):
    assert contracts.failure_samples(models(spark, CLEAN)).isEmpty()


def test_all_columns_are_counted_in_one_scan(spark, tmp_path):
    models(spark, CLEAN)[warehouse.EVENTS].write.parquet(str(tmp_path / "fct"))
    stored = spark.read.parquet(str(tmp_path / "fct"))
    for found in (checks.null_failures(stored, "m", stored.columns),
                  checks.accepted_failures(stored, "m", {"weather": ("RAIN",),
                                                         "speed_band": ("LOW",)})):
        assert physical_plan(found).count("FileScan") == 1


def test_column_metadata(spark):
    fct = contracts.describe(models(spark, CLEAN)[warehouse.EVENTS], contracts.EVENTS)
    flags = {f.name: f.metadata[contracts.PII_FLAG] for f in fct.schema}
    assert [name for name, pii in flags.items() if pii] == ["vehicle_id"]
    assert len(flags) == 13


def test_model_register(spark):
    got = values(contracts.model_register(spark))
    assert got == [(warehouse.LOCATIONS, "data-engineering", 1, False),
                   (warehouse.EVENTS, "data-engineering", 1, True)]
