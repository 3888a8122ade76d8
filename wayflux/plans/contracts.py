"""What the marts promise, and the report that tells whether they keep it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayflux import domain
from wayflux.operators import checks
from wayflux.operators.joins import orphans
from wayflux.plans import warehouse

PII_FLAG = "gdpr_pii_classification"


@dataclass(frozen=True)
class ColumnContract:
    """Promises about one column.  Every column is described; ``pii`` hides its values."""

    name: str
    unique: bool = False
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    not_null: bool = True
    pii: bool = False


@dataclass(frozen=True)
class ModelContract:
    """A model, who answers for it, how fresh it should be, and its columns.

    The freshness figure is information for readers; no check enforces it.
    """

    name: str
    columns: tuple[ColumnContract, ...]
    owner: str = "data-engineering"
    freshness_hours: int = 1

    def names(self, promise: str) -> list[str]:
        return [c.name for c in self.columns if getattr(c, promise)]

    @property
    def has_pii(self) -> bool:
        return bool(self.names("pii"))


_Col = ColumnContract

# Models, columns and promises of the warehouse.
LOCATIONS = ModelContract(warehouse.LOCATIONS, (
    _Col("location_id", unique=True),
    _Col("city_zone", accepted=domain.ZONES),
    _Col("zone_type"),
    _Col("traffic_risk", accepted=domain.RISKS),
    _Col("road_id", accepted=domain.ROADS),
    _Col("road_type"),
    _Col("speed_limit"),
))

EVENTS = ModelContract(warehouse.EVENTS, (
    _Col("event_id", unique=True),
    _Col("location_id", parent=(warehouse.LOCATIONS, "location_id")),
    _Col("vehicle_id", pii=True),
    _Col("road_id"),
    _Col("city_zone"),
    _Col("speed_int"),
    _Col("congestion_level"),
    _Col("event_ts"),
    _Col("peak_flag"),
    _Col("speed_band", accepted=domain.BANDS),
    _Col("hour"),
    _Col("weather", accepted=domain.WEATHERS),
    _Col("date"),
))

CONTRACTS = (LOCATIONS, EVENTS)


def describe(df: DataFrame, contract: ModelContract) -> DataFrame:
    """The model with its flags in the column metadata, where readers and writers find them."""
    for column in contract.columns:
        df = df.withMetadata(column.name, {PII_FLAG: column.pii})
    return df


def model_register(spark, contracts=CONTRACTS) -> DataFrame:
    """Owner, freshness target and personal-data flag of each model."""
    rows = [(c.name, c.owner, c.freshness_hours, c.has_pii) for c in contracts]
    return spark.createDataFrame(
        rows, "model STRING, data_owner STRING, sla_freshness_hours INT, gdpr_pii BOOLEAN")


def stored_register(spark, paths: Mapping[str, str], contracts=CONTRACTS,
                    fmt: str = "parquet") -> DataFrame:
    """``(model, column_name, pii)`` as the metadata of the stored models says.  Columns that a table is
    laid out by are in its paths, without metadata; they are never personal."""
    rows = []
    for contract in contracts:
        for field in spark.read.format(fmt).load(paths[contract.name]).schema:
            rows.append((contract.name, field.name, field.metadata.get(PII_FLAG, False)))
    return spark.createDataFrame(rows, "model STRING, column_name STRING, pii BOOLEAN")


def freshness(models: Mapping[str, DataFrame], as_of: Column, contracts=CONTRACTS) -> DataFrame:
    """``(model, rows, newest, hours_old, sla_freshness_hours)``: what the models hold beside what they aim at.

    ``newest`` is the last event of a model that has events, and its age counts whole hours.  For readers
    only; no check fails on it.
    """
    def measured(contract: ModelContract) -> DataFrame:
        model = models[contract.name]
        newest = F.max("event_ts") if "event_ts" in model.columns else F.lit(None)
        found = model.agg(F.count(F.lit(1)).alias("rows"), newest.cast("timestamp_ntz").alias("newest"))
        return found.select(
            F.lit(contract.name).alias("model"), "rows", "newest",
            F.timestamp_diff("HOUR", F.col("newest"), as_of.cast("timestamp_ntz")).alias("hours_old"),
            F.lit(contract.freshness_hours).alias("sla_freshness_hours"))

    return _union([measured(c) for c in contracts])


def _accepted(contract: ModelContract) -> dict[str, tuple[str, ...]]:
    return {c.name: c.accepted for c in contract.columns if c.accepted}


def _related(contract: ModelContract) -> list[ColumnContract]:
    return [c for c in contract.columns if c.parent]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unique_checks(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return _union([checks.unique_failures(models[c.name], c.name, column)
                   for c in contracts for column in c.names("unique")])


def not_null_checks(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return _union([checks.null_failures(models[c.name], c.name, c.names("not_null"))
                   for c in contracts])


def accepted_checks(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return _union([checks.accepted_failures(models[c.name], c.name, _accepted(c))
                   for c in contracts if _accepted(c)])


def relation_checks(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return _union([
        checks.relation_failures(models[c.name], c.name, column.name,
                                 models[column.parent[0]], column.parent[1])
        for c in contracts for column in _related(c)])


def check_report(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """One row per promised check: ``(model, column_name, test, failures, status)``."""
    parts = [check(models, contracts) for check, any_of in (
        (unique_checks, lambda c: c.names("unique")), (not_null_checks, lambda c: c.names("not_null")),
        (accepted_checks, _accepted), (relation_checks, _related)) if any(map(any_of, contracts))]
    return _judged(_union(parts))


def _judged(found: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return found.withColumn("status", status)


# ---- the same by day ----------------------------------------------------------------------------

CHECK_PARTS = "check_parts"
#: Models whose rows belong to a day and whose unique keys hold it, with the column of the day.
BY_DAY = {EVENTS.name: "date"}


def check_parts(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """What every day of the models in ``BY_DAY`` adds to the report; give only some days to get theirs."""
    parts = [checks.day_parts(
        models[c.name], c.name, BY_DAY[c.name], c.names("unique"), c.names("not_null"), _accepted(c),
        [r.name for r in _related(c)], c.names("pii")) for c in contracts if c.name in BY_DAY]
    return _union(parts)


def merged_report(parts: DataFrame, models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """``check_report`` from stored parts of days; only models that have no days are read."""
    small = [c for c in contracts if c.name not in BY_DAY]
    found = [check_report(models, small).drop("status")] if small else []
    for c in contracts:
        if c.name in BY_DAY:
            promised = [(name, checks.UNIQUE) for name in c.names("unique")]
            promised += [(name, checks.NOT_NULL) for name in c.names("not_null")]
            promised += [(name, checks.ACCEPTED) for name in _accepted(c)]
            promised += [(r.name, checks.RELATED) for r in _related(c)]
            parents = {r.name: (models[r.parent[0]], r.parent[1]) for r in _related(c)}
            found.append(checks.merged_failures(parts, c.name, promised, parents))
    return _judged(_union(found))


def failing_values(models: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """``(model, column_name, test, value)``: what made the checks fail, NULL rows by their key.

    Columns with personal data are left out altogether.
    """
    parts = []
    for contract in contracts:
        model, shown = models[contract.name], {c.name for c in contract.columns if not c.pii}
        keys = [k for k in contract.names("unique") if k in shown]
        for key in keys:
            found = checks.repeated_keys(model, key).withColumn("column_name", F.lit(key))
            parts.append(_labelled(found, contract, checks.UNIQUE))
        nullable = [c for c in contract.names("not_null") if c in shown]
        parts += [_labelled(checks.null_rows(model, nullable, key), contract, checks.NOT_NULL)
                  for key in keys[:1]]
        accepted = {c: values for c, values in _accepted(contract).items() if c in shown}
        if accepted:
            parts.append(_labelled(checks.unexpected_values(model, accepted), contract,
                                   checks.ACCEPTED))
        for column in _related(contract):
            if column.name in shown:
                found = orphans(model, column.name, models[column.parent[0]], column.parent[1])
                found = found.select(F.lit(column.name).alias("column_name"),
                                     F.col("key").alias("value"))
                parts.append(_labelled(found, contract, checks.RELATED))
    return _union(parts)


def failure_samples(models: Mapping[str, DataFrame], limit: int = 5,
                    contracts=CONTRACTS) -> DataFrame:
    """``(model, column_name, test, sample)``: the first ``limit`` failing values of each check.

    The rank is limited before the shuffle, so a check with very many failures sends a few rows.
    """
    window = Window.partitionBy("model", "column_name", "test").orderBy(F.asc_nulls_last("value"))
    ranked = failing_values(models, contracts).withColumn("place", F.row_number().over(window))
    return ranked.where(F.col("place") <= limit).select(
        "model", "column_name", "test", F.col("value").alias("sample"))


def _labelled(found: DataFrame, contract: ModelContract, test: str) -> DataFrame:
    return found.select(F.lit(contract.name).alias("model"), "column_name",
                        F.lit(test).alias("test"), F.col("value").cast("string").alias("value"))
