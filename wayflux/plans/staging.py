"""Staging: gold tables typed for the warehouse, with the constraints its tables declare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux import schemas
from wayflux.functions import whole_number

STG_ZONE, STG_ROAD, STG_FACT = "stg_dim_zone", "stg_dim_road", "stg_fact_traffic"

# table -> columns that must not be NULL
NOT_NULL = {
    STG_ZONE: ("city_zone",),
    STG_ROAD: ("road_id",),
    STG_FACT: ("vehicle_id", "road_id", "city_zone"),
}

CONTRACTS = {
    STG_ZONE: schemas.DIM_ZONE,
    STG_ROAD: schemas.DIM_ROAD,
    STG_FACT: schemas.STAGED_FACT,
}


class ConstraintViolation(ValueError):
    """A staged table breaks a declared constraint; nothing was replaced."""


def normalise(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its types; a value that does not fit becomes NULL.

    Whole numbers that are stored as text or with a fraction part count as whole; others do not fit.
    """
    return df.select(*[_typed(df, f).alias(f.name) for f in contract.fields])


def _typed(df: DataFrame, field: T.StructField) -> Column:
    stored = df.schema[field.name].dataType
    if isinstance(field.dataType, T.IntegerType) and not isinstance(stored, T.IntegralType):
        return whole_number(F.col(field.name))
    return F.col(field.name).try_cast(field.dataType)


def staged(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging tables from gold tables keyed by staging name."""
    return {name: normalise(gold[name], contract) for name, contract in CONTRACTS.items()}


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column, in one scan of these columns only."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def check_not_null(tables: Mapping[str, DataFrame],
                   constraints: Mapping[str, Sequence[str]] = NOT_NULL) -> None:
    """Raise before anything is written when a key column holds NULLs."""
    problems = []
    for name, columns in constraints.items():
        counts = null_counts(tables[name], columns).first().asDict()
        problems += [f"{name}.{c}: {n} NULLs" for c, n in counts.items() if n]
    if problems:
        raise ConstraintViolation("; ".join(problems))
