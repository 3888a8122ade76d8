"""Gold: a star of two member dimensions and one fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux import schemas
from wayflux.domain import STAR_RULES, MemberRule, StarRules
from wayflux.functions import lookup
from wayflux.operators import keep_first

DATE = "date"
_FACT_INPUT = [name for name in schemas.FACT.names if name != DATE]


@dataclass(frozen=True)
class Star:
    zone: DataFrame
    road: DataFrame
    fact: DataFrame


def member_dimension(source: DataFrame, member: str,
                     attributes: Mapping[str, MemberRule]) -> DataFrame:
    """Distinct non-NULL members with rule attributes.  Reads one column, combines map-side."""
    members = source.select(member).where(F.col(member).isNotNull()).distinct()
    return members.withColumns({
        name: lookup(F.col(member), rule.known, rule.otherwise)
        for name, rule in attributes.items()})


def dim_zone(silver: DataFrame, rules: StarRules = STAR_RULES) -> DataFrame:
    return member_dimension(silver, "city_zone", rules.zone)


def dim_road(silver: DataFrame, rules: StarRules = STAR_RULES) -> DataFrame:
    return member_dimension(silver, "road_id", rules.road)


def fact_traffic(silver: DataFrame, rules: StarRules = STAR_RULES) -> DataFrame:
    """One row per reading with its calendar day; readings need a vehicle and a time."""
    known = silver.select(*_FACT_INPUT)
    for key in rules.event_key:
        known = known.where(F.col(key).isNotNull())
    rest = [name for name in _FACT_INPUT if name not in rules.event_key]
    unique = keep_first(known, rules.event_key, rest)
    return unique.withColumn(DATE, F.to_date("event_ts"))


def star(silver: DataFrame, rules: StarRules = STAR_RULES) -> Star:
    return Star(dim_zone(silver, rules), dim_road(silver, rules), fact_traffic(silver, rules))
