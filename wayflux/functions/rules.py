"""Rule columns: small builders over native expressions, all inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[str | int, Column]], otherwise: str | int) -> Column:
    """The value of the first rule that holds; a condition that is NULL does not hold."""
    chain = reduce(lambda acc, rule: acc.when(rule[1], F.lit(rule[0])), rules, F)
    return chain.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return first_match([(1, condition)], 0)


def band(value: Column, cuts: Iterable[tuple[int, str]], top: str) -> Column:
    """Name of the first cut the value lies below; ``top`` beyond the last one."""
    return first_match([(name, value < limit) for limit, name in cuts], top)


def lookup(member: Column, known: Mapping, otherwise: str | int) -> Column:
    """Map members to a value, members of equal value in one IN list."""
    groups: dict = {}
    for key, value in known.items():
        groups.setdefault(value, []).append(key)
    return first_match([(value, member.isin(keys)) for value, keys in groups.items()], otherwise)


def half_even(value: Column, digits: int) -> Column:
    """Round ties to the even neighbour, computed on the scaled double."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale


def clip(value: Column, low: float, high: float) -> Column:
    """Keep the value inside [low, high]."""
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))
