"""Grouped measures over a report frame or directly over a star."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayflux.functions import half_even
from wayflux.operators.joins import Link, enrich

#: Number of rows behind a row of a rollup; a frame with this column holds partial sums.
ROWS = "rows_n"


def is_rollup(frame: DataFrame) -> bool:
    return ROWS in frame.columns


def roll_up(frame: DataFrame, keys: Sequence[str], counted: Sequence[str],
            summed: Sequence[str]) -> DataFrame:
    """Partial sums by ``keys``, NULL being a member: rows, non-NULL values of all named columns, and
    sums of ``summed``, which hold whole numbers.

    Rollups merge: summing two of them by the same or fewer keys gives the rollup of all their rows,
    so every measure can be read from one, and from any part of one that its keys select.
    """
    counts = [F.count(c).alias(f"{c}_n") for c in (*counted, *summed)]
    sums = [F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(f"{c}_sum") for c in summed]
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *counts, *sums)


def rows_where(frame: DataFrame, condition: Column) -> Column:
    """How many rows of a frame, or behind a rollup, meet a condition on its keys."""
    if is_rollup(frame):
        return F.coalesce(F.sum(F.when(condition, F.col(ROWS))), F.lit(0))
    return F.count_if(condition)


@dataclass(frozen=True)
class Measure:
    """A measure that can be computed from partial sums and counts.

    kind ``rows`` counts rows, ``count`` non-NULL values, ``avg`` is sum / count.  Where ``rolled`` is
    set the frame is a rollup, whose stored sums are added up.
    """

    name: str
    kind: str
    column: str | None = None
    digits: int | None = None
    decimals: int | None = None

    def direct(self, rolled: bool = False) -> Column:
        if rolled:
            return self._of_rollup()
        if self.kind == "rows":
            return F.count(F.lit(1)).alias(self.name)
        if self.kind == "count":
            return F.count(self.column).alias(self.name)
        if self.decimals is None:
            return self._round(F.avg(self.column))
        return self._mean(F.sum(self._value()), F.count(self.column))

    def _of_rollup(self) -> Column:
        counted = F.sum(self._rolled_count())
        if self.kind != "avg":
            return F.coalesce(counted, F.lit(0)).alias(self.name)
        return self._round(F.try_divide(F.sum(f"{self.column}_sum").cast("double"), counted))

    def _rolled_count(self) -> str:
        return ROWS if self.kind == "rows" else f"{self.column}_n"

    def partials(self, rolled: bool = False) -> list[Column]:
        """Columns of the first aggregation."""
        if rolled:
            parts = [F.sum(self._rolled_count()).alias(self._part("n"))]
            if self.kind == "avg":
                parts.append(F.sum(self._whole_sum()).alias(self._part("s")))
            return parts
        if self.kind == "rows":
            return [F.count(F.lit(1)).alias(self._part("n"))]
        counted = F.count(self.column).alias(self._part("n"))
        if self.kind == "count":
            return [counted]
        return [counted, F.sum(self._value()).alias(self._part("s"))]

    def recombined(self) -> list[Column]:
        """The same columns again, aggregated from themselves."""
        parts = ["n", "s"] if self.kind == "avg" else ["n"]
        return [F.sum(self._part(p)).alias(self._part(p)) for p in parts]

    def final(self) -> Column:
        counted = F.sum(self._part("n"))
        if self.kind != "avg":
            return F.coalesce(counted, F.lit(0)).alias(self.name)
        return self._mean(F.sum(self._part("s")), counted)

    def _part(self, what: str) -> str:
        return f"_{self.name}_{what}"

    def _whole_sum(self) -> Column:
        """The stored sum in the unit of ``_value``."""
        total = F.col(f"{self.column}_sum")
        return total if self.decimals is None else total * 10 ** self.decimals

    def _value(self) -> Column:
        value = F.col(self.column)
        if self.decimals is None:
            return value
        return F.round(value * float(10 ** self.decimals)).cast("bigint")

    def _mean(self, total: Column, counted: Column) -> Column:
        total = total.cast("double")
        if self.decimals is not None:
            total = total / float(10 ** self.decimals)
        return self._round(F.try_divide(total, counted))

    def _round(self, value: Column) -> Column:
        return (value if self.digits is None else half_even(value, self.digits)).alias(self.name)


def rows(name: str = "events") -> Measure:
    """Number of rows."""
    return Measure(name, "rows")


def count_of(column: str, name: str = "events") -> Measure:
    """Number of rows where the column is not NULL."""
    return Measure(name, "count", column)


def average(column: str, name: str, digits: int | None = None,
            decimals: int | None = None) -> Measure:
    """Mean of the non-NULL values; ``digits`` rounds half to even.

    Sums of doubles depend on the order of rows.  For values with a known number of ``decimals``
    the sum is taken over whole units of that size instead, as a long.
    """
    return Measure(name, "avg", column, digits, decimals)


def breakdown(frame: DataFrame, keys: Sequence[str], measures: Iterable[Measure]) -> DataFrame:
    """One row per key combination, NULL being a member like any other.  The frame may be a rollup."""
    rolled = is_rollup(frame)
    return frame.groupBy(*keys).agg(*[m.direct(rolled) for m in measures])


def share(counted: DataFrame, count: str, name: str) -> DataFrame:
    """Add each row's part of the total.  For counted groups of few members only, as the total is
    taken over all of them in one task."""
    total = F.sum(count).over(Window.partitionBy())
    return counted.withColumn(name, F.col(count) / total)


def star_breakdown(fact: DataFrame, links: Sequence[Link], keys: Sequence[str],
                   measures: Sequence[Measure]) -> DataFrame:
    """``breakdown(enrich(fact, links), keys, measures)`` with the aggregation moved below the
    joins.

    The fact is first reduced to partial sums per (join key, own group key), map-side and before
    any join, so a hot key is one row per task when it meets the dimension.  Sums and counts of a
    group take part in each match as its rows would, so the result is the same even when a
    dimension repeats a key.  A fact that is a rollup starts with its stored sums.
    """
    measures = list(measures)
    frame, rolled = fact, is_rollup(fact)
    for position, link in enumerate(links):
        if position == 0 or link.compact:
            later = {other.fact_key for other in links[position:]} | set(keys)
            grouped = frame.groupBy(*[c for c in frame.columns if c in later])
            parts = [m.partials(rolled) if position == 0 else m.recombined() for m in measures]
            frame = grouped.agg(*[c for part in parts for c in part])
        frame = enrich(frame, [link])
    return frame.groupBy(*keys).agg(*[m.final() for m in measures])
