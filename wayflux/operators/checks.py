"""Declarative data checks.

A check result is ``(model, column_name, test, failures)``.  ``failures`` counts what a reader has
to look at: NULL rows, repeated keys, distinct unexpected values, rows without a parent.  All
checks of a kind share one scan of a model, and nothing is brought to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.operators.joins import orphans

UNIQUE, NOT_NULL, ACCEPTED, RELATED = "unique", "not_null", "accepted_values", "relationships"


def _result(df: DataFrame, model: str, column, test: str, failures) -> DataFrame:
    return df.select(F.lit(model).alias("model"), column.alias("column_name"),
                     F.lit(test).alias("test"), failures.cast("bigint").alias("failures"))


def null_failures(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """NULL rows per column; all columns are counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "failures")
    return _result(long, model, F.col("column_name"), NOT_NULL, F.col("failures"))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """``(value, rows)`` of non-NULL keys that occur more than once."""
    counted = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
               .agg(F.count(F.lit(1)).alias("rows")))
    return counted.where("rows > 1")


def unique_failures(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of repeated keys.  Counting is partial before the shuffle, so a key with very many
    copies arrives as one row per task."""
    found = repeated_keys(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return _result(found, model, F.lit(column), UNIQUE, F.col("failures"))


def _failing(df: DataFrame, conditions: Mapping[str, Column],
             value: Callable[[str], Column]) -> DataFrame:
    """``(column_name, value)`` for every column of a row whose condition holds.

    Rows without a failure are filtered first, so clean data ends in the scan stage.
    """
    found = [F.when(condition, F.struct(F.lit(name).alias("column_name"),
                                        value(name).alias("value")))
             for name, condition in conditions.items()]
    failing = df.where(reduce(or_, conditions.values()))
    exploded = failing.select(F.explode(F.array_compact(F.array(*found))).alias("failing"))
    return exploded.select("failing.column_name", "failing.value")


def null_rows(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``(column_name, value)`` for every NULL; the row is named by its key."""
    conditions = {c: F.col(c).isNull() for c in columns}
    return _failing(df, conditions, lambda name: F.col(key).cast("string"))


def unexpected_values(df: DataFrame, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(column_name, value, rows)`` of values outside the list of their column.

    NULL is left to the not-NULL check.
    """
    conditions = {c: ~F.col(c).isin(list(values)) for c, values in accepted.items()}
    found = _failing(df, conditions, lambda name: F.col(name).cast("string"))
    return found.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def day_parts(df: DataFrame, model: str, day: str, unique: Sequence[str], columns: Sequence[str],
              accepted: Mapping[str, Sequence[str]], related: Sequence[str],
              hidden: Sequence[str] = ()) -> DataFrame:
    """What each day of a model adds to its checks: ``(model, column_name, test, value, rows, day)``.

    Repeated keys are a number for each day, so copies of a key must share their day.  NULLs are counted;
    unexpected values are kept, as the same value on two days counts once; keys of a parent are kept
    with their rows, so that they can meet whatever the parent holds later.  Values of ``hidden``
    columns are kept as digests.
    """
    def shown(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.sha2(text, 256) if column in hidden else text

    def named(df: DataFrame, column, test: str, value, rows) -> DataFrame:
        return df.select(F.lit(model).alias("model"), column.alias("column_name"), F.lit(test).alias("test"),
                         value.cast("string").alias("value"), rows.cast("bigint").alias("rows"), F.col(day))

    parts, nothing = [], F.lit(None)
    if columns:
        nulls = df.groupBy(day).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns])
        named_nulls = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_null").alias("n"))
                                for c in columns])
        found = nulls.select(F.col(day), F.inline(F.filter(named_nulls, lambda x: x["n"] > 0)))
        parts.append(named(found, F.col("column_name"), NOT_NULL, nothing, F.col("n")))
    if accepted:
        found = [F.when(~F.col(c).isin(list(values)), F.struct(F.lit(c).alias("column_name"), shown(c).alias("value")))
                 for c, values in accepted.items()]
        failing = df.where(reduce(or_, [~F.col(c).isin(list(v)) for c, v in accepted.items()])).select(
            F.col(day), F.inline(F.array_compact(F.array(*found))))
        counted = failing.groupBy(day, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(named(counted, F.col("column_name"), ACCEPTED, F.col("value"), F.col("n")))
    for column in unique:
        twice = (df.where(F.col(column).isNotNull()).groupBy(day, column).agg(F.count(F.lit(1)).alias("n"))
                 .where("n > 1").groupBy(day).agg(F.count(F.lit(1)).alias("n")))
        parts.append(named(twice, F.lit(column), UNIQUE, nothing, F.col("n")))
    for column in related:
        keys = df.where(F.col(column).isNotNull()).groupBy(day, column).agg(F.count(F.lit(1)).alias("n"))
        parts.append(named(keys, F.lit(column), RELATED, F.col(column), F.col("n")))
    return reduce(DataFrame.unionByName, parts)


def merged_failures(parts: DataFrame, model: str, promised: Sequence[tuple[str, str]],
                    parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Check results of a model from its days: one row for each ``(column, test)`` of ``promised``.

    Keys that their parent knows are dropped; what is left is counted as the whole-model checks do.
    """
    mine = parts.where(F.col("model") == model)
    related = [mine.where((F.col("test") == RELATED) & (F.col("column_name") == column)).join(
        parent.select(F.col(key).cast("string").alias("value")), "value", "left_anti").select(
        "column_name", "test", "value", "rows") for column, (parent, key) in parents.items()]
    rest = mine.where(F.col("test") != RELATED).select("column_name", "test", "value", "rows")
    found = reduce(DataFrame.unionByName, [rest, *related]).groupBy("column_name", "test", "value").agg(
        F.sum("rows").alias("rows"))

    def total(column: str, test: str) -> Column:
        here = (F.col("column_name") == column) & (F.col("test") == test)
        return F.coalesce(F.sum(F.when(here, F.lit(1) if test == ACCEPTED else F.col("rows"))), F.lit(0))

    return found.agg(F.array(*[F.struct(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
        total(column, test).cast("bigint").alias("failures")) for column, test in promised]).alias("all")
    ).select(F.inline("all"))


def accepted_failures(df: DataFrame, model: str,
                      accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number of distinct unexpected values, one row per checked column."""
    found = unexpected_values(df, accepted).agg(*[
        F.count_if(F.col("column_name") == column).alias(column) for column in accepted])
    long = found.unpivot([], list(accepted), "column_name", "failures")
    return _result(long, model, F.col("column_name"), ACCEPTED, F.col("failures"))


def relation_failures(df: DataFrame, model: str, column: str, parent: DataFrame,
                      parent_column: str) -> DataFrame:
    """Number of rows whose key has no parent."""
    found = orphans(df, column, parent, parent_column).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
    return _result(found, model, F.lit(column), RELATED, F.col("failures"))
