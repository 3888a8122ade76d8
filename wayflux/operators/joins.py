"""Left joins from a fact to its dimensions, and the referential check.

No broadcast is forced here: stored dimensions and literals have a known size, so Spark
broadcasts them while they stay under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to
a sort-merge join, with AQE splitting skewed keys of the fact side, when they outgrow it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_dim_key"


@dataclass(frozen=True)
class Link:
    """A dimension, the fact column that points to it and its key column.

    ``null_safe`` lets a NULL key meet a NULL member.  ``compact`` is read by
    :func:`wayflux.operators.star_breakdown` only: aggregate again before this join.
    """

    dim: DataFrame
    fact_key: str
    dim_key: str | None = None
    null_safe: bool = False
    compact: bool = False


def _attach(fact: DataFrame, link: Link) -> DataFrame:
    dim = link.dim.withColumnRenamed(link.dim_key or link.fact_key, _KEY)
    left, right = F.col(link.fact_key), F.col(_KEY)
    match = left.eqNullSafe(right) if link.null_safe else left == right
    return fact.join(dim, match, "left").drop(_KEY)


def enrich(fact: DataFrame, links: Iterable[Link]) -> DataFrame:
    """The fact with the attributes of every linked dimension; no fact row is lost."""
    for link in links:
        fact = _attach(fact, link)
    return fact


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``(key, rows)`` for child keys without a parent.  NULL keys refer to nothing and pass.

    The child is counted per key first, so the join sees one row per distinct key.
    """
    counted = (child.where(F.col(child_key).isNotNull())
               .groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("rows")))
    known = parent.select(F.col(parent_key).alias("key"))
    return counted.join(known, "key", "left_anti")
