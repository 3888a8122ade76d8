"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of source, language and topic.  The cells' token weights are raked to the
target shares of each of the three in turn until all hold; a cell's calibrated sampling rate is its
raked weight over its tokens, scaled so that the wanted share of all tokens is expected.  A document
stays if the hash of its id and text is below its cell's rate, so runs repeat themselves.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import stored

DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """``shares``: target shares by dimension and value, relative; values not named, and dimensions
    without shares, get their present token share to the power ``flatten`` (1 keeps the mix, 0 makes
    all alike).  ``keep``: expected share of all tokens that stay.  Raking ends when every marginal is
    within ``tolerance`` of its target, when a round brings no marginal nearer, as where targets contradict
    each other, or after ``rounds``; what is missed then is returned as ``missed``."""

    keep: float = 0.5
    flatten: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 0.8})
    shares: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    tolerance: float = 1e-3
    rounds: int = 50
    seed: int = 20


def topic_of(text: str) -> Column:
    """The form of a text (table, code, notice, figures, or its size), which stands for its topic where
    no topic is known; never null."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.length(t) == 0, "empty")
            .when(F.regexp_count(t, F.lit(r" \| ")) >= 5, "table")
            .when(F.regexp_count(t, F.lit(r"[{};<>=]")) * 50 >= F.length(t), "code")
            .when(t.rlike(r"(?i)all rights reserved|licen[cs]e|copyright"), "notice")
            .when(F.regexp_count(t, F.lit(r"[0-9]")) * 20 >= F.length(t), "figures")
            .when(F.length(t) < 400, "snippet").when(F.length(t) < 4000, "article").otherwise("long"))


def _column(docs: DataFrame, name: str) -> Column:
    return (docs[f"`{name}`"] if name in docs.columns else F.lit(None)).cast("string")


def _cells(docs: DataFrame) -> DataFrame:
    text = _column(docs, "text")
    return docs.select(
        F.coalesce(_column(docs, "source"), F.lit("")).alias("source"),
        F.coalesce(_column(docs, "lang"), F.lit("")).alias("lang"), topic_of(text).alias("topic"),
        F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).alias("tokens"))


def _targets(cells: DataFrame, name: str, mix: Mix, total: float) -> DataFrame:
    have = cells.groupBy(name).agg((F.sum("tokens") / F.lit(total)).alias("share"))
    wanted = F.pow("share", F.lit(float(mix.flatten.get(name, 1.0))))
    given = mix.shares.get(name)
    if given:
        named = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
        wanted = F.coalesce(F.element_at(named, F.col(name)).cast("double"), wanted)
    raw = have.select(name, wanted.alias("wanted"))
    return raw.crossJoin(F.broadcast(raw.agg(F.sum("wanted").alias("all")))).select(
        name, (F.col("wanted") / F.col("all")).alias("target"))


def raked(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, lang, topic, tokens, docs, weight, rate, missed`` for each cell of ``docs``; ``missed`` is
    the largest share by which raking still had to change a marginal in its last round.

    Null sources and languages are a value of their own (shown as ''), null texts count as empty ones.
    Cells without tokens get the rate 1.  Only sums and one error reach the driver.
    """
    cells = stored(_cells(docs).groupBy(*DIMENSIONS).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumns({"weight": F.lit(0.0), "rate": F.lit(1.0), "missed": F.lit(0.0)})
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for name in DIMENSIONS:
        now = now.join(_targets(cells, name, mix, float(total))
                       .withColumnRenamed("target", f"target_{name}"), name)
    now = stored(now.where("tokens > 0"), "raked")
    missed = float("inf")
    for _ in range(mix.rounds):
        error = F.lit(0.0)
        for name in DIMENSIONS:
            sums = now.groupBy(name).agg(F.sum("weight").alias(f"sum_{name}"))
            now = now.join(sums, name)
            step = F.col(f"target_{name}") / F.col(f"sum_{name}")
            now = now.withColumn("weight", F.col("weight") * step)
            error = F.greatest(error, F.abs(step - 1))
        now = stored(now.withColumn("error", error).drop(*[f"sum_{n}" for n in DIMENSIONS]), "raked")
        before, missed = missed, now.agg(F.max("error")).first()[0]
        if missed <= mix.tolerance or missed > 0.999 * before:
            break
        now = now.drop("error")
    now = now.withColumn("ratio", F.col("weight") * F.lit(float(total)) / F.col("tokens"))
    scale, wanted = mix.keep, mix.keep * total
    for _ in range(64):  # full cells can't give more, so the others have to
        full = F.col("ratio") * F.lit(scale) >= 1
        fixed, rest = now.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("tokens") * F.col("ratio")))).first()
        better = (wanted - fixed) / rest if rest else scale
        if better <= scale * (1 + 1e-9):
            break
        scale = better
    return cells.join(now.select(
        *DIMENSIONS, "weight", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)).alias("rate")),
        list(DIMENSIONS), "left").withColumns({
            "weight": F.coalesce("weight", F.lit(0.0)), "rate": F.coalesce("rate", F.lit(1.0)),
            "missed": F.lit(float(missed))})


def _with_rates(docs: DataFrame, mix: Mix) -> tuple[DataFrame, Column, Column]:
    """Each cell's rate, what puts a row of ``docs`` into a cell, and whether the row is drawn."""
    rates = stored(raked(docs, mix).select(
        *[F.col(n).alias(f"__mix_{n}") for n in (*DIMENSIONS, "rate", "missed")]), "rates")
    text = _column(docs, "text")
    cell = ((F.coalesce(_column(docs, "source"), F.lit("")) == rates["__mix_source"])
            & (F.coalesce(_column(docs, "lang"), F.lit("")) == rates["__mix_lang"])
            & (topic_of(text) == rates["__mix_topic"]))
    point = F.shiftrightunsigned(F.xxhash64(F.lit(mix.seed), docs["doc_id"], text), 11)
    return rates, cell, point / F.lit(float(1 << 53)) < F.col("__mix_rate")


def mixed_sample(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of ``docs`` that are drawn at their cells' rates, all columns as they are.

    Rows that repeat both id and text stay or go together.  An empty table gives no rows.
    """
    rates, cell, drawn = _with_rates(docs, mix)
    return docs.join(rates, cell & drawn, "left_semi")


def document_rates(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, source, lang, topic, rate, missed, drawn`` for each row of ``docs``; ``drawn`` rows are
    those of ``mixed_sample``, ``missed`` is what raking left of the targets."""
    rates, cell, drawn = _with_rates(docs, mix)
    return docs.join(rates, cell).select(
        docs["doc_id"], *[F.col(f"__mix_{n}").alias(n) for n in DIMENSIONS],
        F.col("__mix_rate").alias("rate"), F.col("__mix_missed").alias("missed"), drawn.alias("drawn"))
