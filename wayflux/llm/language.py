"""Language identification of pages by Bayesian evidence fusion.

The text gives likelihoods: character trigrams under a multinomial model for each language, learnt
from labelled documents.  Three more pieces of evidence are counted over all pages by grouped
aggregation, against the language that the text alone suggests: the language that the markup declares,
the language that the address ends in or names, and the host.  Declared and address evidence become
likelihood tables; the host becomes the prior, smoothed from host to registered domain to all pages.
Their logarithms add up to the posterior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import hashed_rows, only, stored
from wayflux.llm.reputation import ascii_lower_host, levels, path_of

_TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_ENTITY = re.compile(r"&#?\w+;")
_NOT_LETTERS = re.compile(r"[^\w]+|[\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """``labelled``: bound on the labelled documents, by a hash of their ids, that likelihoods are
    learnt from.  ``least``: occurrences in the sample that a trigram needs to be kept.  ``smoothing``:
    added to all counts.  ``prior``: pages that a level's parent is worth.  ``strength``: the share of the text's
    log likelihood that counts, since neighbouring trigrams are not independent, and its bound."""

    labelled: int = 20_000
    least: int = 2
    smoothing: float = 0.5
    prior: float = 20.0
    strength: float = 0.2
    text_bound: float = 25.0


def visible(html: str | None) -> str:
    """The text of a page without tags, scripts, styles, comments and entities."""
    return _ENTITY.sub(" ", _TAGS.sub(" ", html or ""))


def trigrams(text: str) -> Counter:
    words = _NOT_LETTERS.sub(" ", text.lower()).split()
    found: Counter = Counter()
    for word, n in Counter(words).items():
        padded = f" {word} "
        for k in range(len(padded) - 2):
            found[padded[k:k + 3]] += n
    return found


def learn_grams(docs: DataFrame, model: LanguageModel = LanguageModel()) -> dict[str, dict[str, float]]:
    """Log probabilities of trigrams for each language of ``docs`` (doc_id, text, lang).

    Counted by Spark on the bounded sample (rows that repeat an id add one text for each different one,
    within the same bound; rows without an id add none); languages are the values of ``lang``, null ones left out.
    """
    sample = only(docs, doc_id="bigint", text="string", lang="string").where(
        "lang is not null and text is not null")
    sample = sample.withColumn("tie", F.xxhash64("lang", "text")).where("doc_id is not null")
    ids = hashed_rows(sample.select("doc_id", "tie").distinct(), model.labelled, "doc_id", "tie")
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["tie"]) for r in ids], "doc_id bigint, tie bigint")
    picked = sample.join(F.broadcast(ids), ["doc_id", "tie"], "left_semi").dropDuplicates(
        ["doc_id", "tie"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(lang, Counter()).update(trigrams(text.as_py()))
            rows = [(x, g, n) for x, c in sums.items() for g, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["lang", "gram", "n"])

    counts = picked.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    kinds = counts.select("gram").distinct().count()
    totals = {r[0]: float(r[1]) for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    top = counts.where(F.col("n") >= model.least).collect()
    out: dict[str, dict[str, float]] = {}
    for lang, total in totals.items():
        bottom = math.log(total + model.smoothing * kinds)
        out[lang] = {"": math.log(model.smoothing) - bottom}
        out[lang] |= {r["gram"]: math.log(r["n"] + model.smoothing) - bottom for r in top if r["lang"] == lang}
    return out


def _text_scores(langs: list[str], grams: dict[str, dict[str, float]], model: LanguageModel):
    rows = {g: np.array([grams[x].get(g, grams[x][""]) for x in langs])
            for g in sorted(set().union(*(grams[x] for x in langs)) - {""})} if langs else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html in batch.column(3):
                score = np.zeros(len(langs))
                for g, n in trigrams(visible(html.as_py())).items():
                    if g in rows:
                        score += n * rows[g]
                score = (score - score.max(initial=-np.inf)) * model.strength if len(langs) else score
                out.append(np.maximum(score, -model.text_bound))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.float64()))],
                names=["page_id", "host", "hint", "text_score"])
    return run


def declared_language(html: str) -> Column:
    """The primary language tag of the html element, lower-cased; empty where none is declared."""
    return F.coalesce(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)), F.lit(""))


def address_language(url: str) -> Column:
    """A language named by the first path segment, else the host's top-level domain; else empty."""
    return F.coalesce(F.lower(F.coalesce(
        F.nullif(F.regexp_extract(path_of(url), r"^/([A-Za-z]{2})(/|$)", 1), F.lit("")),
        F.nullif(F.regexp_extract(ascii_lower_host(url), r"\.([a-z]{2,})$", 1), F.lit("")))), F.lit(""))


def page_languages(pages: DataFrame, docs: DataFrame, model: LanguageModel = LanguageModel()) -> DataFrame:
    """``page_id, lang, posterior, text_lang, declared, address`` for each row of ``pages``
    (page_id, url, html).

    Null and empty pages are decided by the other evidence; null urls have the empty host.  Ties go to
    the language first in the alphabet.  Without labelled documents the language is null.  Repeated
    rows are each judged; other columns are not read; an empty table gives no rows.
    """
    grams = learn_grams(docs, model)
    langs = sorted(grams)
    rows = only(pages, page_id="bigint", url="string", html="string").select(
        "page_id", ascii_lower_host("url").alias("host"), F.struct(
            declared_language("html").alias("declared"), address_language("url").alias("address")).alias("hint"),
        "html")
    scored = rows.mapInArrow(
        _text_scores(langs, grams, model),
        "page_id bigint, host string, hint struct<declared:string,address:string>, text_score array<double>")
    if not langs:
        nothing = F.lit(None)
        return scored.select("page_id", nothing.cast("string").alias("lang"), nothing.cast("double").alias("posterior"),
                             nothing.cast("string").alias("text_lang"), "hint.declared", "hint.address")
    names = F.array(*map(F.lit, langs))
    best = F.array_position("text_score", F.array_max("text_score")).cast("int")
    domain, _ = levels("host", ())
    pages_scored = stored(scored.select(
        "page_id", "host", "hint.declared", "hint.address", "text_score",
        F.element_at(names, best).alias("text_lang")).withColumn("domain", domain), "languages")

    counted = [F.sum((F.col("text_lang") == x).cast("double")).alias(f"c_{k}") for k, x in enumerate(langs)]
    cs = [F.col(f"c_{k}") for k in range(len(langs))]
    totals = [float(x or 0) for x in pages_scored.agg(*counted).first()]
    n_all = sum(totals)
    overall = [(t + 1) / (n_all + len(langs)) for t in totals]

    def evidence(name: str) -> DataFrame:
        """Log likelihood of each value of the evidence under each language; none declared says nothing."""
        values = pages_scored.where(F.col(name) != "").groupBy(name).agg(*counted)
        sums = values.agg(F.count(F.lit(1)), *[F.sum(c) for c in cs]).first()
        kinds, sums = float(sums[0]), [float(s or 0) for s in sums[1:]]
        return values.select(F.col(name).alias(f"{name}_value"), F.array(*[
            F.log((c + model.smoothing) / (s + model.smoothing * (kinds + 1))) for c, s in zip(cs, sums)])
            .alias(f"{name}_score"))

    hosts = pages_scored.groupBy("host").agg(F.first("domain").alias("domain"), *counted)
    domains = hosts.groupBy("domain").agg(*[F.sum(c).alias(f"c_{k}") for k, c in enumerate(cs)])
    size = sum(cs[1:], cs[0])
    priors = domains.select("domain", F.array(*[
        (c + model.prior * p) / (size + model.prior) for c, p in zip(cs, overall)]).alias("p"))
    host_prior = hosts.join(priors, "domain").select(F.col("host").alias("host_value"), F.array(*[
        F.log((c + model.prior * F.get("p", F.lit(k))) / (size + model.prior)) for k, c in enumerate(cs)])
        .alias("host_score"))

    flat = F.array(*[F.lit(0.0)] * len(langs))
    joined = pages_scored
    for name, side in (("declared", evidence("declared")), ("address", evidence("address")), ("host", host_prior)):
        joined = joined.join(side, F.col(name) == F.col(f"{name}_value"), "left")
    total = F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), lambda k: sum(
        (F.get(F.coalesce(c, flat), k) for c in ("declared_score", "address_score", "host_score")),
        F.get("text_score", k)))
    judged = joined.select("page_id", "text_lang", "declared", "address", total.alias("total"))
    top = F.array_max("total")
    mass = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return judged.select("page_id", F.element_at(names, F.array_position("total", top).cast("int")).alias("lang"),
                         (1 / mass).alias("posterior"), "text_lang", "declared", "address")
