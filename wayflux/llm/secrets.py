"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

DataFrame functions only.  Splitting a text by a pattern and extracting the same pattern give pieces and
matches in turn, so running sums of their lengths are the places of the matches (code points).
A candidate string is a run of token characters.  A window slides over it and the Shannon entropy of
its characters is carried along by counts: one character enters, one leaves, and only their two
terms of sum(c log c) change.  Each character class has its own threshold, and strings that the
allow-list knows are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import only

#: Kinds in the order that ties are listed in: pattern, group whose length counts, least length.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}

#: A word of one case or capitalised, or several capitalised ones of three letters or more in one.
_WORD = "(?:[a-z]*(?:[A-Z][a-z]{2,})++|[A-Z]?[a-z]+|[A-Z]+)"


@dataclass(frozen=True)
class Entropy:
    """Windows of ``window`` characters; the least entropy in bits a character by class of the string:
    ``hex`` digits only, ``mixed`` letters and digits (and base64 signs), ``letters`` without a digit.
    Strings of fewer than ``least`` characters are words to this scan.  ``allow``: patterns of harmless strings."""

    window: int = 20
    least: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.6
    letters_bits: float = 3.8
    allow: tuple[str, ...] = (
        r"^[0-9]+$", r"^(.)\1+$", r"(?i)example|sample|dummy|placeholder|changeme",
        r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
        rf"^[-_/=+]*{_WORD}?(?:[-_/=+]+{_WORD})*+[-_/=+]*$",
        rf"^[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}(?:[-_/=+]+{_WORD})*+$")


def _spans(text: str, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """All matches of one kind as structs (start, rank, end, kind, value), failing ones dropped."""
    texts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = texts if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    walked = F.aggregate(
        F.arrays_zip(texts.alias("t"), values.alias("v"), pieces.alias("p")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, m: F.struct(
            (a["at"] + F.length(m["p"]) + F.coalesce(F.length(m["t"]), F.lit(0))).alias("at"),
            F.when(F.length(m["v"]) >= least, F.concat(a["out"], F.array(F.struct(
                (a["at"] + F.length(m["p"])).alias("start"), F.lit(rank).alias("rank"),
                (a["at"] + F.length(m["p"]) + F.length(m["t"])).alias("end"),
                F.lit(kind).alias("kind"), m["v"].alias("value"))))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(F.size(texts) > 0, walked).otherwise(empty)


def max_entropy(value: Column, window: int) -> Column:
    """The highest entropy, in bits a character, of ``window`` consecutive characters of ``value`` (of
    all of it where it is shorter).

    The sum of c log c is carried along: only the terms of the character that enters and of the one that
    leaves change.  How often these two stand in the window is read off its ``window`` characters.
    """
    chars = F.split(value, "")

    def term(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    def step(a: Column, c: Column) -> Column:
        had = F.length(a["seen"]) - F.length(F.replace(a["seen"], c, F.lit("")))
        sum_in = a["sum"] + term(had + 1) - term(had)
        seen_in = F.concat(a["seen"], c)
        first = F.left(seen_in, F.lit(1))
        full = F.length(seen_in) > window
        left = F.length(seen_in) - F.length(F.replace(seen_in, first, F.lit("")))
        total = F.when(full, sum_in - term(left) + term(left - 1)).otherwise(sum_in)
        seen = F.when(full, F.substring(seen_in, 2, window)).otherwise(seen_in)
        n = F.length(seen).cast("double")
        bits = F.when(n >= F.least(F.lit(window), F.length(value)), F.log2(n) - total / n).otherwise(0.0)
        return F.struct(seen.alias("seen"), total.alias("sum"), F.greatest(a["best"], bits).alias("best"))

    return F.aggregate(
        chars, F.struct(F.lit("").alias("seen"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")),
        step, lambda a: a["best"])


def _entropy_spans(text: str, rule: Entropy) -> Column:
    strings = _spans(text, "entropy", len(BASE), rf"[A-Za-z0-9+/_=-]{{{rule.least},}}", 0, rule.least)

    def suspicious(s: Column) -> Column:
        value = s["value"]
        harmless = F.lit(False)
        for pattern in rule.allow:
            harmless = harmless | value.rlike(pattern)
        bits = max_entropy(value, rule.window)
        least = F.when(value.rlike("^[0-9a-fA-F]+$"), rule.hex_bits).when(
            value.rlike("[0-9]"), rule.mixed_bits).otherwise(rule.letters_bits)
        return F.when(harmless, False).otherwise(bits >= least)

    return F.filter(strings, suspicious)


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_spans(docs: DataFrame, rule: Entropy = Entropy()) -> DataFrame:
    """``doc_id, base, added`` for each row of ``docs``: matches of the patterns and strings of high
    entropy outside them, as arrays of (start, rank, end, kind, value) by start, then kind.

    Null and empty texts have none.  Texts that repeat give the same spans.  Other columns are not
    read; an empty table gives no rows.
    """
    rows = only(docs, doc_id="bigint", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("doc_id", *[
        _spans("text", kind, k, *how).alias(kind) for k, (kind, how) in enumerate(BASE.items())],
        _entropy_spans("text", rule).alias("entropy"))
    joined = found.select("doc_id", F.array_sort(F.concat(*BASE)).alias("base"), "entropy")
    return joined.select("doc_id", "base", F.filter("entropy", lambda e: ~F.exists(
        "base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))).alias("added"))


def secret_report(docs: DataFrame, rule: Entropy = Entropy()) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy`` for each row of ``docs``."""
    found = secret_spans(docs, rule)
    counts = [F.aggregate("base", F.lit(0).cast("bigint"),
                          lambda n, s: n + (s["rank"] == rank).cast("bigint")).alias(f"n_{kind}")
              for rank, kind in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_entropy"))
