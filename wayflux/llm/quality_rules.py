"""Quality rules learnt as a decision list: ordered conjunctions of thresholds.

DataFrame functions only.  Statistics of whole texts are stored once as narrow rows.  Sequential covering
then learns from the labelled ones: a rule grows by the threshold of the highest information gain until it
covers no good text, loses the last conditions that a second part of the rows does not confirm, and
takes the rows that it covers out of the game.  Each step is one grouped count by statistic and bin, so what
reaches the driver is a row for each bin.  The list becomes one chain of ``when``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import only, stored

#: Fixed: white space between words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What rules may look at, in the order that ties are decided in.
STATISTICS = ("n_words", "word_length", "symbols", "shouting", "capitals", "digits", "bars", "dup_lines",
              "repeats", "distinct_words", "line_words", "open_lines")


@dataclass(frozen=True)
class Condition:
    """A statistic that reaches a threshold, or stays below it."""

    name: str
    at_least: bool
    value: float

    def column(self) -> Column:
        return F.col(self.name) >= self.value if self.at_least else F.col(self.name) < self.value

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<'} {self.value:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """The first rule whose conditions all hold names a text as bad; a text that none fits is good."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def first(self) -> Column:
        """Number of the first rule that fits, from 0; null for none."""
        found = None
        for k, rule in enumerate(self.rules):
            holds = _all(rule)
            found = F.when(holds, k) if found is None else found.when(holds, k)
        return F.lit(None).cast("int") if found is None else found

    def text(self) -> Column:
        """The first rule that fits, in words; null for none."""
        found = None
        for rule in self.rules:
            words = F.lit(" and ".join(map(str, rule)))
            found = F.when(_all(rule), words) if found is None else found.when(_all(rule), words)
        return F.lit(None).cast("string") if found is None else found


@dataclass(frozen=True)
class Covering:
    """``labelled``: about so many labelled rows are learnt from, taken by a hash of their ids.
    ``cuts``: thresholds of a statistic and label.  ``prune_share``: of the rows that judge a rule.
    ``precision``: least share of bad texts among those that a rule covers, in both parts.
    ``support``: least number of bad texts that a rule covers."""

    labelled: int = 50_000
    cuts: int = 24
    prune_share: float = 0.33
    precision: float = 0.9
    support: int = 3


def _all(rule: Sequence[Condition]) -> Column:
    holds = F.lit(True)
    for condition in rule:
        holds = holds & condition.column()
    return holds


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` that occur twice or more.

    Windows are told apart by 64-bit hashes of their words.  Only texts with an equal pair sort theirs.
    """
    last = F.size(words) - WINDOW
    hashes = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW))))

    def covered(places: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(1), F.size(places) - 1), lambda k: F.least(
            F.lit(WINDOW), F.get(places, k) - F.get(places, k - 1)))
        return F.aggregate(gaps, F.lit(WINDOW), lambda a, g: a + g)

    def places(ordered: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["h"] == F.get(ordered, other)["h"], F.lit(False))

        twice = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                         lambda k: same(k, k - 1) | same(k, k + 1))
        return F.sort_array(F.transform(twice, lambda k: F.get(ordered, k)["at"]))

    def counted(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h),
                      _let(ordered, lambda o: _let(places(o), covered))).otherwise(0)

    return F.coalesce(_let(hashes, counted), F.lit(0)).cast("bigint")


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts and the statistics of each row of ``docs``.

    A null or empty text counts as one without words; shares of nothing are 0.  Statistics: characters a
    word, symbols a word, exclamation marks a word, capitals and digits (ASCII) among the characters of
    words, vertical bars a word, repeated lines among lines with words, repeated words, distinct words
    among words, words a line, and lines that end without a sentence sign.
    """
    text = F.coalesce("text", F.lit(""))
    # One pass turns all characters of a class into one, so that counting a class is a plain replacement.
    classes = F.translate(text, _SYMBOLS + _CAPITALS + _DIGITS,
                          "#" * len(_SYMBOLS) + "A" * len(_CAPITALS) + "0" * len(_DIGITS))
    cut = only(docs, doc_id="bigint", text="string").select(
        "doc_id", text.alias("text"), classes.alias("classes"), F.array_remove(F.split(text, SPACE, -1), "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))

    def times(sign: str, of: str = "classes") -> Column:
        return (F.length(of) - F.length(F.replace(F.col(of), F.lit(sign), F.lit("")))).cast("bigint")

    counted = cut.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"), times("#").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("words")).alias("n_distinct"),
        times("!", "text").alias("n_shouts"), times("A").alias("n_capitals"), times("0").alias("n_digits"),
        times("|", "text").alias("n_bars"),
        F.size(F.filter("lines", lambda x: ~x.rlike(r"[.!?:;\"')\x{2026}\x{201D}][\x20\x09-\x0D]*$"))).alias("n_open"))

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return counted.select(
        "doc_id", *COUNTS, share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "n_words").alias("symbols"), share("n_shouts", "n_words").alias("shouting"),
        share("n_capitals", "word_chars").alias("capitals"), share("n_digits", "word_chars").alias("digits"),
        share("n_bars", "n_words").alias("bars"), share("n_dup_lines", "n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
        share("n_distinct", "n_words").alias("distinct_words"), share("n_words", "n_lines").alias("line_words"),
        share("n_open", "n_lines").alias("open_lines"))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _bins(cuts: dict[str, list[float]]) -> Column:
    """The number of thresholds that each statistic reaches, as one array."""
    def reached(name: str) -> Column:
        total = F.lit(0)
        for value in cuts[name]:
            total = total + (F.col(name) >= value).cast("int")
        return total

    return F.array(*[reached(name) for name in STATISTICS])


def _cuts(rows: DataFrame, rule: Covering) -> dict[str, list[float]]:
    """Thresholds: quantiles of every statistic among good and among bad texts."""
    parts = [(k + 0.5) / rule.cuts for k in range(rule.cuts)]
    found = rows.groupBy("bad").agg(*[
        F.percentile(name, F.array(*map(F.lit, parts))).alias(name) for name in STATISTICS]).collect()
    return {name: sorted({float(v) for row in found for v in row[name]}) for name in STATISTICS}


def labelled_rows(stats: DataFrame, labels: DataFrame, rule: Covering, usable: Column | None) -> DataFrame:
    """Statistics with ``bad`` and ``judge``: rows that the base rules keep, at most about
    ``rule.labelled`` of them, the same statistics and label once.

    A text is bad when any label of its id says quality 0.  Rows without an id or a label are not used.
    The sample holds the ids whose hash is below a bound that follows from the number of labels.
    """
    marks = only(labels, doc_id="bigint", quality="int").where(F.col("quality").isin(0, 1)).where(
        F.lit(True) if usable is None else usable).groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    have = marks.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    taken = marks.where(draw < rule.labelled / max(have, 1))
    rows = stats.where(~base_failed()).join(taken, "doc_id")
    return rows.select(*STATISTICS, "bad").distinct().withColumn("judge", F.pmod(
        F.xxhash64(F.lit(7), *STATISTICS), F.lit(1000)) < int(1000 * rule.prune_share))


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """Information gain of a rule that covered (bad, good) texts ``before`` and ``after`` a condition."""
    if not after[0]:
        return 0.0
    return after[0] * (math.log2(after[0] / sum(after)) - math.log2(before[0] / sum(before)))


def _grown(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    """Conditions in the order they were added, each of the highest gain on ``rows``."""
    rule: list[Condition] = []
    while True:
        table = rows.where(_all(rule)).select("bad", F.posexplode("bins").alias("k", "bin")).groupBy("k", "bin").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
        of: dict[int, dict[int, tuple[int, int]]] = {}
        for r in table:
            of.setdefault(r["k"], {})[r["bin"]] = (r["bad"], r["good"])
        if not of:
            return rule
        now = tuple(sum(c[i] for c in of[0].values()) for i in (0, 1))
        if not now[0] or not now[1]:
            return rule
        best, gained = None, 1e-9
        for k, name in enumerate(STATISTICS):
            below = [0, 0]
            for j, value in enumerate(cuts[name]):
                cell = of[k].get(j, (0, 0))
                below = [below[0] + cell[0], below[1] + cell[1]]
                above = (now[0] - below[0], now[1] - below[1])
                for at_least, part in ((True, above), (False, tuple(below))):
                    gain = _gain(now, part)
                    if gain > gained:
                        best, gained = Condition(name, at_least, value), gain
        if best is None:
            return rule
        rule.append(best)


def _pruned(rule: list[Condition], judges: DataFrame) -> list[Condition]:
    """The beginning of ``rule`` with the best balance of bad and good texts among the judges; the
    whole rule where they cannot tell."""
    sums = judges.agg(*[F.count_if(_all(rule[:k]) & (F.col("bad") == bad)).alias(f"{name}{k}")
                        for k in range(1, len(rule) + 1) for name, bad in (("bad", True), ("good", False))]).first()
    best, worth = rule, -2.0
    for k in range(len(rule), 0, -1):
        p, n = sums[f"bad{k}"], sums[f"good{k}"]
        if p + n and (p - n) / (p + n) > worth:
            best, worth = rule[:k], (p - n) / (p + n)
    return best


def learn_rules(stats: DataFrame, labels: DataFrame, rule: Covering = Covering(),
                usable: Column | None = None) -> DecisionList:
    """A decision list from the statistics of texts and ``labels`` (``doc_id, quality``).

    Without a bad or without a good labelled text the list is empty.  Covering ends when the next rule covers
    too few bad texts or is too often wrong.
    """
    rows = stored(labelled_rows(stats, labels, rule, usable), "quality-labelled")
    cuts = _cuts(rows, rule)
    if not all(cuts.values()):
        return DecisionList()
    left = stored(rows.withColumn("bins", _bins(cuts)), "quality-bins")
    found: list[tuple[Condition, ...]] = []
    while True:
        grown = _grown(left.where(~F.col("judge")), cuts)
        if not grown:
            break
        grown = _pruned(grown, left.where(F.col("judge")))
        hit = left.where(_all(grown)).groupBy("judge").agg(
            F.count_if("bad").alias("bad"), F.count("*").alias("n")).collect()
        enough = sum(r["bad"] for r in hit) >= rule.support
        if not enough or any(r["bad"] < rule.precision * r["n"] for r in hit):
            break
        found.append(tuple(grown))
        left = left.where(~_all(grown))
    return DecisionList(tuple(found))


def quality_report(docs: DataFrame, labels: DataFrame, rule: Covering = Covering(),
                   usable: Column | None = None) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule``
    for each row of ``docs``; ``rule`` is the learnt rule that takes the text out, else null.

    Rows that repeat an id are judged each by its own text.  Texts that the base rules fail are not kept
    whatever the list says.  Other columns are not read; an empty table gives no rows.
    """
    stats = stored(text_statistics(docs), "quality-statistics")
    learnt = learn_rules(stats, labels, rule, usable)
    return stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"),
                        (~base_failed() & learnt.first().isNull()).alias("kept"),
                        F.when(~base_failed(), learnt.text()).alias("rule"))
