"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and context windows.

1. A bounded sample of labelled documents gives each word its document counts by label; words and
   stems (beginnings of words) that lean to the toxic side with confidence become the lexicon.
2. The lexicon is a trie.  Each distinct word runs through it together with a Levenshtein automaton of
   distance one, so misspelled terms are found without spelling out variants; stems match as they are.
3. Each match is weighed in a window of words around it: one between quotation marks, or with a
   reporting word beside it, counts as quoted, any other as direct.
4. A logistic regression over the counts of direct, misspelled, stem and quoted matches, fitted on the
   sample, gives the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import hashed_rows, only, stored

_WORD = re.compile(r"[^\W_]+")
#: Signs that open a quotation, with those that close it; an apostrophe opens one only before a word
#: and behind none, and closes it only the other way round.
_QUOTES = {'"': '"', "“": "”", "„": "“”", "«": "»", "‹": "›", "‘": "’", "'": "'"}
_SIGNS = re.compile("[\n" + "".join(sorted(set("".join([*_QUOTES, *_QUOTES.values()])))) + "]")
_KINDS = ("direct", "misspelled", "stem", "quoted")
N_FEATURES = 6


@dataclass(frozen=True)
class Toxicity:
    """``labelled``: bound on the labelled rows that are sampled, by a hash of their ids, to learn from.
    ``support``: share of the distinct toxic texts a term is in at least, so that rare words stay out;
    ``contexts``: different words before it, for each different window of five words around it, so that
    words of one much copied and slightly varied text stay out.  ``confidence``: least lower bound of a term's log odds ratio.
    ``stem``: lengths of word beginnings that are tried as stems.  ``fuzzy_from``: shortest word that
    may be misspelled.  ``window``: words on each side of a match that are its context."""

    labelled: int = 20_000
    support: float = 0.01
    contexts: float = 0.25
    confidence: float = 2.2
    stem: tuple[int, int] = (4, 6)
    fuzzy_from: int = 5
    window: int = 6
    reporting: tuple[str, ...] = (
        "said", "says", "wrote", "quoted", "called", "quote", "reported", "sagte", "schrieb", "zitat",
        "dit", "écrit", "cité", "dijo", "escribió", "cita")
    ridge: float = 0.05


class Lexicon:
    """Terms and stems in one trie; ``match`` gives the kind and weight of a word's best match."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], fuzzy_from: int) -> None:
        self._root: dict = {}
        self._fuzzy: dict = {}
        self._fuzzy_from = fuzzy_from
        long = {t: w for t, w in terms.items() if len(t) >= fuzzy_from}
        for root, kind, entries in ((self._root, "term", terms), (self._root, "stem", stems),
                                    (self._fuzzy, "term", long)):
            for word, weight in entries.items():
                node = root
                for letter in word:
                    node = node.setdefault(letter, {})
                node[kind] = weight
        self._known: dict[str, tuple[int, float] | None] = {}

    def match(self, word: str) -> tuple[int, float] | None:
        try:
            return self._known[word]
        except KeyError:
            if len(self._known) > 400_000:
                self._known.clear()
            found = self._known[word] = self._search(word)
            return found

    def _search(self, word: str) -> tuple[int, float] | None:
        node, stem = self._root, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                break
            stem = node.get("stem", stem)
        if node is not None and "term" in node:
            return 0, node["term"]
        if stem is not None:
            return 2, stem
        if len(word) >= self._fuzzy_from:
            best = self._near(word)
            if best is not None:
                return 1, best
        return None

    def _near(self, word: str) -> float | None:
        """The highest weight of a term one insertion, deletion, substitution or swap away.

        The automaton of distance one has two kinds of states for each place in the word: no edit yet, and
        one edit made.  In the first the trie is followed along the word and all edges leave it; in the second
        only the word's own letters go on, so all such walks end soon."""
        best, node = None, self._fuzzy
        for at in range(len(word) + 1):
            here = word[at] if at < len(word) else None
            rest, swapped = word[at + 1:], word[at + 1:at + 2]
            ends = [_end(node, rest)] if here is not None else []  # a letter too many in the word
            for letter, below in node.items():
                if letter == "term":
                    continue
                if here is not None and letter != here:
                    ends.append(_end(below, rest))  # another letter
                    if letter == swapped and here in below:
                        ends.append(_end(below[here], word[at + 2:]))
                ends.append(_end(below, word[at:]))  # a letter missing in the word
            for weight in ends:
                if weight is not None and (best is None or weight > best):
                    best = weight
            node = node.get(here) if here is not None else None
            if node is None:
                break
        return best


def _end(node: dict, rest: str) -> float | None:
    for letter in rest:
        node = node.get(letter)
        if node is None:
            return None
    return node.get("term")


def quotations(text: str) -> list[tuple[int, int]]:
    """Places of the signs of all quotations that are opened and closed within a line, outer and inner."""
    found, stack = [], []

    def letter(k: int) -> bool:
        return 0 <= k < len(text) and text[k].isalnum()

    for m in _SIGNS.finditer(text):
        at, sign = m.start(), m.group()
        if sign == "\n":
            stack.clear()
            continue
        closes = [k for k, (_, opened) in enumerate(stack) if sign in _QUOTES[opened]]
        if sign in "'’" and letter(at - 1) and letter(at + 1):
            continue  # an apostrophe inside a word
        if closes and (sign != "'" or not letter(at + 1)):
            found.append((stack[closes[-1]][0], at))
            del stack[closes[-1]:]
        elif sign in _QUOTES and (sign != "'" or letter(at + 1) and not letter(at - 1)):
            stack.append((at, sign))
    return found


def features(text: str | None, lexicon: Lexicon, rule: Toxicity) -> list[float]:
    """Counts by kind (log), the highest weight of an unquoted match, and matches for each word."""
    counts, top, n_hits = [0, 0, 0, 0], 0.0, 0
    if text:
        words = _WORD.findall(text.lower())
        kinds = {w: m for w in set(words) if (m := lexicon.match(w)) is not None}
        if kinds:
            spans = [m.span() for m in _WORD.finditer(text)]
            lowered, quoted = [text[a:b].lower() for a, b in spans], sorted(quotations(text))
            for k, w in enumerate(lowered):
                if (m := kinds.get(w)) is None:
                    continue
                n_hits += 1
                lo, hi = max(0, k - rule.window), min(len(spans) - 1, k + rule.window)
                opened = quoted[bisect_left(quoted, (spans[lo][0] - 1,)):bisect_left(quoted, (spans[k][0],))]
                inside = any(spans[k][1] <= b <= spans[hi][1] for _, b in opened)
                if inside or any(x in rule.reporting for x in lowered[lo:hi + 1]):
                    counts[3] += 1
                else:
                    counts[m[0]] += 1
                    top = max(top, m[1])
        n_words = max(len(words), 1)
    else:
        n_words = 1
    return [*map(math.log1p, counts), top / 4, math.log1p(100 * n_hits / n_words)]


def _weights(p: np.ndarray, n: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Lower confidence bounds of the smoothed log odds ratios."""
    ratio = np.log((p + 0.5) / (n_toxic + 1)) - np.log((n + 0.5) / (n_clean + 1))
    return ratio - 1.64 * np.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty),
                               x.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _in_many_contexts(toxic: DataFrame, candidates: DataFrame, rule: Toxicity) -> DataFrame:
    """Of the candidates (kind, word, margin), those that follow many different words.  What only much
    copied texts have in common always follows the same one; their windows are counted once, so copies
    that differ elsewhere add nothing either."""
    low, high = rule.stem
    heads = F.expr(f"concat(array(named_struct('kind', 'term', 'head', word)), transform(filter("
                   f"sequence({low}, {high}), k -> k < length(word)), "
                   f"k -> named_struct('kind', 'stem', 'head', left(word, k))))")
    around = F.transform("words", lambda w, k: F.xxhash64(F.slice(
        "words", F.greatest(k - 1, F.lit(1)), F.least(k + 3, F.lit(5)))))
    pairs = toxic.select(F.inline(F.arrays_zip(
        F.col("words").alias("word"), F.concat(F.array(F.lit("")), F.col("words")).alias("before"),
        around.alias("around")))).where("word is not null").distinct()
    pairs = pairs.groupBy("word", "before").count()
    seen = (pairs.select("before", "count", F.inline(heads)).withColumnRenamed("head", "word")
            .join(candidates, ["kind", "word"]).groupBy("kind", "word", "margin", "before")
            .agg(F.sum("count").alias("count")))
    return seen.groupBy("kind", "word", "margin").agg(
        F.count(F.lit(1)).alias("contexts"), F.sum("count").alias("times")).where(
        f"contexts >= greatest(3, {rule.contexts} * times)")


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    stems: dict[str, float]
    weights: list[float]
    rule: Toxicity


def learn(docs: DataFrame, labels: DataFrame, rule: Toxicity = Toxicity(),
          usable: Column | None = None) -> Model:
    """Fit on at most ``rule.labelled`` labelled documents for which ``usable`` holds.

    The sample's ids (bounded) are broadcast; rows that repeat an id count once for each different text,
    within the same bound.  Word counts of the sample are summed and tested by Spark, and only the
    lexicon, which is part of the sample's words, reaches the driver.  Labels with null id or value are not used; of
    contradicting labels of one id the toxic one counts.  The lexicon comes from distinct texts: those of
    one label with the same words in the same order are one.  What clean texts count is brought to
    the number of clean rows; the regression is fitted on all rows.  Without toxic or without clean
    rows, and where no word leans with confidence, the model gives 0 to all.
    """
    known = only(labels, doc_id="bigint", toxic="int").where("doc_id is not null and toxic is not null")
    if usable is not None:
        known = known.where(usable)
    sample = hashed_rows(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), rule.labelled, "doc_id")
    sample = F.broadcast(docs.sparkSession.createDataFrame(
        [(r["doc_id"], r["toxic"]) for r in sample], "doc_id bigint, toxic int"))
    texts = stored(only(docs, doc_id="bigint", text="string").join(sample, "doc_id")
                   .where("text is not null").withColumn("tie", F.xxhash64("text"))
                   .dropDuplicates(["doc_id", "tie"]), "labelled")
    if texts.count() > rule.labelled:
        kept = hashed_rows(texts.select("doc_id", "tie"), rule.labelled, "doc_id", "tie")
        kept = docs.sparkSession.createDataFrame([(r["doc_id"], r["tie"]) for r in kept], "doc_id bigint, tie bigint")
        texts = stored(texts.join(F.broadcast(kept), ["doc_id", "tie"], "left_semi"), "labelled")
    texts = texts.select("toxic", "text")
    totals = dict(texts.groupBy("toxic").count().collect())
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, {}, [-30.0] + [0.0] * N_FEATURES, rule)
    distinct = stored(texts.select("toxic", F.regexp_extract_all(
        F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words"))
        .withColumn("hash", F.xxhash64("words")).dropDuplicates(["toxic", "hash"]), "distinct")
    once = dict(distinct.groupBy("toxic").count().collect())
    n_toxic, copied = once[1], n_clean / once[0]
    words = distinct.select("toxic", F.explode(F.array_distinct("words")).alias("word"))
    counts = words.groupBy("word").agg(
        F.sum("toxic").alias("p"), ((F.count(F.lit(1)) - F.sum("toxic")) * copied).alias("n"))
    counts = stored(counts, "word-counts")
    support = max(3, math.ceil(rule.support * n_toxic))
    lean = f"p >= {support} and p * {n_clean} > 4 * n * {n_toxic}"
    low, high = rule.stem
    stem_counts = counts.select("p", "n", F.explode(F.expr(
        f"transform(filter(sequence({low}, {high}), k -> k < length(word)), k -> left(word, k))"))
        .alias("word")).groupBy("word").agg(F.sum("p").alias("p"), F.sum("n").alias("n"),
                                            F.count(F.lit(1)).alias("forms"))

    def leaning(found: DataFrame, kind: str, extra: str) -> DataFrame:
        margin = (F.log((F.col("p") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") + 0.5) / (n_clean + 1))
                  - 1.64 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5)))
        return (found.where(lean).withColumn("margin", margin).where(F.col("margin") >= rule.confidence)
                .where(extra).select(F.lit(kind).alias("kind"), "word", "margin"))

    candidates = stored(leaning(counts, "term", "length(word) >= 3").unionByName(
        leaning(stem_counts, "stem", "forms >= 3")), "candidates")
    varied = stored(_in_many_contexts(distinct.where("toxic = 1"), candidates, rule), "varied")

    def chosen(kind: str) -> dict[str, float]:
        rows = varied.where(F.col("kind") == kind).select("word", "margin").collect()
        return {r["word"]: float(r["margin"]) for r in rows}

    terms, stems = chosen("term"), chosen("stem")
    stems = {s: w for s, w in stems.items() if not any(s[:k] in stems for k in range(low, len(s)))}
    terms = {t: w for t, w in terms.items() if not any(t[:k] in stems for k in range(low, len(t)))}

    if not terms and not stems:
        return Model({}, {}, [-30.0] + [0.0] * N_FEATURES, rule)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, stems, rule.fuzzy_from)
        for batch in batches:
            found = [features(t.as_py(), lexicon, rule) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = texts.select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
    weights = [float(w) for w in _fit(x, y, rule.ridge)]
    weights[0] = min(weights[0], -1.0)  # a text without any match is never called toxic
    return Model(terms, stems, weights, rule)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, direct, misspelled, stem, quoted`` for each row of ``docs``.

    Only the text is judged.  Null and empty texts get the score of a text without matches; rows that
    repeat an id are judged each by itself; a null id stays null.  Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms, model.stems, model.rule.fuzzy_from)
        weights = np.array(model.weights)
        for batch in batches:
            x = np.array([features(t.as_py(), lexicon, model.rule) for t in batch.column(1)])
            x = x.reshape(batch.num_rows, N_FEATURES)
            score = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            found = np.rint(np.expm1(x[:, :4])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                 *[pa.array(found[:, k]) for k in range(4)]],
                names=["doc_id", "score", "predicted", *_KINDS])

    return only(docs, doc_id="bigint", text="string").mapInArrow(
        run, "doc_id bigint, score double, predicted int, "
        + ", ".join(f"{k} bigint" for k in _KINDS))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are, judged in place."""
    names = [f.name for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms, model.stems, model.rule.fuzzy_from)
        weights, at = np.array(model.weights), [n.lower() for n in names].index("text")
        for batch in batches:
            x = np.array([features(t.as_py(), lexicon, model.rule) for t in batch.column(at)])
            yield batch.filter(pa.array(weights[0] + x.reshape(-1, N_FEATURES) @ weights[1:] < 0))

    return docs.mapInArrow(run, docs.schema)
