"""Spelling variants: words that differ in one code point, grouped under the most frequent form.

Pairs are found by pivotal grams.  All bigrams have one global order, the rarest first.  The prefix of
a word is its first three bigrams in that order, and two of these that do not overlap are its pivots, the
rarest two by dynamic programming over positions.  One edit spoils at most one of two disjoint
bigrams.  So of two words within one edit, the one whose prefix ends earlier in the order has a pivot that
the other still holds, at the same place or one further, and holds it in its own prefix.

What lies on one side of a kept bigram is untouched by the edit, and so is one half of the other side.
The side, where it is short with such a half, is part of the join key, so common endings and beginnings
do not meet all at once, and each candidate is then verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayflux.llm.common import ascii_lower, only, stored

#: Fixed: letters of which words consist.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
_PREFIX = 3  # one edit with bigrams: 2 * 1 + 1
#: Kept sides of at most so many code points are shared by too many words to be a key alone.
_SHORT = 4
_FAR = 1 << 60


def word_counts(docs: DataFrame, least_chars: int = 5, least_count: int = 3,
                typo_every: int | None = None) -> DataFrame:
    """``word, n``: runs of letters of all texts in lower case (A-Z only) and how often they occur.

    Words of fewer than ``least_chars`` code points or ``least_count`` occurrences are left out.  With
    ``typo_every`` one in so many occurrences loses a code point first: those where it divides the
    crc32 of ``doc_id:word``, at place crc32 % length.  Null texts have no words; a null id reads as
    an empty one.  Counts combine before the shuffle, so a frequent word is a row for each task.
    """
    rows = only(docs, doc_id="bigint", text="string")
    words = rows.select("doc_id", F.explode(F.regexp_extract_all(
        ascii_lower("text"), F.lit(LETTERS), F.lit(0))).alias("word"))
    if typo_every:
        h, size = F.col("h"), F.length("word")
        at = (h % size).cast("int")
        words = words.withColumn("h", F.crc32(F.concat(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word"))).select(
            F.when(h % typo_every == 0, F.concat(
                F.left(F.col("word"), at), F.substring(F.col("word"), at + 2, size)))
            .otherwise(F.col("word")).alias("word"))
    return (words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def _grams(words: DataFrame) -> DataFrame:
    """``word, size, at, gram`` for each bigram, places from 0."""
    size = F.length("word")
    return words.select("word", size.alias("size"), F.explode(
        F.sequence(F.lit(0), size - 2)).alias("at")).withColumn(
        "gram", F.substring(F.col("word"), F.col("at") + 1, F.lit(2)))


def _pivots(prefix: Column) -> Column:
    """The two disjoint bigrams of ``prefix`` (sorted by place) whose ranks have the least sum.

    A fold over places carries the cheapest pair so far, the cheapest bigram before the last one and the
    last one itself, which only the next place can overlap.
    """
    gram = "struct<at:int,rank:int>"
    nothing = F.lit(None).cast(gram)

    def rank(g: Column) -> Column:
        return F.coalesce(g["rank"].cast("bigint"), F.lit(_FAR))

    def cheaper(a: Column, b: Column) -> Column:
        return F.when(rank(b) < rank(a), b).otherwise(a)

    def step(state: Column, g: Column) -> Column:
        free = F.when(state["last"]["at"] <= g["at"] - 2, cheaper(state["one"], state["last"])).otherwise(
            state["one"])
        better = free.isNotNull() & (rank(free) + rank(g) < state["cost"])
        return F.struct(
            F.when(better, F.array(free, g)).otherwise(state["two"]).alias("two"),
            F.when(better, rank(free) + rank(g)).otherwise(state["cost"]).alias("cost"),
            cheaper(state["one"], state["last"]).alias("one"), g.alias("last"))

    start = F.struct(F.array().cast(f"array<{gram}>").alias("two"), F.lit(2 * _FAR).alias("cost"),
                     nothing.alias("one"), nothing.alias("last"))
    return F.aggregate(prefix, start, step, lambda s: s["two"])


def gram_prefixes(words: DataFrame) -> DataFrame:
    """``word, size, prefix, pivots, last``: bigrams as (at, rank), and the rank that ends the prefix.

    A bigram's rank is its place in the order by frequency, then text.  The prefix is the first three
    bigrams and, where the third occurs again in the word, its other places too.
    """
    grams = _grams(words)
    counts = grams.groupBy("gram").agg(F.count("*").alias("times"))
    # Two of 90 letters: at most 8,100 rows, so one task can order them and each task can hold them.
    order = F.broadcast(counts.select("gram", F.row_number().over(
        Window.orderBy("times", "gram")).cast("bigint").alias("rank")))
    listed = grams.join(order, "gram").groupBy("word", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").cast("int").alias("rank"), "at"))).alias("grams"))
    last = F.element_at("grams", _PREFIX)["rank"]
    return listed.withColumn("last", last).select(
        "word", "size", "last", F.sort_array(F.transform(
            F.filter("grams", lambda g: g["rank"] <= F.col("last")),
            lambda g: F.struct(g["at"].alias("at"), g["rank"].alias("rank")))).alias("prefix")).withColumn(
        "pivots", _pivots(F.col("prefix")))


def _keys(words: DataFrame, grams: str, pivot: bool) -> DataFrame:
    """``word, last, key`` for each bigram of the column ``grams``, each side of it, and each size that a
    word within one edit may have.

    The key is a hash of the bigram with all that lies on its untouched side, and the size of the word that
    holds it in its prefix.  Where this is short, half of the other side belongs to it as well: that
    side is cut in the middle of the pivot's word, and one of its halves is untouched too.
    """
    word, at, size = F.col("word"), F.col("g.at"), F.col("size")
    cut = words.select("word", "last", "size", F.explode(grams).alias("g")).select(
        "word", "last", "size", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.left(word, at + 2).alias("kept"), F.substring(word, at + 3, size).alias("rest")),
            F.struct(F.lit(1).alias("side"), F.substring(word, at + 1, size).alias("kept"), F.left(word, at).alias("rest")))).alias("x"))
    side, kept, rest = F.col("x.side"), F.col("x.kept"), F.col("x.rest")

    def keys(longer: int) -> Column:
        """For words of which the one with the prefix is ``longer`` by so many code points."""
        goal = size + longer if pivot else size
        chars = F.length(rest) if pivot else F.length(rest) - longer
        half = F.floor(chars / 2).cast("int")
        return F.when(F.length(kept) > _SHORT, F.array(F.xxhash64(side, kept, goal))).otherwise(F.array(
            F.xxhash64(side, kept, goal, F.lit(0), F.left(rest, half)),
            F.xxhash64(side, kept, goal, F.lit(1), F.right(rest, chars - half))))

    return cut.select("word", "last", F.explode(F.array_distinct(
        F.concat(*[keys(longer) for longer in (-1, 0, 1)]))).alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: all pairs of different words within one inserted, deleted or replaced code point, in
    both directions.  ``words`` has distinct words of at least five code points in ``word``."""
    known = stored(gram_prefixes(words.select("word")), "spelling-grams")
    pivots = _keys(known, "pivots", True).select("key", F.col("word").alias("a"), F.col("last").alias("a_last"))
    prefixes = _keys(known, "prefix", False).select("key", F.col("word").alias("b"), F.col("last").alias("b_last"))
    met = pivots.join(prefixes, "key").where(
        (F.col("a") != F.col("b")) & (F.col("a_last") <= F.col("b_last"))
        & (F.levenshtein("a", "b", 1) == 1))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each word with a form: links are doubled until none leads further.

    Counts at least double from a word to its form, so there are no cycles and a few rounds do.
    """
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        further = stored(links.join(links.select(F.col("word").alias("root"), F.col("root").alias("next")),
                                    "root", "left"), "spelling-links")
        links = further.select("word", F.coalesce("next", "root").alias("root"))
        if further.where(F.col("next").isNotNull()).isEmpty():
            return links


def spelling_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (``word, n``; distinct words of at
    least five code points).

    ``form`` is the near word of the largest count, ties by code points, if it is at least twice the
    word's own, else null; ``root`` is where forms lead in the end.  No words give no rows.
    """
    words = stored(words, "spelling-words")
    counted = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("top.less") >= 2 * F.col("n"), F.col("top.near")).alias("form"),
        F.when(-F.col("top.less") >= 2 * F.col("n"), -F.col("top.less")).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame, typo_every: int | None = 97) -> DataFrame:
    """Variants of all words of ``docs``; see ``word_counts`` and ``spelling_groups``.

    Other columns are not read; an empty table gives no rows.
    """
    return spelling_groups(word_counts(docs, typo_every=typo_every))
