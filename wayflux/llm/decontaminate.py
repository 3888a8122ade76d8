"""Benchmark decontamination as a prefix-filtered set join, DataFrame functions only.

An item becomes windows of ``span`` consecutive words (an item of fewer words is one window).  For
a window to occur all of its words must, so one token is the necessary prefix: its rarest word,
counted over all documents.  Document words are joined with these anchors alone; the anchor's
offset fixes where the window would have to start, which has to leave room on both sides (positional
and length bound), and the window is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import ascii_lower, only, stored

#: What separates words once A-Z are lower-cased.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPAN = 10
#: Anchors, with their windows, are broadcast up to this size and shuffled beyond it.
BROADCAST_BYTES = 32 << 20


def words_of(text: str) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _BREAK), ""), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``window, items``: each distinct window and the ids of the items that have it."""
    words = only(benchmark, item_id="bigint", text="string").select(
        "item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    windows = F.when(F.size("words") <= span, F.array("words")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - span, F.lit(0))),
        lambda k: F.slice("words", k + 1, span)))
    return (words.select("item_id", F.explode(windows).alias("window"))
            .groupBy("window").agg(F.collect_set("item_id").alias("items")))


def _anchored(docs: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """Windows with the offset and text of their rarest word over all documents."""
    places = windows.select("window", "items", F.posexplode("window").alias("offset", "word"))
    known = places.select("word").distinct()
    words = docs.select(F.explode(words_of("text")).alias("word"))
    if small:
        counts = words.join(F.broadcast(known), "word", "left_semi").groupBy("word").count()
    else:
        counts = words.groupBy("word").count().join(known, "word", "left_semi")
    rarest = places.join(counts, "word", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "offset")).alias("least"),
        F.first("items").alias("items"))
    return rarest.select("window", "items", F.col("least.word").alias("anchor"),
                         F.col("least.offset").alias("offset"))


def occurrences(docs: DataFrame, benchmark: DataFrame, span: int = SPAN,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text_hash, first, last, items``: each place (word positions, last exclusive) where
    a window occurs in a text, and the items that have this window."""
    docs = only(docs, doc_id="bigint", text="string").where("text is not null").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    windows = stored(item_windows(benchmark, span), "windows")
    weight = windows.agg(F.sum(F.aggregate(
        "window", F.lit(64), lambda n, w: n + 16 + F.octet_length(w)) * F.size("window"))).first()[0]
    small = (weight or 0) <= broadcast_bytes
    anchors = stored(_anchored(docs, windows, small), "anchors")
    start = F.col("pos") - F.col("offset")
    fits = (F.col("word") == F.col("anchor")) & (start >= 0) & (
        start + F.size("window") <= F.col("n_words"))
    same = F.slice("words", start + 1, F.size("window")) == F.col("window")
    cut = docs.select("doc_id", "text_hash", words_of("text").alias("words"))
    if small:
        found = (cut.select("doc_id", "text_hash", "words", F.size("words").alias("n_words"),
                            F.posexplode("words").alias("pos", "word"))
                 .join(F.broadcast(anchors), fits & same))
    else:
        keys = ["doc_id", "text_hash"]
        places = cut.select(*keys, F.size("words").alias("n_words"),
                            F.posexplode("words").alias("pos", "word")).join(anchors, fits)
        found = (cut.alias("d").join(places.select(*[F.col(c).alias(f"p_{c}") for c in keys],
                                                   "pos", "offset", "window", "items"),
                                     F.col("d.doc_id").eqNullSafe(F.col("p_doc_id"))
                                     & (F.col("d.text_hash") == F.col("p_text_hash")))
                 .where(same))
    return found.select("doc_id", "text_hash", start.alias("first"),
                        (start + F.size("window")).alias("last"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``.

    A word is hit that stands in any occurrence of a window.  Null and empty texts have no words and
    no hits; rows that repeat an id are judged each by its own text.  Items without words match
    nothing; an item without an id marks words but is not counted.  Empty tables give no rows, or
    rows without hits.  Other columns are not read.
    """
    hits = occurrences(docs, benchmark, span, broadcast_bytes).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["last"] - F.greatest(s["first"], a["reach"]), F.lit(0))).alias("n"),
            F.greatest(a["reach"], s["last"]).alias("reach")),
        lambda a: a["n"].cast("bigint"))
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string")))).alias("list"))
    rows = only(docs, doc_id="bigint", text="string").select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD_ANY_CASE)), F.lit(0)).cast("bigint").alias("n_words"))
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["hit_id"])
                       & (rows["text_hash"] == hits["hit_hash"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` in whose text no window occurs, all columns as they are."""
    hit = occurrences(docs, benchmark, span).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(hit, docs["doc_id"].cast("bigint").eqNullSafe(hit["__id"])
                     & (F.xxhash64(docs["text"].cast("string")) == hit["__hash"]), "left_anti")
