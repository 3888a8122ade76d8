"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

1. Texts become shingle sets; equal sets become one class, so exact copies cost one row each.
2. Signatures of the classes are cut into bands; classes that agree in a band share a bucket.
3. Each bucket links its members to a center drawn at random for each bucket, so a bucket of n
   classes gives n - 1 pairs.  Pairs whose signatures are far below the threshold go, the rest is
   verified on full sets and the links are closed to components.
4. Buckets that still hold several components may hide links that miss every center.  Their members
   go through a set join: a pair above the threshold shares one of the rarest shingles of both, so
   only these are joined, between different components, under size and positional bounds: first with
   the most central class of the largest component, then what is still apart with all.  That is
   exact for all members and stays small where thousands of near copies share all but their edits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wayflux.llm.common import NO_ID, only, stored
from wayflux.llm.components import components
from wayflux.llm.shingles import WordHasher, mixed, shingle_sets
from wayflux.llm.superminhash import signatures


@dataclass(frozen=True)
class NearDup:
    """``shingle`` words, and a similarity of ``least / 100`` or more.

    ``bands`` of ``rows`` slots each: at a similarity of 0.8 a pair misses all 32 bands of 4 with
    probability 5e-8.  ``slack``: pairs whose estimate is that far below the threshold are not
    verified; it is over four standard deviations.
    """

    shingle: int = 5
    least: int = 80
    bands: int = 32
    rows: int = 4
    slack: float = 0.17

    @property
    def slots(self) -> int:
        return self.bands * self.rows


_SETS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("class", T.BinaryType()), T.StructField("sign", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType(), False))])
_MEMBERS = T.StructType([
    T.StructField("class", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(rule: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, band = WordHasher(), np.arange(rule.bands, dtype=np.uint64)

        def pack(ids, hashes, sets):
            signs = signatures(sets, rule.slots)
            cells = signs.reshape(len(sets), rule.bands, rule.rows)
            keys = np.broadcast_to(mixed(band + np.uint64(1)), cells.shape[:2])
            for k in range(rule.rows):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
            short = mixed(signs).astype(np.uint16)
            full = [len(s) > 0 for s in sets]
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if s.size else None for s in sets], pa.binary()),
                pa.array([x.tobytes() if f else None for x, f in zip(short, full)], pa.binary()),
                pa.array([x if f else None for x, f in zip(keys.view(np.int64), full)],
                         pa.list_(pa.field("element", pa.int64(), False)))],
                schema=pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()),
                                  ("class", pa.binary()), ("sign", pa.binary()),
                                  ("bands", pa.list_(pa.field("element", pa.int64(), False)))]))

        for batch in batches:
            ids, hashes, sets, held = [], [], [], 0
            for doc_id, text_hash, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                            shingle_sets(batch.column(1), rule.shingle, hasher)):
                ids.append(doc_id)
                hashes.append(text_hash)
                sets.append(s)
                held += len(s) + 64
                if held > 400_000:
                    yield pack(ids, hashes, sets)
                    ids, hashes, sets, held = [], [], [], 0
            if ids:
                yield pack(ids, hashes, sets)
    return run


def _expand(rule: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [s for s in shingle_sets(batch.column(0), rule.shingle, hasher) if s.size]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in found], pa.binary()),
                 pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["class", "shingles"])
    return run


def _agreeing(a: str, b: str, rule: NearDup) -> Column:
    """How many slots of two signatures agree."""
    slots = F.sequence(F.lit(0), F.lit(rule.slots - 1))
    return F.size(F.filter(slots, lambda k: F.substring(F.col(a), k * 2 + 1, F.lit(2))
                           == F.substring(F.col(b), k * 2 + 1, F.lit(2))))


def _verified(pairs: DataFrame, members: DataFrame, rule: NearDup) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    left = members.select(F.col("class").alias("u"), F.col("shingles").alias("a"))
    right = members.select(F.col("class").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(left, "u").join(right, "v").where(
        100 * both >= rule.least * (F.size("a") + F.size("b") - both)).select("u", "v")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the component of their class, which is the class itself where it has no link."""
    return rows.join(roots, F.col("class") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "class")).drop("node")


#: Shingles with over one in so many of all rows are hot, so there are at most so many of them.
_HOT = 1000


def _shares(size: str, total: int) -> Column:
    """How many tasks share a shingle that has ``size`` of ``total`` rows: one unless it is hot."""
    return F.ceil(F.col(size) * _HOT / max(total, 1)).cast("int")


def _dealt(rows: DataFrame, sums: DataFrame, size: str, total: int) -> DataFrame:
    """``rows`` with the ``salt`` of their share: the rows of a hot shingle are dealt out by their class."""
    hot = F.broadcast(sums.where(F.col(size) * _HOT > total).select("shingle", _shares(size, total).alias("shares")))
    return rows.join(hot, "shingle", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("class"), "shares").cast("int"), F.lit(0))).drop("shares")


def _repeated(rows: DataFrame, size: str, total: int) -> DataFrame:
    """``rows`` once for each share of their shingle, with its ``salt``."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), _shares(size, total) - 1)))


def _rare_heads(entries: DataFrame, members: DataFrame, roots: DataFrame, rule: NearDup) -> DataFrame:
    """The rarest shingles of all classes in buckets with several components: as many as a pair above
    the threshold can't do without, except those that no other class has."""
    labelled = _rooted(entries.select("key", "class"), roots)
    mixed_keys = labelled.groupBy("key").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("n")
    ).where("n > 2 and a <> b").select("key")
    open_classes = labelled.join(mixed_keys, "key", "left_semi").select("class").distinct()
    tokens = stored(
        members.join(open_classes, "class")
        .select("class", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), "shingles")
    counts, total = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")), tokens.count()
    ranked = _dealt(tokens, counts, "df", total).join(
        _repeated(counts, "df", total), ["shingle", "salt"]).withColumns({
        "place": F.row_number().over(Window.partitionBy("class").orderBy("df", "shingle")),
        "own": F.count_if(F.col("df") == 1).over(Window.partitionBy("class"))})
    return stored(ranked.where(
        (F.col("df") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * (rule.least / 100)) + 1))
        .select("class", "n", "shingle", "place", "own"), "heads")


def _hidden_pairs(heads: DataFrame, roots: DataFrame, rule: NearDup, central: bool) -> DataFrame:
    """Pairs between components that share a rare shingle and can reach the threshold by their sizes and
    the shingle's places.  Classes outside a shingle's largest component meet all others that have it,
    or with ``central`` only the class of the largest component with fewest shingles of its own."""
    t = rule.least / 100
    rooted = _rooted(heads, roots)
    parts = ("class", "root", "n", "place")
    per_root = rooted.groupBy("shingle", "root").agg(
        F.count(F.lit(1)).alias("c"),
        F.min_by(F.struct(*parts), F.struct(F.col("own") / F.col("n"), "class")).alias("best"))
    largest = stored(per_root.groupBy("shingle").agg(
        F.max_by(F.struct("root", "best"), F.struct("c", "root")).alias("main"),
        F.count(F.lit(1)).alias("roots"), F.sum("c").alias("size")).where("roots > 1"), "largest")
    total = largest.agg(F.sum("size")).first()[0] or 0
    met = _dealt(rooted, largest, "size", total).join(
        _repeated(largest, "size", total), ["shingle", "salt"])
    left = met.where("root <> main.root").select(
        "shingle", *[F.col(c).alias(f"x_{c}") for c in parts],
        *[F.col(f"main.best.{c}").alias(f"y_{c}") for c in parts if central])
    need = F.ceil((F.col("x_n") + F.col("y_n")) * (t / (1 + t)) - 1e-9)
    room = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place")) + 1
    if central:
        found = left.where(room >= need)
    else:  # plain shuffles on both sides, so Spark can split what is skewed by its bytes
        right = met.select("shingle", *[F.col(c).alias(f"y_{c}") for c in parts])
        found = left.join(right, "shingle").where(
            (F.col("x_root") != F.col("y_root")) & (room >= need))
    return found.select(F.greatest("x_class", "y_class").alias("u"),
                        F.least("x_class", "y_class").alias("v")).distinct()


def near_dup_groups(docs: DataFrame, rule: NearDup = NearDup()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text).

    component_id is the least doc_id that links reach, kept says whether it is the row's own.
    Empty and null texts have no shingles and form no group.  Equal texts are always linked.  Rows
    that repeat an id are each judged by their own text.  A null id counts as the least one and
    comes back as null.  Other columns are not read; an empty table gives no rows.
    """
    return _judged(docs, rule).drop("text_hash")


def _judged(docs: DataFrame, rule: NearDup) -> DataFrame:
    """The groups with the hash of each row's text."""
    docs = only(docs, doc_id="bigint", text="string")
    rows = stored(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketch(rule), _SETS), "sketches")
    ranked = rows.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    classes = ranked.where("class is not null").groupBy("class").agg(F.min("id").alias("id"))
    one = ranked.where("class is not null").select("class", "bands").dropDuplicates(["class"])
    entries = one.select("class", F.explode("bands").alias("key"))
    centers = entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("class", F.xxhash64("key", "class")).alias("center")).where("n > 1")
    entries = stored(entries.join(centers, "key").select("key", "class", "center", "n"), "buckets")

    signs = rows.where("class is not null").select("class", "sign").dropDuplicates(["class"])
    pairs = entries.where("class <> center").select(
        F.greatest("class", "center").alias("u"), F.least("class", "center").alias("v")).distinct()
    floor = math.ceil((rule.least / 100 - rule.slack) * rule.slots)
    pairs = (pairs.join(signs.toDF("u", "sign_u"), "u").join(signs.toDF("v", "sign_v"), "v")
             .where(_agreeing("sign_u", "sign_v", rule) >= floor).select("u", "v"))

    wanted = entries.select("class").distinct().join(classes, "class").select("class", "id")
    members = stored(
        docs.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
        .join(wanted.select("id").distinct(), "id", "left_semi").select("text")
        .mapInArrow(_expand(rule), _MEMBERS)
        .join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"]), "members")
    links = stored(_verified(pairs, members, rule), "verified")
    roots = components(links)
    heads = _rare_heads(entries, members, roots, rule)
    for central in (True, False):  # what links to a central class need not meet all of its component
        more = stored(_verified(_hidden_pairs(heads, roots, rule, central), members, rule), "verified")
        if not more.isEmpty():
            links = links.unionByName(more)
            roots = components(links)

    least = (classes.join(roots, F.col("class") == F.col("node"))
             .groupBy("root").agg(F.min("id").alias("component"))
             .join(roots, "root").select(F.col("node").alias("class"), "component"))
    copies = classes.join(least, "class", "left").select(
        "class", F.coalesce("component", "id").alias("component"))
    out = ranked.join(copies, "class", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select("doc_id", "text_hash", "n_shingles",
                      F.nullif("component", F.lit(NO_ID)).alias("component_id"),
                      (F.col("component") == F.col("id")).alias("kept"))


def keep_one(docs: DataFrame, rule: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` that stay when each group keeps its least doc_id, all columns as they
    are.  Rows that repeat a kept id stay only if their own text is judged kept too."""
    gone = (_judged(docs, rule).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("__gone"),
                                        F.col("text_hash").alias("__hash"))
            .agg(F.bool_or("kept").alias("__any")).where("not __any").select("__gone", "__hash"))
    return docs.join(gone, (F.coalesce(docs["doc_id"], F.lit(NO_ID)) == gone["__gone"])
                     & (F.xxhash64(docs["text"].cast("string")) == gone["__hash"]), "left_anti")
