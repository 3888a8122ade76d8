"""Centroid clustering by Lloyd's rounds with norm-of-sum bounds.

Every vector keeps the squared distance to each centroid as it was last computed, and the round of
that computation.  All earlier positions of the centroids are kept as well, so a stored distance is
loosened by the norm of the centroid's whole displacement since then, which is never more than the sum
of the norms of its single steps.  Only what the loosened bounds cannot decide is computed again, as
whole numbers, so the result is that of an exhaustive search.

Vectors are never shuffled: each round reads the stored table of the round before, and what reaches
the driver is a row of sums for each centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import only, stored

#: Components of at most this size keep all squared distances of 64 components within 63 bits.
LARGEST = 1 << 27
#: Below this size products of doubles are exact whole numbers too.
_EXACT_DOUBLES = 1 << 20
#: Square roots of doubles are wrong by far less than this share.
_SLACK = 1e-9

_STATE = "vec_id bigint, v array<int>, cluster int, sq array<bigint>, seen array<int>"
_RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
           "centroid_sha256 string")


@dataclass(frozen=True)
class Clustering:
    """``clusters`` centroids and ``rounds`` updates; vectors have ``size`` components (64 at most),
    which become floor(``scale`` * x).  Start vectors are those of the least sha256 of
    ``seed:vec_id``."""

    clusters: int = 16
    rounds: int = 3
    size: int = 64
    scale: int = 64
    seed: int = 1


def whole_vectors(embeddings: DataFrame, rule: Clustering = Clustering()) -> DataFrame:
    """``vec_id, v``: vectors of exactly ``rule.size`` finite components as whole numbers.

    Other vectors are left out: null, shorter, longer, with null, NaN or infinite components.  A
    component beyond 2^27 in size raises an error, as squared distances would leave 63 bits.
    """
    rows = only(embeddings, vec_id="bigint", embedding="array<double>")
    whole = F.transform("embedding", lambda x: F.floor(x * rule.scale))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    small = F.forall("embedding", lambda x: F.abs(x * rule.scale) <= LARGEST)
    return rows.where((F.size("embedding") == rule.size) & finite).select("vec_id", F.when(
        small, whole).otherwise(F.raise_error(F.lit("a component is beyond 2^27 after scaling")))
        .cast("array<int>").alias("v"))


def _matrix(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _pairs(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows that lie side by side, exact."""
    step = x - c
    return np.einsum("ij,ij->i", step, step)


def _all_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, exact."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT_DOUBLES:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([_pairs(x, c) for c in centroids], axis=1)


def reassign(x: np.ndarray, cluster: np.ndarray, sq: np.ndarray, seen: np.ndarray,
             history: list[np.ndarray], exact: bool) -> tuple[np.ndarray, int]:
    """Nearest centroids of ``history[-1]`` for the rows of ``x``; ties go to the smaller number.

    ``sq`` and ``seen`` (squared distances and the rounds they are of) are brought up to date where a
    distance is computed.  With ``exact`` the distance to the nearest one always is.  Returns the new
    numbers and how many distances were computed.
    """
    now, rows, k = len(history) - 1, np.arange(len(x)), len(history[-1])
    moved = np.stack([np.sqrt(_pairs(history[now], old).astype(np.float64)) for old in history])
    loose = moved[seen, np.arange(k)] * (1 + _SLACK)
    root = np.sqrt(sq.astype(np.float64))
    lower = root * (1 - _SLACK) - loose
    upper = (root * (1 + _SLACK) + loose)[rows, cluster]
    lower[rows, cluster] = np.inf
    open_rows = rows if exact else np.flatnonzero(lower.min(1, initial=np.inf) <= upper)
    own = cluster[open_rows]
    sq[open_rows, own] = _pairs(x[open_rows], history[now][own])
    seen[open_rows, own] = now
    upper = np.sqrt(sq[open_rows, own].astype(np.float64)) * (1 + _SLACK)
    at, other = np.nonzero(lower[open_rows] <= upper[:, None])
    sq[open_rows[at], other] = _pairs(x[open_rows[at]], history[now][other])
    seen[open_rows[at], other] = now
    # What was not computed in this round is further away than the centroid of the last round.
    known = np.where(seen[open_rows] == now, sq[open_rows], np.iinfo(np.int64).max)
    result = cluster.copy()
    result[open_rows] = known.argmin(1)
    return result, len(open_rows) + len(at)


def _assigned(points: DataFrame, history: list[np.ndarray], exact: bool) -> DataFrame:
    """The state of all vectors after the round of ``history[-1]``."""
    names = ["vec_id", "v", "cluster", "sq", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = history[-1].shape
        for batch in batches:
            x = _matrix(batch.column("v"), size, np.int64)
            if len(history) == 1:
                sq = _all_distances(x, history[0])
                seen, cluster = np.zeros(sq.shape, np.int32), sq.argmin(1).astype(np.int32)
            else:
                sq = _matrix(batch.column("sq"), k, np.int64)
                seen = _matrix(batch.column("seen"), k, np.int32)
                cluster, _ = reassign(x, batch.column("cluster").to_numpy().astype(np.int64), sq, seen,
                                      history, exact)
            ends = pa.array(np.arange(0, sq.size + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)),
                 pa.ListArray.from_arrays(ends, pa.array(sq.ravel())),
                 pa.ListArray.from_arrays(ends, pa.array(seen.ravel().astype(np.int32)))], names=names)

    return points.mapInArrow(run, _STATE)


def _start(points: DataFrame, rule: Clustering) -> np.ndarray:
    """The start vectors in order; rows that repeat an id are told apart by their components."""
    digest = F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.col("vec_id").cast("string")), 256)
    first = points.select(digest.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(
        rule.clusters).collect()
    return np.array([r["v"] for r in first], np.int64).reshape(len(first), rule.size)


def _means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Floors of the means of all vectors of a centroid; those without a vector stay."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[
        F.sum(F.col("v")[i].cast("bigint")).alias(f"s{i}") for i in range(before.shape[1])])
    after = before.copy()
    for row in sums.collect():
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(before.shape[1])]
    return after


def centroid_clusters(embeddings: DataFrame, rule: Clustering = Clustering()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each kept vector.

    Rows that repeat an id or a vector are vectors of their own.  A null id can be a start vector only
    after all others.  With fewer vectors than clusters each is a centroid of its own; without vectors
    the result is empty.  Other columns are not read.
    """
    spark = embeddings.sparkSession
    state = stored(whole_vectors(embeddings, rule), "centroid-vectors")
    history = [_start(state, rule)]
    if not len(history[0]):
        return spark.createDataFrame([], _RESULT)
    for turn in range(rule.rounds + 1):
        state = stored(_assigned(state, history, exact=turn == rule.rounds), f"centroid-round-{turn}")
        if turn < rule.rounds:
            history.append(_means(state, history[-1]))
    final = state.select("vec_id", "cluster", F.get("sq", F.col("cluster")).alias("distance"))
    spread = {r["cluster"]: r["inertia"] for r in
              final.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(k, spread[k], sum(spread.values()),
             hashlib.sha256(",".join(str(int(x)) for x in history[-1][k]).encode()).hexdigest())
            for k in spread]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return final.join(F.broadcast(of), "cluster").select(  # one row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
