"""Centroid clustering of integer vectors with heap-ordered bounds.

A scanned vector's gap is its upper bound (the distance of its own centroid) less its
lower bound (that of the second nearest).  While centroids move, the gap can grow by
no more than what the own centroid and the farthest-moving other one have drifted, so
it is stored offset by the drift its cluster has accumulated so far, and the vectors
of a cluster stay in the order in which their gaps expire.  A round pops those whose
gap has expired, scans them exactly against all centroids and pushes them anew.

A cluster's heap is spread over written generations: the vectors a round pushes are
written in the order of cluster and expiry.  What the next rounds pop of a
generation is a range of expiries that begins where the last pop ended, so nothing
is ever rewritten and the rest is neither read nor moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import shared_folder, small_batches

# Squared distances of scaled components up to 2^26 fit a bigint (and sums of 2^36 components do).
LARGEST = 1 << 26
# Up to this size double precision multiplies and adds whole numbers exactly.
_EXACT_IN_DOUBLE = 1 << 20
# Roots are rounded: a gap this near its expiry counts as expired.
_SLACK = 1e-6


@dataclass
class Clustering:
    """``assigned``: ``id``, ``cluster``, ``distance`` of each vector.

    ``centroids`` are the final ones, ``scanned`` says how many vectors were
    compared with all centroids in each assignment; the first scans all.
    """

    assigned: DataFrame
    centroids: list[list[int]]
    scanned: list[int] = field(default_factory=list)


def scaled_vectors(rows: DataFrame, dimensions: int = 64, scale: int = 64, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``vec``, whole numbers floor(scale * x), of the vectors with ``dimensions`` finite components.

    Vectors that are null, of another length or hold null or non-finite components
    are left out, and so are those with a component beyond ``LARGEST``, whose squared
    distances a bigint does not hold.
    """
    doubles = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    usable = F.forall("scaled", lambda x: x.isNotNull() & (F.abs(x) <= float(LARGEST)))  # false for NaN, too
    return (
        rows.select(F.col(id_column).alias("id"), doubles.alias("scaled"))
        .where((F.size("scaled") == dimensions) & usable)
        .select("id", F.transform("scaled", lambda x: F.floor(x).cast("bigint")).alias("vec"))
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors whose ``seed:id`` has the smallest SHA-256; equal ids in the order of components, null ids last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r.vec) for r in vectors.orderBy(order.asc_nulls_last(), "vec").limit(k).select("vec").collect()]


def _squared(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    if max(np.abs(vecs).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT_IN_DOUBLE:
        a, b = vecs.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((vecs - c) ** 2).sum(1) for c in centroids], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _scan(rows: DataFrame, centroids: list[list[int]], drift: np.ndarray) -> DataFrame:
    """``id``, ``vec``, ``before`` of the rows with their nearest centroid and ``expiry``, the drift at which that must be looked at again."""
    fixed = np.array(centroids, np.int64)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 8192):
            if not batch.num_rows:
                continue
            squared = _squared(_matrix(batch.column(1)), fixed)
            own = squared.argmin(axis=1)  # the first of equals
            at = np.arange(len(own))
            upper = np.sqrt(squared[at, own].astype(np.float64))
            squared[at, own] = np.iinfo(np.int64).max
            lower = np.sqrt(squared.min(axis=1).astype(np.float64))
            expiry = (lower - upper) * (1 - _SLACK) - _SLACK + drift[own]
            columns = [*batch.columns, pa.array(own.astype(np.int32)), pa.array(expiry)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vec", "before", "cluster", "expiry"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vec", "before").mapInArrow(scanned, f"id {kind}, vec array<bigint>, before int, cluster int, expiry double")


def _between(low: np.ndarray | None, high: np.ndarray | None) -> Column:
    """Rows whose expiry lies above ``low`` and not above ``high`` of their cluster; the conditions reach the scan."""
    ranges = []
    for c in range(len(low if low is not None else high)):
        above = "" if low is None else f" AND expiry > {float(low[c])!r}D"
        ranges.append(f"(cluster = {c}{above}" + (")" if high is None else f" AND expiry <= {float(high[c])!r}D)"))
    return F.expr(" OR ".join(ranges))


def _moved(pushed: DataFrame, dimensions: int) -> tuple[dict[int, list[int]], dict[int, int], int]:
    """What the pushed vectors add to the sums and counts of clusters, and how many they are.

    Each task adds up its own rows, so only one row per task and cluster is shuffled.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            seen += batch.num_rows
            vecs = _matrix(batch.column(0))
            before = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            after = batch.column(2).to_numpy()
            for side, sign in ((after, 1), (before, -1)):
                for c in np.unique(side[(before != after) & (side >= 0)]):
                    mine = vecs[(side == c) & (before != after)]
                    total = sums.setdefault(int(c), np.zeros(dimensions + 1, np.int64))
                    total[:-1] += sign * mine.sum(axis=0)
                    total[-1] += sign * len(mine)
        numbers = [(-1, 0, seen), *((c, i, int(x)) for c, total in sums.items() for i, x in enumerate(total))]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*numbers), (pa.int32(), pa.int32(), pa.int64()))], ["cluster", "place", "amount"])

    parts = pushed.select("vec", "before", "cluster").mapInArrow(partial, "cluster int, place int, amount bigint")
    totals = {(r.cluster, r.place): r.amount for r in parts.groupBy("cluster", "place").agg(F.sum("amount").alias("amount")).collect()}
    seen = totals.pop((-1, 0), 0)
    changed = {c for c, _ in totals}
    sums = {c: [totals[c, i] for i in range(dimensions)] for c in changed}
    return sums, {c: totals[c, dimensions] for c in changed}, seen


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> Clustering:
    """Clusters of the rows of ``vectors`` (``id``, ``vec`` of whole numbers, all of one length).

    Centroids start as :func:`first_centroids`.  Each round assigns every vector to
    the nearest centroid (ties: the smaller number) and replaces every non-empty
    centroid by the floor of its vectors' mean; a last assignment follows.  With
    fewer vectors than ``k`` there are as many centroids as vectors; without any,
    no row comes out.  Repeated rows count as often as they occur.

    The driver holds the centroids and the sums and counts of their vectors; vectors
    are never shuffled.  Generations are written to the shared folder, so a lost
    executor costs the tasks it ran.
    """
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, k, seed)
    kind = vectors.schema["id"].dataType.simpleString()
    if not centroids:
        return Clustering(spark.createDataFrame([], f"id {kind}, cluster int, distance bigint"), [])
    k, dimensions, folder = len(centroids), len(centroids[0]), shared_folder(spark, "centroids")
    sums, counts = [[0] * dimensions for _ in range(k)], [0] * k
    drift = np.zeros(k)
    popped: np.ndarray | None = None
    generations: list[tuple[str, np.ndarray | None]] = []  # path, drift up to which it was popped
    scanned = []
    due = vectors.withColumn("before", F.lit(None).cast("int"))
    for turn in range(rounds + 1):
        path = f"{folder}/{turn}"
        _scan(due, centroids, drift).sortWithinPartitions("cluster", "expiry").write.parquet(path)
        pushed = spark.read.parquet(path)
        added, more, seen = _moved(pushed, dimensions)
        scanned.append(seen)
        generations = [(p, popped) for p, _ in generations] + [(path, None)]
        if turn == rounds:
            break
        for c, total in added.items():
            sums[c] = [a + b for a, b in zip(sums[c], total)]
            counts[c] += more[c]
        means = [[s // n for s in total] if n else old for total, n, old in zip(sums, counts, centroids)]
        moves = np.array([np.sqrt(float(sum((a - b) ** 2 for a, b in zip(old, new)))) for old, new in zip(centroids, means)])
        others = np.array([np.delete(moves, c).max(initial=0.0) for c in range(k)])
        centroids, drift = means, drift + moves + others
        reads = [spark.read.parquet(p).where(_between(low, drift)) for p, low in generations]
        due = reduce(DataFrame.union, [r.select("id", "vec", F.col("cluster").alias("before")) for r in reads])
        popped = drift
    live = [spark.read.parquet(p) if low is None else spark.read.parquet(p).where(_between(low, None)) for p, low in generations]
    rows = reduce(DataFrame.union, [r.select("id", "vec", "cluster") for r in live])
    return Clustering(_distances(rows, centroids, kind), centroids, scanned)


def _distances(rows: DataFrame, centroids: list[list[int]], kind: str) -> DataFrame:
    fixed = np.array(centroids, np.int64)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = _matrix(batch.column(1)) - fixed[batch.column(2).to_numpy()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array((apart * apart).sum(axis=1))], ["id", "cluster", "distance"])

    return rows.mapInArrow(measured, f"id {kind}, cluster int, distance bigint")


def centroid_clusters(
    rows: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dimensions: int = 64, scale: int = 64,
    id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """One row per usable vector of ``rows``: its id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    See :func:`scaled_vectors` for which vectors are used and :func:`cluster_vectors`
    for how.  ``distance`` is squared; the inertias are its sums over the cluster and
    over all.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    done = cluster_vectors(scaled_vectors(rows, dimensions, scale, id_column, vector), k, rounds, seed)
    path = f"{shared_folder(spark, 'clusters')}/assigned"
    done.assigned.write.parquet(path)
    assigned = spark.read.parquet(path)
    inertia = {r.cluster: r.sum for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in done.centroids]
    facts = [(c, s, sum(inertia.values()), digests[c]) for c, s in sorted(inertia.items())]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
