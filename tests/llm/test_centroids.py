"""Centroid clustering against a plain version in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from velorank.llm import centroids


def plain_clusters(rows, k=16, rounds=3, dimensions=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    for turn in range(rounds + 1):
        apart = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres] for _, v in kept]
        own = [d.index(min(d)) for d in apart]
        if turn < rounds:
            for c in set(own):
                mine = [v for (_, v), o in zip(kept, own) if o == c]
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    inertia = [sum(min(d) for d, o in zip(apart, own) if o == c) for c in range(len(centres))]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, o, min(d), inertia[o], sum(inertia), marks[o]) for (i, _), d, o in zip(kept, apart, own)), key=repr)


def clustered(frame, **settings):
    return sorted((tuple(r) for r in centroids.centroid_clusters(frame, **settings).collect()), key=repr)


def test_clusters_match_plain_version(spark, folder):
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = clustered(frame)
    assert got == plain_clusters([(r.vec_id, r.embedding) for r in frame.collect()])
    assert len(got) == frame.count()


def test_odd_vectors(spark):
    """Nulls, other lengths, not-a-number, ties, repeated rows, ids that are null, and columns named like the operator's."""
    one, two = [0.5] * 64, [-0.25] * 32 + [0.75] * 32
    rows = [(1, one), (2, two), (2, two), (3, one), (3, two), (None, one), (4, None), (5, []), (6, [1.0] * 63), (7, [None] + one[1:]),
            (8, [float("nan")] + one[1:]), (9, [float("inf")] + one[1:]), (10, [0.0] * 64), (11, [1e-9, -1e-9] * 32)]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id bigint, embedding array<double>, cluster int, before int, vec string").repartition(3)
    for k in (2, 4, 16):
        assert clustered(frame, k=k) == plain_clusters(rows, k)
    assert clustered(frame.where("vec_id = 1")) == plain_clusters(rows[:1])
    none = centroids.centroid_clusters(frame.where("vec_id = 4"))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_vectors_a_bigint_can_not_measure_are_left_out(spark):
    frame = spark.createDataFrame([(1, [1.0] * 64), (2, [1e300] + [0.0] * 63), (3, [2.0**19] * 64)], "vec_id bigint, embedding array<double>")
    assert [r[:3] for r in clustered(frame, k=1)] == [(1, 0, 64 * (64 - (64 + 2**25) // 2) ** 2), (3, 0, 64 * (2**25 - (64 + 2**25) // 2) ** 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_only_expired_gaps_are_scanned(spark, seed):
    """Far groups: once centroids have settled, hardly any vector is popped; the result is that of scanning all."""
    random = np.random.default_rng(seed)
    groups = random.normal(size=(8, 64)) * 4
    rows = [(i, (groups[i % 8] + random.normal(size=64) * 0.2).tolist()) for i in range(800)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    done = centroids.cluster_vectors(centroids.scaled_vectors(frame), k=8, rounds=6)
    got = sorted((r.id, r.cluster, r.distance) for r in done.assigned.collect())
    assert got == sorted(r[:3] for r in plain_clusters(rows, k=8, rounds=6))
    assert done.scanned[0] == 800 and done.scanned[-1] < 400 and sum(done.scanned) < 5 * 800


def test_sums_stay_exact_beyond_double_precision():
    big = np.array([[1 << 26, -(1 << 26) + 1], [3, (1 << 26) - 1]])
    assert centroids._squared(big, big).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in big] for v in big]


def test_popping_reads_only_the_front_of_a_heap(spark, tmp_path):
    spark.range(10).select((F.col("id") % 2).cast("int").alias("cluster"), F.col("id").cast("double").alias("expiry")).write.parquet(str(tmp_path / "g"))
    rows = spark.read.parquet(str(tmp_path / "g")).where(centroids._between(np.array([1.0, 4.0]), np.array([4.0, 7.0])))
    assert sorted(r.expiry for r in rows.collect()) == [2.0, 4.0, 5.0, 7.0]
    assert "PushedFilters: [Or(" in rows._jdf.queryExecution().toString()
