"""Near-duplicate embeddings by sorted projection passes.

In each pass a vector gets a code of concatenated random hashes, vectors are ordered
lexicographically by their codes, and each is compared with a bounded window of its
neighbours in that order.  Pairs are verified by their cosine and united over all passes.

A hash says on which side of a random hyperplane a vector lies.  Planes through the
origin hardly split a crowd that lies in one cone, so a pass moves each of its planes
to the middle of the run that shares the prefix before it, as a bounded sample shows
it: the first hashes to the median, the further ones to the mean.  The number of passes
follows from the counted vectors and from how often made-up pairs at the threshold,
drawn around the sample, fall into one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import partitions, small_batches, stored, with_positions
from velorank.llm.components import connected_components

# Chance that no pass brings a pair at the threshold together.
MISS = 1e-3
# Neighbours in a pass's order that a vector is compared with.
WINDOW = 256
SEED = 7
# Hashes of a code, and how many of them are moved to medians of the sample's runs.
_BITS = 31
_DEPTH = 7
# Vectors, the ones of smallest digest, that planes are fitted to and passes are tried on.
_SAMPLE = 4096
_TRIED = (512, 16)
_COUNTABLE = 50
# Passes at least; so many make up for what the trial can't see in small tables.
_LEAST_PASSES = 8
# Windows that are compared in one group.
_WINDOWS = 8
_TILE = 1024
# Passes whose shuffles are on disk at the same time.
_ROUND = 4
# Parts that the members of a large group are dealt to when they look up its size.
_SALT = 64
# Members of small groups that are counted together.
_COUNTED = 2048
# Single precision finds what may be near, double precision decides.
_SLACK = 1e-3


def _units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that tiny and huge ones keep their direction."""
    rows = np.frombuffer(b"".join(vectors), kind).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class _Pass:
    """The planes of a pass for vectors of one length, moved to the middles of the sample's runs."""

    def __init__(self, sample: np.ndarray, turn: int, seed: int) -> None:
        self.planes = np.random.default_rng([seed, turn, sample.shape[1]]).standard_normal((sample.shape[1], _BITS))
        places = sample @ self.planes
        run = np.zeros(len(sample), np.int64)
        self.medians = []
        for level in range(_DEPTH):
            middles = np.zeros(1 << level)
            for r in np.unique(run):
                middles[r] = np.median(places[run == r, level])
            self.medians.append(middles)
            run = 2 * run + (places[:, level] > middles[run])
        self.means = np.zeros((1 << _DEPTH, _BITS - _DEPTH))
        for r in np.unique(run):
            self.means[r] = places[run == r, _DEPTH:].mean(axis=0)

    def codes(self, units: np.ndarray) -> np.ndarray:
        """Hashes, first one highest, as numbers that sort like them."""
        places = units @ self.planes
        code = np.zeros(len(units), np.int64)
        for level, middles in enumerate(self.medians):
            code = 2 * code + (places[:, level] > middles[code])
        above = places[:, _DEPTH:] > self.means[code]
        return code << (_BITS - _DEPTH) | above @ (1 << np.arange(_BITS - _DEPTH)[::-1])


def _hit_rate(n: int, sample: np.ndarray, threshold: float, window: int, seed: int) -> float:
    """How often a pass brings a pair at the threshold into one window among ``n`` vectors like the sample.

    A pair meets if the run that shares its common prefix fits into a window.
    """
    if n <= window:
        return 1.0
    pairs, turns = _TRIED
    random = np.random.default_rng([seed, sample.shape[1]])
    some = sample[random.permutation(len(sample))[:pairs]]
    across = random.standard_normal(some.shape)
    across -= (across * some).sum(axis=1, keepdims=True) * some
    length = np.sqrt((across * across).sum(axis=1, keepdims=True))
    cosine = float(np.clip(threshold, 0.0, 1.0))
    others = cosine * some + np.sqrt(1 - cosine * cosine) * across / np.where(length > 0, length, 1.0)
    spreads = []
    for turn in range(turns):
        one = _Pass(sample, turn, seed)
        a, b, every = one.codes(some), one.codes(others), np.sort(one.codes(sample))
        shared = np.array([_BITS - int(x).bit_length() for x in a ^ b])
        below = _BITS - shared
        inside = np.searchsorted(every, ((b >> below) + 1) << below) - np.searchsorted(every, b >> below << below)
        # What a sample of this size can't tell is taken to halve with each further hash.
        spreads.append(np.maximum(inside / len(sample), 0.5 ** np.maximum(shared, np.log2(len(sample)))))
    needed = np.stack(spreads) / window
    half, quarter = turns // 2, max(1, len(some) // 4)

    def rate(size: float) -> float:
        """The rate of the quarter of pairs that meet least: those of crowds.  Half of the turns say which, the others how often."""
        hits = size * needed <= 1
        return float(hits[half:, np.argsort(hits[:half].sum(axis=0), kind="stable")[:quarter]].mean())

    # Where hits are too rare to count, they are as rare as in smaller tables, and rarer by the power seen there.
    size = float(n)
    while rate(size) * half * quarter < _COUNTABLE and size > window:
        size /= 2
    if size == n or size <= window:
        return rate(size)
    power = np.log(rate(size) / rate(size / 16)) / np.log(16)
    return rate(size) * (n / size) ** min(power, 0.0)


def _passes(n: int, sample: np.ndarray, threshold: float, window: int, seed: int = SEED) -> int:
    """Passes that miss a pair at the threshold with a chance of ``MISS`` at most."""
    rate = _hit_rate(n, sample, threshold, window, seed) if len(sample) else 1.0
    rate = max(rate, min(1.0, window / n) if n else 1.0)  # neighbours in any order meet this often
    return max(_LEAST_PASSES, int(np.ceil(np.log(MISS) / np.log1p(-rate))) if rate < 1 else 1)


def _usable(rows: DataFrame, id_column: str, vector: str, kind: str) -> DataFrame:
    """``id``, ``vec`` (raw bytes) and ``digest`` of each row; the last two are null for vectors that link with nothing."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs: list[bytes | None] = []
            for values in batch.column(1):
                own = values.values
                if not values.is_valid or not len(own) or own.null_count:
                    vecs.append(None)
                    continue
                x = own.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # no negative zeros
                vecs.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            vecs = [v if i is not None else None for v, i in zip(vecs, batch.column(0).to_pylist())]
            digests = [None if v is None else hashlib.sha256(v).digest() for v in vecs]
            columns = [batch.column(0), pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vec", "digest"])

    id_kind = rows.schema[id_column].dataType.simpleString()
    return rows.select(id_column, vector).mapInArrow(read, f"id {id_kind}, vec binary, digest binary")


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a symmetric boolean matrix connects, each to the first of its group."""
    left, out = near.any(axis=1), []
    for seed in np.flatnonzero(left):
        if not left[seed]:
            continue
        left[seed] = False
        front = np.array([seed])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & left)
            left[front] = False
            out += [(int(i), int(seed)) for i in front]
    return out


def _sampled(classes: DataFrame, kind: str) -> tuple[int, dict[int, np.ndarray]]:
    """How many vectors there are, and a bounded sample of unit vectors by length."""
    sample = classes.orderBy("digest").limit(_SAMPLE).select("vec").collect()
    by_size: dict[int, list[bytes]] = {}
    for r in sample:
        by_size.setdefault(len(r.vec), []).append(bytes(r.vec))
    return classes.count(), {size: _units(vecs, kind) for size, vecs in by_size.items()}


def _coded(classes: DataFrame, samples: dict[int, np.ndarray], passes: int, seed: int, kind: str) -> DataFrame:
    """``id``, ``size`` and ``codes``, the code of each pass, of every vector."""
    spark = classes.sparkSession
    fitted = spark.sparkContext.broadcast({size: [_Pass(units, t, seed) for t in range(passes)] for size, units in samples.items()})

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = dict(fitted.value)
        for batch in small_batches(batches, 4096):
            vecs = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vecs])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                units = _units([vecs[i] for i in at], kind)
                if size not in plans:  # a length the sample does not hold: planes through the origin
                    plans[size] = [_Pass(units[:0], t, seed) for t in range(passes)]
                codes = np.stack([one.codes(units) for one in plans[size]], axis=1).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, passes, dtype=np.int32), codes.ravel())
                columns = [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), size, np.int32)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "size", "codes"])

    return stored(classes.select("id", "vec").mapInArrow(coded, "id bigint, size int, codes array<int>"))


def _window_links(units: np.ndarray, window: int, threshold: float) -> list[tuple[int, int]]:
    """Links that connect what is near among rows at most ``window`` places apart, in tiles of bounded size."""
    n, rough = len(units), units.astype(np.float32)
    found_a, found_b = [], []
    for first in range(0, n, window):
        rows = np.arange(first, min(first + window, n))
        cols = np.arange(first, min(first + 2 * window, n))
        apart = cols[None, :] - rows[:, None]
        i, j = np.nonzero((rough[rows] @ rough[cols].T >= threshold - _SLACK) & (apart > 0) & (apart <= window))
        near = np.einsum("ij,ij->i", units[rows[i]], units[cols[j]]) >= threshold
        found_a.append(rows[i[near]])
        found_b.append(cols[j[near]])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return []
    some = np.union1d(a, b)
    near = np.zeros((len(some), len(some)), bool)
    near[np.searchsorted(some, a), np.searchsorted(some, b)] = True
    return [(int(some[i]), int(some[j])) for i, j in _forest(near | near.T)]


def _pass_links(coded: DataFrame, classes: DataFrame, turns: range, window: int, threshold: float, kind: str) -> DataFrame:
    """Verified links ``a``, ``b`` that connect what is near within a window of some of the passes.

    Codes alone are sorted, over sampled splitters, and numbered through.  A group
    holds some windows of that order and the window after them, so every vector
    meets its whole window and moves 1 + 1 / ``_WINDOWS`` times a pass.
    """
    step = window * _WINDOWS
    each = F.posexplode(F.slice("codes", turns.start + 1, len(turns))).alias("turn", "code")
    ordered = with_positions(coded.select("id", "size", each), "turn", "size", "code", "id")
    block = F.floor(F.col("position") / step)
    late = (F.col("position") % step < window) & (block > 0)
    blocks = F.explode(F.when(late, F.array(block - 1, block)).otherwise(F.array(block))).alias("block")
    placed = ordered.select("id", "turn", "position", blocks).join(classes.select("id", "vec"), "id")

    def compared(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        ids, turn = table.column("id").to_numpy(), table.column("turn").to_numpy()
        vecs = table.column("vec").to_pylist()
        kinds = np.array([len(v) for v in vecs])
        starts = np.flatnonzero(np.r_[True, (turn[1:] != turn[:-1]) | (kinds[1:] != kinds[:-1])])
        ends: list[list[int]] = [[], []]
        for first, last in zip(starts, np.r_[starts[1:], len(ids)]):  # other passes and lengths don't compare
            for i, j in _window_links(_units(vecs[first:last], kind), window, threshold):
                ends[0].append(int(ids[first + i]))
                ends[1].append(int(ids[first + j]))
        return pa.table([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    return placed.groupBy("block").applyInArrow(compared, "a bigint, b bigint").distinct()


def _links(classes: DataFrame, threshold: float, passes: int | None, window: int, seed: int, kind: str) -> DataFrame:
    """Links of all passes; those of a few passes at a time are written, so that their shuffles can go."""
    n, samples = _sampled(classes, kind)
    if passes is None:
        passes = max((_passes(n, units, threshold, window, seed) for units in samples.values()), default=1)
    coded = _coded(classes, samples, passes, seed, kind)
    found = [_pass_links(coded, classes, range(t, min(t + _ROUND, passes)), window, threshold, kind) for t in range(0, passes, _ROUND)]
    return reduce(DataFrame.union, [stored(f) for f in found]).distinct()


def _link_counts(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``id``, ``links``: for each vector of a group how many others of it, copies counted, are near.

    A large group is dealt into tiles of two bounded parts of it, so groups of any
    size are counted in tasks of bounded size, and no pair is written.  Its members
    look up its size in ``_SALT`` places, so that they need not meet in one task.
    Small groups are counted many at a time.
    """
    members = stored(members)
    counts = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    large = counts.where(F.col("n") > _TILE).select(
        "component", F.ceil(F.col("n") / _TILE).cast("int").alias("parts"), F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))).alias("salt")
    )
    buckets = members.count() // _COUNTED + 1
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALT)).cast("int"))
    rows = salted.join(large, ["component", "salt"], "left").select(
        "component", "id", "weight", "vec", F.col("parts").isNotNull().alias("large"), F.coalesce("parts", F.lit(1)).alias("parts"),
        F.when(F.col("parts").isNotNull(), F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(buckets))).alias("place"),
    ).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    held = ["large", "place", "component", "id", "weight", "vec"]
    asking = rows.withColumn("other", F.explode(others)).select(F.col("part").alias("i"), F.col("other").alias("j"), F.lit(True).alias("asks"), *held)
    asked = rows.withColumn("other", F.explode(others)).select(F.col("other").alias("i"), F.col("part").alias("j"), F.lit(False).alias("asks"), *held)

    def counted(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, weights, groups = (table.column(c).to_numpy() for c in ("id", "weight", "component"))
        vecs = table.column("vec").to_pylist()
        sizes = np.array([len(v) for v in vecs])
        out, links = ids[asks], np.zeros(int(asks.sum()), np.int64)
        for size in np.unique(sizes):
            mine, theirs = np.flatnonzero(asks & (sizes == size)), np.flatnonzero(~asks & (sizes == size))
            place = np.searchsorted(np.flatnonzero(asks), mine)
            if not len(mine) or not len(theirs):
                continue
            mine_units, units = _units([vecs[i] for i in mine], kind), _units([vecs[i] for i in theirs], kind)
            for first in range(0, len(mine), _TILE):
                rows = slice(first, first + _TILE)
                near = mine_units[rows] @ units.T >= threshold
                near &= (ids[mine[rows]][:, None] != ids[theirs]) & (groups[mine[rows]][:, None] == groups[theirs])
                links[place[rows]] = near @ weights[theirs]
        return pa.table({"id": out, "links": links})

    tiles = asking.union(asked).groupBy("large", "place", "i", "j").applyInArrow(counted, "id bigint, links bigint")
    return tiles.groupBy("id").agg(F.sum("links").alias("links"))


def near_vectors(
    rows: DataFrame, threshold: float = 0.95, passes: int | None = None, window: int = WINDOW, seed: int = SEED,
    id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """One row per row of ``rows``: its id, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other vectors of cosine at least ``threshold``,
    ``component_id`` is the smallest id reachable over such links, itself included,
    and ``kept`` marks that one.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths don't
    link; a row without an id links with nothing and is not kept.  Equal vectors
    are one in the search and are all counted.  An empty table gives an empty
    result; other columns are ignored.  Ids must be integers.

    Passes find groups: a link is missed only if no pass brings a pair, or a chain
    of pairs between them, into one window, which for a pair at the threshold has a
    chance of about ``MISS`` at every size and in crowds.  Within a group every link
    is then counted.  ``passes`` sets their number, ``window`` how many neighbours a
    vector is compared with in each.
    """
    kind = {"float": "<f4"}.get(rows.schema[vector].dataType.elementType.simpleString(), "<f8")
    rows = rows.select(F.col(id_column).cast("bigint").alias(id_column), vector)
    read = stored(_usable(rows, id_column, vector, kind))
    classes = stored(
        read.where(F.col("digest").isNotNull())
        .groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.min("vec").alias("vec"))
        .repartition(partitions(rows.sparkSession), "id")  # passes join by it
    )
    groups = connected_components(_links(classes, threshold, passes, window, seed, kind))
    groups = stored(groups.union(groups.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "id"))
    counts = _link_counts(groups.join(classes, "id").select("component", "id", "weight", "vec"), threshold, kind)
    found = (
        classes.select("digest", "id", "weight").join(groups, "id", "left").join(counts, "id", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    return read.select("id", "digest").join(found, "digest", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
