"""Near-duplicates by SimHash and an inverted index over fingerprint bytes.

Two fingerprints of 8 bytes that differ in at most ``distance`` bits share at
least ``8 - distance`` bytes in place.  Posting lists of single bytes would each
hold a 256th of all documents, and counting along them would touch a share of
all pairs.  So the index is keyed by one positional byte less than that minimum
(every choice of places is a key): any qualifying pair meets in several lists, and
lists stay short at any size.  Within a list the shared positional bytes of a pair
are tallied; pairs below the minimum are dropped, and the rest is verified bit by
bit.  What stands in a long list is indexed once more, by the whole minimum.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from velorank.llm.common import partitions, small_batches, stored, unused, whole_text
from velorank.llm.components import connected_components

SEED = 42
_CHUNK = 1 << 16
# Lists up to this length are compared pair by pair; in longer ones a group is grown from its first member.
_PAIRWISE = 32
# From this length on, neighbours are looked up by their possible values instead of by scanning the list.
_SCAN = 1 << 13
# Members of lists beyond this length are indexed by one more byte.
_LONGEST = 1 << 12


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits; a bit is 1 if it is set in over half the shingles' hashes, 0 for no word at all.

    ASCII letters are lower-cased, words are separated by ASCII white space, and a
    text of fewer words than a shingle is one shingle.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends]
    of = xxhash.xxh64_intdigest
    n, ones = len(parts) - words + 1, np.zeros(64, np.int64)
    for first in range(0, n, _CHUNK):
        last = min(first + _CHUNK, n)
        hashes = [of(joined[s : e - 1], SEED) for s, e in zip(starts[first:last], ends[first + words - 1 : last + words - 1])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """The id and ``fp``, the fingerprint as a signed bigint, of each row; null text as empty."""
    rows = docs.select(F.col(id_column), whole_text(text).alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            marks = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            fp = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], [id_column, "fp"])

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(hashed, f"`{id_column}` {kind}, fp bigint")


def index_masks(places: int) -> list[int]:
    """The bits of each choice of so many byte places, as signed 64-bit values."""
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in itertools.combinations(range(8), places)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the 8 positional bytes each pair has in common."""
    return ((a ^ b).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Count filter first, then the bits."""
    alike = shared_bytes(a, b) >= 8 - distance
    alike[alike] = np.bitwise_count(a[alike] ^ b[alike]) <= distance
    return alike


def _grown(members: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join what hangs together in one long list: each member to the first of its group."""
    out, left = [], members
    flips = None
    if len(members) > _SCAN:
        flips = np.array([sum(1 << b for b in bits) for k in range(1, distance + 1) for bits in itertools.combinations(range(64), k)], np.uint64)
    while len(left):
        seed, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            at = queue.pop()
            if flips is not None and len(left) > _SCAN:
                near = np.isin(left, at ^ flips, assume_unique=True)
            else:
                near = linked(np.full(len(left), at), left, distance)
            if near.any():
                found, left = left[near], left[~near]
                out.append((found, np.full(len(found), seed)))
                queue.extend(found)
    return out


def list_links(
    keys: np.ndarray, marks: np.ndarray, distance: int, longest: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links within complete posting lists, and the members of those longer than ``longest``.

    ``keys`` and ``marks`` are sorted together.
    """
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])
    keys, marks = keys[fresh], marks[fresh]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(keys)])
    short = np.repeat((sizes > 1) & (sizes <= _PAIRWISE), sizes)
    found, crowded = [(marks[:0], marks[:0])], [marks[:0]]
    for gap in range(1, min(_PAIRWISE, int(sizes.max(initial=1)))):
        i = np.flatnonzero(short[:-gap] & (keys[:-gap] == keys[gap:]))
        i = i[linked(marks[i], marks[i + gap], distance)]
        found.append((marks[i], marks[i + gap]))
    for start, size in zip(starts[sizes > _PAIRWISE], sizes[sizes > _PAIRWISE]):
        members = marks[start : start + size]
        if longest is not None and size > longest:
            crowded.append(members)
        else:
            found += _grown(members, distance)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]), np.concatenate(crowded)


def _listed(marks: DataFrame, places: int, distance: int, longest: int | None) -> DataFrame:
    """Links ``a``, ``b`` out of the lists of all choices of ``places`` bytes; members of longer lists as ``a`` alone.

    Lists are sorted on disk and read as a stream; of a list that is too long only
    the first ``longest`` members and a batch are held.
    """
    masks = F.array(*[F.lit(m) for m in index_masks(places)])
    postings = marks.select(F.explode(masks).alias("mask"), "fp").select(F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = [], []  # of the last list met, whose end has not come yet
        passing = None  # the key of a list known to be too long

        def out(keys: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
            a, b, crowded = list_links(keys, marks, distance, longest)
            b = pa.concat_arrays([pa.array(b.view(np.int64)), pa.nulls(len(crowded), pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, crowded]).view(np.int64)), b], ["a", "b"])

        def alone(marks: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64)), pa.nulls(len(marks), pa.int64())], ["a", "b"])

        for batch in batches:
            keys, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if passing is not None and len(keys):
                same = int(np.searchsorted(keys, passing, side="right"))
                yield alone(marks[:same])
                keys, marks = keys[same:], marks[same:]
            if not len(keys):
                continue
            passing = None
            last = int(np.searchsorted(keys, keys[-1]))
            if last:  # the list before the batch's last one is complete
                yield out(np.concatenate([*held_keys, keys[:last]]), np.concatenate([*held, marks[:last]]))
                held_keys, held = [], []
            elif held_keys and held_keys[0][0] != keys[0]:
                yield out(np.concatenate(held_keys), np.concatenate(held))
                held_keys, held = [], []
            held_keys.append(keys[last:])
            held.append(marks[last:])
            # Choices of places can have one key, so a mark may be listed under it once for each of them.
            if longest is not None and len(together := np.unique(np.concatenate(held))) > longest:
                yield alone(together)
                held_keys, held, passing = [], [], keys[-1]
        if held:
            yield out(np.concatenate(held_keys), np.concatenate(held))

    lists = postings.repartition(partitions(marks.sparkSession), "key").sortWithinPartitions("key", "fp")
    return lists.mapInArrow(joined, "a bigint, b bigint")


def fingerprint_links(distinct: DataFrame, distance: int = 3, longest: int = _LONGEST) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly the fingerprints within ``distance`` bits.

    ``distinct`` has each fingerprint once; ``distance`` is at most 7.  In lists of
    more than 32 members a group's members are linked to its first one, not pair by
    pair.  Members of lists beyond ``longest`` are indexed by the guaranteed number
    of bytes, where a list holds at most 2^(8 x distance) of them whatever the input
    is: a pair that meets in such a list and shares enough meets there again.
    """
    least = 8 - distance
    if least < 2:
        return _listed(distinct, least, distance, None).distinct()
    first = stored(_listed(distinct, least - 1, distance, longest))
    crowded = first.where(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    return first.where(F.col("b").isNotNull()).union(_listed(crowded, least, distance, None)).distinct()


def _rooted(marked: DataFrame, id_column: str, distance: int) -> DataFrame:
    """``fp``, its smallest id ``first_id``, and ``root``, which the fingerprints of a group share."""
    classes = stored(marked.groupBy("fp").agg(F.min(id_column).alias("first_id")))
    groups = connected_components(fingerprint_links(classes.select("fp"), distance)).withColumnRenamed("node", "fp")
    return classes.join(groups, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` differing bits, itself included.  Null, empty and wordless texts
    have fingerprint zero and are linked like any other.  Repeated rows get equal
    results; an empty table gives an empty one; other columns are ignored.  Equal
    fingerprints are folded first, so copies cost one entry in the index.
    """
    marked = stored(fingerprints(docs, id_column, text, words))
    rooted = _rooted(marked, id_column, distance)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3
) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest id, nulls last.

    Fingerprints stand beside the rows, so ids may be null or repeat.  Of rows that
    share both id and fingerprint any one stays.
    """
    rooted = _rooted(stored(fingerprints(docs, id_column, text, words)), id_column, distance)
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("unknown"), "first_id", "fp")).alias("best"))
    mark, first, root = unused(docs, "_fp", "_first", "_root")
    best = best.select(F.col("best.fp").alias(mark), F.col("best.first_id").alias(first), F.col("root").alias(root))
    texts = docs.columns.index(text)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            marks = [fingerprint(t, words) for t in batch.column(texts).to_pylist()]
            fp = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fp], [*batch.schema.names, mark])

    rows = docs.mapInArrow(marked, StructType([*docs.schema.fields, StructField(mark, LongType())]))
    leading = rows.join(best, mark).where(F.col(id_column).eqNullSafe(F.col(first)))
    return leading.dropDuplicates([root]).select(*docs.columns)
