"""Packing documents into sequences: best two-fit on a histogram of lengths.

Only lengths matter to packing, and there are at most ``capacity`` of them.  So
the rule is run on the counts of each length: a bin made by it is repeated as
often as the counts allow, which gives a few bins per length, whatever the
number of documents is.  Pieces then find their place by their rank among the
pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velorank.llm.common import small_batches, stored, whole_text
from velorank.llm.tokens import byte_bpe

CAPACITY = 1024
END = 2
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint, _part int, _row bigint"


def _fill(counts: np.ndarray, capacity: int) -> list[int]:
    """One bin by best two-fit, its largest piece first; ``counts`` is by length and not changed."""
    left, gap, bin_ = counts.copy(), capacity, []
    while gap:
        fitting = np.flatnonzero(left[: gap + 1])
        if not len(fitting):
            break
        size = int(fitting[-1])
        take = min(int(left[size]), gap // size)
        bin_ += [size] * take
        left[size] -= take
        gap -= take * size
    if gap and len(bin_) > 1:
        pair = _best_pair(left, bin_[-1] + 1, bin_[-1] + gap)
        if pair:
            bin_[-1:] = pair
    return bin_


def _best_pair(left: np.ndarray, least: int, most: int) -> list[int] | None:
    """Two pieces that are left whose lengths sum up to the largest value in the range."""
    lengths = np.flatnonzero(left)
    best: tuple[int, int, int] | None = None
    if len(lengths):
        # For each first length the longest second one that still fits.
        at = np.searchsorted(lengths, most - lengths, "right") - 1
        for i in np.flatnonzero(at >= 0):
            j = int(at[i])
            if j == i and left[lengths[i]] < 2:
                j -= 1
            if j < 0:
                continue
            total = int(lengths[i] + lengths[j])
            if total >= least and (best is None or total > best[0]):
                best = (total, int(lengths[i]), int(lengths[j]))
    return None if best is None else sorted(best[1:], reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins, each a list of lengths and the number of times it is made.

    Greedy filling takes the longest piece that fits; then the bin's smallest one
    gives way to two unpacked ones that fill more of the gap it leaves.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    while counts.any():
        bin_ = _fill(counts, capacity)
        lengths, uses = np.unique(bin_, return_counts=True)
        times = int((counts[lengths] // uses).min())
        counts[lengths] -= uses * times
        plan.append((bin_, times))
    return plan


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than ``capacity``."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def token_pieces(
    docs: DataFrame, tokenizer: tuple[str, str | None], capacity: int = CAPACITY, end: int = END,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece of each document's ids, written once: its place in the document, length and checksum."""
    rows = docs.select(F.col(id_column), whole_text(text).alias("_text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_bpe(*tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in small_batches(batches):
            at, out = [], []
            for i, content in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.encode(content), np.uint32(end)).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    at.append(i)
                    out.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), part, int(seen[length])))
                    seen[length] += 1
            cells = np.array(out, np.int64).reshape(-1, 6)
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            columns += [pa.array(cells[:, k].astype(np.int32) if k in (0, 4) else cells[:, k]) for k in range(6)]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "piece", "start", "length", "ids_crc32", "_part", "_row"])

    kind = rows.schema[id_column].dataType.simpleString()
    return stored(rows.mapInArrow(pieces, f"`{id_column}` {kind}, {PIECES}"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for each row of :func:`token_pieces`.

    A piece's rank among those of its length is its place in its partition plus
    the counts of the partitions before, so no task holds all pieces of a common
    length.  What reaches the driver is one count per length; what is broadcast is
    the plan, a row for each piece of a bin, of which there are a few per length.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots, taken, bins = [], dict.fromkeys(histogram, 0), 0
    for lengths, times in plan_bins(histogram, capacity):
        offset = 0
        for length in lengths:
            slots.append((length, taken[length], taken[length] + times, bins, offset))
            taken[length] += times
            offset += length
        bins += times
    plan = spark.createDataFrame(slots, "length bigint, _from bigint, _to bigint, _bin bigint, offset bigint")
    ranked = pieces.join(before, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_row"))
    inside = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(plan), "length").where(inside)
    return placed.withColumn("sequence_id", F.col("_bin") + F.col("_rank") - F.col("_from")).drop(
        "_part", "_row", "_before", "_rank", "_from", "_to", "_bin"
    )


def pack_documents(
    docs: DataFrame, tokenizer: tuple[str, str | None], capacity: int = CAPACITY, end: int = END,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each document's pieces and their place in sequences of at most ``capacity`` ids.

    Columns: the id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``.  A null or empty text is its end id alone.
    Repeated rows are packed each for itself; an empty table gives an empty
    result; other columns are ignored.
    """
    columns = [id_column, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(token_pieces(docs, tokenizer, capacity, end, id_column, text), capacity).select(*columns)
