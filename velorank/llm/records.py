"""Token ids as length-delimited binary records with masked checksums and an offset index.

A file is a sequence of frames, all numbers little-endian::

    uint64 length | uint32 masked crc32 of those 8 bytes | payload | uint32 masked crc32 of the payload

A payload is the document's id (int64), the bytes per token id (one byte, 2 or 4, plus
128 for a document without an id, whose id field is 0), and the token ids as unsigned
integers of that size.
Checksums are masked by rotating them right by 15 bits and adding a constant, so
that a checksum stored among the data is not mistaken for one of the data.  Next
to each ``.rec`` file stands an ``.idx`` file with one int64 pair per record, its
offset and length, so readers can fetch records in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velorank.llm.common import partitions, small_batches, stored, whole_text
from velorank.llm.tokens import byte_bpe

# Fixed by the record format.
MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_DOCUMENT = struct.Struct("<qB")
_NO_ID = 128


class BadRecord(ValueError):
    """A frame is cut short or fails its checksum."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = _DOCUMENT.pack(0, width | _NO_ID) if doc is None else _DOCUMENT.pack(doc, width)
    return head + ids.astype(f"<u{width}").tobytes()


def parse_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    """The document's id (None if it has none) and its token ids, as little-endian unsigned 32-bit numbers."""
    doc, width = _DOCUMENT.unpack_from(payload)
    if width & _NO_ID:
        doc, width = None, width ^ _NO_ID
    return doc, np.frombuffer(payload, f"<u{width}", offset=_DOCUMENT.size).astype("<u4")


def read_frame(source) -> bytes | None:
    """The next payload, or None at the end."""
    head = source.read(_HEAD.size)
    if not head:
        return None
    if len(head) < _HEAD.size or masked(head[:8]) != _HEAD.unpack(head)[1]:
        raise BadRecord("record head")
    size = _HEAD.unpack(head)[0]
    payload, tail = source.read(size), source.read(_TAIL.size)
    if len(payload) < size or len(tail) < _TAIL.size or masked(payload) != _TAIL.unpack(tail)[0]:
        raise BadRecord("record payload")
    return payload


def read_at(file: str, record: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, through the index."""
    fs, path = pafs.FileSystem.from_uri(file)
    with fs.open_input_file(path.removesuffix(".rec") + ".idx") as index:
        offset, length = struct.unpack("<qq", index.read_at(16, 16 * record))
    with fs.open_input_file(path) as source:
        source.seek(offset)
        return parse_payload(read_frame(pa.BufferReader(source.read(length))))


def write_records(
    docs: DataFrame, folder: str, tokenizer: tuple[str, str | None], end: int | None = 2,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write all documents in ascending order of id; returns the manifest.

    The manifest has a row per file: ``part`` (order of the files), ``file``,
    ``records``, ``tokens``, ``bytes``.  ``folder`` is a URI any executor can
    write to.  A task writes under names of its own and reports them when it is
    done, so what a lost or repeated task leaves behind is never read.  Ids must
    be integers; documents without one come last.  Rows that share an id, or have
    none, stand together in any order, over as many files as their number asks for.
    A null text is empty; repeated rows are records of their own; an empty table
    gives no files.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), whole_text(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    # The row's place only parts rows of one id; the splitters are sampled from ids alone, so texts are read once.
    by_id = F.col("id").asc_nulls_last()
    ordered = rows.repartitionByRange(partitions(spark), by_id, "row").sortWithinPartitions(by_id, "row").select("id", "text")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_bpe(*tokenizer), TaskContext.get().partitionId()
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}"
        records = tokens = place = 0
        data = index = None
        try:
            for batch in small_batches(batches):
                for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if data is None:
                        data = fs.open_output_stream(f"{path}/{name}.rec", compression=None, buffer_size=1 << 20)
                        index = fs.open_output_stream(f"{path}/{name}.idx", compression=None, buffer_size=1 << 16)
                    ids = encoder.encode(content)
                    ids = ids if end is None else np.append(ids, np.uint32(end)).astype("<u4")
                    record = frame(payload_of(doc, ids))
                    data.write(record)
                    index.write(struct.pack("<qq", place, len(record)))
                    records, tokens, place = records + 1, tokens + len(ids), place + len(record)
        finally:
            for stream in (data, index):
                if stream is not None:
                    stream.close()
        if records:
            names = ["part", "file", "records", "tokens", "bytes"]
            cells = [[part], [f"{folder}/{name}.rec"], [records], [tokens], [place]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names)

    manifest = "part int, file string, records bigint, tokens bigint, bytes bigint"
    return stored(ordered.mapInArrow(written, manifest))


def read_records(manifest: DataFrame) -> DataFrame:
    """A row per record in the files: ``part``, ``id``, ``start``, ``n_tokens``, ``ids``.

    ``start`` counts the ids of all records before it, over all files.  Frames are
    read one after another and their checksums verified.
    """
    firsts = with_starts(manifest)

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file, start in zip(*(batch.column(k).to_pylist() for k in range(3))):
                fs, path = pafs.FileSystem.from_uri(file)
                with fs.open_input_stream(path, compression=None, buffer_size=1 << 20) as source:
                    held, size = [], 0
                    while (payload := read_frame(source)) is not None:
                        doc, ids = parse_payload(payload)
                        held.append((part, doc, start, len(ids), ids.tobytes()))
                        start, size = start + len(ids), size + len(payload)
                        if size > 1 << 22:
                            yield _batch(held)
                            held, size = [], 0
                    if held:
                        yield _batch(held)

    kinds = "part int, id bigint, start bigint, n_tokens bigint, ids binary"
    # One file to a task: the manifest is small, what it names is not.
    spread = firsts.repartitionByRange(partitions(manifest.sparkSession), "part")
    return spread.select("part", "file", "start").mapInArrow(contents, kinds)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["part", "id", "start", "n_tokens", "ids"])


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids in all files before; a row per file is all that is summed."""
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))
