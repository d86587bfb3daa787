"""WARC archives of captured pages, and their index by external merge.

Tasks write archives and, next to them, runs of index entries sorted by URL key and
timestamp.  The runs are merged by loser trees: first, as long as there are more of
them than a task should open, in groups into longer runs; then by key ranges, each
task merging its range out of all runs.  The ranges are cut by sampled entries, full
keys with time, id and place, so a URL captured very often is spread over several, and
so are pages that share an id or have none.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import partitions, small_batches, stored, with_positions

LEAST_REVISIT = 100
FAN_IN = 64
_RUN_ROWS = 100_000
_GROUP_ROWS = 4096
_SAMPLES = 64
_LAST_SECOND = 200_000_000_000
# Fixed by the WARC format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Entries sort as they stand; ``unnamed`` pages, which have no id, come after the others (their ``page_id`` is 0 here).
ENTRY = pa.schema([
    ("urlkey", pa.string()), ("timestamp", pa.string()), ("unnamed", pa.bool_()), ("page_id", pa.int64()),
    ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()),
])
_ENTRY_DDL = "urlkey string, timestamp string, unnamed boolean, page_id bigint, file string, offset bigint, size bigint"
# What cuts and samples hold: no two entries are equal in it.
_KEY = pa.schema(list(ENTRY)[:6])
_KEY_DDL = _ENTRY_DDL.rpartition(",")[0]


def url_key(url: str | None) -> str:
    """Sortable form of a URL: host reversed, then path and query; empty for null."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    default = {"http": 80, "https": 443}.get(parts.scheme)
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return host + (f":{port}" if port and port != default else "") + ")" + (parts.path or "/") + query


class LoserTree:
    """Merges sorted streams: each inner node holds the loser of its match, so a new value plays one match per level."""

    def __init__(self, streams: list[Iterator[tuple]]) -> None:
        self._streams = streams
        self._heads = [next(s, None) for s in streams]
        n = len(streams)
        self._losers = [-1] * max(n, 1)
        self._winner = -1
        for leaf in range(n):
            self._enter(leaf)

    def _less(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None and (x is not None or a < b) or x is not None and y is not None and (x, a) < (y, b)

    def _enter(self, leaf: int) -> None:
        """Put a leaf into the tree for the first time: it waits at the first free node, else plays on."""
        node, best = (leaf + len(self._streams)) // 2, leaf
        while node > 0:
            if self._losers[node] < 0:
                self._losers[node] = best
                return
            if self._less(self._losers[node], best):
                self._losers[node], best = best, self._losers[node]
            node //= 2
        self._winner = best

    def __iter__(self) -> Iterator[tuple]:
        n = len(self._streams)
        while n and self._heads[self._winner] is not None:
            leaf = self._winner
            yield self._heads[leaf]
            self._heads[leaf] = next(self._streams[leaf], None)
            node, best = (leaf + n) // 2, leaf
            while node > 0:
                if self._less(self._losers[node], best):
                    self._losers[node], best = best, self._losers[node]
                node //= 2
            self._winner = best


# Records


def _header(lines: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"


def _name(page: int | None) -> str:
    return "<urn:page:none>" if page is None else f"<urn:page:{page}>"


def _record(page: int | None, url: str | None, when: str, payload: bytes, digest: str, first: int | None) -> bytes:
    """A gzip member with a response, or a revisit, which has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines: list[tuple[str, object]] = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _name(page)),
        ("WARC-Date", when),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url:
        lines.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if first is not None:
        lines += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(first))]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(_header(lines) + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    if len(rest) < len(block) + 4 or len(block) < int(warc["Content-Length"]):
        raise ValueError("a record is cut short")
    head, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:]), payload


def read_members(source) -> Iterator[tuple[int, int, bytes]]:
    """Offset, size and content of each gzip member of an archive, one at a time."""
    offset, held = 0, b""
    while held or (held := source.read(1 << 20)):
        unpacker, parts, size = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not held and not (held := source.read(1 << 20)):
                raise ValueError("an archive is cut short")
            parts.append(unpacker.decompress(held))
            size += len(held) - len(unpacker.unused_data)
            held = unpacker.unused_data
        yield offset, size, b"".join(parts)
        offset += size


def _urn(text: str | None) -> int | None:
    return int(text.removeprefix("<urn:page:").removesuffix(">")) if text and text != _name(None) else None


# Writing


def _write_run(fs, path: str, entries: list[tuple]) -> None:
    table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*entries), ENTRY)], schema=ENTRY)
    with fs.open_output_stream(path, compression=None) as out:
        pq.write_table(table, out, row_group_size=_GROUP_ROWS)


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
    date: str | None = None, least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """Write every page as a record; returns the manifest: ``run`` (path), ``entries``, ``samples``.

    Of equal payloads of at least ``least_revisit`` bytes the smallest id is a
    response and the others are revisits that refer to it.  Payloads are moved once,
    to where their digest is; a digest that very many pages share is split by
    adaptive execution.  Without a ``date`` column a page's date is its id in seconds
    from 1970.  A null payload is empty, a null URL is left out.  Rows that repeat
    an id are records of their own (the first row of a digest is the one of its
    smallest id, so repeats of it are responses too).  Pages without an id come last:
    they revisit the smallest id of their payload, and are responses where it has none,
    for nothing could be referred to.  A task's files have names of their own and
    count once it is done.
    """
    known = F.col(id_column).cast("bigint")
    when = F.col(date).cast("timestamp") if date else F.lit(None).cast("timestamp")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(known.alias("id"), F.col(url).cast("string").alias("url"), F.unix_seconds(when).alias("second"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("shared", F.when(F.octet_length("body") >= least_revisit, F.col("digest")))
    keys = pages.select(known.alias("id"), F.sha2(body, 256).alias("shared"), F.octet_length(body).alias("n"))
    firsts = (
        keys.where(F.col("n") >= least_revisit).groupBy("shared").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & F.col("first").isNotNull()).drop("copies")
    )
    decided = rows.join(firsts, "shared", "left").select("id", "url", "second", "body", "digest", "first")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}"
        entries: list[tuple] = []
        runs: list[tuple] = []
        place, data = 0, None

        def close_run() -> None:
            entries.sort()
            run = f"{name}-{len(runs):04d}.run"
            _write_run(fs, f"{path}/{run}", entries)
            step = max(1, len(entries) // _SAMPLES)
            samples = [dict(zip(_KEY.names, e)) for e in entries[step // 2 :: step]]
            runs.append((f"{folder}/{run}", len(entries), samples))
            entries.clear()

        try:
            for batch in small_batches(batches):
                for page, address, second, content, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if data is None:
                        data = fs.open_output_stream(f"{path}/{name}.warc.gz", compression=None, buffer_size=1 << 20)
                    moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=(page or 0) % _LAST_SECOND if second is None else second)
                    stamp = moment.strftime("%Y-%m-%dT%H:%M:%SZ")
                    record = _record(page, address, stamp, content, digest, None if first == page else first)
                    data.write(record)
                    entries.append((url_key(address), stamp, page is None, page or 0, f"{folder}/{name}.warc.gz", place, len(record)))
                    place += len(record)
                    if len(entries) == _RUN_ROWS:
                        close_run()
            if entries:
                close_run()
        finally:
            if data is not None:
                data.close()
        kinds = pa.list_(pa.struct(list(_KEY)))
        columns = [pa.array([r[k] for r in runs], t) for k, t in enumerate((pa.string(), pa.int64(), kinds))]
        yield pa.RecordBatch.from_arrays(columns, ["run", "entries", "samples"])

    manifest = f"run string, entries bigint, samples array<struct<{_KEY_DDL}>>"
    return stored(decided.mapInArrow(written, manifest))


# Merging


def _slice(run: str, low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """A run's entries from ``low`` to below ``high``; row groups outside are not read."""
    fs, path = pafs.FileSystem.from_uri(run)
    with fs.open_input_file(path) as source:
        file = pq.ParquetFile(source)
        for group in range(file.metadata.num_row_groups):
            keys = file.metadata.row_group(group).column(0).statistics
            if keys is not None and keys.has_min_max and (low and keys.max < low[0] or high and keys.min > high[0]):
                continue
            columns = file.read_row_group(group).to_pydict()
            for entry in zip(*(columns[f.name] for f in ENTRY)):
                if (low is None or entry >= low) and (high is None or entry < high):
                    yield entry


def _batches(entries: Iterator[tuple], extra: list[tuple[str, int]] = []) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held), ENTRY)]
        fixed = [pa.array([v] * len(held), pa.int32()) for _, v in extra]
        return pa.RecordBatch.from_arrays([*fixed, *columns], [*(n for n, _ in extra), *ENTRY.names])

    for entry in entries:
        held.append(entry)
        if len(held) == _GROUP_ROWS:
            yield out()
            held = []
    if held:
        yield out()


def _merge_groups(spark, runs: list[str], folder: str, fan_in: int) -> list[str]:
    """Longer runs, each merged out of ``fan_in`` of the given ones."""
    groups = [runs[i : i + fan_in] for i in range(0, len(runs), fan_in)]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(folder)
                name = f"merged-{uuid.uuid4().hex}.run"
                with fs.open_output_stream(f"{path}/{name}", compression=None) as out, pq.ParquetWriter(out, ENTRY) as writer:
                    for rows in _batches(iter(LoserTree([_slice(r, None, None) for r in group]))):
                        writer.write_batch(rows, row_group_size=_GROUP_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["run"])

    work = spark.createDataFrame([(g,) for g in groups], "runs array<string>").repartition(len(groups))
    return [r["run"] for r in stored(work.mapInArrow(merged, "run string")).collect()]


def merge_index(manifest: DataFrame, folder: str, fan_in: int = FAN_IN) -> DataFrame:
    """All entries in global order of URL key, timestamp and id, nulls last: ``range``, then the entry's columns.

    Ranges ascend, and within a range rows come in order.  ``fan_in`` runs are open
    in a task at most.  Paths of the runs, and one cut per range, pass through the
    driver; entries don't.
    """
    spark = manifest.sparkSession
    runs = sorted(r["run"] for r in manifest.select("run").collect())
    while len(runs) > fan_in:
        runs = _merge_groups(spark, runs, folder, fan_in)
    n = partitions(spark)
    samples = with_positions(manifest.select(F.explode("samples").alias("s")).select("s.*"), *_KEY.names)
    total = samples.count()
    step = max(1, total // n)
    chosen = samples.where((F.col("position") % step == 0) & (F.col("position") > 0)).orderBy("position").collect()  # at most 2 n
    cuts = sorted(tuple(r[name] for name in _KEY.names) for r in chosen)
    ranges = list(zip(range(len(cuts) + 1), [None, *cuts], [*cuts, None]))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                _, low, high = ranges[number]
                yield from _batches(iter(LoserTree([_slice(r, low, high) for r in runs])), [("range", number)])

    work = spark.createDataFrame([(r[0],) for r in ranges], "range int").repartitionByRange(len(ranges), "range")
    found = work.mapInArrow(merged, f"range int, {_ENTRY_DDL}")
    return found.withColumn("page_id", F.when(~F.col("unnamed"), F.col("page_id"))).drop("unnamed")


# Reading


def read_archives(index: DataFrame) -> DataFrame:
    """The records of all archives an index names, read from the files one after another.

    Columns: ``file``, ``offset``, ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``url``, ``timestamp``.  A response's payload is
    digested anew and must match its header.
    """
    kinds = "file string, offset bigint, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, timestamp string"
    names = [k.split()[0] for k in kinds.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(file)
                held = []
                with fs.open_input_file(path) as source:
                    for offset, _, data in read_members(source):
                        warc, http, payload = parse_record(data)
                        digest = warc["WARC-Payload-Digest"].removeprefix("sha256:")
                        if warc["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"damaged payload in {file} at {offset}")
                        held.append((
                            file, offset, _urn(warc["WARC-Record-ID"]), int(http["Content-Length"]), digest, warc["WARC-Type"],
                            _urn(warc.get("WARC-Refers-To")), warc.get("WARC-Target-URI"), warc["WARC-Date"],
                        ))
                        if len(held) == _GROUP_ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                            held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    # Written first: else its own small shuffle, merged into one task, would decide how many tasks read the archives.
    files = stored(index.select("file").distinct())
    return files.repartitionByRange(max(1, files.count()), "file").mapInArrow(contents, kinds)


def archive_and_index(pages: DataFrame, folder: str, **columns) -> DataFrame:
    """Write ``pages``, merge the index and read the records back: a row per capture with its place in the index.

    An empty table gives an empty result; other columns are ignored.
    """
    index = stored(merge_index(write_archives(pages, folder, **columns), folder))
    places = index.select("range", "urlkey", "file", "offset")
    # Both sides come out of lists of files, whose small size must not make Spark broadcast them.
    return read_archives(index).hint("merge").join(places.hint("merge"), ["file", "offset"])
