"""Archives: exact round trip, merged order, loser trees."""

import hashlib
import heapq
import io

import numpy as np
import pytest

from velorank.llm import warc
from velorank.llm.common import shared_folder, stored
from velorank.llm.queries import op8_warc


@pytest.mark.parametrize("streams", [0, 1, 2, 3, 5, 8, 17])
def test_loser_tree_merges(streams):
    random = np.random.default_rng(streams)
    lists = [sorted((int(x), k) for x in random.integers(0, 50, random.integers(0, 40))) for k in range(streams)]
    assert list(warc.LoserTree([iter(x) for x in lists])) == list(heapq.merge(*lists))


PAGES = [
    (1, "http://www.b.example.com/x?b=2&a=1", "p" * 200), (2, "https://a.example.com", "p" * 200), (3, "http://www.b.example.com/x?a=1&b=2", "p" * 200),
    (4, None, None), (5, "", ""), (6, "http://b.example.com/\r\nX: y", "short"), (7, "not a url é", "short"), (8, "http://[bad", "🙂" * 50),
    (9, "http://c.example:8080/p", "q" * 99), (10, "http://c.example:80/p", "q" * 99), (11, "http://c.example/p", "🙂" * 50),
]


def brute(pages):
    first = {}
    for i, _, html in sorted(pages, key=lambda p: p[0]):
        body = (html or "").encode()
        if len(body) >= 100:
            first.setdefault(body, i)
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        to = first.get(body, i)
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to == i else "revisit", None if to == i else to))
    return sorted(out)


def rows_of_list(rows):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


def rows_of(frame):
    return rows_of_list(frame.collect())


def pages_frame(spark, pages):
    return spark.createDataFrame([(*p, 1, 2, 3) for p in pages], "page_id bigint, url string, html string, file int, digest int, offset int").repartition(4)


def test_pages_come_back(spark):
    captures = warc.archive_and_index(pages_frame(spark, PAGES), shared_folder(spark, "warc"))
    assert rows_of(captures) == brute(PAGES)
    key = {r.page_id: r.urlkey for r in captures.collect()}
    assert key[1] == key[3] and key[10] == key[11] != key[9] and key[4] == key[5] == ""
    assert "\r" not in "".join(r.url or "" for r in captures.collect())
    assert warc.archive_and_index(pages_frame(spark, []), shared_folder(spark, "warc")).count() == 0


def test_given_pages(spark, folder):
    pages = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows_of(op8_warc(spark, folder)) == brute(pages)


def test_index_is_one_global_order(spark, monkeypatch):
    """Many short runs, merged in two levels, with a URL that a third of the captures share."""
    monkeypatch.setattr(warc, "_RUN_ROWS", 7)
    pages = [(i, "http://hot.example/" if i % 3 == 0 else f"http://s{i * 37 % 101}.example/{i % 5}", f"page {i}") for i in range(300)]
    folder = shared_folder(spark, "warc")
    manifest = warc.write_archives(pages_frame(spark, pages), folder)
    assert manifest.count() > 10
    index = stored(warc.merge_index(manifest, folder, fan_in=4))
    found = index.collect()
    assert sorted(r.page_id for r in found) == list(range(300))
    ranges = {}
    for r in found:
        ranges.setdefault(r.range, []).append((r.urlkey, r.timestamp, r.page_id))
    order = [entry for number in sorted(ranges) for entry in ranges[number]]
    assert order == sorted(order) and len(ranges) > 1
    assert len({number for number, own in ranges.items() if any(e[0] == "example,hot)/" for e in own)}) > 1
    assert rows_of(warc.read_archives(index)) == brute(pages)


def test_members_are_read_in_pieces():
    records = [warc._record(i, "http://a/", "1970-01-01T00:00:01Z", bytes([65 + i]) * (i * 100_000), "0" * 64, None) for i in range(4)]

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 1000))

    found = list(warc.read_members(Slow(b"".join(records))))
    assert [n for _, n, _ in found] == [len(r) for r in records]
    assert [len(warc.parse_record(data)[2]) for _, _, data in found] == [i * 100_000 for i in range(4)]
    with pytest.raises(ValueError, match="short"):
        list(warc.read_members(io.BytesIO(b"".join(records)[:-5])))


def test_pages_without_id_come_last(spark):
    """They revisit the smallest id of their payload; payloads no id has are responses all."""
    known = [(3, "http://a/", "p" * 100), (1, "http://b/", "p" * 100), (0, "http://a/", "x")]
    unnamed = [(None, "http://a/", "p" * 100), (None, None, "q" * 100), (None, None, "q" * 100), (None, "http://a/", None)]
    captures = warc.archive_and_index(pages_frame(spark, known + unnamed), shared_folder(spark, "warc")).collect()
    assert rows_of_list([r for r in captures if r.page_id is not None]) == brute(known)
    found = sorted((r.payload_bytes, r.record_type, r.refers_to) for r in captures if r.page_id is None)
    assert found == [(0, "response", None), (100, "response", None), (100, "response", None), (100, "revisit", 1)]


def test_pages_of_one_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "_RUN_ROWS", 10)
    pages = [(None, "http://hot.example/", f"page {i}") for i in range(200)] + [(i, f"http://s{i}.example/", "x") for i in range(100)]
    folder = shared_folder(spark, "warc")
    index = stored(warc.merge_index(warc.write_archives(pages_frame(spark, pages), folder), folder, fan_in=8))
    found = index.collect()
    assert len(found) == 300 == len({(r.file, r.offset) for r in found}) and sum(r.page_id is None for r in found) == 200
    assert len({r.range for r in found if r.page_id is None}) > 1
    order = [(r.urlkey, r.timestamp, r.page_id is None, r.page_id or 0) for r in sorted(found, key=lambda r: r.range)]
    assert order == sorted(order)
