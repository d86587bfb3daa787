"""Token operators against the tokenizers library, brute-force layouts and exact round trips."""

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from velorank.llm import packing, records, trie_bpe
from velorank.llm.common import shared_folder
from velorank.llm.tokens import ByteBpe, public_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = Tokenizer.from_file(public_files()[0])
WORD_LIBRARY = Tokenizer.from_file(WORDS)
FAST, PLAIN, TRIE = ByteBpe(*public_files()), ByteBpe(public_files()[0]), trie_bpe.TrieBpe(WORDS)
ODD = [
    "", "  ", " <|endoftext|>Hi<|startoftext|>x<|endoftext|", "İstanbul ΑΣ ̀é ﬁ ١٢ ２ ² ½ 中文字 🙂🙂 a\u0085b​c\x1cd it's 'S IT'LL",
    "aaaaaaaaaaaaaa aaaaaaaaa", "a" * 3000, "\0<|endoftext|> \0x", "don't''s '''s _x_ __", "ǅ Ǆ ß ẞ ŉ ſ K Å", "x\r\n\r\n  y   \t z ",
]


def by_library(text):
    ids = WORD_LIBRARY.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), WORD_LIBRARY.decode(ids, skip_special_tokens=False)


def test_trie_encodes_as_the_library(texts):
    every = [*texts.values(), *ODD]
    assert TRIE.encode_all(every) == [by_library(t) for t in every]


def test_fast_byte_ids_are_the_librarys(texts):
    for text in [*texts.values(), *ODD]:
        want = BYTES.encode(text, add_special_tokens=False).ids
        assert FAST.encode(text).tolist() == PLAIN.encode(text).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="aeinrst' \n’éß1_-", max_size=60)))
def test_any_text_encodes_as_by_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert TRIE.encode_all([text]) == [by_library(text)]
    assert FAST.encode(text).tolist() == BYTES.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("point", [range(0, 0x250), range(0x250, 0x3100, 7)])
def test_every_character_is_split_as_by_the_library(point):
    every = [t % chr(c) for c in point for t in ("a%sb", "1%s 2", "  %s  x", "'%s")]
    assert TRIE.encode_all(every) == [by_library(t) for t in every]
    assert [FAST.encode(t).tolist() for t in every] == [BYTES.encode(t, add_special_tokens=False).ids for t in every]


def test_words_with_shared_prefixes_and_forgetting(monkeypatch):
    words = [a + b for a in ("un", "under", "understand", "u", "interest") for b in ("", "ing", "ed", "able", "ingly", "s")]
    small = trie_bpe.TrieBpe(WORDS)
    monkeypatch.setattr(trie_bpe, "WORDS", 3)
    monkeypatch.setattr(trie_bpe, "PAIRS", 5)
    for _ in range(2):
        assert small.encode_all([" ".join(words)]) == [by_library(" ".join(words))]


def test_encode_and_decode_rows(odd_docs, no_docs):
    rows = trie_bpe.encode_and_decode(odd_docs, WORDS, contents=True).collect()
    want = []
    for r in odd_docs.collect():
        n, ids, decoded = by_library(r.text or "")
        want.append((r.doc_id, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), decoded))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in rows) == sorted(want)
    assert all(TRIE.decode(r.ids) == r.decoded for r in rows)
    assert trie_bpe.encode_and_decode(no_docs, WORDS).count() == 0


# Packing


def first_fit_decreasing(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        for i, room in enumerate(bins):
            if room >= length:
                bins[i] -= length
                break
        else:
            bins.append(capacity - length)
    return len(bins)


def test_two_fit_replaces_the_smallest_by_a_tighter_pair():
    # Greedy: 60 + 30 leaves 10; instead of 30, 22 and 18 fill the bin.
    assert packing.plan_bins({60: 1, 30: 1, 22: 1, 18: 1}, 100) == [([60, 22, 18], 1), ([30], 1)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=200))
def test_plan_places_every_piece_once(lengths):
    histogram = {}
    for length in lengths:
        histogram[length] = histogram.get(length, 0) + 1
    plan = packing.plan_bins(histogram, 64)
    placed = {}
    for bin_, times in plan:
        assert times > 0 and 0 < sum(bin_) <= 64
        for length in bin_:
            placed[length] = placed.get(length, 0) + times
    assert placed == histogram
    made = sum(times for _, times in plan)
    assert made >= -(-sum(lengths) // 64)
    assert made <= 1.2 * first_fit_decreasing(lengths, 64) + 1


def test_plan_stays_short_for_many_pieces():
    random = np.random.default_rng(1)
    lengths, counts = np.unique(random.integers(1, 1025, 3_000_000), return_counts=True)
    plan = packing.plan_bins(dict(zip(lengths.tolist(), counts.tolist())))
    made = sum(times for _, times in plan)
    assert len(plan) < 5000 and made <= 1.002 * -(-int((lengths * counts).sum()) // 1024)


def check_packing(docs, rows, capacity=1024):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in docs.items():
        ids = np.append(BYTES.encode(text, add_special_tokens=False).ids, 2).astype("<u4")
        own = sorted(pieces.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == capacity for r in own[1:]) and sum(r.length for r in own) == len(ids)
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    assert not pieces
    return len(sequences)


def test_packing_of_whole_documents(spark, folder, texts):
    rows = packing.pack_documents(spark.read.parquet(f"{folder}/documents.parquet"), public_files()).collect()
    used = check_packing(texts, rows)
    assert used <= first_fit_decreasing([r.length for r in rows], 1024)


def test_packing_of_odd_rows(odd_docs, no_docs):
    once = odd_docs.dropDuplicates(["doc_id"])
    check_packing({r.doc_id: r.text or "" for r in once.collect()}, packing.pack_documents(once, public_files(), 64).collect(), 64)
    assert packing.pack_documents(odd_docs, public_files()).count() > packing.pack_documents(once, public_files()).count()
    assert packing.pack_documents(no_docs, public_files()).count() == 0


# Records


def test_records_round_trip(spark, odd_docs, no_docs):
    manifest = records.write_records(odd_docs, shared_folder(spark, "records"), public_files())
    rows = records.read_records(manifest).orderBy("start").collect()
    docs = sorted(odd_docs.collect(), key=lambda r: r.doc_id)
    assert [r.id for r in rows] == [r.doc_id for r in docs]
    at = 0
    for r, doc in zip(rows, docs):
        ids = [*BYTES.encode(doc.text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (at, len(ids), ids)
        at += len(ids)
    files = manifest.orderBy("part").collect()
    assert sum(f.records for f in files) == len(docs) and sum(f.tokens for f in files) == at
    shuffled = [records.read_at(f.file, n) for f in files for n in reversed(range(f.records))]
    assert sorted((i, ids.tolist()) for i, ids in shuffled) == sorted((r.id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    empty = records.write_records(no_docs, shared_folder(spark, "records"), public_files())
    assert empty.count() == records.read_records(empty).count() == 0


def test_documents_without_id_come_last(spark):
    """A third of the rows has no id, a third one and the same: both are spread over several files."""
    docs = [(None, f"none {i % 7}") for i in range(400)] + [(-5, "hot")] * 400 + [(i, f"text {i}") for i in range(400)] + [(2**63 - 1, None)]
    given = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    manifest = records.write_records(given, shared_folder(spark, "records"), public_files())
    rows = records.read_records(manifest).orderBy("start").collect()
    want = sorted(docs, key=lambda d: (d[0] is None, d[0]))
    assert [r.id for r in rows] == [d[0] for d in want]
    found = sorted((r.id is None, r.id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert found == sorted((i is None, i or 0, [*BYTES.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in docs)
    starts = np.cumsum([0, *(r.n_tokens for r in rows)])
    assert [r.start for r in rows] == starts[:-1].tolist()
    for shared in (None, -5):
        assert len({r.part for r in rows if r.id == shared}) > 1


def test_damage_is_noticed():
    import pyarrow as pa

    payload = records.payload_of(7, np.array([1, 70_000], "<u4"))
    good = records.frame(payload)
    assert records.parse_payload(records.read_frame(pa.BufferReader(good)))[1].tolist() == [1, 70_000]
    for place in (0, 9, 14, len(good) - 1):
        bad = bytearray(good)
        bad[place] ^= 1
        with pytest.raises(records.BadRecord):
            records.read_frame(pa.BufferReader(bytes(bad)))
    for cut in (4, 15, len(good) - 2):
        with pytest.raises(records.BadRecord):
            records.read_frame(pa.BufferReader(good[:cut]))
    crc = zlib.crc32(payload)
    assert records.masked(payload) == struct.unpack("<I", good[-4:])[0] == (((crc >> 15) | (crc << 17 & 0xFFFFFFFF)) + 0xA282EAD8) & 0xFFFFFFFF
