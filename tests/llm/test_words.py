"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import pytest

from velorank.llm import spelling

LETTERS = "A-Za-zÀ-ÿ"


def plain_words(docs, slip=None):
    found = Counter()
    for i, text in docs:
        for run in re.findall(f"[{LETTERS}]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if slip and h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return found


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(docs, slip=None, min_length=5, min_count=3):
    words = {w: n for w, n in plain_words(docs, slip).items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 2 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def variants(docs, **settings):
    rows = spelling.spelling_variants(docs, **settings).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r) for r in rows.collect())


def test_variants_match_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 40")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert variants(docs, slip_one_in=97) == plain_variants(rows, 97)


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_crowded_vocabulary(spark, parts):
    """Few letters, so that words with equal letter counts abound; chains of forms; any number of parts finds all."""
    draw = random.Random(parts)
    words = {"".join(draw.choice("abàÿ") for _ in range(draw.randint(4, 8))) for _ in range(300)}
    rows = [(i, " ".join([w] * draw.choice([1, 2, 3, 6, 13, 30]))) for i, w in enumerate(sorted(words))]
    rows += [(1000, "chains " * 3 + "chainss " * 6 + "chainsss " * 12 + "chainssst " * 24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = variants(docs, parts=parts)
    assert got == plain_variants(rows)
    assert [r[2] for r in got if r[0] == "chains"] == ["chainssst"]


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows, clashing columns, letters at the edges of the range, a null id."""
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert variants(odd_docs, slip_one_in=97) == plain_variants(rows, 97)
    assert variants(no_docs) == []
    rows = [(None, "Größe größe GRÖSSE Ångström ångström × ÷ a×b÷cde a×b÷cde a×b÷cde żółw żółw żółw"), (1, None), (1, "größe gröse gröse gröse größen größen größen größe größe größe größe größe")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, word int, n int")
    for slip in (None, 2, 97):
        assert variants(docs, slip_one_in=slip) == plain_variants(rows, slip)
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, ratio=1)


def test_near_words_share_a_key():
    """Whatever the places are dealt to."""
    draw = random.Random(1)
    for _ in range(2000):
        word = "".join(draw.choice("abcdeé") for _ in range(draw.randint(5, 9)))
        at, kind = draw.randrange(len(word)), draw.randrange(3)
        other = word[:at] + ("" if kind == 0 else draw.choice("xab")) + word[at + (kind != 2) :]
        dealt = {(c, k): draw.randrange(5) for c in "abc" for k in range(3)}
        if word != other:
            short = min(len(word), len(other))
            assert set(spelling.join_keys(word, short, dealt)) & set(spelling.join_keys(other, short, dealt))
    assert len(spelling.signatures("erdbeere", {}, 5)) == 10


def test_words_of_equal_letters_hardly_meet(spark):
    """Anagrams share all signatures; halves of the words keep them apart."""
    draw = random.Random(5)
    words = set()
    while len(words) < 400:
        letters = list("abcdefghijkl")
        draw.shuffle(letters)
        words.add("".join(letters))
    keys = Counter(k for w in words for k in set(spelling.join_keys(w, len(w), {})))
    assert sum(n * (n - 1) // 2 for n in keys.values()) < len(words) * 4
