"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters are a binary vector with one place for each (letter, occurrence).
One inserted or deleted letter flips one place of it and a replaced one two, so near
words have vectors within Hamming distance two.  The places are dealt to a fixed
number of parts; whatever two places differ, all but two parts agree, so the
projections on every choice of all but two parts are exact signatures: near words
share one at least.  Words are equi-joined on them and verified letter by letter.

Words that are put together from the same syllables have equal vectors.  The join
key therefore also holds half of the word: of two words one edit apart, the shorter
of m letters, either the first m // 2 letters are equal or the last m - m // 2.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import small_batches, stored, whole_text

WORD = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = 4
# Places whose commonness decides their part; rarer ones go by hash.
_RANKED = 4096


def words_of(text: Column) -> Column:
    """The maximal runs of letters of a text, A-Z in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.translate(w, UPPER, LOWER))


def occurrences(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``word``, one row per word of each text; a null text has none."""
    return docs.select(F.col(id_column).alias("id"), F.explode(words_of(whole_text(text))).alias("word"))


def with_slips(words: DataFrame, one_in: int) -> DataFrame:
    """Words of which about one in ``one_in`` loses a letter, by the CRC-32 of ``id:word`` (a null id is empty)."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
    at = F.pmod(F.col("h"), F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.withColumn("h", h).select("id", F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``word`` and ``n`` of the words long and common enough; counted before anything is shuffled."""
    long_enough = words.where(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def dealt_places(words: DataFrame, parts: int) -> dict[tuple[str, int], int]:
    """The part of the commonest places, dealt back and forth so that parts say about as much as each other.

    At most ``_RANKED`` places reach the driver.  Any dealing finds all near words;
    this one only keeps signatures telling.
    """
    letters = F.array_sort(F.split("word", ""))
    placed = words.select(F.explode(F.transform(letters, lambda c, i: F.struct(c.alias("c"), (i + 1 - F.array_position(letters, c)).cast("int").alias("k")))).alias("p"))
    common = placed.groupBy("p.c", "p.k").count().orderBy(F.col("count").desc(), "c", "k").limit(_RANKED).collect()
    turn = [*range(parts), *reversed(range(parts))]
    return {(r.c, r.k): turn[i % len(turn)] for i, r in enumerate(common)}


def signatures(word: str, dealt: dict[tuple[str, int], int], parts: int = PARTS) -> list[str]:
    """The projections of a word's letters on every choice of all but two parts."""
    held: list[list[str]] = [[] for _ in range(parts)]
    before, k = "", 0
    for c in sorted(word):
        k = k + 1 if c == before else 0
        before = c
        part = dealt.get((c, k))
        held[xxhash.xxh32_intdigest(f"{c}{k}") % parts if part is None else part].append(c)
    whole = ["".join(h) for h in held]
    return [f"{i}:" + "|".join(whole[p] for p in chosen) for i, chosen in enumerate(itertools.combinations(range(parts), parts - 2))]


def join_keys(word: str, shorter: int, dealt: dict[tuple[str, int], int], parts: int = PARTS) -> list[int]:
    """Hashes of each signature with either half of the word, where the shorter of a pair has ``shorter`` letters."""
    half = shorter // 2
    halves = (f"<{shorter}:{word[:half]}:", f">{shorter}:{word[len(word) - shorter + half:]}:")
    keys = {xxhash.xxh64_intdigest(side + s) for s in signatures(word, dealt, parts) for side in halves}
    return [x - (1 << 64) if x >> 63 else x for x in keys]


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``a``, ``na``, ``b``, ``nb``, both ways, for words exactly one inserted, deleted or replaced code point apart.

    ``words`` has distinct ``word`` and its ``n``.  A word meets words of its own
    length under its own number of letters, and shorter ones under that less one.
    """
    dealt = dealt_places(words, parts)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in small_batches(batches, 4096):
            own = batch.column(0).to_pylist()
            columns = [pa.array([join_keys(w, len(w) - less, dealt, parts) for w in own], kind) for less in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["word", "n", "same", "shorter"])

    rows = stored(words.select("word", "n").mapInArrow(keyed, "word string, n bigint, same array<bigint>, shorter array<bigint>"))
    own = rows.select(F.explode("same").alias("key"), F.col("word").alias("a"), F.col("n").alias("na"))
    other = rows.select(F.explode(F.concat("same", "shorter")).alias("key"), F.col("word").alias("b"), F.col("n").alias("nb"))
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))  # words of equal length would meet twice
    met = own.join(other, "key").where(once & (F.length("a") <= F.length("b")) & (F.levenshtein("a", "b", 1) == 1))
    pairs = met.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))
    ways = F.explode(F.array(F.struct("a", "na", "b", "nb"), F.struct(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb"))))
    return pairs.select(ways.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form reached from it, for rows of ``word`` and ``form``.

    Pointers jump twice as far in each round; counts at least double from form to
    form, so a few rounds do.  Rounds are written to the shared folder.
    """
    jumps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = stored(jumps.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        jumps = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return jumps


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3,
    ratio: int = 2, slip_one_in: int | None = None, parts: int = PARTS,
) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words have at least ``min_length`` code points and ``min_count`` occurrences in
    all texts.  ``form`` is the commonest word one edit away (ties: the smallest in
    code-point order) if it occurs at least ``ratio`` times as often, else null, and
    ``root`` what following forms ends at.  ``slip_one_in`` drops a letter of about
    one occurrence in so many (see :func:`with_slips`).

    Null and empty texts have no words, an empty table gives no rows, repeated rows
    count each, null ids are texts like any other; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, so that chains of forms end soon")
    found = occurrences(docs, id_column, text)
    if slip_one_in:
        found = with_slips(found, slip_one_in)
    words = stored(vocabulary(found, min_length, min_count))
    near = stored(near_words(words, parts))
    best = near.groupBy("a", "na").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("na")
    best = stored(best.select(
        F.col("a").alias("word"), "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ))
    ends = roots(best.where(F.col("form").isNotNull()))
    return words.join(best, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
    )
