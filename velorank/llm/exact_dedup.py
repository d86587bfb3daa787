"""Exact deduplication by sorting contents (DataFrame functions only).

Sampled splitters range-partition the normalised texts, each partition is sorted
(spilling to disk as needed), and a sort aggregate compares each text with its
neighbour in full.  Only texts that a first count finds in very many rows are cut
into several runs, which a second, small sort of the same kind unites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import partitions, stored, unused, whole_text

# Characters at a text's beginning and end that splitters hold, which pass through the driver.
SPLITTER_LENGTH = 32
# A text that many rows share is sorted as this many runs for each partition.
RUNS_PER_PARTITION = 4
# Rows of one beginning, end and length that one task may hold, however small the table.
HOT_ROWS = 1000

NORMALISATIONS = {
    "none": lambda text: text,
    "case_and_space": lambda text: F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")),
}


def _normalised(text: str, normalise: str) -> Column:
    return NORMALISATIONS[normalise](whole_text(text))


# What rows are ordered by before their whole contents: a total preorder of contents that short splitters can cut.
_ORDER = ("head", "length", "tail")


def _ordered_contents(docs: DataFrame, id_column: str, text: str, normalise: str) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), _normalised(text, normalise).alias("content"))
    return rows.select(
        "id", "content", F.substring("content", 1, SPLITTER_LENGTH).alias("head"),
        F.length("content").alias("length"), F.substring("content", -SPLITTER_LENGTH, SPLITTER_LENGTH).alias("tail"),
    )


def content_runs(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: str = "none"
) -> DataFrame:
    """One row per run of equal contents in the sorted partitions: ``text_sha256``, ``kept``, ``size``, ``hot``, and hot contents.

    A content is one run, unless its beginning, length and end are those of more
    rows than a task should hold: then it is a run for each of a bounded number of
    salts.  The hot ones, fewer than the runs there may be, are found by a count that
    is summed before its shuffle.
    """
    n = partitions(docs.sparkSession)
    best = {"smallest": F.min, "largest": F.max}[keep]
    known = F.col("id").isNull() if keep == "smallest" else F.col("id").isNotNull()  # a null id comes last
    rows = _ordered_contents(docs, id_column, text, normalise)
    most = max(HOT_ROWS, docs.count() // (n * RUNS_PER_PARTITION))
    hot = stored(rows.groupBy(*_ORDER).count().where(F.col("count") > most).select(*_ORDER, F.lit(True).alias("hot")))
    spread = F.coalesce(F.xxhash64(F.col("id").cast("string"), F.spark_partition_id()), F.lit(0))
    rows = rows.join(F.broadcast(hot), list(_ORDER), "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(spread, F.lit(n * RUNS_PER_PARTITION))).otherwise(0))
    # A struct's extreme has no hash-aggregate form: equal neighbours are folded in sort order.
    return (
        rows.repartitionByRange(n, *_ORDER, "salt")
        .groupBy(*_ORDER, "salt", "content", "hot")
        .agg(best(F.struct(known, "id")).alias("kept"), F.count(F.lit(1)).alias("size"))
        .select(*_ORDER, F.when(F.col("hot"), F.col("content")).alias("content"), "hot", F.sha2("content", 256).alias("text_sha256"), "kept", "size")
    )


def content_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: str = "none"
) -> DataFrame:
    """One row per distinct normalised text: ``text_sha256``, ``keep_id``, ``group_size``.

    The comparison of neighbours in sorted runs decides; the runs of a hot content,
    of which there are at most ``RUNS_PER_PARTITION`` x partitions, are sorted by
    their contents once more.
    """
    n = partitions(docs.sparkSession)
    best = {"smallest": F.min, "largest": F.max}[keep]
    runs = stored(content_runs(docs, id_column, text, keep, normalise))
    whole = runs.where(~F.col("hot")).select("text_sha256", "kept", "size")
    united = (
        runs.where("hot").repartitionByRange(n, *_ORDER)
        .groupBy(*_ORDER, "content")
        .agg(best("kept").alias("kept"), F.sum("size").alias("size"), F.first("text_sha256").alias("text_sha256"))
        .select("text_sha256", "kept", "size")
    )
    return whole.union(united).select("text_sha256", F.col("kept.id").alias("keep_id"), F.col("size").alias("group_size"))


def mark_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: str = "none"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null counts as empty text, so all null and empty texts are one group.  Ties
    don't arise between different ids; rows that repeat an id and its text count
    as copies and are all marked alike.  A null id is kept only where its group
    has no other.  An empty table gives an empty result; other columns are ignored.
    """
    # Written, so that the join's own shuffle is all that stands before it and a hot digest can be split.
    groups = stored(content_groups(docs, id_column, text, keep, normalise))
    rows = docs.select(F.col(id_column), F.sha2(_normalised(text, normalise), 256).alias("text_sha256"))
    return rows.join(groups, "text_sha256").select(
        F.col(id_column),
        "keep_id",
        "group_size",
        F.col(id_column).eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: str = "none"
) -> DataFrame:
    """The rows of ``docs`` whose text no better row has, with all their columns.

    Of rows that repeat both id and text one remains.  The kept rows' ids are
    joined back by digest and id; of the texts themselves only kept ones are
    shuffled, once more than :func:`content_groups` does.
    """
    digest, key = unused(docs, "_digest", "_key")
    groups = content_groups(docs, id_column, text, keep, normalise)
    groups = groups.select(F.col("text_sha256").alias(digest), F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias(key))
    rows = docs.withColumn(digest, F.sha2(_normalised(text, normalise), 256))
    rows = rows.withColumn(key, F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    # Keyed by digest and id, the copies of a hot text are spread before they are dropped.
    return rows.join(groups, [digest, key], "left_semi").dropDuplicates([digest, key]).select(*docs.columns)
