import os

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark(spark):
    from velorank.llm.common import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def texts():
    """All documents of the smallest tables: id to text."""
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, copies, repeated rows, and columns named like the operators' own."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5),
        (4, "One two three four five six seven.", "en", "a", 34), (5, "One two three four five six seven.", "de", "b", 34),
        (5, "One two three four five six seven.", "de", "b", 34), (6, "ONE two three four five six seven.", "en", None, 34),
        (7, "word " * 30_000, "en", "a", 150_000), (8, "password = \"abcdefghijkl0123\" und Größe 🙂 <|endoftext|>", "de", "c", 50),
        (9, "a" * 5000, None, "c", 5000), (10, "naïve café 中文 ½ x²", "fr", "c", 18),
    ]
    names = "position size text_sha256 part _fp _root _first _digest _key _spans _part _row _before curve shard slot word n content hot".split()
    extra = [(*r, "x", *range(len(names))) for r in rows]
    return spark.createDataFrame(extra, DOCS + ", fp string, " + ", ".join(f"{n} int" for n in names)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def hot_docs(spark):
    """A third of all rows share one text."""
    texts = ["the same words again and again in one text"] * 300 + [f"text number {i} of many others with {i * 7} words" for i in range(600)]
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS).repartition(6)


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
