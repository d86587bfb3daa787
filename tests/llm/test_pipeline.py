"""The registered queries as they are registered, and the pipeline against its stages done plainly."""

import re

import duckdb
import pytest
from oracle_check import compare, connect
from test_dedup import near_groups
from test_tokens import check_packing

import __spark_entry__ as contract
import corpus_pipeline
from velorank.llm import secret_scan, simhash, toxicity
from velorank.llm.queries import ORACLE, QUERIES, op5_toxicity

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    registered = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    good, note = compare(spark, connect(SMALL), QUERIES[name], ORACLE[name], SMALL)
    assert good, note


def test_pipeline_matches_plain_stages(spark):
    folder = "/root/testdata/sf0.01"
    toxic = {r.doc_id for r in op5_toxicity(spark, folder).collect() if r.predicted}
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall())
    left = {i: t for i, t in docs.items() if i not in toxic}
    keep = {}
    for i, t in left.items():
        keep[t] = max(keep.get(t, i), i)
    left = {i: t for t, i in keep.items()}
    left = {i: left[i] for i, (_, first) in near_groups(left).items() if i == first}
    frame = spark.createDataFrame(sorted(left.items()), "doc_id bigint, text string")
    spans = {r.doc_id: r.found for r in secret_scan.find_secrets(frame).collect()}
    for i, found in spans.items():
        for s in sorted(found, key=lambda s: -s.start):
            if not any(o.start < s.start < o.end for o in found):
                end = max([s.end, *(o.end for o in found if s.start <= o.start < s.end)])
                left[i] = left[i][: s.start] + secret_scan.REPLACEMENT + left[i][end:]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert toxic and 0 < len(left) < len(docs)
    check_packing(left, rows)


def test_stages_keep_the_columns(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMALL).columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).columns[0] == "doc_id"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "secret_scan", "best_fit_packing"]


def test_rows_without_an_id_are_decided_by_their_text(spark):
    """Unique, near-copied and toxic texts without an id, and an id that repeats with different texts."""
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(None, "a text that nothing else resembles at all"), (7, long), (None, long + " end"), (None, "only null ids here"), (None, "only null ids here")]
    rows += [(7, "quite another text under the same id"), (3, "another one of id three"), (9, long.upper())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = sorted(((r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs).collect()), key=str)
    assert left == sorted([rows[0], rows[1], rows[3], rows[5], rows[6]], key=str)
    texts = [(i, f"calm words about weather number {i}", 0) for i in range(60)] + [(100 + i, f"awful slurry words here {i}", 1) for i in range(20)]
    odd = [(None, "awful slurry words here again"), (None, "calm words about weather again"), (100, "calm words about weather too")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts] + odd, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in texts if i != 100], "doc_id bigint, toxic int")
    kept = toxicity.drop_toxic(docs, marks, toxicity.Settings(association=10.0)).collect()
    assert sorted((r.text for r in kept)) == sorted([t for _, t, y in texts if not y] + [odd[1][1], odd[2][1]])


def test_n_chars_changes_only_with_the_text(spark):
    texts = ["calm [REDACTED] words", 'password = "abcdefghijkl0123" here', None]
    docs = spark.createDataFrame([(i, t, 7, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint, _before int")
    rows = {r.doc_id: r for r in corpus_pipeline.redact(spark, docs, "").collect()}
    assert rows[0].n_chars == 7 and rows[2].n_chars == 7 and rows[0]["_before"] == 1
    assert rows[1].n_chars == len(rows[1].text) != 7
