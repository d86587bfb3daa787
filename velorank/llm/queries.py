"""One query per operator of this folder, over whole tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from velorank.llm import (
    centroids, embeddings, exact_dedup, hilbert, html_text, packing, records, secret_scan, simhash, spelling, toxicity, trie_bpe, warc,
)
from velorank.llm.common import shared_folder, ship_package, whole_text
from velorank.llm.tokens import public_files

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 8
WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(id_column: str = "doc_id") -> F.Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1


def training_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").where(~held_out()).select("doc_id", "toxic")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, distance=3)


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_files(), capacity=1024, end=2)


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"), threshold=0.95)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))

    def number(kind: int) -> F.Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{secret_scan.KINDS[kind]}")

    base = secret_scan.joined(F.filter("found", lambda s: s["kind"] < 3))
    return found.select("doc_id", *map(number, range(3)), F.sha2(base, 256).alias("base_sha256"), secret_scan.joined(F.col("found")).alias("spans"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scores = toxicity.toxicity_scores(table(spark, folder, "documents"), training_labels(spark, folder))
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def op6_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = docs.select(
        "doc_id", "lang", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
    )
    sharded = hilbert.hilbert_shards(sized, ["lang", "source", "size"], ["doc_id", "text_crc32"], SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_exact_copies(table(spark, folder, "documents"), keep="largest", normalise="none")


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.archive_and_index(table(spark, folder, "pages"), shared_folder(spark, "warc"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return trie_bpe.encode_and_decode(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op10_token_records(spark: SparkSession, folder: str) -> DataFrame:
    manifest = records.write_records(table(spark, folder, "documents"), shared_folder(spark, "records"), public_files(), end=2)
    return records.read_records(manifest).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.spelling_variants(table(spark, folder, "documents"), min_length=5, min_count=3, ratio=2, slip_one_in=97)
    return words.select("word", "form", "root", "n", "n_near", "form_n")


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, folder, "embeddings"), k=16, rounds=3, seed=1, dimensions=64, scale=64)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_best_fit_packing, op3_embedding_near_dedup, op4_secret_scan, op5_toxicity,
        op6_hilbert_sharding, op7_exact_dedup, op8_warc, op9_bpe, op10_token_records,
        op11_html_extraction, op12_spelling_variants, op13_centroid_clusters,
    )
}



def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds of op13 as chained tables."""
    steps = [f"""
WITH kept AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), v AS (
    SELECT vec_id, [floor(64e0 * x)::BIGINT FOR x IN e] AS x, row_number() OVER () AS r FROM kept
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS c, x AS y FROM v
    ORDER BY c LIMIT {k}
)"""]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
    SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, y)])::BIGINT AS d FROM v, c{turn}
    ) GROUP BY r
)""")
        if turn < rounds:
            steps.append(f"""c{turn + 1} AS MATERIALIZED (
    SELECT c, list(m ORDER BY i) AS y FROM (
        SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
            SELECT c, i, sum(x[i]) AS s, count(*) AS n FROM a{turn} JOIN v USING (r), range(1, 65) t(i) GROUP BY c, i
        )
    ) GROUP BY c
    UNION ALL SELECT c, y FROM c{turn} WHERE c NOT IN (SELECT c FROM a{turn})
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, a{rounds}.c::INT AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(y, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = a{rounds}.c
"""


# The queries without SQL (hashing, tokenizing, curves, learning) are tested against brute force.
ORACLE: dict[str, str] = {
    "op3_embedding_near_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reached(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a
), least AS (SELECT a, min(b) AS c FROM reached GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
""",
    "op7_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
""",
    # DuckDB has no CRC-32: its table of 256 remainders is built by shifting, then bytes are folded in.
    "op12_spelling_variants": """
WITH RECURSIVE shifted(b, step, x) AS (
    SELECT b, 0, b::BIGINT FROM range(256) t(b)
    UNION ALL SELECT b, step + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END FROM shifted WHERE step < 8
), remainders AS (SELECT list(x ORDER BY b) AS r FROM shifted WHERE step = 8
), runs AS (
    SELECT doc_id, count(*) AS k, w FROM (
        SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS w0,
               translate(w0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents
    ) GROUP BY doc_id, w
), bytes AS (
    SELECT doc_id, w, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS h FROM runs
), hashed AS (
    SELECT w, k, xor(list_reduce(
        list_prepend(4294967295::BIGINT, [('0x' || h[2 * i - 1 : 2 * i])::BIGINT FOR i IN range(1, len(h) // 2 + 1)]),
        lambda c, b: xor(c // 256, r[xor(c % 256, b) + 1])), 4294967295) AS crc
    FROM bytes, remainders
), words AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT CASE WHEN crc % 97 = 0 THEN w[1 : crc % len(w)] || w[crc % len(w) + 2 :] ELSE w END AS word, k FROM hashed
    ) WHERE len(word) >= 5 GROUP BY word HAVING n >= 3
), cuts AS MATERIALIZED (
    SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS cut FROM words, LATERAL (SELECT unnest(range(1, len(word) + 1)) AS i)
), near AS (
    SELECT DISTINCT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM cuts a JOIN cuts b
    ON a.cut = b.cut AND a.i = b.i AND len(a.word) = len(b.word) AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN cuts b ON a.word = b.cut
    UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN cuts b ON a.word = b.cut
), best AS MATERIALIZED (
    SELECT a AS word, count(*) AS n_near, arg_min(b, (-nb, b)) AS f, max(nb) AS fn, any_value(na) AS own FROM near GROUP BY a
), forms AS MATERIALIZED (SELECT word, f AS form, fn AS form_n FROM best WHERE fn >= 2 * own
), reached(word, here) AS (
    SELECT word, form FROM forms UNION ALL SELECT r.word, f.form FROM reached r JOIN forms f ON f.word = r.here
), ends AS (SELECT word, here AS root FROM reached WHERE here NOT IN (SELECT word FROM forms))
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words w LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
""",
    "op13_centroid_clusters": _clusters_sql(),
}
