"""Registered queries of this subpackage and their SQL where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grovespark.llm.archive import page_records
from grovespark.llm.bpe_automaton import encode_texts
from grovespark.llm.bpe_counts import count_tokens
from grovespark.llm.language import predict_language
from grovespark.llm.line_dedup import dedup_lines
from grovespark.llm.fingerprints import document_fingerprints
from grovespark.llm.knn import voronoi_top_k
from grovespark.llm.packing import pack_documents
from grovespark.llm.pivots import near_vectors
from grovespark.llm.prefix_trie import prefix_trie
from grovespark.llm.simhash import simhash_components
from grovespark.llm.toxicity import score_toxicity
from grovespark.llm.vector_codes import vector_codes

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op2_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_top_k(table(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_kept", "text")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_document_fingerprints, op2_bpe_encoding, op3_exact_top_k, op4_simhash_near_dedup, op5_best_fit_packing, op6_toxicity, op7_language_id, op8_warc_archive, op9_line_dedup, op10_token_counts, op11_embedding_near_dedup, op12_vector_codes, op13_prefix_trie)}

ORACLES = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op8_warc_archive": """
        WITH p AS (
            SELECT page_id, url, encode(coalesce(html, '')) AS b, chr(13) || chr(10) AS crlf FROM pages),
        d AS (
            SELECT *, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest, max(page_id) OVER (PARTITION BY b) AS last FROM p),
        t AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM d),
        r AS (
            SELECT *, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type FROM t),
        h AS (
            SELECT *, 'WARC/1.1' || crlf || 'WARC-Type: ' || record_type || crlf || 'WARC-Record-ID: <urn:page:' || page_id || '>' || crlf
                || 'WARC-Date: 1970-01-01T00:00:00Z' || crlf
                || coalesce('WARC-Target-URI: ' || regexp_replace(url, '[\\r\\n]', '', 'g') || crlf, '')
                || 'WARC-Payload-Digest: sha1:' || payload_digest || crlf
                || coalesce('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || crlf || 'WARC-Refers-To: <urn:page:' || refers_to || '>' || crlf, '')
                || 'Content-Type: text/html' || crlf
                || 'Content-Length: ' || CASE WHEN refers_to IS NULL THEN payload_bytes ELSE 0 END || crlf || crlf AS header
            FROM r)
        SELECT page_id, payload_bytes, payload_digest, record_type, refers_to,
               sha1(encode(header) || CASE WHEN refers_to IS NULL THEN b ELSE encode('') END || encode(crlf || crlf)) AS record_sha1, true AS verified
        FROM h""",
}


def _lloyd_sql(entries: int = 256, parts: int = 4, rounds: int = 4) -> str:
    """Plain Lloyd rounds, all vectors against all entries, one step after another."""
    near = "SELECT vec_id, label, p, v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT x.*, b.e, CAST(list_sum(list_transform(list_zip(x.v, b.v), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS BIGINT) AS d FROM parts x JOIN {0} b USING (p)) GROUP BY ALL"
    near = near.replace("GROUP BY ALL", "GROUP BY vec_id, label, p, v")
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(f'b{r}')})")
        mean = f"SELECT p, e, list(m ORDER BY i) AS v FROM (SELECT p, e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m FROM a{r}, generate_series(1, len(v)) g(i) GROUP BY p, e, i) GROUP BY p, e"
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN ({mean}) m ON m.p = b.p AND m.e = b.e)")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT vec_id, label, p, q[p * len(q) // {parts} + 1 : (p + 1) * len(q) // {parts}] AS v FROM kept, range({parts}) t(p)),
        b0 AS MATERIALIZED (SELECT p, CAST(r - 1 AS BIGINT) AS e, v FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS r FROM parts) WHERE r <= {entries}),
        {", ".join(steps)},
        last AS MATERIALIZED ({near.format(f"b{rounds}")}),
        coded AS (SELECT vec_id, label, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id, label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
        FROM coded"""


ORACLES |= {
    "op11_embedding_near_dedup": """
        WITH RECURSIVE v AS MATERIALIZED (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (SELECT a AS x, b AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
        least AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
        n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        c AS (SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(r.y, e.vec_id)) AS component_id
              FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least r ON r.x = e.vec_id)
        SELECT *, vec_id = component_id AS kept FROM c""",
    "op12_vector_codes": _lloyd_sql(),
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT c, c - c % 5 AS head, xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                lambda crc, b: list_reduce(list_transform(range(8), lambda x: CAST(x AS BIGINT)), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)), xor(crc, b)), CAST(4294967295 AS BIGINT))) % 9 AS h
            FROM (SELECT DISTINCT c FROM t)),
        led AS (SELECT v.c, v.h, t.pos AS d, role, text FROM convs v JOIN t ON t.c = v.head AND t.pos <= v.h),
        sizes AS (SELECT v.c, v.h, count(l.d) AS hn FROM convs v LEFT JOIN led l ON l.c = v.c GROUP BY v.c, v.h),
        built AS MATERIALIZED (
            SELECT c, d, role, text FROM led
            UNION ALL SELECT t.c, s.hn + t.pos - s.h, role, text FROM t JOIN sizes s ON s.c = t.c AND t.pos > s.h),
        paths AS MATERIALIZED (
            SELECT c, d, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d) AS path, octet_length(encode(text)) AS bytes FROM built
            UNION ALL SELECT c, 0, [], 0 FROM convs),
        lens AS (SELECT c, max(d) AS n FROM paths GROUP BY c),
        nodes AS MATERIALIZED (
            SELECT p.d, p.path, min(p.c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
                   string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE p.d = l.n) AS ends
            FROM paths p JOIN lens l ON l.c = p.c GROUP BY p.d, p.path),
        ups AS MATERIALIZED (SELECT v.d, v.path, v.n_convs, v.bytes, u.u AS ud, v.path[1 : u.u] AS upath FROM nodes v, range(0, v.d + 1) r(x), LATERAL (SELECT r.x AS u) u),
        kids AS (SELECT ud, upath, count(*) AS n FROM ups WHERE d = ud + 1 GROUP BY 1, 2),
        sums AS (
            SELECT u.ud, u.upath, sum((u.n_convs - 1) * u.bytes) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
            FROM ups u LEFT JOIN kids k ON k.ud = u.d AND k.upath = u.path GROUP BY 1, 2)
        SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
               s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
        FROM nodes n JOIN sums s ON s.ud = n.d AND s.upath = n.path LEFT JOIN kids k ON k.ud = n.d AND k.upath = n.path
        LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1 : n.d - 1]""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
