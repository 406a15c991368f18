"""Every operator on empty tables, very long and null texts, repeated rows, null keys and clashing columns."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grovespark.llm import bpe_automaton, bpe_counts, fingerprints, knn, language, line_dedup, packing, simhash, toxicity

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def labels_of(df):
    return df.select("doc_id", F.lit(0).alias("toxic"))


OPERATORS = {
    "op1": fingerprints.document_fingerprints,
    "op2": lambda df: bpe_automaton.encode_texts(df, BYTES),
    "op4": simhash.simhash_components,
    "op5": lambda df: packing.pack_documents(df, WORDS),
    "op6": lambda df: toxicity.score_toxicity(df, labels_of(df)),
    "op7": lambda df: language.predict_language(df.withColumn("lang", F.lit("en"))),
    "op9": line_dedup.dedup_lines,
    "op10": lambda df: bpe_counts.count_tokens(df, BYTES),
    "near_dedup": simhash.near_dedup,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert OPERATORS[name](empty).count() == 0


def test_empty_embeddings(spark):
    assert knn.voronoi_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.fixture(scope="module")
def rough(spark):
    """A text of half a million characters in one line, one in many, nulls, repeated rows, and working names as columns."""
    long = " ".join(f"word{i % 977}" for i in range(70_000))
    many = "\n".join(f"line number {i} of a long text" for i in range(4_000))
    rows = [(1, long), (2, many), (3, None), (4, ""), (5, "same text here"), (5, "same text here"), (6, "same text here"), (None, "no key"), (None, None)]
    df = spark.createDataFrame([(k, t, 1, "a", 0, "b") for k, t in rows], "doc_id long, text string, id int, key string, n int, part string")
    return df.repartition(3)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("op5", "near_dedup")])
def test_rough_rows_stay(rough, name):
    out = OPERATORS[name](rough).select("doc_id").collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted((r.doc_id for r in rough.collect()), key=str)


def test_rough_rows_in_the_stages(rough):
    kept = simhash.near_dedup(rough)
    assert kept.columns == rough.columns
    # one of the same texts, one of the texts without words; rows without a key pass unjudged
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 5, None, None], key=str)
    packed = OPERATORS["op5"](rough).collect()
    starts = {}
    for r in packed:
        starts.setdefault((r.doc_id, r.piece, r.start, r.ids_crc32), []).append(r.length)
    assert sum(r.doc_id == 5 for r in packed) == 2 and sum(r.doc_id is None for r in packed) == 2
    assert all(r.start == 4096 * r.piece for r in packed)


def test_equal_keys_and_fingerprints(spark):
    df = spark.createDataFrame([(7, "a b c d"), (7, "a b c d"), (7, "other words here now"), (None, "a b c d")], "doc_id long, text string")
    rows = simhash.simhash_components(df).collect()
    assert len({r.fingerprint for r in rows}) == 2 and {r.component_id for r in rows} == {7}
    prints = fingerprints.document_fingerprints(df).collect()
    assert len({r.fingerprint for r in prints}) == 2


def test_top_k_with_repeated_rows_and_large_values(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [1e30, 0.0]), (4, [70000.0, 1.0]), (20, [-1.0, 0.0])]
    out = knn.voronoi_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=4).collect()
    got = [(r.rank, r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == 0]
    assert got == [(1, 4, 64 * 64 * 70000), (2, 1, 4096), (3, 1, 4096), (4, 2, 2048)]


def test_top_k_beyond_longs(spark):
    """Scores that no double or long holds: exact where a long does, left out where none can."""
    rows = [(0, [2.0**52, 3.0]), (1, [-(2.0**52), 5.0]), (2, [2.0, 2.0**55]), (3, [2.0**-6, 1.0]), (4, [-(2.0**-6), -1.0]), (20, [1.0, 1.0])]
    out = knn.voronoi_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=9).collect()
    whole = {k: [int(x * 64) for x in v] for k, v in rows}
    for q in (0, 20):
        scores = {k: sum(a * b for a, b in zip(whole[q], v)) for k, v in whole.items() if k != q}
        want = sorted(((-s, k) for k, s in scores.items() if abs(s) < 1 << 63))
        assert [(-r.score, r.vec_id) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == want


@pytest.mark.parametrize("keys", [[-3, 5], [None, 5], [None, -3], [None, -(2**62), -1, 0, 1, 2**62], [None, None], [7]])
def test_next_documents_of_negative_and_null_keys(spark, keys):
    df = spark.createDataFrame([(k, f"text {k}. One more.") for k in keys], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.document_fingerprints(df).collect()}
    order = sorted(keys, key=lambda k: (k is not None, k or 0))
    for i, k in enumerate(order):
        text, following = f"text {k}. One more.", f"text {order[(i + 1) % len(order)]}. One more."
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
