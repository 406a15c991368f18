import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grovespark.llm import archive, bpe_automaton, bpe_counts, components, fingerprints, knn, language, line_dedup, packing, simhash, toxicity

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_bpe_encoding_and_counts(spark, sf, odd):
    tok = Tokenizer.from_file(BYTES)
    for df in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        want = Counter((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for k, t in texts_of(df) for ids in [tok.encode(t, add_special_tokens=False).ids])
        assert Counter(map(tuple, bpe_automaton.encode_texts(df, BYTES).collect())) == want
        counts = Counter((r.doc_id, r.n_tokens) for r in bpe_counts.count_tokens(df, BYTES).collect())
        assert counts == Counter((k, n) for k, n, _, _ in want.elements())


def test_packing(spark, sf, odd):
    tok = Tokenizer.from_file(WORDS)
    for df in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = packing.pack_documents(df, WORDS, group_size=64).collect()
        lengths = Counter()
        bins = {}
        for r in rows:
            lengths[r.doc_id] += r.length
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        want = Counter()
        for k, t in texts_of(df):
            want[k] += len(tok.encode(t, add_special_tokens=False).ids) + 1
        assert lengths == want
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 4096


def test_local_search_keeps_items():
    lengths = [1000 + (i * 37) % 900 for i in range(300)]
    bins = packing.local_search(packing.best_fit(lengths, 4096), lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(lengths[i] for i in b) <= 4096 for b in bins)
    assert len(bins) <= len(packing.best_fit(lengths, 4096))


def brute_simhash(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\n", " ").replace("\t", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_simhash(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.simhash_components(df).collect()}
    fps = {k: brute_simhash(t) for k, t in texts_of(df)}
    assert {k: f for k, (f, _) in got.items()} == fps
    up = {k: k for k in fps}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in fps:
        for b in fps:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert {k: c for k, (_, c) in got.items()} == {k: root(k) for k in fps}


@pytest.mark.parametrize("small", [1, 24])
def test_links_cover_the_radius(spark, small):
    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(-(2**62), 2**62, 40)}
    for f in list(fps)[:20]:
        for _ in range(6):
            i, j = rng.integers(0, 62, 2)
            fps.add(f ^ (1 << int(i)) ^ (1 << int(j)))
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(nodes, small=small)
    near = [(a, b) for a in fps for b in fps if b < a and bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    want = {r.node: r.component for r in components.connected_components(spark.createDataFrame(near, "a long, b long")).collect()}
    assert {r.node: r.component for r in components.connected_components(edges).collect()} == want
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 for r in edges.collect())


def test_near_dedup_keeps_one(spark, odd):
    kept = simhash.near_dedup(odd).collect()
    assert len(kept) == 5 and {r.doc_id for r in kept} == {1, 2, 4, 6, 7}


def test_knn(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8) / 3]) for i in range(300)] + [(1000 + i, [0.5] * 8) for i in range(100)] + [(2000, None), (2001, [float("nan")] * 8), (2002, [None] * 8), (None, [0.1] * 8)]
    got = knn.voronoi_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, block=50, query_block=10).collect()
    v = {i: np.floor(64 * np.array(e, np.float32).astype(float)).astype(int) for i, e in rows if i is not None and e is not None and None not in e and not np.isnan(e).any()}
    want = {(q, r + 1, c, -s) for q in v if q % 20 == 0 for r, (s, c) in enumerate(sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:5])}
    assert {tuple(r) for r in got} == want


def test_archive_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 1200
    pages = spark.createDataFrame([(1, "u1", big), (2, "u2", big), (3, None, None), (4, "u4", "small"), (5, "u5", "small"), (6, "u6", big)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in archive.page_records(pages).collect()}
    assert [rows[i].record_type for i in range(1, 7)] == ["revisit", "revisit", "response", "response", "response", "response"]
    assert rows[1].refers_to == 6 and rows[3].payload_bytes == 0 and all(r.verified for r in rows.values())
    assert rows[1].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    records = archive.read_archive(*archive.write_archive(pages))
    archive.export_warc(records, str(tmp_path / "warc"))
    back = archive.import_warc(spark, str(tmp_path / "warc" / "part-*")).collect()
    assert Counter(r.header for r in back) == Counter(r.header for r in records.collect())


def test_fingerprints(spark, sf, odd):
    for df in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = fingerprints.document_fingerprints(df).collect()
        order = sorted(texts_of(df))
        n = len(order)
        want = Counter()
        for i, (k, t) in enumerate(order):
            nxt = order[(i + 1) % n][1]
            half = len(t) // 2
            want[(k, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    sum_ = fingerprints.with_fingerprint(spark.createDataFrame([("B two. A one.", "A one.\nB two.", "A one."), ], "x string, y string, z string"), "x", "a")
    sum_ = fingerprints.with_fingerprint(fingerprints.with_fingerprint(sum_, "y", "b"), "z", "c")
    r = sum_.select("a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("same"), fingerprints.combine(F.col("a"), F.col("c"), -1).alias("less"), "c").first()
    assert r.a == r.b and r.same == 1.0 and r.less.n == 1


def test_line_dedup(spark, odd):
    base = [" ".join(f"word{i}x{j}" for j in range(24)) for i in range(4)]
    rows = [(1, base[0] + "\n" + base[1], "z"), (2, base[0].replace("word0x5", "other") + "\n\n" + base[2], "z"), (3, None, "z"), (None, base[0], "z"), (5, base[1].upper() + "  \n" + base[3], "z"), (6, "short\nshort", "z")]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, tx string")).collect()}
    assert out[1].text == base[0] + "\n" + base[1] and out[2].text == "\n" + base[2] and out[5].text == base[3] and out[6].text == "short"
    assert out[None].text == base[0] and out[3].text is None and out[2].n_lines == 2 and out[2].n_kept == 1
    assert line_dedup.dedup_lines(odd).count() == odd.count() and line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_language_and_toxicity(spark, odd):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    found = language.predict_language(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()
    assert {r.lang_pred for r in language.predict_language(odd.withColumn("lang", F.lit("en"))).where("doc_id in (2, 3, 5)").collect()} == {"und"}
    labels = spark.read.parquet(f"{d}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels)
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").where("held_out")
    assert held.where("predicted = 0 and toxic = 0").count() >= 0.95 * held.where("toxic = 0").count()
    assert held.where("predicted = 1 and toxic = 1").count() >= 0.5 * held.where("toxic = 1").count()
    assert toxicity.score_toxicity(odd, labels.limit(0)).count() == odd.count()
