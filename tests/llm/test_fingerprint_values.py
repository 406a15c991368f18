import math
import re
import struct

import xxhash
from pyspark.sql import functions as F

from grovespark.llm import fingerprints as fp


def spark_hash(text, seed):
    """xxhash64(text, lit(seed)) of Spark: the text with seed 42, then the integer with that as its seed."""
    first = xxhash.xxh64_intdigest(text.encode(), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), first)


def brute(text):
    units = [u for u in (p.strip(" ") for p in re.split(r"(?<=[.!?;\n])", text)) if u not in ("", "\n")]
    hashes = [[spark_hash(u, s) for u in units] for s in range(2)]
    lanes = [sum(h >> b & 1 for h in own) % 65536 for own in hashes for b in range(64)]
    return len(units), [sum(own) % 2**64 for own in hashes], lanes


def as_text(n, sums, lanes):
    return f"{n:08x}" + "".join(f"{s:016x}" for s in sums) + "".join(f"{x:04x}" for x in lanes)


def cosine(a, b):
    x, y = ([2 * c - n for c in lanes] for n, _, lanes in (a, b))
    size = math.sqrt(sum(v * v for v in x) * sum(v * v for v in y))
    return 1.0 if a[:2] == b[:2] else 0.0 if not size else max(0.0, min(1.0, sum(p * q for p, q in zip(x, y, strict=True)) / size))


def lane_order(lanes):
    """Lanes lie as bits 0 to 31 of a seed's hashes, then 32 to 63."""
    return lanes


def test_values_equal_a_plain_computation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    want = {}
    for i, (k, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = brute(t), brute(edited), brute(after)
        want[k] = (as_text(*a), as_text(*b), cosine(a, b), cosine(a, c))
    for r in fp.document_fingerprints(docs).collect():
        one, two, near_edited, near_next = want[r.doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == (one, two)
        assert abs(r.near_edited - near_edited) < 1e-9 and abs(r.near_next - near_next) < 1e-9


def test_insertion_and_deletion_equal_a_fresh_fingerprint(spark):
    many = "Same unit. " * 70_000
    df = spark.createDataFrame([("One. Two.", "Three. Two.", "Two. One. Three. Two."), (many, "Other.", "Other. " + many), ("", "A.", "A.")], "x string, y string, z string")
    for c in "xyz":
        df = fp.with_fingerprint(df, c, f"f{c}")
    put, out = fp.combine(F.col("fx"), F.col("fy")), fp.combine(F.col("fz"), F.col("fy"), -1)
    for r in df.select((put == F.col("fz")).alias("put"), (out == F.col("fx")).alias("out"), F.array_max("fz.lanes").alias("most")).collect():
        assert r.put and r["out"] and r.most < 65536
