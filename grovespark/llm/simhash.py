"""SimHash fingerprints linked by covering locality-sensitive hashing.

Bit position i gets a code m(i), a vector of radius + 1 bits other than zero; the mask of each vector v other than
zero keeps the positions whose code has an odd product with v. For at most `radius` differing positions some v has an
even product with all their codes, so the two fingerprints agree on that mask: every pair within the radius meets in
some table, with 2^(radius + 1) - 1 tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.buckets import SLOTS, bucket_classes
from grovespark.llm.components import connected_components
from grovespark.llm.pieces import small
from grovespark.llm.prefilter import likely
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

BITS = 64


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    codes = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    return [sum((bin(c & v).count("1") & 1) << i for i, c in enumerate(codes)) for v in range(1, 2 ** (radius + 1))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(words: list[bytes], width: int) -> int:
    """Bit i is one if it is set in over half the XXH64 (seed 42) of the shingles, repeats included; no words: zero."""
    n = max(1, len(words) - width + 1) if words else 0
    ones = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for lo in range(0, n, 200_000):
        part = words[lo : lo + 200_000 + width - 1]
        own = [part] if len(part) < width else zip(*(part[k:] for k in range(width)), strict=False)
        h = np.array([hashed(b" ".join(s), 42) for s in own], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(df: DataFrame, width: int = 3, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, fp) of every row, fp a signed 64-bit integer; no shuffle. A-Z count as lower case; null text as empty."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for batch in small(batches):
            # bytes.lower() changes A-Z alone and bytes.split() parts at space and \x09-\x0D alone
            fps = [signed(simhash((t or "").encode().lower().split(), width)) for t in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(fps, pa.int64())], names=[*keys, "fp"])

    ensure_on_workers(df.sparkSession)
    return df.select(*keys, F.col(text).alias("__text")).mapInArrow(run, f"{kinds}, fp bigint")


def _flips(fp: Column, mask: Column) -> Column:
    """fp itself and every fp with one bit changed that the mask leaves out."""
    ones = [F.lit(signed(1 << i)) for i in range(BITS)]
    free = F.filter(F.array(*ones), lambda b: b.bitwiseAND(mask) == 0)
    return F.concat(F.array(fp), F.transform(free, lambda b: fp.bitwiseXOR(b)))


def links(nodes: DataFrame, radius: int = 2, small: int = 24) -> DataFrame:
    """(a, b): links between distinct fingerprints in column fp whose components are those of all pairs within radius.

    Buckets of up to `small` fingerprints compare their pairs. In larger ones (any size, none dropped) and radius 2 the
    fingerprints that share one at distance 1 or less are within 2 of each other, so each is linked to the least of them.
    """
    if radius != 2:
        raise ValueError("the exact way for large buckets is for radius 2")
    tables = F.explode(F.array(*[F.struct(F.lit(k).alias("table"), F.lit(signed(m)).alias("mask")) for k, m in enumerate(covering_masks(radius))])).alias("t")
    keyed = nodes.select("fp", tables).select("fp", "t.table", "t.mask", F.col("fp").bitwiseAND(F.col("t.mask")).alias("bucket"))
    sizes = materialize(keyed.groupBy("table", "bucket").agg(F.count("*").alias("n")).where("n > 1"))
    shared = materialize(keyed.join(sizes, ["table", "bucket"]))
    listed = shared.where(F.col("n") <= small).groupBy("table", "bucket").agg(F.collect_list("fp").alias("fps"))
    near = lambda x: F.filter("fps", lambda y: (y < x) & (F.bit_count(x.bitwiseXOR(y)) <= radius))
    few = listed.select(F.explode(F.flatten(F.transform("fps", lambda x: F.transform(near(x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
    rows = materialize(shared.where(F.col("n") > small).select("fp", F.explode(_flips(F.col("fp"), F.col("mask"))).alias("ball")).distinct())
    least = materialize(rows.groupBy("ball").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"))
    many = rows.join(least, "ball").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return few.unionByName(many).distinct()


def simhash_components(df: DataFrame, width: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id) of every row; component_id is the smallest key reachable over links.

    Rows without words have fingerprint zero and are linked like any other. Equal fingerprints are one node, so that
    copies are never paired. A row with a null key keeps its fingerprint and joins its component, but never names it.
    """
    prints = materialize(fingerprints(df, width, text, (key,)))
    where = materialize(_components(prints, key, radius))
    return prints.join(where, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _components(prints: DataFrame, key: str, radius: int) -> DataFrame:
    """(fp, component_id): the least key of each fingerprint's component."""
    nodes = materialize(prints.groupBy("fp").agg(F.min(key).alias("least")))
    found = connected_components(links(nodes.select("fp"), radius))
    placed = materialize(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component")))
    named = materialize(placed.groupBy("component").agg(F.min("least").alias("component_id")))
    return placed.join(named, "component").select("fp", "component_id")


#: Independent sub-fingerprints of the near-copy stage; each has 2^(radius + 1) - 1 positions and as many tables.
SUBS = 5


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Distinct XXH64 (seed 42) of the shingles, sorted; fewer words than a shingle are one; no words: none."""
    own = ([words] if words else []) if len(words) < width else zip(*(words[k:] for k in range(width)), strict=False)
    hashed = xxhash.xxh64_intdigest
    return np.array(sorted({hashed(b" ".join(s), 42) for s in own}), np.uint64)


def _constants(name: str, shape: tuple[int, ...]) -> np.ndarray:
    n = int(np.prod(shape))
    return np.array([xxhash.xxh64_intdigest(f"{name}{i}") | 1 for i in range(n)], np.uint64).reshape(shape)


class Cover:
    """Keys of a set under covering tables over min-wise sub-fingerprints.

    A sub-fingerprint has 2^(radius + 1) - 1 positions, each the least element of the set in an order of its own, so
    that two sets agree in a position with a chance of their Jaccard similarity. By the covering masks two sets meet
    in a table of a sub-fingerprint in which at most `radius` positions differ: at Jaccard 0.8 and radius 2 in one of
    7 positions with a chance of 0.85, in one of five sub-fingerprints with one of 0.9999.
    """

    def __init__(self, radius: int, subs: int = SUBS):
        size = 2 ** (radius + 1) - 1
        self.turn, self.spread = _constants("turn", (subs * size, 1)), _constants("spread", (subs * size, 1))
        kept = np.array([[m >> i & 1 for i in range(size)] for m in covering_masks(radius, size)], np.uint64)
        self.tables = np.kron(np.eye(subs, dtype=np.uint64), kept) * _constants("table", (subs * size, subs * size))

    def keys(self, hashes: np.ndarray) -> tuple[list[int], int]:
        """The keys of all tables, and a sketch: eight bits of each of the first eight positions."""
        least = None
        for lo in range(0, len(hashes), 20_000):
            own = ((hashes[lo : lo + 20_000] ^ self.turn) * self.spread).min(axis=1)
            least = own if least is None else np.minimum(least, own)
        if least is None:
            return [], 0
        slots = (least[:SLOTS] >> np.uint64(24)).astype(np.uint8)
        # tables of unlike coefficients never share a key but by chance of 2^-64
        return (self.tables * least).sum(axis=1, dtype=np.uint64).view(np.int64).tolist(), int(slots.view("<i8")[0])


def _covered(df: DataFrame, width: int, radius: int, text: str, keys: tuple[str, ...]) -> DataFrame:
    """(keys, id, n, sketch, keys): id names the set of n shingles, equal for equal sets, zero without words; no shuffle."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        cover = Cover(radius)
        for batch in small(batches):
            sets = [shingle_hashes((t or "").encode().lower().split(), width) for t in batch.column(len(keys)).to_pylist()]
            ids = [signed(xxhash.xxh64_intdigest(h.tobytes())) if len(h) else 0 for h in sets]
            found = [cover.keys(h) for h in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(ids, pa.int64()), pa.array(map(len, sets), pa.int32()), pa.array([s for _, s in found], pa.int64()), pa.array([k for k, _ in found], pa.list_(pa.int64()))], names=[*keys, "id", "n", "sketch", "keys"])

    ensure_on_workers(df.sparkSession)
    return df.select(*keys, F.col(text).alias("__text")).mapInArrow(run, f"{kinds}, id bigint, n int, sketch bigint, keys array<bigint>")


def _shingle_sets(df: DataFrame, width: int, text: str) -> DataFrame:
    """(id, body): the distinct shingle hashes of each row."""

    def run(batches):
        for batch in small(batches):
            sets = [shingle_hashes((t or "").encode().lower().split(), width).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "body"])

    ensure_on_workers(df.sparkSession)
    return df.select("id", F.col(text).alias("__text")).mapInArrow(run, "id bigint, body array<bigint>")


def near_dedup(df: DataFrame, width: int = 5, radius: int = 2, text: str = "text", key: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """df with one row of each component, that with the least (key, text hash). Rows with a null key pass unjudged.

    Rows are linked whose sets of word shingles have at least the threshold as exact Jaccard similarity (sets of 64-bit
    hashes), among all that meet in a covering table of one of the independent sub-fingerprints (see Cover). A 64-bit
    SimHash would have to be covered to about 16 bits for this threshold, which takes 2^17 tables.
    Rows without words are one component. Columns stay as they are.
    """
    known = df.where(F.col(key).isNotNull()).withColumn("__tx", F.xxhash64(text))
    prints = materialize(_covered(known, width, radius, text, (key, "__tx")))
    nodes = materialize(prints.groupBy("id").agg(F.min(F.struct(key, "__tx")).alias("at")))

    def bodies_of(ids: DataFrame) -> DataFrame:
        chosen = materialize(nodes.join(ids, "id").select("id", f"at.{key}", "at.__tx"))
        return _shingle_sets(likely(known.select(key, "__tx", text), chosen, "__tx").join(chosen, [key, "__tx"]), width, text)

    # the sizes are those of the whole sets, so this ratio loses no pair
    found = bucket_classes(prints.select("id", "sketch", "n", F.explode("keys").alias("key")), bodies_of, lambda body: body, threshold, ratio=threshold - 1e-9)
    placed = nodes.join(found, nodes["id"] == found["node"], "left").select("at", F.coalesce("component", "id").alias("component"))
    keepers = placed.groupBy("component").agg(F.min("at").alias("at")).select(f"at.{key}", "at.__tx")
    kept = known.join(materialize(keepers), [key, "__tx"]).dropDuplicates([key, "__tx"])
    return kept.select(df.columns).unionByName(df.where(F.col(key).isNull()))
