"""Homomorphic multiset fingerprints of documents, with DataFrame functions alone.

A text is cut into paragraphs, and those at sentence ends. Each unit is hashed to a wide vector of zeros and ones; the
fingerprint is the sum of its units' vectors, lane by lane modulo 2^16, with the count of units and two sums of whole
hashes modulo 2^64. So it does not depend on the order of units, and `combine` puts units in or takes them out by adding
or subtracting their fingerprint; the result equals the fingerprint of the changed text. As lanes are independent signs, the scalar product of two fingerprints estimates how
many units two texts share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.scratch import materialize

LANES = 128
LANE_MOD = 1 << 16
UNIT_END = r"(?<=[.!?;\n])"
#: Two lanes of 32 bits lie in one 64-bit sum, which holds 2^31 units before they touch.
PAIR = (1 << 32) | 1
LOW = (1 << 32) - 1


def units(text: Column) -> Column:
    """Paragraphs and sentences without white space around them; blank ones don't count."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), UNIT_END, -1), lambda u: F.trim(u)), lambda u: (u != "") & (u != "\n"))


def _pair_sums(hashes: str) -> Column:
    """32 sums for each 64 lanes: of bits i and i + 32 of all hashes, side by side."""
    bit = lambda i: F.aggregate(F.col(hashes), F.lit(0).cast("long"), lambda a, h: a + F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(PAIR)))
    return F.transform(F.sequence(F.lit(0), F.lit(31)), bit)


def _unpacked(pairs: str) -> list[Column]:
    return [F.transform(pairs, lambda p: p.bitwiseAND(F.lit(LANE_MOD - 1))), F.transform(pairs, lambda p: F.shiftrightunsigned(p, 32).bitwiseAND(F.lit(LANE_MOD - 1)))]


def _carried(low: Column, high: Column) -> list[Column]:
    """Halves of 32 bits of a sum modulo 2^64 whose halves were added apart."""
    return [low.bitwiseAND(F.lit(LOW)), (high + F.shiftright(low, 32)).bitwiseAND(F.lit(LOW))]


def _whole_sum(hashes: Column) -> list[Column]:
    """Low and high half of the sum of 64-bit hashes modulo 2^64, without overflow: the halves are summed apart."""
    part = lambda f: F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + f(h))
    return _carried(part(lambda h: h.bitwiseAND(F.lit(LOW))), part(lambda h: F.shiftrightunsigned(h, 32)))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds struct `name`: lanes (LANES counts modulo LANE_MOD), n (units), sums (halves of the whole sums, low half first)
    of a text; null is empty.

    Step by step, so that each array is made once and not inside the functions that go over it.
    """
    seeds = range(LANES // 64)
    df = df.withColumn("__units", units(F.col(text)))
    hashed = lambda s: F.transform("__units", lambda u: F.xxhash64(u, F.lit(s)))
    df = df.withColumns({f"__h{s}": hashed(s) for s in seeds})
    df = df.withColumns({f"__p{s}": _pair_sums(f"__h{s}") for s in seeds})
    lanes = F.concat(*[c for s in seeds for c in _unpacked(f"__p{s}")])
    made = F.struct(lanes.alias("lanes"), F.size("__units").cast("long").alias("n"), F.array(*[x for s in seeds for x in _whole_sum(F.col(f"__h{s}"))]).alias("sums"))
    return df.withColumn(name, made).drop("__units", *[f"__{k}{s}" for s in seeds for k in "hp"])


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of the units of a with those of b put in (sign 1) or taken out (sign -1)."""
    lanes = F.transform(F.zip_with(a["lanes"], b["lanes"], lambda x, y: x + sign * y), lambda x: F.pmod(x, F.lit(LANE_MOD)))
    sums = []
    for k in range(0, 2 * (LANES // 64), 2):
        half = [a["sums"][k + i] + sign * b["sums"][k + i] for i in range(2)]
        sums += _carried(*half)
    return F.struct(lanes.alias("lanes"), (a["n"] + sign * b["n"]).alias("n"), F.array(*sums).alias("sums"))


def as_text(fp: Column) -> Column:
    """Hex: count, whole sums, lanes modulo 2^16."""
    hexed = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    lanes = F.array_join(F.transform(fp["lanes"], lambda x: hexed(x, 4)), "")
    sums = [hexed(fp["sums"][k + i], 8) for k in range(0, 2 * (LANES // 64), 2) for i in (1, 0)]
    return F.concat(hexed(fp["n"], 8), *sums, lanes)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the estimated cosine of two multisets of units, from their fingerprints alone. Two empty ones are 1.

    A lane says how many of n units have its bit, less how many have not, modulo 2 * LANE_MOD; it is taken for the number
    nearest to zero, which it is unless a lane is further from even than LANE_MOD.
    """
    sign = lambda c, fp: (F.pmod(2 * c - fp["n"] + LANE_MOD, F.lit(2 * LANE_MOD)) - LANE_MOD).cast("double")
    dot = lambda x, y: F.aggregate(F.zip_with(x["lanes"], y["lanes"], lambda p, q: sign(p, x) * sign(q, y)), F.lit(0.0), lambda s, v: s + v)
    ab = dot(a, b)
    size = F.sqrt(dot(a, a) * dot(b, b))
    same = (a["n"] == b["n"]) & (a["sums"] == b["sums"])
    return F.when(same, F.lit(1.0)).when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ab / size)))


def successors(ids: DataFrame, key: str = "id", fan: int = 7) -> DataFrame:
    """(key, next): each distinct id with the next greater one, null for the greatest. Ids are not negative.

    Ids are grouped by their leading bits and ordered within groups of at most 2^fan; the first of each next group
    comes from the groups' own successors, level by level, so no step orders more than 2^fan ids in one place. Each level
    takes fan bits away, so there are at most 63 / fan levels. Negative ids would never meet the others: an error.
    """
    low = ids.select(F.when(F.col(key) < 0, F.raise_error(F.lit("successors take ids from 0 on"))).otherwise(F.col(key)).alias("id")).distinct()
    grouped = materialize(low.groupBy(F.shiftright("id", fan).alias("g")).agg(F.sort_array(F.collect_list("id")).alias("all")))
    pairs = F.transform("all", lambda x, i: F.struct(x.alias("id"), F.get("all", i + 1).alias("next")))
    inner = grouped.select("g", F.explode(pairs).alias("p")).select("g", "p.id", "p.next")
    if grouped.limit(2).count() <= 1:
        return inner.select(F.col("id").alias(key), "next")
    above = successors(grouped.select("g"), "g", fan)
    heads = grouped.select(F.col("g").alias("next"), F.col("all")[0].alias("head"))
    heads = materialize(above.join(heads, "next").select("g", "head"))
    last = inner.where("next is null").join(heads, "g", "left").select("id", F.col("head").alias("next"))
    return inner.where("next is not null").select("id", "next").unionByName(last).select(F.col("id").alias(key), "next")


def document_fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", fan: int = 6) -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Null text counts as empty. The next document is the row after it by (key, text), after the last the first; a null
    key sorts first, then negative ones. One row is its own next. Texts are shuffled once, by the leading bits of the key, so that
    neighbours meet in groups of 2^fan keys; only the last row of each group gets its neighbour by a join.
    """
    rows = df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # leading bits of the key with its sign bit turned, so that groups count from 1 in the order of keys; 0 has no key
    rows = rows.withColumn("g", F.coalesce(F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(-(1 << 63))), fan) + 1, F.lit(0).cast("long")))
    heads = rows.groupBy("g").agg(F.min(F.struct(F.coalesce(key, F.lit(-(1 << 63))).alias("k"), "text")).alias("head"))
    heads = materialize(heads.select("g", F.col("head.text").alias("head")))
    groups = heads.select("g")
    first = groups.agg(F.min("g")).first()[0]
    after = materialize(successors(groups, "g").select("g", F.coalesce("next", F.lit(first)).alias("next")))
    after = materialize(after.join(heads.select(F.col("g").alias("next"), "head"), "next").select("g", "head"))
    w = _by_key("g", key)
    placed = rows.withColumn("following", F.lead("text").over(w))
    inner = placed.where("following is not null")
    # the last row of a group has no follower within it; few rows, so their texts are joined to the next group's head
    outer = rows.withColumn("last", F.lead(F.lit(1)).over(w)).where("last is null").drop("last").join(after, "g").withColumnRenamed("head", "following")
    return _judged(inner.select(key, "text", "following").unionByName(outer.select(key, "text", "following")), key)


def _by_key(group: str, key: str):
    from pyspark.sql import Window

    return Window.partitionBy(group).orderBy(F.col(key).asc_nulls_first(), "text")


def _judged(rows: DataFrame, key: str) -> DataFrame:
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("following"), F.lit(1), half))
    hashed = rows.select(key, n.cast("long").alias("n_chars"), edited.alias("edited"), "text", "following")
    hashed = hashed.withColumn("edited_sha256", F.sha2("edited", 256))
    for source, name in (("text", "a"), ("edited", "b"), ("following", "c")):
        hashed = with_fingerprint(hashed, source, name)
    return hashed.select(key, "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"))
