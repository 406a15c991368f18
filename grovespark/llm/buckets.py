"""Links between the members of shared buckets by exact Jaccard similarity, with DataFrame functions alone.

A member carries a sketch, the eight low bits of eight min-wise values of its set packed into one long, and a size. Two
members are compared only if enough slots of their sketches agree and their sizes are near; what is compared is
verified by the exact Jaccard similarity of the whole sets.

No bucket is capped. First every member is held against the least of its bucket; where more than one component is left
in a bucket of many members, they are held against two drawn ones of other components; every two members of a bucket
that are then still in different components meet, large buckets in blocks against blocks. For these two steps members
carry the parity bitmaps of their whole sets, made once for each, which leave out what can't reach the threshold: they
differ in no more bits than the sets have elements that are not shared, so no pair is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.components import connected_components
from grovespark.llm.prefilter import light, likely
from grovespark.llm.scratch import discard, materialize

#: Members of a block; a bucket of more is split, and each two of its blocks meet in one task's group.
BLOCK = 512
#: In buckets of more members drawn ones come before all pairs.
MANY = 32
SLOTS = 8
#: Words of 64 bits of a parity bitmap.
WORDS = 16
#: Slots that must agree. At Jaccard 0.8 two or fewer of eight agree with a chance of 0.0012; with 0 no pair is left out.
LEAST_SAME = 3


def _fits(a: str, b: str, ratio: float, least_same: int) -> Column:
    """Whether the sketches and sizes of two members, by their column prefixes, allow for the threshold."""
    x = F.col(f"{a}sketch").bitwiseXOR(F.col(f"{b}sketch"))
    same = reduce(lambda s, k: s + F.when(F.shiftright(x, 8 * k).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0), range(SLOTS), F.lit(0))
    return (same >= least_same) & (F.least(f"{a}n", f"{b}n") >= ratio * F.greatest(f"{a}n", f"{b}n"))


def shared_members(keyed: DataFrame) -> DataFrame:
    """(key, id, sketch, n, lo, hi): the distinct members of buckets that hold two and more, with the bucket's ends."""
    ends = materialize(keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi"))
    out = materialize(likely(keyed, ends, "key").join(ends, "key").select("key", "id", "sketch", "n", "lo", "hi").distinct())
    discard(ends)
    return out


def verified(pairs: DataFrame, bodies: DataFrame, elements: Callable[[Column], Column], threshold: float) -> DataFrame:
    """Of pairs (a, b), those whose sets have at least the threshold as exact Jaccard similarity."""
    with_a = pairs.join(bodies.select(F.col("id").alias("a"), F.col("body").alias("v")), "a")
    both = with_a.join(bodies.select(F.col("id").alias("b"), F.col("body").alias("w")), "b")
    # exploded as one row each: Spark would put sets and counts into the filter, and work each set out three times
    full = both.select("a", "b", F.explode_outer(F.array(F.struct(elements(F.col("v")).alias("x"), elements(F.col("w")).alias("y")))).alias("s"))
    shared = full.select("a", "b", F.explode_outer(F.array(F.struct(F.size("s.x").alias("nx"), F.size("s.y").alias("ny"), F.size(F.array_intersect("s.x", "s.y")).alias("both")))).alias("c"))
    near = F.col("c.both") >= threshold * F.greatest(F.lit(1), F.col("c.nx") + F.col("c.ny") - F.col("c.both"))
    return materialize(shared.where(near).select("a", "b"))


def _marks(ids: DataFrame, bodies: DataFrame, elements: Callable[[Column], Column]) -> DataFrame:
    """(id, m, w0, w1, ...): size and parity bitmap of each member's whole set."""
    rows = bodies.join(ids, "id").select("id", F.explode(elements(F.col("body"))).alias("h"))
    rows = rows.select("id", F.shiftright("h", 6).bitwiseAND(F.lit(WORDS - 1)).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    words = [F.coalesce(F.bit_xor(F.when(F.col("w") == k, F.col("bit"))), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)]
    return materialize(rows.groupBy("id").agg(F.count("*").alias("m"), *words))


def _may_reach(a: str, b: str, threshold: float) -> Column:
    """Whether sizes and bitmaps of two members, by their column prefixes, allow for the threshold; false for no pair that
    reaches it: of sets with Jaccard t, at most (1 - t) / (1 + t) of all elements, counted in both, are not shared."""
    apart = reduce(lambda s, k: s + F.bit_count(F.col(f"{a}w{k}").bitwiseXOR(F.col(f"{b}w{k}"))), range(WORDS), F.lit(0))
    bound = apart <= (1 - threshold) / (1 + threshold) * (F.col(f"{a}m") + F.col(f"{b}m")) + 1e-6
    return (F.least(f"{a}m", f"{b}m") >= threshold * F.greatest(f"{a}m", f"{b}m") - 1e-6) & bound


def _parted(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with part, the component, and size of the bucket."""
    placed = materialize(members.join(light(found), F.col("id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "id")).drop("node", "component"))
    split = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").drop("p", "q")
    out = materialize(placed.join(light(materialize(split)), "key"))
    discard(placed)
    return out


def _drawn_pairs(members: DataFrame, fits: Callable[[str, str], Column], draws: int) -> DataFrame:
    """(a, b): members of large buckets against drawn ones of their bucket that are in other components."""
    out, members = [], members.where(F.col("size") > MANY)
    for k in range(draws):
        draw = F.xxhash64("id", "key", F.lit(k))
        heads = members.groupBy("key").agg(*[F.min_by(c, draw).alias(f"h_{c}") for c in members.columns if c not in ("key", "size")])
        met = members.join(heads, "key").where((F.col("part") != F.col("h_part")) & fits("", "h_"))
        out.append(met.select(F.greatest("id", "h_id").alias("a"), F.least("id", "h_id").alias("b")))
    return materialize(reduce(DataFrame.unionByName, out).distinct())


def _block_pairs(members: DataFrame, fits: Callable[[str, str], Column], block: int) -> DataFrame:
    """(a, b): every two members of a bucket that are in different components and fit."""
    own = members.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    columns = [c for c in members.columns if c not in ("key", "size")]
    one = own.select("key", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), *[F.col(c).alias(f"a_{c}") for c in columns])
    two = own.select("key", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"), *[F.col(c).alias(f"b_{c}") for c in columns])
    once = (F.col("i") < F.col("j")) | (F.col("a_id") > F.col("b_id"))
    met = one.join(two, ["key", "i", "j"]).where((F.col("a_part") != F.col("b_part")) & once & fits("a_", "b_"))
    return materialize(met.select(F.greatest("a_id", "b_id").alias("a"), F.least("a_id", "b_id").alias("b")).distinct())


def _merged(found: DataFrame, edges: DataFrame) -> DataFrame:
    """found (node, component) after more edges (a, b): components of the components, which are few, and one join."""
    at = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    lifted = edges.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))
    above = connected_components(lifted).select(F.col("node").alias("component"), F.col("component").alias("__top"))
    moved = found.join(above, "component", "left").select("node", F.coalesce("__top", "component").alias("component"))
    new = above.join(found.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("__top").alias("component"))
    return materialize(moved.unionByName(new))


def bucket_classes(keyed: DataFrame, bodies_of: Callable[[DataFrame], DataFrame], elements: Callable[[Column], Column], threshold: float, ratio: float, block: int = BLOCK, draws: int = 2, least_same: int = LEAST_SAME) -> DataFrame:
    """(node, component) over all pairs that share a bucket of keyed (key, id, sketch, n), fit and reach the threshold.

    bodies_of gives (id, body) for a table of ids, and elements the array of distinct hashes that a body stands for; it
    is worked out after bodies have moved. ratio is the least quotient of the sizes n of two members that are compared,
    least_same the least number of sketch slots that agree (0 and 0: every two of a bucket are compared).
    Two members of a bucket are left uncompared only where they do not fit or are in one component already.
    """
    members = shared_members(keyed)
    heads = members.where("id = lo").select("key", F.col("sketch").alias("h_sketch"), F.col("n").alias("h_n"))
    stars = materialize(members.where("id <> lo").join(heads, "key").where(_fits("", "h_", ratio, least_same)).select(F.col("id").alias("a"), F.col("lo").alias("b")).distinct())
    # only in buckets of three and more are there pairs without the least member
    many = materialize(members.where("id <> lo and id <> hi").select("key").distinct())
    rest = materialize(likely(members, many, "key").join(many, "key").select("key", "id", "sketch", "n"))
    discard(members, many)
    ids = stars.select(F.explode(F.array("a", "b")).alias("id")).unionByName(rest.select("id")).distinct()
    ids = materialize(ids)
    bodies = materialize(bodies_of(ids))
    near = verified(stars, bodies, elements, threshold)
    discard(stars, ids)
    found = connected_components(near)
    open_ = _parted(rest, found)
    if open_.isEmpty():
        return found
    marks = _marks(open_.select("id").distinct(), bodies, elements)
    fits = lambda a, b: _fits(a, b, ratio, least_same) & _may_reach(a, b, threshold)
    for pairs_of in (lambda m: _drawn_pairs(m, fits, draws), lambda m: _block_pairs(m, fits, block)):
        marked = materialize(open_.join(marks, "id"))
        pairs = pairs_of(marked)
        discard(marked)
        if not pairs.isEmpty():
            more = verified(pairs, bodies, elements, threshold)
            if not more.isEmpty():
                found = _merged(found, more)
                open_ = _parted(open_.drop("part", "size"), found)
        discard(pairs)
    return found
