"""Connected components by alternating large and small stars (distributed union-find).

Every step is a pre-aggregated minimum per node and an equi-join whose two sides are plain scans of
written tables, so that a hub with a third of all edges is split by the adaptive skew join. Minima that a count shows to
be few are broadcast instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.prefilter import light
from grovespark.llm.scratch import discard, materialize


def _starred(neighbours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v, m): each neighbour pair with m, the least of u and all its neighbours; and the table it reads."""
    least = materialize(neighbours.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    return neighbours.join(light(least), "u"), least


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)), F.count_if(F.col("u") <= F.col("v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is its least node.

    Nodes may be of any orderable type. Null ends and loops are dropped. An empty table gives an empty one.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    e = materialize(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        starred, least = _starred(both)
        large = materialize(starred.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # every large edge points from the greater node to the smaller one
        small, lesser = _starred(large)
        after_small = materialize(small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v").where("u <> v").distinct())
        discard(e, least, large, lesser)
        e = after_small
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = materialize(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct())
    discard(e)
    return out
