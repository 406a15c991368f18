"""Near copies of vectors by a pivot-permutation index.

Vectors are described by their nearest reference points, in order. Two vectors are candidates if they share enough of
their nearest pivots. Pivots are numbered from the rarest on. Inverted lists go by (label, pivot): a vector stands in
the lists of all but its most frequent pivots, so that every two that share `shared` of them meet in a list, and they are
compared in the first list that both stand in and in no other. Candidates are verified by their cosine in double
precision. Lists longer than a block are compared block against block, so no list is held in one task; equal vectors of a
label are one entry with its number. A group of many unlike near copies costs what exact numbers of links cost: the
cosine of every two of them, spread over the pairs of blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.components import connected_components
from grovespark.llm.scratch import discard, materialize
from grovespark.session import ensure_on_workers

#: Reference points closer than this cosine to one already chosen are left out: within a group of near copies the order
#: of many close pivots would be chance.
APART = 0.7


def _plain(df: DataFrame, embedding: str) -> Column:
    """The vector as floats if it holds floats, else as doubles; -0.0 becomes 0.0. Floats halve what is shuffled, and their
    cosine is worked out in doubles all the same."""
    kind = "float" if df.schema[embedding].dataType.simpleString() == "array<float>" else "double"
    return F.transform(F.col(embedding), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind))


def vector_classes(df: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(id, vh, label, vec, n) of the vectors that may link: equal vectors of one label are a class of n rows, known by its
    least id and a hash. Rows with a null id or label, and vectors that are null, zero or hold null or non-finite
    components, are left out."""
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    members = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), _plain(df, embedding).alias("vec")).where("id is not null and label is not null and vec is not null").where(usable)
    classes = members.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return classes.select("id", F.xxhash64("label", "vec").alias("vh"), "label", "vec", "n")


def _unit(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of length 1; shorter ones end in zeros. Scaled by the largest component first, against overflow."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def fit_pivots(classes: DataFrame, count: int, width: int, most: int, nearest: int) -> np.ndarray:
    """Reference points: of a sample of at most 4 * most vectors, drawn by hash, those that lie apart from one another,
    the one first that is among the `nearest` of fewest of the sample.

    Their number grows as the root of the vectors, from 64 to `most`: lists then grow as the root too.
    """
    wanted = max(64, min(most, math.isqrt(count)))
    drawn = classes.orderBy(F.xxhash64("vec", F.lit(7)), "id").limit(4 * wanted).select("vec").collect()
    x = _unit(pd.Series([r["vec"] for r in drawn]), width)
    chosen: list[int] = []
    for i in range(len(x)):
        if len(chosen) < wanted and (not chosen or (x[chosen] @ x[i]).max() < APART):
            chosen.append(i)
    pivots = x[chosen]
    return pivots[np.argsort(np.bincount(_nearest(x, pivots, nearest).ravel(), minlength=len(pivots)), kind="stable")]


def _nearest(unit: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """Numbers of the m nearest pivots of each row, nearest first."""
    return np.concatenate([np.argsort(-(unit[lo : lo + 1024] @ pivots.T), axis=1, kind="stable")[:, :m] for lo in range(0, len(unit), 1024)])


def _linked(x: pd.DataFrame, y: pd.DataFrame | None, pivot: int, threshold: float, shared: int, width: int) -> pd.DataFrame:
    """Links between the rows of x and of y (None: within x) of one list: each row's number of linked vectors, and for
    each row with a link the least (id, vh) of its component within the two blocks."""
    both = x if y is None else pd.concat([x, y], ignore_index=True)
    near = np.stack(both["near"].to_numpy())
    seen, place = np.unique(near, return_inverse=True)  # the pivots of these blocks alone
    unit, marks = _unit(both["vec"], width), np.zeros((len(both), len(seen)), np.float32)
    np.put_along_axis(marks, place.reshape(near.shape), 1, axis=1)
    a, b = (slice(0, len(both)), slice(0, len(both))) if y is None else (slice(0, len(x)), slice(len(x), len(both)))
    common = marks[a] @ marks[b].T
    earlier = marks[:, seen < pivot]  # pivots whose lists come before this one
    fit = (common >= shared) & (earlier[a] @ earlier[b].T == 0)
    fit &= unit[a] @ unit[b].T >= threshold
    if y is None:
        np.fill_diagonal(fit, False)
    n, links = both["n"].to_numpy(), np.zeros(len(both), np.int64)
    links[a] += fit @ n[b]
    if y is not None:
        links[b] += fit.T @ n[a]
    ids = list(zip(both["id"], both["vh"]))
    root = np.argsort(np.argsort(pd.MultiIndex.from_tuples(ids), kind="stable"), kind="stable")
    by_rank = np.argsort(root)
    while True:  # the least rank spreads along links until nothing changes
        low = root.copy()
        far = np.where(fit, root[b][None], len(both)).min(1, initial=len(both))
        low[a] = np.minimum(low[a], far)
        if y is not None:
            low[b] = np.minimum(low[b], np.where(fit, root[a][:, None], len(both)).min(0, initial=len(both)))
        if (low == root).all():
            break
        root = low
    hit = np.flatnonzero(links)
    to = both.iloc[by_rank[root[hit]]]
    return pd.DataFrame({"id": both["id"].to_numpy()[hit], "vh": both["vh"].to_numpy()[hit], "links": links[hit], "to_id": to["id"].to_numpy(), "to_vh": to["vh"].to_numpy()})


def pivot_links(classes: DataFrame, threshold: float = 0.93, nearest: int = 12, shared: int = 4, block: int = 1024, most_pivots: int = 1 << 13) -> DataFrame:
    """(id, vh, links, to_id, to_vh): partial numbers of links of classes(id, vh, label, vec, n), and with them edges
    that span the links' components. A vector without a link to another class has no row."""
    session = classes.sparkSession
    ensure_on_workers(session)
    schema = "id long, vh long, links long, to_id long, to_vh long"
    count, width = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not count:
        return session.createDataFrame([], schema)
    pivots = fit_pivots(classes, count, width, most_pivots, nearest)
    m = min(nearest, len(pivots))
    need = min(shared, m)

    def place(frames):
        for pdf in frames:
            if len(pdf):
                out = pdf[["id", "vh", "label", "vec", "n"]].copy()
                out["near"] = _nearest(_unit(pdf["vec"], width), pivots, m).tolist()
                yield out

    label_type, vec_type = (classes.schema[c].dataType.simpleString() for c in ("label", "vec"))
    placed = materialize(classes.mapInPandas(place, f"id long, vh long, label {label_type}, vec {vec_type}, n long, near array<int>"))
    # the lists of the first pivots by number: any two with `need` in common have one of them in common there
    lists = F.slice(F.array_sort("near"), 1, m - need + 1)
    entered = placed.select("*", F.explode(lists).alias("pivot"))
    lengths = materialize(entered.groupBy("label", "pivot").agg(F.count("*").alias("size")))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / block)).cast("int")
    cut = entered.join(lengths, ["label", "pivot"]).where("size > 1").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id", "vh", F.lit(3)), F.col("blocks")).cast("int"))
    # a row goes to the pairs of its block with itself and with every other block of its list
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "own").alias("lo"), F.greatest(k, "own").alias("hi")))
    dealt = cut.select("id", "vh", "label", "vec", "n", "near", "pivot", "own", F.explode(pairs).alias("q")).select("id", "vh", "label", "vec", "n", "near", "pivot", "own", "q.lo", "q.hi")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, pivot = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0]), int(pdf["pivot"].iloc[0])
        x = pdf[pdf["own"] == lo].reset_index(drop=True)
        y = None if lo == hi else pdf[pdf["own"] == hi].reset_index(drop=True)
        if not len(x) or (y is not None and not len(y)):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("id", "vh", "links", "to_id", "to_vh")})
        return _linked(x, y, pivot, threshold, need, width)

    found = materialize(dealt.groupBy("label", "pivot", "lo", "hi").applyInPandas(solve, schema))
    discard(placed, lengths)
    return found


def near_vectors(df: DataFrame, threshold: float = 0.93, nearest: int = 12, shared: int = 4, block: int = 1024, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of every row: vectors of equal labels link at a cosine of threshold or more.

    n_links: other rows linked directly; component_id: the least key that links reach, the row's own included; kept: it
    is its own. Rows with a null label, and vectors that are null, zero or hold null or non-finite components, link with
    nothing; rows with a null key neither, and keep a null component that is not kept. Shorter vectors count as padded
    with zeros. Rows that repeat a key are vectors of their own; equal vectors of one label always link, and are kept if
    they have the least key. Links that are given all have the cosine; pairs that share fewer than `shared` of their
    `nearest` pivots are not found (on random 64-dimensional pairs at 0.93 itself: 0.02 % of them with 226 pivots, 0.6 %
    with 1,000, 2 % with 4,000; fewer of nearer ones). Smaller `shared` finds more and compares more.
    """
    classes = materialize(vector_classes(df, key, embedding, label))
    found = pivot_links(classes, threshold, nearest, shared, block)
    edges = found.select(F.struct("id", "vh").alias("a"), F.struct(F.col("to_id").alias("id"), F.col("to_vh").alias("vh")).alias("b"))
    comps = connected_components(edges)
    links = materialize(found.groupBy("id", "vh").agg(F.sum("links").alias("links")))
    comps = comps.select(F.col("node.id").alias("id"), F.col("node.vh").alias("vh"), F.col("component.id").alias("component"))
    known = materialize(classes.join(links, ["id", "vh"], "left").join(comps, ["id", "vh"], "left").select("label", "vec", F.col("n").alias("__n"), F.coalesce("links", F.lit(0)).alias("__links"), F.coalesce("component", "id").alias("__component")))
    rows = df.select(F.col(key).cast("long").alias("__id"), F.col(label).alias("label"), _plain(df, embedding).alias("vec"))
    out = rows.join(known, ["label", "vec"], "left")
    keyed = F.col("__id").isNotNull()
    n_links = F.when(keyed, F.col("__links") + F.col("__n") - 1)
    component = F.when(keyed, F.coalesce("__component", "__id"))
    return out.select(F.col("__id").alias(key), F.coalesce(n_links, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("__id") == component, F.lit(False)).alias("kept"))
