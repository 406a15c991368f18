"""Exact top-k inner products by a Voronoi k-nearest-neighbour join.

Inner products become distances by one more coordinate (sqrt(M^2 - |x|^2) for data, 0 for queries), where
|q - x|^2 = |q|^2 + M^2 - 2 q.x. Data and queries go to the cell of their nearest pivot. The summaries of the cells
(how far the queries reach, the k smallest distances of the data) bound the k-th distance of each group of queries;
by the triangle inequality only data that may lie within that bound is sent to the group, in blocks of bounded size.
A group is as many neighbouring cells as hold query_block queries together; a cell with more is a group alone and its
queries go in chunks, so data is sent once for about every query_block queries whose bound it meets.
Equal vectors are one candidate with its k smallest ids, so a vector that a third of all rows share is compared once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

FAN = 64
#: Quantised components lie below this, so that they fit a long.
LARGEST = 1 << 62
#: Scores below the first are exact in doubles, below the second in longs; others are worked out as Python's numbers.
IN_DOUBLES, IN_LONGS = 1 << 52, 1 << 62


def least_k(df: DataFrame, keys: list[str], values: str, part: str, parts: int, k: int) -> DataFrame:
    """(keys, values): the k smallest of all arrays in `values` for each key, merged as a tree.

    part numbers the rows from 0 to parts - 1; each step joins at most FAN parts of a key, so no group grows beyond
    FAN * k values however many rows share a key.
    """
    while True:
        df = df.groupBy(*keys, part).agg(F.slice(F.array_sort(F.flatten(F.collect_list(values))), 1, k).alias(values))
        if parts <= 1:
            return df.drop(part)
        parts = math.ceil(parts / FAN)
        df = df.withColumn(part, F.floor(F.col(part) / FAN) if parts > 1 else F.lit(0))


def quantized(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null for vectors that are null, hold null or non-finite components, or such
    as reach LARGEST, which no long can hold."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LARGEST))
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pd.Series, width: int, kind: type = float) -> np.ndarray:
    out = np.zeros((len(column), width), kind)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def voronoi_top_k(df: DataFrame, k: int = 20, every: int = 20, scale: int = 64, key: str = "vec_id", embedding: str = "embedding", max_pivots: int = 512, block: int = 4096, query_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by `every`, its k best other rows.

    Ties go to the smaller id; fewer rows than k give what there is. Rows with a null key, and vectors that are null,
    hold null or non-finite components or such as no long can hold (see `quantized`), take no part; a pair whose score no
    long can hold is left out. Shorter vectors count as padded
    with zeros. Rows that repeat an id are candidates for no query with that id, and for others as often as they occur;
    a repeated query is answered once for each of its vectors. max_pivots bounds what the driver holds: pivots, k + 1
    distances of each cell, and a bound for every two cells; below it their number grows as the root of the rows.
    """
    keep = k + 1  # one may be the query itself
    given = df.select(F.col(key).cast("long").alias("__id"), quantized(F.col(embedding), scale).alias("vec")).where(F.col("vec").isNotNull() & F.col("__id").isNotNull())
    rows = materialize(given.groupBy("vec", "__id").agg(F.count("*").alias("times")))
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    count, width, far = rows.agg(F.count("*"), F.max(F.size("vec")), F.max(norm)).first()
    if not count:
        return empty
    parts = max(1, math.ceil(count / block))
    salted = rows.select("vec", F.array(F.struct(F.col("__id").alias("id"), "times")).alias("ids"), F.pmod(F.xxhash64("__id"), F.lit(parts)).alias("part"))
    classes = materialize(least_k(salted, ["vec"], "ids", "part", parts, keep).withColumn("cls", F.col("ids")[0]["id"]))
    # a vector's class is named by its least id and a hash, as an id may come with several vectors
    classes = classes.withColumn("cls", F.xxhash64("cls", "vec"))
    asked = rows.where(F.col("__id") % every == 0).select("__id", "vec")
    classes = materialize(classes.join(asked.select("vec").distinct().withColumn("asked", F.lit(True)), "vec", "left"))
    pivots = _matrix(pd.Series([r[0] for r in classes.orderBy(F.xxhash64("vec"), "cls").limit(max(1, min(max_pivots, math.isqrt(count)))).select("vec").collect()]), width)
    pivots = np.c_[pivots, np.sqrt(np.maximum(far - (pivots**2).sum(1), 0))]

    ensure_on_workers(df.sparkSession)
    kind = float if far < IN_DOUBLES else np.int64 if far < IN_LONGS else object

    def place(frames):
        for pdf in frames:
            x = _matrix(pdf["vec"], width)
            square = (x**2).sum(1)
            out = {}
            for name, last in (("cell", np.sqrt(np.maximum(far - square, 0))), ("qcell", np.zeros(len(x)))):
                own = np.c_[x, last]
                d = np.sqrt(np.maximum((own**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * own @ pivots.T, 0))
                out[name] = d.argmin(1)
                out[name + "_distance"] = d.min(1)
            yield pd.DataFrame({"cls": pdf["cls"], "ids": pdf["ids"], "vec": pdf["vec"], "asked": pdf["asked"].fillna(False).astype(bool), **out})

    placed = materialize(classes.select("cls", "ids", "vec", "asked").mapInPandas(place, "cls long, ids array<struct<id:long,times:long>>, vec array<long>, asked boolean, cell long, cell_distance double, qcell long, qcell_distance double"))
    part = F.pmod(F.xxhash64("cls"), F.lit(parts))
    near = least_k(placed.select("cell", F.array("cell_distance").alias("least"), part.alias("part")), ["cell"], "least", "part", parts, keep)
    near = {r.cell: np.array(r.least) for r in near.collect()}
    reach = {r.qcell: (r.reach, r.n) for r in placed.where("asked").groupBy("qcell").agg(F.max("qcell_distance").alias("reach"), F.count("*").alias("n")).collect()}
    if not reach:
        return empty
    between = np.sqrt(np.maximum((pivots**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * pivots @ pivots.T, 0))
    slack = 1e-6 * (1 + math.sqrt(far))
    # least distance to its own pivot from which data of cell j may matter for queries of cell i
    least = np.full((len(pivots), len(pivots)), np.inf)
    for i, (u, _) in reach.items():
        bounds = np.sort(np.concatenate([u + between[i, j] + d for j, d in near.items()]))
        within = bounds[keep - 1] if len(bounds) >= keep else np.inf
        least[i] = between[i] - u - within - slack
    group_of, chunks, sizes = {}, {}, {}
    for i in sorted(reach, key=lambda i: (between[0, i], i)):
        g = len(sizes) - 1
        if g < 0 or sizes[g] + reach[i][1] > query_block:
            g += 1
        group_of[i], sizes[g] = g, sizes.get(g, 0) + reach[i][1]
    chunks = {g: max(1, math.ceil(n / query_block)) for g, n in sizes.items()}
    needed = {}
    for i, g in group_of.items():
        needed[g] = np.minimum(needed.get(g, np.inf), least[i])

    session = df.sparkSession
    small = lambda data, schema: F.broadcast(session.createDataFrame(data, schema))  # noqa: E731  at most pivots * groups rows
    cells = small([(int(i), int(g), chunks[g]) for i, g in group_of.items()], "qcell long, grp long, chunks long")
    sends = small([(int(j), int(g), float(needed[g][j]), chunks[g]) for g in needed for j in near], "cell long, grp long, least double, chunks long")
    queries = placed.where("asked").join(cells, "qcell").select("grp", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("chunks")).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.col("cls").alias("qcls"), F.col("vec").alias("qvec"))
    data = placed.join(sends, "cell").where(F.col("cell_distance") >= F.col("least")).select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), part.alias("part"), "cls", "vec", "ids")

    def solve(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"cls": [], "part": [], "best": []}
        if len(q) and len(c):
            c = c.sort_values("cls", kind="stable")
            y, ids, at = _matrix(c["vec"], width, kind), c["ids"].tolist(), int(c["part"].iloc[0])
            x, owners = _matrix(q["qvec"], width, kind), q["qcls"].tolist()
            for lo in range(0, len(x), 128):
                scores = x[lo : lo + 128] @ y.T  # by Cauchy and Schwarz at most `far`
                for i, row in enumerate(scores):
                    if kind is object:
                        row = np.array([s if abs(s) < 1 << 63 else None for s in row], object)
                        fit = np.flatnonzero(row != None)  # noqa: E711  element by element
                        found = fit[np.argsort(-row[fit], kind="stable")][:keep]
                        found = np.flatnonzero([s is not None and s >= row[found[-1]] for s in row]) if len(found) else found
                    else:
                        floor = np.partition(row, len(row) - keep)[len(row) - keep] if len(row) > keep else row.min()
                        found = np.flatnonzero(row >= floor)
                    found = found[np.argsort(-row[found], kind="stable")][:keep]
                    best = sorted((-int(row[j]), int(v["id"]), int(v["times"])) for j in found for v in ids[j])[:keep]
                    out["cls"].append(owners[lo + i])
                    out["part"].append(at)
                    out["best"].append([{"loss": s, "id": v, "times": n} for s, v, n in best])
        return pd.DataFrame(out)

    keys = ["grp", "chunk", "part"]
    solved = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(solve, "cls long, part long, best array<struct<loss:long,id:long,times:long>>")
    best = materialize(least_k(materialize(solved), ["cls"], "best", "part", parts, keep))
    owners = materialize(asked.join(placed.where("asked").select("vec", "cls"), "vec").select(F.col("__id").alias("query_id"), "cls"))
    others = F.filter("best", lambda b: b["id"] != F.col("query_id"))
    others = F.slice(F.flatten(F.transform(others, lambda b: F.array_repeat(b, F.least(b["times"], F.lit(k)).cast("int")))), 1, k)
    return owners.join(best, "cls").select("query_id", F.posexplode(others).alias("at", "b")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.loss")).alias("score"))
