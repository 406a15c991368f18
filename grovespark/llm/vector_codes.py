"""Vector codes: product quantisation by Lloyd's rounds that compare only what may have changed.

Vectors become whole numbers and are cut into equal parts; each part position has its own codebook. A written table holds
the entry of every part and its exact squared distance. In a round, a part whose entry stayed as it was needs to look at
the entries that moved alone: all others are where they were, and none of them beat its entry then. Parts whose entry
moved look at all entries. Ties go to the lower index both times, so codes are those of plain Lloyd rounds.

Only codebooks and their sums pass through the driver: parts * entries rows, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.scratch import discard, materialize
from grovespark.session import ensure_on_workers

#: Whole numbers up to here are exact in a double.
EXACT = 1 << 53
#: Rows whose distances to a codebook are held at once.
STRIP = 4096


@dataclass(frozen=True)
class Codebooks:
    """entries[part]: a list of entries, each a list of whole numbers; width: components of a part."""

    entries: list[list[list[int]]]
    width: int

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined with commas."""
        return hashlib.sha256(",".join(str(x) for book in self.entries for e in book for x in e).encode()).hexdigest()


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(x.astype(np.float64) * scale)


def _exact(values: np.ndarray, largest: int, width: int) -> np.ndarray:
    """values in the narrowest type that holds every squared distance exactly: doubles, longs or Python's whole numbers."""
    most = max(1, width) * (2 * largest + 2) ** 2
    return values.astype(np.float64) if most < EXACT else values.astype(np.int64) if most < 1 << 62 else values.astype(object)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Of every row of x to every entry; both hold whole numbers of one exact type."""
    if x.dtype == np.float64:
        return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def nearest(x: np.ndarray, entries: np.ndarray, code: np.ndarray | None = None, error: np.ndarray | None = None, moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(code, error) of the rows of x: index of the nearest entry, the lower of equals, and the squared distance to it.

    With the code and error of the round before and a mask of the entries that moved since, rows whose entry stayed
    are compared with the moved entries alone.
    """
    if code is None:
        code, error, stayed = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype), np.zeros(len(x), bool)
    else:
        code, error, stayed = code.copy(), error.astype(x.dtype), ~moved[code]
    for lo in range(0, len(x), STRIP):
        rows = lo + np.flatnonzero(~stayed[lo : lo + STRIP])
        if len(rows):
            d = squared_distances(x[rows], entries)
            code[rows] = d.argmin(1)  # the first of equals
            error[rows] = d.min(1)
        rows = lo + np.flatnonzero(stayed[lo : lo + STRIP])
        if len(rows) and moved.any():
            at = np.flatnonzero(moved)
            d = squared_distances(x[rows], entries[at])
            best, least = at[d.argmin(1)], d.min(1)
            better = (least < error[rows]) | ((least == error[rows]) & (best < code[rows]))
            code[rows[better]], error[rows[better]] = best[better], least[better]
    return code, error


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors of whole numbers as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _assigner(books: Codebooks, before: Codebooks | None, largest: int):
    """A function over pandas frames of (id, label, vec, code, error) that gives every part its nearest entry."""
    parts, width = len(books.entries), books.width

    def run(frames):
        as_array = lambda book: _exact(np.array(book, dtype=object).reshape(len(book), width), largest, width)
        entries = [as_array(b) for b in books.entries]
        moved = [np.array([a != b for a, b in zip(old, new, strict=True)]) for old, new in zip(before.entries, books.entries, strict=True)] if before else None
        for pdf in frames:
            x = _exact(_matrix(pdf["vec"], parts * width), largest, width)
            codes, errors = [], []
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                known = (np.stack(pdf["code"].to_numpy())[:, p].astype(np.int64), np.stack(pdf["error"].to_numpy())[:, p], moved[p]) if before and len(pdf) else ()
                code, error = nearest(own, entries[p], *known)
                codes.append(code)
                errors.append(error)
            out = pdf[["id", "label", "vec"]].copy()
            out["code"] = list(np.stack(codes, axis=1).tolist()) if len(pdf) else []
            out["error"] = [[int(e) for e in row] for row in zip(*errors)] if len(pdf) else []
            yield out

    return run


def _moved_on(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floor of its parts' mean; unused ones stay. Sums are made by Spark, map side first."""
    width, parts = books.width, len(books.entries)
    each = state.select(F.posexplode(F.transform("code", lambda c, p: F.struct(c.alias("code"), F.slice("vec", p * width + 1, width).alias("part")))).alias("p", "s"))
    sums = each.groupBy("p", "s.code").agg(F.count("*").alias("n"), *[F.sum(F.coalesce(F.get("s.part", F.lit(i)), F.lit(0)).cast("decimal(38,0)")).alias(f"c{i}") for i in range(width)])
    entries = [[list(e) for e in book] for book in books.entries]
    for r in sums.collect():  # at most parts * entries rows
        entries[r["p"]][r["code"]] = [int(r[f"c{i}"]) // r["n"] for i in range(width)]
    assert all(len(b) == len(books.entries[p]) for p, b in enumerate(entries)) and len(entries) == parts
    return Codebooks(entries, width)


def whole_vectors(df: DataFrame, scale: int = 1024, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, vec): floor(scale * x) of each component; vectors that are null or hold null or non-finite components
    are left out. A component whose whole number no long can hold is an error, as the result's errors are longs."""
    wide = F.transform(F.col(embedding), lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), wide.alias("__x")).where(F.col("__x").isNotNull() & finite)
    return kept.select("id", "label", F.transform("__x", lambda x: F.floor(x * scale).cast("long")).alias("vec"))


def fit_codes(rows: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4) -> tuple[DataFrame, Codebooks]:
    """(id, label, vec, code, error) of rows(id, label, vec), code and error with one value for each part; the codebooks.

    Codebooks start as the parts of the `entries` rows with the smallest ids, equal ids by vector; null ids come last.
    Fewer rows make fewer entries. Vectors end in zeros up to the longest length that `parts` divides. Each round
    writes its table and deletes the one before it.
    """
    ensure_on_workers(rows.sparkSession)
    count, longest, largest = rows.agg(F.count("*"), F.max(F.size("vec")), F.max(F.greatest(F.abs(F.coalesce(F.array_max("vec"), F.lit(0))), F.abs(F.coalesce(F.array_min("vec"), F.lit(0)))))).first()
    width = -(-(longest or 0) // parts)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    padded = [r["vec"] + [0] * (parts * width - len(r["vec"])) for r in first]
    books, before = Codebooks([[v[p * width : (p + 1) * width] for v in padded] for p in range(parts)], width), None
    none = F.lit(None).cast("array<int>")
    state = rows.select("id", "label", "vec", none.alias("code"), none.cast("array<long>").alias("error"))
    if not count:
        return state, books
    schema = f"id long, label {rows.schema['label'].dataType.simpleString()}, vec array<long>, code array<int>, error array<long>"
    for r in range(rounds + 1):
        made = materialize(state.mapInPandas(_assigner(books, before, int(largest or 0)), schema))
        discard(state)
        state = made
        if r < rounds:
            before, books = books, _moved_on(state, books)
    return state, books


def vector_codes(df: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row with a vector of finite components.

    code: the index of each part's entry, from 0, as two hex digits; error: the squared distances of the parts summed;
    label_error: errors summed over equal labels, null ones together. Rows that repeat an id are coded each for itself,
    a null id is kept. An empty table gives an empty one, vectors without components have error 0. More than 256 entries
    would need more digits and are an error. Errors beyond a long fail and don't wrap.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits for each part, so codebooks have 1 to 256 entries")
    state, books = fit_codes(materialize(whole_vectors(df, scale, key, embedding, label)), entries, parts, rounds)
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    coded = state.select("id", "label", code.alias("code"), F.aggregate("error", F.lit(0).cast("long"), lambda a, e: a + e).alias("error"))
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    out = coded.join(sums.withColumnRenamed("label", "__of"), F.col("label").eqNullSafe(F.col("__of")))
    return out.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
