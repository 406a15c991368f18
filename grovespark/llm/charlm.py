"""Interpolated Kneser-Ney character models: counting on Spark, probabilities in sorted hash arrays."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.pieces import small
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

LETTERS = re.compile(r"[^\W\d_]+").findall
MIX = np.uint64(0x9E3779B97F4A7C15)
DISCOUNT = 0.75


def padded(word: str, order: int) -> str:
    return " " * (order - 1) + word + " "


def ngrams_of(words: list[str], weights: np.ndarray | None, order: int) -> Counter:
    """Counts of the n-grams of blank-padded words, each word as often as its weight says (None: once)."""
    if not words:
        return Counter()
    codes = np.frombuffer((" " * (order - 1) + (" " * order).join(words) + " ").encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    # a word's n-grams end at its letters and at the blank behind it
    own = np.repeat(np.arange(len(words)), size + 1)
    ends = np.arange(len(own)) + (order - 1) * (own + 1)
    windows = np.lib.stride_tricks.sliding_window_view(codes, order)[ends - (order - 1)]
    bits = 64 // order
    wide = np.flatnonzero((windows >> np.uint32(min(31, bits))).any(axis=1)) if int(codes.max()) >> bits else np.zeros(0, np.int64)
    packed = np.zeros(len(windows), np.uint64)
    for k in range(order):
        packed = packed << np.uint64(bits) | windows[:, k].astype(np.uint64)
    out = Counter()
    for i in wide.tolist():  # rare: characters that don't fit
        out["".join(map(chr, windows[i]))] += 1 if weights is None else int(weights[own[i]])
    kept = np.delete(packed, wide) if len(wide) else packed
    if weights is None:
        values, sums = np.unique(kept, return_counts=True)
    else:
        by = np.argsort(kept, kind="stable")
        values, first = np.unique(kept[by], return_index=True)
        sums = np.add.reduceat(np.delete(weights[own], wide)[by], first) if len(first) else first
    low = np.uint64((1 << bits) - 1)
    letters = np.stack([values >> np.uint64(bits * (order - 1 - k)) & low for k in range(order)], axis=1).astype("<u4")
    names = letters.tobytes().decode("utf-32-le")
    for i, n in enumerate(sums.tolist()):
        out[names[i * order : (i + 1) * order]] += n
    return out


def count_ngrams(df: DataFrame, group: str, text: str = "text", order: int = 4) -> DataFrame:
    """(grp, ngram, n) over the words of all rows: lower-case runs of letters with blank padding.

    Words are counted in each task, n-grams are summed there and then by a shuffle, so what moves is types, not text.
    All types are kept, as a shared table; `of_group` reads one group's. Null groups or texts take no part.
    """

    def run(batches):
        words: dict[str, Counter] = {}

        def grams():
            for g, counted in words.items():
                once = [w for w, n in counted.items() if n == 1]
                often = [(w, n) for piece, n in counted.items() if n > 1 for w in LETTERS(piece)]
                found = ngrams_of(LETTERS(" ".join(once)), None, order)
                found.update(ngrams_of([w for w, _ in often], np.array([n for _, n in often], np.int64), order))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(found), pa.string()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["grp", "ngram", "n"])
            words.clear()

        for batch in small(batches):
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words.setdefault(g, Counter())
                own.update(t.lower().split())
            if sum(map(len, words.values())) > 200_000:
                yield from grams()
        yield from grams()

    ensure_on_workers(df.sparkSession)
    rows = df.select(F.col(group).cast("string").alias("grp"), F.col(text).alias("t")).where("grp is not null and t is not null")
    summed = rows.mapInArrow(run, "grp string, ngram string, n bigint").groupBy("grp", "ngram").agg(F.sum("n").alias("n"))
    return materialize(summed)


def groups_of(counts: DataFrame) -> list[str]:
    return sorted(r.grp for r in counts.select("grp").distinct().collect())


def of_group(counts: DataFrame, group: str) -> pd.DataFrame:
    """All (ngram, n) of one group, the most frequent first."""
    return counts.where(F.col("grp") == group).select("ngram", "n").orderBy(F.desc("n"), "ngram").toPandas()


def alphabet_size(counts: DataFrame) -> int:
    """Different characters in the n-grams of all groups, and two."""
    return 2 + counts.select(F.explode(F.regexp_extract_all("ngram", F.lit("(?s)(.)"), F.lit(1)))).distinct().count()


class KneserNey:
    """Log probabilities of one group's n-grams, by order: sorted hashes with values, and back-off weights of contexts."""

    def __init__(self, ngrams: list[str], counts: np.ndarray, order: int, alphabet: int):
        self.order, self.floor = order, -np.log(alphabet)
        levels = [pd.Series(counts.astype(float), index=pd.Index(ngrams))]
        while len(levels) < order:  # continuation counts: how many different characters stand before
            levels.append(pd.Series(1.0, index=levels[-1].index.str[1:]).groupby(level=0).sum())
        self.tables, below = [], None
        for n, level in enumerate(reversed(levels), 1):
            context = level.index.str[:-1]
            stats = level.groupby(context).agg(["sum", "size"])
            total, kinds = stats["sum"].reindex(context).to_numpy(), stats["size"].reindex(context).to_numpy()
            lower = np.full(len(level), 1 / alphabet) if below is None else below.reindex(level.index.str[1:]).fillna(1 / alphabet).to_numpy()
            p = (level.to_numpy() - DISCOUNT) / total + DISCOUNT * kinds / total * lower
            below = pd.Series(p, index=level.index)
            weights = np.log(DISCOUNT * stats["size"].to_numpy() / stats["sum"].to_numpy())
            self.tables.append((*self._sorted(level.index, n, np.log(p)), *self._sorted(stats.index, n - 1, weights)))

    @staticmethod
    def _sorted(texts, n: int, values: np.ndarray):
        if n == 0:
            return np.zeros(1, np.uint64), values[:1]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
        keys = np.zeros(len(codes), np.uint64)
        for k in range(n):
            keys = keys * MIX + codes[:, k] + np.uint64(1)
        at = np.argsort(keys, kind="stable")
        return keys[at], values[at]

    def log_probs(self, keys: list[np.ndarray]) -> np.ndarray:
        """keys[n]: hashes of the n characters that end at each place, keys[0] zeros; contexts end one place before."""
        out, todo = np.zeros(len(keys[0])), np.arange(len(keys[0]))
        for n in range(self.order, 0, -1):
            known, value, contexts, weights = self.tables[n - 1]
            at = np.minimum(np.searchsorted(known, keys[n][todo]), len(known) - 1)
            hit = known[at] == keys[n][todo]
            out[todo[hit]] += value[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            before = keys[n - 1][todo - 1] if n > 1 else keys[0][todo]
            at = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
            hit = contexts[at] == before
            out[todo[hit]] += weights[at[hit]]
        out[todo] += self.floor
        return out


def window_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    keys = [np.zeros(len(codes), np.uint64)]
    shifted = codes.astype(np.uint64) + np.uint64(1)
    for n in range(1, order + 1):
        own = np.zeros(len(codes), np.uint64)
        for k in range(n):
            own = own * MIX + np.concatenate([np.zeros(n - 1 - k, np.uint64), shifted[: len(shifted) - (n - 1 - k)]])
        keys.append(own)
    return keys


def score_words(models: list[KneserNey], words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed log probability of each word under each model, and the number of characters scored (with the end)."""
    if not words:
        return np.zeros((0, len(models))), np.zeros(0, np.int64)
    codes = np.frombuffer("".join(padded(w, order) for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    keys = window_hashes(codes, order)
    starts = np.cumsum(sizes + order - 1) - sizes - (order - 1)
    scored = np.ones(len(codes), bool)
    for k in range(order - 1):
        scored[starts + k] = False
    edges = np.cumsum(sizes) - sizes
    out = np.empty((len(words), len(models)))
    for j, m in enumerate(models):
        out[:, j] = np.add.reduceat(m.log_probs(keys)[scored], edges)
    return out, sizes
