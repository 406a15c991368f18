"""Token counts by rank-synchronous merging of ragged arrays.

A batch of pre-tokens is one array of symbols with sequence bounds. In each round every unfinished sequence applies
its own lowest-ranked pair at all its places at once; a sequence without a known pair is done, and what is left of it
is its count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.bpe_automaton import load_merges
from grovespark.llm.pieces import BYTE_SPECIAL, PieceTable, blocks, pretokens, small, sums
from grovespark.session import ensure_on_workers

NO_RANK = np.int64(1 << 40)


class RankMerger:
    def __init__(self, path: str):
        ids, merges, special = load_merges(path)
        self.special_id = special[BYTE_SPECIAL]
        self.byte_id = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.merged = np.array([w for _, _, w in merges], np.int64)
        keys = np.array([a << 20 | b for a, b, _ in merges], np.int64)
        self.bits = 19
        slots = 1 << self.bits
        self.keys, self.ranks = np.full(slots, -1, np.int64), np.full(slots, NO_RANK, np.int64)
        waiting, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(waiting):  # linear probing, one step for all keys that still have no slot
            free = self.keys[at] < 0
            _, first = np.unique(at, return_index=True)
            lands = np.zeros(len(at), bool)
            lands[first] = True
            lands &= free
            self.keys[at[lands]], self.ranks[at[lands]] = keys[waiting[lands]], waiting[lands]
            waiting, at = waiting[~lands], (at[~lands] + 1) & (slots - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        out, at, todo = np.full(len(keys), NO_RANK, np.int64), self._slot(keys), np.arange(len(keys))
        for _ in range(self.probes):
            held = self.keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (held >= 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
            if not len(todo):
                break
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        done = sizes.copy()
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        rank = self._pair_ranks(symbol, owner)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            length = np.diff(np.r_[starts, len(symbol)])
            over = least == NO_RANK
            done[owner[starts[over]]] = length[over]
            if over.any():
                keep = np.repeat(~over, length)
                symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
                least, length = least[~over], length[~over]
                if not len(symbol):
                    break
            chosen = rank == np.repeat(least, length)
            at = np.flatnonzero(chosen)
            # of pairs that overlap (equal symbols in a run) every second one, from the left
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            at = moved[at]
            changed = np.unique(np.r_[at, at[at > 0] - 1])
            rank[changed] = self._pair_ranks(symbol, owner, changed)
        return done

    def _pair_ranks(self, symbol, owner, at=None):
        """Rank of the pairs that start at these places; none at the last symbol of a sequence."""
        at = np.arange(len(symbol)) if at is None else at
        out = np.full(len(at), NO_RANK, np.int64)
        inner = np.flatnonzero(at + 1 < len(symbol))
        inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
        out[inner] = self.rank(symbol[at[inner]], symbol[at[inner] + 1])
        return out

    def count_many(self, queue) -> tuple[np.ndarray, np.ndarray]:
        """One value for each piece: the tokens of its pre-tokens. Equal pre-tokens are merged once."""
        tokens, counts = pretokens(queue)
        numbers = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
        each = self.counts([t.encode() for t in numbers]) if numbers else np.zeros(0, np.int64)
        values = each[np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))]
        return sums(values, counts), np.ones(len(counts), np.int64)


_READY: dict[str, PieceTable] = {}


def ready(path: str) -> PieceTable:
    if path not in _READY:
        _READY[path] = PieceTable(RankMerger(path).count_many, BYTE_SPECIAL, 1)
    return _READY[path]


def count_tokens(df: DataFrame, path: str, limit: int = 512, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; no shuffle.

    Null text counts as empty; repeated rows and null keys are counted like others; just `limit` tokens are not over it. An
    empty table gives an empty one. Other columns are left behind.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        table = ready(path)
        for batch in small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = []
            for lo, hi in blocks(texts):
                numbers, counts = table.number(texts[lo:hi])
                found.append(sums(table.values[numbers].astype(np.int64), counts))
            n = np.concatenate(found) if found else np.zeros(0, np.int64)
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], names=[key, "n_bytes", "n_tokens", "over_limit"])

    ensure_on_workers(df.sparkSession)
    return df.select(key, F.col(text).alias("__text")).mapInArrow(run, f"{key} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
