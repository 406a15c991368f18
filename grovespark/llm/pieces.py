"""Batched tokenising of whole texts by their distinct space-separated pieces.

A text is cut at single spaces; each distinct piece is encoded once per worker and texts become arrays of
piece numbers, whose ids are gathered with numpy. Memory is bounded: texts go in blocks, and the table of
pieces is emptied beyond a size.
"""

from __future__ import annotations

import re

import numpy as np
import regex

#: The split pattern and the special token of the public byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
BYTE_SPECIAL = "<|endoftext|>"

_PRETOKENS = regex.compile(BYTE_PATTERN).findall
#: White space that a cut at single spaces would treat otherwise than the whole text.
_RUNS = re.compile(r"\s\s(?:\s|\Z)").search

REST, FIRST, RAW = 0, 1, 2


class _Interner(dict):
    """Numbers strings in order of arrival; new ones wait in the table's queue."""

    def __init__(self, table, kind):
        self.table, self.kind = table, kind

    def __missing__(self, key):
        self[key] = n = self.table.size
        self.table.size += 1
        self.table.queue.append((self.kind, key))
        return n


class PieceTable:
    """encode_many gets [(kind, piece)] and returns (values, lengths): the pieces' ids, one after another.

    special: the string that is a token of its own wherever it occurs, with its id; None if there is none.
    """

    def __init__(self, encode_many, special=None, special_id=None, limit=150_000):
        self.encode_many, self.special, self.special_id, self.limit = encode_many, special, special_id, limit
        self.clear()

    def clear(self):
        self.size, self.queue = 0, []
        self.by_kind = [_Interner(self, k) for k in (REST, FIRST, RAW)]
        self.values, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.special is not None:
            self.size = 1
            self.values, self.starts, self.lengths = np.array([self.special_id], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def _settle(self):
        if self.queue:
            values, lengths = self.encode_many(self.queue)
            ends = np.cumsum(lengths) + len(self.values)
            self.values = np.concatenate([self.values, values.astype(np.uint32)])
            self.starts, self.lengths = np.concatenate([self.starts, ends - lengths]), np.concatenate([self.lengths, lengths])
            self.queue = []

    def number(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts, and how many each text has."""
        if self.size > self.limit:
            self.clear()
        rest, first, raw = self.by_kind
        pieces, at, fixed, counts = [], [], [], []
        for text in texts:
            before = len(pieces)
            for j, s in enumerate(text.split(self.special) if self.special is not None and self.special in text else (text,)):
                if j:
                    at.append(len(pieces))
                    fixed.append(0)
                    pieces.append("")
                if not s:
                    continue
                if _RUNS(s):
                    for token in _PRETOKENS(s):
                        at.append(len(pieces))
                        fixed.append(raw[token])
                        pieces.append("")
                else:
                    p = s.split(" ")
                    at.append(len(pieces))
                    fixed.append(first[p[0]])
                    p[0] = ""
                    pieces += p
            counts.append(len(pieces) - before)
        numbers = np.fromiter(map(rest.__getitem__, pieces), np.int64, len(pieces))
        numbers[at] = fixed
        self._settle()
        return numbers, np.array(counts, np.int64)

    def words(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """As number(), for vocabularies in which spaces only part words."""
        if self.size > self.limit:
            self.clear()
        pieces, counts = [], []
        for text in texts:
            p = text.split(" ")
            pieces += p
            counts.append(len(p))
        numbers = np.fromiter(map(self.by_kind[REST].__getitem__, pieces), np.int64, len(pieces))
        self._settle()
        return numbers, np.array(counts, np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids end."""
        return self.ids(*self.number(texts))

    def ids(self, numbers, counts) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers]
        ids = gather(self.values, self.starts[numbers], lengths)
        return ids, sums(lengths, counts).cumsum()


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of each pair, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the next count values for each count; zero counts give zero."""
    running = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]


def pretokens(queue) -> tuple[list[str], np.ndarray]:
    """Pre-tokens of queued pieces, one after another, and how many each has."""
    out, counts = [], []
    for kind, piece in queue:
        tokens = [piece] if kind == RAW else _PRETOKENS(" " + piece if kind == REST else piece)
        out += tokens
        counts.append(len(tokens))
    return out, np.array(counts, np.int64)


def blocks(texts, max_chars: int = 1_500_000):
    """Slices of a list of texts with about so many characters each, a longer text alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > max_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def small(batches, rows: int = 256):
    """Arrow batches in slices of so many rows, so that a worker holds few texts as Python strings at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
