"""BPE encoding and decoding by a deterministic tokenisation automaton.

The merges are compiled one after another as gadgets. A gadget for (x, z) takes the arc z away from the state
that follows x and adds the arc xz instead; a state is known by the token that leads to it, and starts as a copy
of the state of that token's right part. So the arc t leaves the state of a unless some gadget (x, z) took it, or
took a part of it, while x still ended a and z still began t. The arcs are worked out from the gadgets when first
used and kept in the transition table.

Over bytes the automaton is stepped by a second table, whose states are the longest ends of what was read that begin a
token (as in Aho and Corasick's machine): it names the tokens that may end at a place, and exactly one of them is an arc
from the state of the place where it begins. So a word is read once, from left to right, without going back, and has
exactly one path; decoding emits the labels of its arcs.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.pieces import BYTE_SPECIAL, PieceTable, blocks, gather, pretokens, small
from grovespark.session import ensure_on_workers

NEVER = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, as character: byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_merges(path: str) -> tuple[dict[bytes, int], list[tuple[int, int, int]], dict[str, int]]:
    """Of a tokenizers file: ids by bytes, merges (left, right, whole) in rank order, and special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbols = byte_symbols()
    raw = lambda s: bytes(symbols[c] for c in s)
    names = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = []
    for m in spec["model"]["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.append((names[left], names[right], names[left + right]))
    return {raw(s): i for s, i in names.items() if s not in special}, merges, special


class MergeAutomaton:
    def __init__(self, path: str):
        ids, merges, special = load_merges(path)
        self.special_id = special[BYTE_SPECIAL]
        self.arcs: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}
        size = max([*ids.values(), *special.values()]) + 1
        self.label = [b""] * size
        for b, i in ids.items():
            self.label[i] = b
        for s, i in special.items():
            self.label[i] = s.encode()
        self.gadgets = {}
        #: what ends (begins) a token, from the whole down to a byte, with the rank at which it is used up
        self.ends, self.begins = [[(i, NEVER)] for i in range(size)], [[(i, NEVER)] for i in range(size)]
        made = {i for b, i in ids.items() if len(b) == 1}
        for rank, (left, right, whole) in enumerate(merges):
            self.gadgets[left << 20 | right] = rank
            if whole in made or left not in made or right not in made or not self._passes(left, right, rank):
                continue
            made.add(whole)
            self.ends[whole] = [(whole, NEVER), (right, rank), *self.ends[right][1:]]
            self.begins[whole] = [(whole, NEVER), (left, rank), *self.begins[left][1:]]
        self.ids = {b: i for b, i in ids.items() if i in made}
        self._compile_steps()
        self.label_bytes = np.frombuffer(b"".join(self.label), np.uint8)
        self.label_length = np.array([len(b) for b in self.label], np.int64)
        self.label_start = np.cumsum(self.label_length) - self.label_length

    def _passes(self, a: int, t: int, before: int = NEVER) -> bool:
        """No gadget older than `before` parts a and t. Of overlapping equal pairs the leftmost merges first."""
        get = self.gadgets.get
        for x, x_used in self.ends[a]:
            for z, z_used in self.begins[t]:
                r = get(x << 20 | z)
                if r is not None and r < before and r < x_used and r <= z_used:
                    return False
        return True

    def arc(self, a: int, t: int) -> bool:
        """Whether arc t leaves the state that token a leads to."""
        key = a << 20 | t
        if (known := self.arcs.get(key)) is None:
            if len(self.arcs) > 1_500_000:
                self.arcs.clear()
            known = self.arcs[key] = self._passes(a, t)
        return known

    def _compile_steps(self) -> None:
        """The byte table: `step` of state << 8 | byte along tokens, the state that the longest proper end leads to, and
        the tokens that end in a state, longest first, as (token, length)."""
        self.step: dict[int, int] = {}
        ending, size = [0], 1
        for word, token in self.ids.items():
            at = 0
            for byte in word:
                to = self.step.get(at << 8 | byte)
                if to is None:
                    to = self.step[at << 8 | byte] = size
                    ending.append(-1)
                    size += 1
                at = to
            ending[at] = token
        ending[0] = -1
        below: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for key, to in self.step.items():
            below[key >> 8].append((key & 255, to))
        self.back, self.found = [0] * size, [()] * size
        level = [0]
        while level:
            after = []
            for at in level:
                for byte, to in below[at]:
                    self.back[to] = self._next(self.back[at], byte) if at else 0
                    own = ((ending[to], len(self.label[ending[to]])),) if ending[to] >= 0 else ()
                    self.found[to] = own + self.found[self.back[to]]
                    after.append(to)
            level = after

    def _next(self, at: int, byte: int) -> int:
        get = self.step.get
        while (to := get(at << 8 | byte)) is None:
            if not at:
                return 0
            at = self.back[at]
        return to

    def encode(self, word: bytes) -> list[int]:
        """The path of the word: at each place the one token that is an arc from where it begins."""
        if (whole := self.ids.get(word)) is not None:
            return [whole]
        step, known, found, at = self.step.get, self.arcs.get, self.found, 0
        last, sizes = [-1], [0]
        for i, byte in enumerate(word, 1):
            to = step(at << 8 | byte)
            if to is None:  # worked out once, then in the table
                to = self.step[at << 8 | byte] = self._next(at, byte)
            at = to
            for token, size in found[at]:
                before = last[i - size]
                if before < 0:
                    break
                if (open_arc := known(before << 20 | token)) is None:
                    open_arc = self.arc(before, token)
                if open_arc:
                    break
            last.append(token)
            sizes.append(size)
        path, i = [], len(word)
        while i:
            path.append(last[i])
            i -= sizes[i]
        return path[::-1]

    def encode_many(self, queue) -> tuple[np.ndarray, np.ndarray]:
        tokens, counts = pretokens(queue)
        known = self.known
        if len(known) > 150_000:
            known.clear()
        ids, sizes, at = [], [], 0
        for n in counts.tolist():
            before = len(ids)
            for token in tokens[at : at + n]:
                if (path := known.get(token)) is None:
                    path = known[token] = self.encode(token.encode())
                ids += path
            at += n
            sizes.append(len(ids) - before)
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.label_bytes, self.label_start[ids], self.label_length[ids]).tobytes()


_READY: dict[str, tuple[MergeAutomaton, PieceTable]] = {}


def ready(path: str) -> tuple[MergeAutomaton, PieceTable]:
    """The worker's automaton and table of pieces for a vocabulary file."""
    if path not in _READY:
        a = MergeAutomaton(path)
        _READY[path] = a, PieceTable(a.encode_many, BYTE_SPECIAL, a.special_id)
    return _READY[path]


def encode_texts(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row; no shuffle.

    Null text counts as empty. Rows repeat as they come; a null key stays null. keep_ids adds the ids themselves.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches):
        automaton, table = ready(path)
        for batch in small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, ids_sha, text_sha, kept = [], [], [], []
            for lo, hi in blocks(texts):
                ids, ends = table.encode(texts[lo:hi])
                start = 0
                for end in ends.tolist():
                    own = ids[start:end]
                    n.append(end - start)
                    ids_sha.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(automaton.decode(own)).hexdigest())
                    if keep_ids:
                        kept.append(own.astype(np.int32))
                    start = end
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ensure_on_workers(df.sparkSession)
    return df.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)
