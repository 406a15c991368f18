"""Best-fit packing of token sequences with swap-based local search.

Documents become pieces of at most `capacity` tokens. Pieces are dealt by a hash into groups of bounded size; each
group is packed by best fit, longest first, and then improved: the emptiest bins give their pieces to other underfull
bins by moves, one-for-one and two-for-one exchanges that raise the sum of squared fills, until no bin empties.
What stays in underfull bins of all groups is dealt and packed again, as long as that lowers the number of bins.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from unicodedata import normalize

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.bpe_automaton import byte_symbols
from grovespark.llm.pieces import PieceTable, blocks, small
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

#: Special tokens and split pattern of the public word-level vocabulary.
WORD_SPECIALS = ("<|startoftext|>", "<|endoftext|>")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

#: Times that underfull bins are opened and packed again at most; sequence numbers have room for it.
MOST_LEVELS = 32

_WORDS = regex.compile(WORD_PATTERN).findall
_READY: dict[str, tuple] = {}


def _ready(path: str):
    if path not in _READY:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        model, shown, known = tokenizer.model, {b: ord(c) for c, b in byte_symbols().items()}, {}

        def encode_many(queue):
            ids, lengths = [], []
            if len(known) > 100_000:
                known.clear()
            for _, piece in queue:
                before = len(ids)
                for token in _WORDS(piece.lower() if piece.isascii() else normalize("NFC", piece).lower()):
                    if (own := known.get(token)) is None:
                        own = known[token] = [t.id for t in model.tokenize(token.encode().decode("latin-1").translate(shown))]
                    ids += own
                lengths.append(len(ids) - before)
            return np.array(ids, np.uint32), np.array(lengths, np.int64)

        _READY[path] = tokenizer, PieceTable(encode_many)
    return _READY[path]


def word_ids(path: str, texts: list[str]):
    """Token ids of each text, as the library gives them. White space only parts words in this vocabulary, so each
    distinct piece goes through the library's model once. Texts with special strings, or with a capital sigma, whose
    lower case Python takes from its place in the word, go through the library whole.
    """
    tokenizer, table = _ready(path)
    plain = [t.replace("\n", " ") for t in texts]
    odd = {i for i, t in enumerate(texts) if "Σ" in t or any(s in t for s in WORD_SPECIALS)}
    numbers, counts = table.words(["" if i in odd else t for i, t in enumerate(plain)])
    ids, ends = table.ids(numbers, counts)
    start = 0
    for i, end in enumerate(ends.tolist()):
        yield np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32) if i in odd else ids[start:end]
        start = end


def cut_documents(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every piece; no shuffle. Null text: the end id alone."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches):
        for batch in small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys, rows = batch.column(0).to_pylist(), []
            for lo, hi in blocks(texts):
                for k, ids in zip(keys[lo:hi], word_ids(path, texts[lo:hi]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    rows += [(k, i, at, len(own := ids[at : at + capacity]), zlib.crc32(own.tobytes())) for i, at in enumerate(range(0, len(ids), capacity))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])], names=[key, "piece", "start", "length", "ids_crc32"])

    ensure_on_workers(df.sparkSession)
    return df.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, into the fullest bin that still has room."""
    bins, room = [], []  # room: sorted (free, bin)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([i])
            free, b = capacity - lengths[i], len(bins) - 1
        else:
            free, b = room.pop(at)
            bins[b].append(i)
            free -= lengths[i]
        if free:
            insort(room, (free, b))
    return bins


def _offers(own: list[int], lengths: list[int]):
    """What a bin can give: nothing, one of its items or two. Items of one length are alike, so each length is offered
    once; as lengths add up to the fill, a bin has few different ones."""
    by: dict[int, list[int]] = {}
    for i in own:
        by.setdefault(lengths[i], []).append(i)
    yield (), 0
    kinds = sorted(by)
    for x in kinds:
        yield (by[x][0],), x
    for n, x in enumerate(kinds):
        if len(by[x]) > 1:
            yield (by[x][0], by[x][1]), 2 * x
        for y in kinds[n + 1 :]:
            yield (by[x][0], by[y][0]), x + y


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins that raise the sum of squared fills; bins that empty go. Ends with the first
    round that empties none.

    One-for-one, two-for-one and moves: a bin takes one longer piece for one or two of its own whose lengths sum to
    less, or a piece for nothing, if that fills it better. The fuller bin always gains, so squared fill rises.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    while True:
        held = sum(map(bool, bins))
        under = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: (fill[b], b))
        if len(under) < 2:
            break
        pool: list[tuple[int, int]] = []  # pieces of emptier bins: (length, item), sorted
        home: dict[int, int] = {}
        donors = under[: max(1, len(under) // 4)]
        for d in donors:
            for i in bins[d]:
                insort(pool, (lengths[i], i))
                home[i] = d
        for b in reversed(under[len(donors) :]):
            while pool and fill[b] < capacity:
                gap, own = capacity - fill[b], bins[b]
                best = (0, None, ())
                for given, size in _offers(own, lengths):
                    at = bisect_left(pool, (size + gap + 1, -1)) - 1
                    if at >= 0 and (gain := pool[at][0] - size) > best[0]:
                        best = (gain, pool[at][1], given)
                        if gain == gap:
                            break
                gain, item, given = best
                if item is None:
                    break
                d = home.pop(item)
                # the emptier bin must hold what it gets in turn, and the exchange must raise squared fill
                if fill[b] + gain <= fill[d] - gain:
                    home[item] = d
                    break
                pool.pop(bisect_left(pool, (lengths[item], item)))
                bins[d].remove(item)
                own.append(item)
                for i in given:
                    own.remove(i)
                    bins[d].append(i)
                    insort(pool, (lengths[i], i))
                    home[i] = d
                fill[b] += gain
                fill[d] -= gain
        # the donors' pieces, packed anew, may need fewer bins
        loose = [i for d in donors for i in bins[d]]
        again = best_fit([lengths[i] for i in loose], capacity)
        filled = [d for d in donors if bins[d]]
        if len(again) < len(filled):
            for d in donors:
                bins[d], fill[d] = [], 0
            for d, members in zip(donors, again, strict=False):
                bins[d] = [loose[i] for i in members]
                fill[d] = sum(lengths[i] for i in bins[d])
        if sum(map(bool, bins)) == held:
            break
    return [b for b in bins if b]


def _pack_groups(items: DataFrame, key: str, capacity: int, group_size: int, level: int) -> DataFrame:
    """Adds (sequence_id, offset, filled): bins are numbered within a group, groups within a level. Items are dealt by
    their row number, so that equal rows don't meet more than others."""
    groups = max(1, math.ceil(items.count() / group_size))
    spread = items.withColumn("__group", F.pmod(F.xxhash64("__row", F.lit(level)), F.lit(groups)).cast("long"))
    schema = f"{key} {items.schema[key].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, __row bigint, sequence_id bigint, offset bigint, filled bigint"

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", key, "piece", "ids_crc32", "__row"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].tolist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, filled = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        base = (int(pdf["__group"].iloc[0]) * MOST_LEVELS + level) << 24
        for n, members in enumerate(bins):
            at = 0
            for i in members:
                sequence[i], offset[i] = base + n, at
                at += lengths[i]
            filled[members] = at
        pdf["sequence_id"], pdf["offset"], pdf["filled"] = sequence, offset, filled
        return pdf.drop(columns="__group")

    ensure_on_workers(items.sparkSession)
    return materialize(spread.groupBy("__group").applyInPandas(pack, schema))


def pack_documents(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id", group_size: int = 2048, full: float = 0.995) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): every piece in one sequence of at most capacity.

    Null text counts as empty (its piece is the end id alone). Equal rows are packed as rows of their own. An empty
    table gives an empty result. Bins filled less than `full` of the capacity are opened and packed again in groups dealt
    anew, so that what the groups leave behind is shared, until that needs no fewer bins (MOST_LEVELS times at most).
    """
    pieces = materialize(cut_documents(df, path, capacity, end_id, text, key).withColumn("__row", F.monotonically_increasing_id()))
    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    # whole pieces need no packing: their bins are numbered by row, below zero
    whole = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("__row")).withColumn("offset", F.lit(0).cast("long"))
    done, rest, bins = [whole], pieces.where(F.col("length") < capacity), None
    for level in range(MOST_LEVELS):
        packed = _pack_groups(rest, key, capacity, group_size, level)
        loose = packed.where(F.col("filled") < full * capacity)
        before, bins = bins, packed.select("sequence_id").distinct().count()
        left = loose.select("sequence_id").distinct().count()
        if before is not None and bins >= before or left <= 1 or level == MOST_LEVELS - 1:
            done.append(packed)
            break
        done.append(packed.where(F.col("filled") >= full * capacity))
        rest, bins = loose.drop("sequence_id", "offset", "filled"), left
    out = done[0].select(names)
    for d in done[1:]:
        out = out.unionByName(d.select(names))
    return out
