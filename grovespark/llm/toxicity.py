"""Toxicity of texts behind a noisy channel.

Tokens that look disguised (letters mixed with digits or signs, letters said three times or more, letters parted by
spaces or signs) are decoded: each character spans a lattice of what it may stand for, repeats and separators may
vanish, and Viterbi finds the letters that a character model of the corpus makes likeliest. The restored words are
scored by what labelled rows teach: words and word beginnings that occur in toxic rows of different wording and hardly
ever in clean ones.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.charlm import LETTERS, KneserNey, alphabet_size, count_ngrams, of_group, window_hashes
from grovespark.llm.language import training_fold
from grovespark.llm.pieces import small
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

ORDER = 3
#: What signs may stand for in disguised words.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "(": "c", "<": "c", "v": "u", "*": "aeiou", "#": "h"}
#: Costs in nats: another letter for a sign, a vowel for a star, leaving out a separator, a sign, a digit, a repeat.
SWAP_COST, VOWEL_COST, REPEAT_COST = 1.0, 3.0, 0.3
SEPARATORS, SEPARATOR_COST, SIGN_COST, DIGIT_COST = " .-_~^'", 0.5, 3.0, 12.0
HEADS, TAILS = ".,;:?\"'()[]{}<>*#%&-_=~^`/\\", ".,;:!?\"'()[]{}<>|*#%&$@+-_=~^`/\\"
PREFIXES = (4, 5, 6)
#: A feature needs so many toxic rows that differ in the piece before it (copies of one text count once), and may
#: occur in one clean row for so many toxic ones.
LEAST_ROWS, ROWS_FOR_CLEAN, PRIOR = 5, 50, 6
#: Score of a text in which nothing points to toxicity.
BASE = 0.02
_MIXED = re.compile(r"[^\W\d_][\d@$!|+€£¢(<*#.\-_~^]+[^\W\d_]|[\d@$!|+€£¢(<]+[^\W\d_]|[^\W\d_][\d@$€£¢]").search
_REPEATED = re.compile(r"([^\W\d_])\1\1").search
_SAID_AGAIN = re.compile(r"(.)\1+").sub
SINGLE = frozenset(map(chr, range(33, 127)))
_SPACED = re.compile(r"(?<!\S)(?:[^\s%&=~] ){3,}[^\s%&=~](?!\S)")


class Decoder:
    """Exact Viterbi over the lattice of a token. States are the last ORDER - 1 letters, of which a place of the lattice
    reaches few, so none is left out."""

    def __init__(self, model: KneserNey):
        self.model, self.known = model, {}

    def _log_prob(self, context: str, letter: str) -> float:
        s = context + letter
        if (p := self.known.get(s)) is None:
            codes = np.frombuffer(s.encode("utf-32-le"), np.uint32)
            p = self.known[s] = float(self.model.log_probs([k[-2:] for k in window_hashes(codes, ORDER)])[-1])
        return p

    def decode(self, token: str) -> str:
        states = {" " * (ORDER - 1): (0.0, "")}
        for i, c in enumerate(token):
            options = [(c, 0.0)] if c.isalpha() else []
            options += [(x, SWAP_COST if len(LEET[c]) < 3 else VOWEL_COST) for x in LEET.get(c, "")]
            drop = None if c.isalpha() else SEPARATOR_COST if c in SEPARATORS else DIGIT_COST if c.isdigit() else SIGN_COST
            if i and c == token[i - 1]:
                drop = REPEAT_COST
            new: dict[str, tuple[float, str]] = {}
            for context, (cost, said) in states.items():
                if drop is not None and (context not in new or new[context][0] > cost + drop):
                    new[context] = cost + drop, said
                for letter, extra in options:
                    total, to = cost + extra - self._log_prob(context, letter), context[1:] + letter
                    if to not in new or new[to][0] > total:
                        new[to] = total, said + letter
            states = new
        return min((cost - self._log_prob(context, " "), said) for context, (cost, said) in states.items())[1]


class _Pieces(dict):
    """What each piece of text says: looked up once, as `read` finds it."""

    def __init__(self, read):
        self.read = read

    def __missing__(self, piece):
        self[piece] = out = self.read(piece)
        return out


class Reader:
    """Texts to restored words."""

    def __init__(self, decoder: Decoder):
        self.decoder = decoder

    def words(self, piece: str) -> list[str]:
        """Lower-case words of a piece, read as written and, if it looks disguised, as decoded."""
        core = piece.lower().lstrip(HEADS).rstrip(TAILS)
        if core.isalpha() and not _REPEATED(core):
            return [core]
        words = LETTERS(core)
        if _REPEATED(core) or _MIXED(core):
            words = [*words, *LETTERS(self.decoder.decode(core))]
        return words

    def pieces(self, text: str) -> set[str]:
        found = set(text.split())
        found.update(self.spaced(text, found))
        return found

    @staticmethod
    def spaced(text: str, pieces: set[str]) -> list[str]:
        """Letters parted by spaces, as if parted by points. The pattern runs where there are single characters enough."""
        if len(pieces & SINGLE) + sum(len(p) == 1 and p not in SINGLE for p in pieces if not p.isascii()) < 3:
            return []
        return [m.group().replace(" ", ".") for m in _SPACED.finditer(text)]


def features(word: str) -> list[str]:
    """A word is a feature whole (=word) and by its beginnings (word-), letters said twice or more taken as one."""
    word = _SAID_AGAIN(r"\1", word)
    return [f"={word}", *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


class ToxicModel:
    def __init__(self, decoder: Decoder, weights: dict[str, float], base: float):
        self.decoder, self.weights, self.base = decoder, weights, base
        self.heads = {f.lstrip("=")[:2] for f in weights}

    def _known(self, piece: str) -> tuple[str, ...]:
        """The features of a piece that have a weight. Words begin like none of them, as a rule."""
        words = [w for w in self._reader.words(piece) if w[:2] in self.heads or w[:1] == w[1:2]]
        return tuple(sorted({f for w in words for f in features(w) if f in self.weights}))

    def scores(self, texts: list[str]) -> list[float]:
        if "_reader" not in self.__dict__:
            self._reader = Reader(self.decoder)
            self._seen = _Pieces(self._known)
        if len(self._seen) > 100_000:
            self._seen.clear()
        out, look = [], self._seen.__getitem__
        for text in texts:
            found = {f for hits in set(map(look, self._reader.pieces(text))) for f in hits}
            clean = 1 - self.base
            for f in sorted(found):
                clean *= 1 - self.weights[f]
            out.append(1 - clean)
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}


def train(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", buckets: int = 3, held_out: int = 1, sample_rows: int = 20_000) -> ToxicModel:
    """The character model is counted over all texts; sample_rows bounds the labelled rows that teach the words."""
    counts = count_ngrams(df.withColumn("__all", F.lit("")), "__all", text, ORDER)
    if counts.isEmpty():
        counts = df.sparkSession.createDataFrame([("", " " * ORDER, 1)], counts.schema)
    own = of_group(counts, "")
    decoder = Decoder(KneserNey(own["ngram"].tolist(), own["n"].to_numpy(), ORDER, alphabet_size(counts)))
    judged = labels.where(training_fold(F.col(key), buckets, held_out) & F.col(label).isNotNull())
    chosen = judged.groupBy(key).agg(F.max(label).cast("int").alias("__toxic")).orderBy(F.xxhash64(key), key).limit(sample_rows)
    sample = df.where(F.col(text).isNotNull()).join(F.broadcast(chosen), key).select("__toxic", text)
    shared = df.sparkSession.sparkContext.broadcast(decoder)

    def run(batches):
        reader = Reader(shared.value)
        known = _Pieces(lambda piece: tuple(f for w in reader.words(piece) for f in features(w)))
        for batch in small(batches):
            toxic, texts = (c.to_pylist() for c in batch.columns)
            if len(known) > 100_000:
                known.clear()
            for y, t in zip(toxic, texts, strict=True):
                own: dict[str, int] = {}
                pieces, before = t.split(), ""
                for p in [*pieces, *reader.spaced(t, set(pieces))]:
                    for f in known[p]:
                        if f not in own:
                            own[f] = crc32(before.encode())
                    before = p
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(own), pa.int32()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], names=["toxic", "feature", "place"])

    ensure_on_workers(df.sparkSession)
    found = materialize(sample.mapInArrow(run, "toxic int, feature string, place bigint"))
    counted = found.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") >= F.greatest(F.lit(LEAST_ROWS), ROWS_FOR_CLEAN * F.col("c")))
    sound = materialize(counted)
    places = found.where("toxic = 1").join(sound, "feature", "left_semi").groupBy("feature", "place").count().groupBy("feature").agg(F.count("*").alias("places"))
    rows = sound.join(places, "feature").where(F.col("places") >= F.greatest(F.lit(LEAST_ROWS), ROWS_FOR_CLEAN * F.col("c")))
    return ToxicModel(decoder, {r.feature: (r.places + 1) / (r.places + r.c + PRIOR) for r in rows.collect()}, BASE)


def score_toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = 3, held_out: int = 1, limit: float = 0.7) -> DataFrame:
    """(key, held_out, score, predicted) of every row; predicted is 1 from `limit` on.

    Learns from labels whose key's crc32 leaves another remainder than held_out. Null texts score like empty ones:
    BASE, the score of texts in which nothing points to toxicity. Repeated labels of a key count
    once, as toxic if any is. A null key counts as not held out.
    """
    model = train(df, labels, text, key, buckets=buckets, held_out=held_out)
    return apply_model(df, model, text, key, limit).withColumn("held_out", F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % buckets == held_out, F.lit(False))).select(key, "held_out", "score", "predicted")


def apply_model(df: DataFrame, model: ToxicModel, text: str = "text", key: str = "doc_id", limit: float = 0.7) -> DataFrame:
    """(key, score, predicted) of every row, each by its own text: repeated rows and null keys are scored too, a null text
    like an empty one, an empty table gives an empty one. Other columns are left behind, so their names don't matter."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    ensure_on_workers(df.sparkSession)

    def run(batches):
        m = shared.value
        for batch in small(batches):
            scores = np.array(m.scores([t or "" for t in batch.column(1).to_pylist()]), np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= limit).astype(np.int32))], names=[key, "score", "predicted"])

    return df.select(key, F.col(text).alias("__text")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, score double, predicted int")


def drop_toxic(df: DataFrame, model: ToxicModel, text: str = "text", limit: float = 0.7) -> DataFrame:
    """The rows of df that score below limit, with all their columns as they are; no shuffle.

    Rows are judged by their text alone: repeated rows stay or go together, null keys don't matter, a null text is judged
    like an empty one, a score of just the limit goes. An empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    ensure_on_workers(df.sparkSession)

    def run(batches):
        for batch in small(batches):
            scores = shared.value.scores([t or "" for t in batch.column(text).to_pylist()])
            yield batch.filter(pa.array([s < limit for s in scores], pa.bool_()))

    return df.mapInArrow(run, df.schema)
