"""Language identification by interpolated Kneser-Ney character models.

Each language's model is counted over all its training documents; a text goes to the language with the lowest
length-normalised cross-entropy. Texts whose best cross-entropy lies far above what the models give their own
language are rejected; each language's limit is calibrated on all of its own training rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.charlm import LETTERS, KneserNey, alphabet_size, count_ngrams, groups_of, of_group, score_words
from grovespark.llm.pieces import blocks, small, sums
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

ORDER = 4
#: Share of a softmax over cross-entropies that is the score; the scale makes a nat of difference count tenfold.
SHARPNESS = 10.0


class _Words(dict):
    """Word numbers; new words wait in order."""

    def __init__(self):
        self.queue = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.queue.append(key)
        return n


class LanguageModels:
    def __init__(self, counts, order: int = ORDER):
        self.order = order
        self.languages = groups_of(counts)
        alphabet = alphabet_size(counts)
        # one language's n-grams at a time are held as strings
        self.models = [KneserNey(own["ngram"].tolist(), own["n"].to_numpy(), order, alphabet) for own in (of_group(counts, g) for g in self.languages)]
        self.limits = np.full(len(self.languages), np.inf)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text under each language, and its letters and word ends; without letters: 0."""
        state = self.__dict__.setdefault("_state", {})
        if not state or len(state["words"]) > 100_000:
            state.update(words=_Words(), value=np.zeros((0, len(self.models))), size=np.zeros(0, np.int64))
        words, numbers, counts = state["words"], [], []
        for t in texts:
            own = t.lower().split()
            numbers += map(words.__getitem__, own)
            counts.append(len(own))
        if words.queue:
            runs = [LETTERS(w) for w in words.queue]
            per_word = np.array([len(r) for r in runs], np.int64)
            value, size = score_words(self.models, [x for r in runs for x in r], self.order)
            state["value"] = np.vstack([state["value"], np.stack([sums(value[:, j], per_word) for j in range(len(self.models))], axis=1)])
            state["size"] = np.concatenate([state["size"], sums(size, per_word)])
            words.queue = []
        at, counts = np.array(numbers, np.int64), np.array(counts, np.int64)
        size = sums(state["size"][at], counts)
        total = np.stack([sums(state["value"][at, j], counts) for j in range(len(self.models))], axis=1)
        return -total / np.maximum(size, 1)[:, None], size

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_state"}


def training_fold(key: Column, buckets: int, held_out: int) -> Column:
    """True for rows to learn from; false for the held-out remainder and for null keys."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % buckets != held_out, F.lit(False))


def counted(df: DataFrame, learn: Column, text: str, lang: str) -> LanguageModels:
    """Models of every language among the rows to learn from, without limits."""
    return LanguageModels(count_ngrams(df.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()), lang, text, ORDER))


def calibrate(models: LanguageModels, judged: DataFrame, own: str, deviations: float = 12.0) -> None:
    """Sets each language's limit from judged(own, best, entropy, letters): all rows that are of it (own) and taken for it."""
    fits = judged.where((F.col("letters") >= 20) & (F.col("best") == F.col(own)))
    for name, mean, deviation, most in fits.groupBy(own).agg(F.avg("entropy"), F.coalesce(F.stddev("entropy"), F.lit(0.0)), F.max("entropy")).collect():
        models.limits[models.languages.index(name)] = max(mean + deviations * deviation, most + 1.0)


def train(df: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", deviations: float = 12.0) -> LanguageModels:
    """Models of every language among the rows to learn from, each with a limit that all of its rows set."""
    models = counted(df, learn, text, lang)
    if models.languages:
        rows = df.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
        calibrate(models, entropy_table(rows.select(text, lang), models, text, [lang]), lang, deviations)
    return models


def entropy_table(df: DataFrame, models: LanguageModels, text: str, keep: list[str]) -> DataFrame:
    """keep columns with best (language), entropy, score, letters and rejected; no shuffle."""
    ensure_on_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(models)
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        m = shared.value
        for batch in small(batches):
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            best, entropy, score, letters, rejected = [], [], [], [], []
            for lo, hi in blocks(texts):
                if not m.languages:
                    h, size = np.zeros((hi - lo, 1)), np.zeros(hi - lo, np.int64)
                else:
                    h, size = m.entropies(texts[lo:hi])
                i = h.argmin(1)
                low = h.min(1)
                share = 1 / np.exp(-SHARPNESS * (h - low[:, None])).sum(1)
                none = size == 0
                best += [None if n else m.languages[k] for k, n in zip(i.tolist(), none.tolist(), strict=True)]
                entropy += low.tolist()
                score += np.where(none, 0.0, share).tolist()
                letters += size.tolist()
                rejected += (none | (low > (m.limits[i] if m.languages else np.inf))).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(best, pa.string()), pa.array(entropy, pa.float64()), pa.array(score, pa.float64()), pa.array(letters, pa.int64()), pa.array(rejected, pa.bool_())], names=[*keep, "best", "entropy", "score", "letters", "rejected"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{kinds}, best string, entropy double, score double, letters bigint, rejected boolean")


def drop_unknown(df: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """The rows of df whose language is not rejected, with all their columns as they are; no shuffle.

    Rows are judged by their text alone: repeated rows stay or go together, null keys don't matter. Null texts and texts
    without a letter go; with nothing learnt all rows go. An empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    ensure_on_workers(df.sparkSession)

    def run(batches):
        m = shared.value
        for batch in small(batches):
            texts, keep = [t or "" for t in batch.column(text).to_pylist()], []
            for lo, hi in blocks(texts):
                if m.languages:
                    h, size = m.entropies(texts[lo:hi])
                    keep += ((size > 0) & (h.min(1) <= m.limits[h.argmin(1)])).tolist()
                else:
                    keep += [False] * (hi - lo)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def predict_language(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", buckets: int = 4, held_out: int = 2) -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) of every row.

    Learns from rows with text, lang and a key whose crc32 leaves another remainder than held_out. Null texts and
    texts without a letter are `und` with score 0, as is everything if there is nothing to learn from. Ties go to the
    language that sorts first. A null key counts as not held out and is not learnt from.
    """
    learn = training_fold(F.col(key), buckets, held_out)
    models = counted(df, learn, text, lang)
    # every row is judged once; the limits come from the training rows among them
    own = F.when(learn & F.col(text).isNotNull(), F.col(lang).cast("string"))
    found = materialize(entropy_table(df.select(key, text, own.alias("__own")), models, text, [key, "__own"]))
    calibrate(models, found, "__own")
    limit = F.lit(float("inf"))
    if models.languages:
        limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in zip(models.languages, models.limits.tolist(), strict=True) for x in pair]), F.col("best")), limit)
    out = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % buckets == held_out, F.lit(False))
    return found.select(key, out.alias("held_out"), F.coalesce("best", F.lit("und")).alias("lang_pred"), "score", (F.col("rejected") | (F.col("entropy") > limit)).alias("rejected"))
