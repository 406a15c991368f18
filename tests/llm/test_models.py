"""Character models, decoding and language against brute force; rejection and recall on the given tables."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grovespark.llm import charlm, language, toxicity

RUNS = re.compile(r"[^\W\d_]+").findall
FOREIGN = {
    -1: "Быстрая коричневая лиса перепрыгивает через ленивую собаку, а потом возвращается домой к своим детям и долго спит.",
    -2: "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita.",
    -3: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są obdarzeni rozumem i sumieniem.",
    -4: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki ja omatunto.",
    -5: "xqzj vkwpf qqhxz jjkvw zzxqp wvkqj hfxzq pqwjv xkzqj vwqfx jzhqk wpxvq kqzjx fvwqz",
}


class PlainKneserNey:
    """The textbook recursion over dictionaries."""

    def __init__(self, counts: Counter, order: int, alphabet: int):
        self.levels, self.alphabet = {order: counts}, alphabet
        for n in range(order, 1, -1):
            self.levels[n - 1] = Counter(g[1:] for g in self.levels[n])
        self.total, self.kinds = defaultdict(int), defaultdict(int)
        for level in self.levels.values():
            for g, c in level.items():
                self.total[len(g), g[:-1]] += c
                self.kinds[len(g), g[:-1]] += 1

    def prob(self, s: str) -> float:
        if not s:
            return 1 / self.alphabet
        context, lower = (len(s), s[:-1]), self.prob(s[1:])
        if context not in self.total:
            return lower
        own = max(self.levels[len(s)][s] - charlm.DISCOUNT, 0)
        return (own + charlm.DISCOUNT * self.kinds[context] * lower) / self.total[context]

    def word(self, word: str, order: int) -> float:
        s = charlm.padded(word, order)
        return sum(math.log(self.prob(s[i : i + order])) for i in range(len(s) - order + 1))


def grams(words, order):
    return Counter(s[i : i + order] for w in words for s in [charlm.padded(w, order)] for i in range(len(s) - order + 1))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_log_probabilities_equal_the_plain_recursion(order):
    counts = grams("the theft of then three other others bathe a é 漢字 aa aaa".split(), order)
    model = charlm.KneserNey(list(counts), np.array(list(counts.values())), order, 30)
    plain = PlainKneserNey(counts, order, 30)
    words = ["the", "there", "x", "漢", "zzz", "othe", "aaaa", "é"]
    got, sizes = charlm.score_words([model], words, order)
    assert np.allclose(got[:, 0], [plain.word(w, order) for w in words]) and sizes.tolist() == [len(w) + 1 for w in words]


def test_predicted_languages_equal_the_plain_models(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    counts = defaultdict(Counter)
    for r in rows:
        if r.lang is not None and r.text is not None and not fold[r.doc_id]:
            counts[r.lang].update(grams(RUNS(r.text.lower()), language.ORDER))
    alphabet = 2 + len({c for own in counts.values() for g in own for c in g})
    models = {lang: PlainKneserNey(own, language.ORDER, alphabet) for lang, own in sorted(counts.items())}
    known = {}
    for r in language.predict_language(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        known[r.doc_id] = r
    for r in rows:
        words, got = RUNS((r.text or "").lower()), known[r.doc_id]
        assert got.held_out == fold[r.doc_id]
        if not words:
            assert got.lang_pred == "und" and got.score == 0
            continue
        repeats, letters = Counter(words), sum(len(w) + 1 for w in words)
        h = {lang: -sum(n * m.word(w, language.ORDER) for w, n in repeats.items()) / letters for lang, m in models.items()}
        best = min(h, key=h.get)
        share = 1 / sum(math.exp(-language.SHARPNESS * (x - h[best])) for x in h.values())
        assert got.lang_pred == best and math.isclose(got.score, share, rel_tol=1e-6)


def with_foreign(spark, docs):
    rows = [(k, t, None, "web", len(t)) for k, t in FOREIGN.items()]
    return docs.unionByName(spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema))


def test_rejection_on_a_real_table(spark):
    """Foreign languages and gibberish are rejected; of the held-out documents with letters none is."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = language.predict_language(with_foreign(spark, docs))
    assert {r.doc_id for r in out.where("rejected and doc_id < 0").collect()} == set(FOREIGN)
    held = out.where("held_out and doc_id >= 0 and lang_pred <> 'und'").agg(F.count("*").alias("n"), F.count_if("rejected").alias("wrong")).first()
    assert held.n > 900 and held.wrong == 0


def test_language_stage_drops_foreign_texts_alone(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = corpus_pipeline.drop_unknown_language(spark, with_foreign(spark, docs), d)
    assert kept.columns == docs.columns
    want = docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in want)


def paths(decoder, token):
    """(cost, word) of every way through the lattice of a token, one character after another."""
    options = []
    for i, c in enumerate(token):
        own = [(c, 0.0)] if c.isalpha() else []
        own += [(x, toxicity.SWAP_COST if len(toxicity.LEET[c]) < 3 else toxicity.VOWEL_COST) for x in toxicity.LEET.get(c, "")]
        if i and c == token[i - 1]:
            own.append(("", toxicity.REPEAT_COST))
        elif not c.isalpha():
            own.append(("", toxicity.SEPARATOR_COST if c in toxicity.SEPARATORS else toxicity.DIGIT_COST if c.isdigit() else toxicity.SIGN_COST))
        options.append(own)
    for way in itertools.product(*options):
        word = "".join(x for x, _ in way)
        said, cost = " " * (toxicity.ORDER - 1), sum(c for _, c in way)
        for letter in word + " ":
            cost -= decoder._log_prob(said[-2:], letter)
            said += letter
        yield cost, word


def test_decoding_is_the_cheapest_way_through_the_lattice():
    counts = grams(("idiot stupid the then water later little silly moron loser hello all ball " * 3 + "x").split(), toxicity.ORDER)
    decoder = toxicity.Decoder(charlm.KneserNey(list(counts), np.array(list(counts.values())), toxicity.ORDER, 40))
    for token in ("1d10t", "st*p1d", "i.d.i.o.t", "lllo5er", "m0r0n", "h3ll0", "s!lly", "7h3n", "w@t3r", "b@ll", "!!", "x#", "aallll", "1-1", "v|v"):
        ways = list(paths(decoder, token))
        word = decoder.decode(token)
        assert math.isclose(min(c for c, w in ways if w == word), min(c for c, _ in ways), abs_tol=1e-9), token
    assert [decoder.decode(t) for t in ("1d10t", "i.d.i.o.t", "m0r0n", "st*p1d")] == ["idiot", "idiot", "moron", "stupid"]


def test_recall_and_ranking_on_held_out_labels(spark):
    """sf0.1: 0.75 of the toxic rows are flagged and 0.9 hold something learnt; of the clean rows hardly any, and 1 in 100."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.002 * len(clean)
    noticed = lambda some: sum(r.score > toxicity.BASE + 1e-9 for r in some)
    assert noticed(toxic) >= 0.9 * len(toxic) and noticed(clean) <= 0.01 * len(clean)


def test_limits_of_languages_come_from_all_training_rows(spark):
    from grovespark.llm import language

    rows = [(i, " ".join(f"w{'abcdefghij'[(i * k) % 10]}{'klmno'[(i + k) % 5]}rd" for k in range(1, 9)), "en") for i in range(2600)] + [(2600, "zqxj vvkq jjxz qqzk xxvj kkqz zzjx qxkz", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    models = language.train(df, F.lit(True))
    h, size = models.entropies([t for _, t, _ in rows])
    h = h[size >= 20, 0]
    assert len(h) == len(rows) and abs(models.limits[0] - max(h.mean() + 12 * h.std(ddof=1), h.max() + 1)) < 1e-9
    found = language.predict_language(df)
    assert found.count() == len(rows) and found.where("rejected and not held_out").count() == 0
