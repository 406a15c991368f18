import random
from itertools import combinations

from grovespark.llm import simhash


def test_near_dedup_equals_brute_force_on_planted_copies(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    texts = []
    for _ in range(60):
        words = [word() for _ in range(rng.randint(150, 400))]
        texts.append(" ".join(words))
        for share in (0.8, 0.85, 0.9, 0.95, 0.7):
            own = list(words)
            for _ in range(max(1, round(len(words) * (1 - share) / (1 + share) / 5))):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    up = list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    near = 0
    for a, b in combinations(range(len(texts)), 2):
        if a // 6 == b // 6 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
            near += 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near > 150
    assert {r.doc_id for r in simhash.near_dedup(df).collect()} == {root(k) for k in up}
