import random
from collections import defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from grovespark.llm import buckets, line_dedup


def components(nodes, edges):
    up = {k: k for k in nodes}

    def root(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {k: root(k) for k in nodes}


def jaccard(x, y):
    return len(x & y) / len(x | y)


def template_lines(pairs=150):
    """Lines of ten shared words and three own ones, each twice, once with a word more."""
    rng = random.Random(5)
    shared = " ".join(f"common{i}" for i in range(10))
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    out = []
    for _ in range(pairs):
        own = " ".join(word() for _ in range(3))
        out += [f"{shared} {own}", f"{shared} {own} {word()}"]
    return out


def test_template_lines_meet_all_of_their_buckets(spark):
    df = spark.createDataFrame(list(enumerate(template_lines())), "doc_id long, text string")
    seen, classes = line_dedup.line_classes(df)
    lines = line_dedup.line_table(df)
    sets = {r.id: set(r.x) for r in lines.select(F.xxhash64("norm").alias("id"), line_dedup.shingles(line_dedup.body_of(F.col("norm")), 8).alias("x")).collect()}
    met = defaultdict(set)
    for r in line_dedup.signatures(lines).collect():
        for k in r["keys"]:
            met[k].add(r.id)
    near = {p for ids in met.values() for p in combinations(sorted(ids), 2) if jaccard(sets[p[0]], sets[p[1]]) >= 0.8}
    want = components(sets, near)
    got = {r.id: r["class"] for r in classes.collect()}
    assert max(map(len, met.values())) > 50 and len(near) >= 100
    assert {k: got.get(k, k) for k in sets} == want


def test_blocks_give_the_components_of_all_pairs(spark):
    rng = random.Random(2)
    sets = {}
    for g in range(60):
        base = set(rng.sample(range(g * 1000, g * 1000 + 999), 40)) | set(range(10**6, 10**6 + 25))
        for k in range(3):
            sets[g * 3 + k] = (base - set(rng.sample(sorted(base), 4 * k))) | {10**7 + g * 3 + k}
    wide = {k: [x * 0x9E3779B97F4A7C15 % 2**63 for x in v] for k, v in sets.items()}
    table = spark.createDataFrame(list(wide.items()), "id long, body array<long>")
    sketch = {k: sum((min((x ^ m) * m % 2**61 for x in v) & 255) << 8 * i for i, m in enumerate((3, 5, 7, 11, 13, 17, 19))) for k, v in wide.items()}
    keyed = spark.createDataFrame([(c, k, sketch[k], len(sets[k])) for c, ks in ((7, sets), (9, [0]), (11, [4, 8])) for k in ks], "key long, id long, sketch long, n int")
    want = components(sets, [p for p in combinations(sets, 2) if jaccard(sets[p[0]], sets[p[1]]) >= 0.8])
    for block in (16, 512):
        got = {r.node: r.component for r in buckets.bucket_classes(keyed, lambda ids: table.join(ids, "id"), lambda x: x, 0.8, 0.8, block).collect()}
        assert {k: got.get(k, k) for k in sets} == want
    assert buckets.bucket_classes(keyed.limit(0), lambda ids: table.join(ids, "id"), lambda x: x, 0.8, 0.8).count() == 0


def test_lines_that_differ_in_a_tail_or_inside_a_long_word_stay(spark):
    apart = ["report_2024_01.csv", "report_2024_99.csv", "invoice number 8374920", "invoice number 8999999", "x" * 8 + "a" * 40, "x" * 8 + "b" * 40]
    alike = " ".join(f"word{j}of" for j in range(12))
    rows = list(enumerate([*apart, alike, alike + " a"]))
    out = {r.doc_id: r.n_kept for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {k: int(k < 7) for k, _ in rows}
