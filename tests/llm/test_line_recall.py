import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from grovespark.llm import line_dedup


def shingles(line, width=8):
    return {line} if len(line) <= width else {line[i : i + width] for i in range(len(line) - width + 1)}


def near_pairs(lines):
    """All pairs of lines with a Jaccard similarity of 0.8 or more: sets that alike share one of their rarest elements."""
    sets = {x: shingles(x) for x in lines}
    seen = Counter(s for own in sets.values() for s in own)
    index, out = defaultdict(list), []
    for x in sorted(sets, key=lambda x: len(sets[x])):
        n = len(sets[x])
        rare = sorted(sets[x], key=lambda s: (seen[s], s))[: n - math.ceil(0.8 * n - 1e-9) + 1]
        out += [(x, y) for y in {y for s in rare for y in index[s]} if 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])]
        for s in rare:
            index[s].append(x)
    return out


def components(pairs):
    up = {}

    def root(k):
        while up.setdefault(k, k) != k:
            k = up[k]
        return k

    for a, b in pairs:
        up[root(a)] = root(b)
    return {k: root(k) for k in list(up)}


def test_classes_are_those_of_all_near_pairs(spark):
    """On a whole table: nearly every near pair is in one class, and no class joins lines that near pairs don't."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {re.sub(r"[\s\xa0]+", " ", x.lower()).strip(" ") for r in df.collect() for x in (r.text or "").split("\n") if re.search(r"[^\s\xa0]", x)}
    pairs = near_pairs(lines)
    ids = {r.line: r.id for r in spark.createDataFrame([(x,) for x in lines], "line string").select("line", F.xxhash64("line").alias("id")).collect()}
    _, classes = line_dedup.line_classes(df)
    got = {r.id: r["class"] for r in classes.collect()}
    want = components([(ids[a], ids[b]) for a, b in pairs])
    assert len(pairs) > 100
    assert sum(got.get(ids[a]) == got.get(ids[b], -1) for a, b in pairs) >= 0.98 * len(pairs)
    members = defaultdict(set)
    for k, c in got.items():
        members[c].add(want.get(k, k))
    assert all(len(roots) == 1 for roots in members.values())


def test_repeated_rows_count_their_own_lines_and_clashing_names_are_replaced(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    rows = [(1, "one line\nother line", 5), (1, "one line\nother line", 6), (2, "one line", 7), (3, long + "\n" + long, 8), (4, "", 9), (None, None, 1)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines int"))
    assert out.columns == ["doc_id", "text", "n_lines", "n_kept"]
    got = sorted(((r.doc_id, r.n_lines, r.n_kept) for r in out.collect()), key=str)
    assert got == sorted([(1, 2, 2), (1, 2, 2), (2, 1, 0), (3, 2, 1), (4, 0, 0), (None, 0, 0)], key=str)


def found_share(spark, pairs):
    """Share of pairs of lines whose two documents lose one line together."""
    rows = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    left = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("n_kept > 0").count()
    return (len(rows) - left) / len(pairs)


def words(rng, n, letters, first="abcdefghijklmnopqrstuvwxyz"):
    return [rng.choice(first) + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(letters - 1)) for _ in range(n)]


def test_pairs_on_both_sides_of_the_step_between_signatures(spark):
    rng = random.Random(4)
    pairs = []
    for starts, letters in ((6, 22), (8, 17), (9, 16), (7, 19), (5, 31)):
        for _ in range(60):
            line = words(rng, starts, letters)
            pairs.append((" ".join(line), " ".join(line) + "".join(words(rng, 1, 8))))
            pairs.append((" ".join(line), " ".join(line + words(rng, 2, 3))))
    near = [p for p in pairs if len(shingles(p[0]) & shingles(p[1])) >= 0.8 * len(shingles(p[0]) | shingles(p[1]))]
    assert len(near) > 400 and found_share(spark, near) >= 0.98


@pytest.mark.parametrize("first", ["stuvwxyzàéü", "abcdefghijklmnopqr"])
def test_first_letters_make_no_difference(spark, first):
    rng = random.Random(6)
    pairs = []
    for _ in range(400):
        line = words(rng, 16, 6, first)
        k = rng.randrange(16)
        pairs.append((" ".join(line), " ".join(line[:k] + [line[k][:3] + "0" + line[k][4:]] + line[k + 1 :])))
    assert found_share(spark, pairs) >= 0.98
