"""Pivot index, vector codes and prefix trie against brute force, and on rough tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovespark.llm import pivots, prefix_trie, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int, n long, vh string"
TURNS = "conv_id long, turn long, role string, text string, d int, a string"


def brute_links(rows, threshold=0.93):
    """{position: (n_links, component)} of rows (id, vector, label)."""
    fit = [i for i, (k, v, l) in enumerate(rows) if k is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(rows[i][1]) for i in fit), default=0)
    x = np.array([list(rows[i][1]) + [0.0] * (width - len(rows[i][1])) for i in fit])
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x
    near = {i: [j for b, j in enumerate(fit) if j != i and rows[i][2] == rows[j][2] and x[a] @ x[b] >= threshold] for a, i in enumerate(fit)}
    out = {}
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(near.get(i, [])), min((rows[j][0] for j in seen), key=lambda k: (k is None, k)))
    return out


def planted(seed=5, groups=60, width=32):
    """Random vectors with partners at cosines on both sides of the threshold."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        x = rng.normal(size=width)
        x /= np.linalg.norm(x)
        rows.append((len(rows), x.tolist(), g % 3))
        for c in (0.999, 0.95, 0.932, 0.928, 0.8):
            z = rng.normal(size=width)
            z -= (z @ x) * x
            rows.append((len(rows), (3 * (c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z))).tolist(), g % 3))
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_links_are_those_of_all_pairs(spark, block):
    hot = [(1000 + i, [1.0] * 31 + [1 + i / 300], 1) for i in range(120)]  # near copies that share all lists
    rows = planted() + hot
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = {r.vec_id: r for r in pivots.near_vectors(df, block=block).collect()}
    want = brute_links(rows)
    assert len(got) == len(rows)
    for i, (k, _, _) in enumerate(rows):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (*want[i], want[i][1] == k)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.931 among vectors enough for more pivots than the least number."""
    rng, width, rows = np.random.default_rng(2), 64, []
    for _ in range(3000):
        x, z = rng.normal(size=(2, width))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        rows += [(len(rows), x.tolist(), 0), (len(rows) + 1, (0.931 * x + np.sqrt(1 - 0.931**2) * z / np.linalg.norm(z)).tolist(), 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    found = pivots.near_vectors(df).where("n_links > 0").count() / len(rows)
    assert found > 0.99


def test_rough_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, -0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 0.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (-3, [1e300, 1e299], 1), (11, [1e-300, 0.0], 1), (12, [-0.0, 5.0], 1)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(df).collect()), key=str)
    want = brute_links([(k, [x / 1e150 if x and abs(x) > 1e200 else x for x in v] if k == -3 else v, l) for k, v, l in rows if k != 11])
    expect = [(k, *want[i], k is not None and want[i][1] == k) for i, (k, _, _) in enumerate([r for r in rows if r[0] != 11])]
    # the tiny vector points the way of the first ones: one more link for each of that group, and their links for itself
    group = {1: 1, 2: 1, -3: 1}
    expect = [(k, n + (1 if c == -3 else 0), c, kept) for k, n, c, kept in expect] + [(11, sum(group.values()) + 1, -3, False)]
    assert got == sorted(expect, key=str)


def test_empty_vectors_and_turns(spark):
    vectors, turns = spark.createDataFrame([], VECTORS), spark.createDataFrame([], TURNS)
    assert pivots.near_vectors(vectors).count() == 0
    assert vector_codes.vector_codes(vectors).count() == 0
    assert prefix_trie.prefix_trie(turns).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 0, "")], TURNS)).count() == 0


def brute_codes(rows, entries, parts=4, rounds=4):
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    whole = [[int(np.floor(np.float64(x) * 1024)) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], whole[i]))[:entries]
    books = [[whole[i][p * width : (p + 1) * width] for i in first] for p in range(parts)]
    of = lambda v, p: v[p * width : (p + 1) * width]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(of(v, p), e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        codes = [[near(v, p)[1] for p in range(parts)] for v in whole]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [of(v, p) for v, c in zip(whole, codes) if c[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    last = [[near(v, p) for p in range(parts)] for v in whole]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return ["".join(f"{k:02x}" for _, k in r) for r in last], [sum(d for d, _ in r) for r in last], sha


@pytest.mark.parametrize("scale,width,entries", [(1.0, 8, 12), (0.003, 10, 256), (1e5, 8, 20)])
def test_codes_are_those_of_plain_rounds(spark, scale, width, entries):
    """Small values make many ties, great ones leave doubles behind; 10 components are filled up to 12."""
    rng = np.random.default_rng(3)
    rows = [(int(k), (rng.normal(size=width) * scale).round(6).tolist(), [None, 1, 2][i % 3]) for i, k in enumerate(rng.permutation(300) - 20)]
    rows += [(5, rows[0][1], 1), (5, rows[1][1][:3], None), (None, rows[2][1], None)]
    odd = [(1, None, 1), (2, [float("nan")] * width, 1), (3, [None] * width, 1), (4, [float("-inf")] * width, 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], VECTORS).repartition(4)
    got = sorted(((str(r.vec_id), r.code, r.error, r.label_error) for r in vector_codes.vector_codes(df, entries).collect()))
    codes, errors, sha = brute_codes(rows, entries)
    sums = defaultdict(int)
    for (_, _, l), e in zip(rows, errors):
        sums[l] += e
    assert got == sorted((str(k), c, e, sums[l]) for (k, _, l), c, e in zip(rows, codes, errors))
    assert {r.codebooks_sha256 for r in vector_codes.vector_codes(df, entries).collect()} == {sha}


def test_moved_entries_alone_are_enough():
    """After any move of entries the shorter search gives what the full one gives, ties included."""
    rng = np.random.default_rng(1)
    for kind in (np.float64, np.int64, object):
        x, old = rng.integers(0, 4, (500, 3)).astype(kind), rng.integers(0, 4, (20, 3)).astype(kind)
        code, error = vector_codes.nearest(x, old)
        new = old.copy()
        new[rng.permutation(20)[:7]] = rng.integers(0, 4, (7, 3)).astype(kind)
        moved = np.array([(a != b).any() for a, b in zip(old, new)])
        short, full = vector_codes.nearest(x, new, code, error, moved), vector_codes.nearest(x, new)
        assert (short[0] == full[0]).all() and (short[1] == full[1]).all()


def test_vectors_without_components_and_too_many_entries(spark):
    df = spark.createDataFrame([(1, [], 1, 1, "x"), (2, [], None, 1, "x")], VECTORS)
    assert [(r.code, r.error) for r in vector_codes.vector_codes(df).collect()] == [("00000000", 0)] * 2
    with pytest.raises(ValueError):
        vector_codes.vector_codes(df, entries=257)


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1].encode()) if path else 0
    ends = lambda p: ",".join(str(c) for c in sorted(nodes[p]) if len(built[c]) == len(p))
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in nodes.items())


def trie_of(spark, rows, **how):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], TURNS).repartition(5)
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(df, **how).collect())


def test_trie_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(c), int(t), ["user", "assistant"][t % 2], f"text {rng.integers(2 + t)} é") for c in range(0, 400, 3) for t in range(rng.integers(1, 14))]
    rows += [(c, t, "user", "the same" * t) for c in range(1000, 1400) for t in range(3)]  # many members that end in one node
    rows += [(7, None, None, "first"), (7, None, None, "first"), (7, 1, "user", None), (7, 1, None, "tie"), (7, 1, "user", "a tie"), (None, 1, "x", "y"), (2**40, 0, "user", ""), (2**40 + 1, 0, "user", "")]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(10, t, "user", f"turn {t // 2}") for t in range(700)] + [(c, t, "user", f"turn {t // 2}") for c in range(11, 30) for t in range(5)]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], TURNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(tuple(r) for r in prefix_trie.prefix_trie(df).collect()) == brute_trie(rows)
        parts = prefix_trie.ordered_turns(df, "conv_id", "turn", "role", "text", 0).where("conv = 10").select(F.shiftright("seq", 33)).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 4


def test_equal_digests_of_different_turns_are_seen(spark):
    turns = spark.createDataFrame([(1, 1, "user", "a"), (1, 1, "user", "a"), (2, 2, "user", "b")], "d0 long, d1 long, role string, text string")
    assert prefix_trie.same_turns(turns)
    assert not prefix_trie.same_turns(turns.withColumn("d0", F.lit(1)).withColumn("d1", F.lit(1)))
