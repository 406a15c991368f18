"""Walks along parent_id with ids that say nothing, and ranks in groups that hold most rows."""

import random

import pytest
from pyspark.sql import functions as F

from grovespark.operators import chains, ordering

NODE = "id string, parent_id string, name string, node_type string, place int"


def deep_forest(depth=64, seed=3):
    """A chain of 64 levels with branches, a root with most of all nodes as children, a lone root and a lost child."""
    rng, rows = random.Random(seed), []
    name = lambda: f"{rng.getrandbits(60):x}"
    chain = [name() for _ in range(depth)]
    for i, c in enumerate(chain):
        rows.append((c, chain[i - 1] if i else None, f"n{i}", "task", rng.randrange(9)))
        rows += [(name(), c, f"b{i}", "atomic", rng.randrange(9)) for _ in range(rng.randrange(4))]
    wide = name()
    rows += [(wide, None, "wide", "domain", 4)] + [(name(), wide, f"w{i}", "task", i % 7) for i in range(300)]
    rows += [(name(), None, "lone", "domain", 1), (name(), "not there", "lost", "task", 2)]
    rng.shuffle(rows)
    return rows


def walked(rows):
    ids = {r[0] for r in rows}
    kids = {}
    for r in rows:
        kids.setdefault(r[1] if r[1] in ids else None, []).append(r)
    out, sizes = [], {}

    def walk(r, path):
        out.append((r[0], path[0][0] if path else r[0], len(path), [p[0] for p in path] + [r[0]]))
        sizes[r[0]] = 1
        for k in sorted(kids.get(r[0], []), key=lambda k: (k[4], k[0])):
            walk(k, [*path, r])
            sizes[r[0]] += sizes[k[0]]

    for r in sorted(kids[None], key=lambda k: (k[4], k[0])):
        walk(r, [])
    return out, sizes, kids


@pytest.fixture(scope="module")
def rows():
    return deep_forest()


@pytest.fixture(scope="module")
def forest(spark, rows):
    return spark.createDataFrame(rows, NODE).repartition(4)


def test_depth_root_and_size(forest, rows):
    want, sizes, _ = walked(rows)
    got = chains.chains(forest)
    assert {(r.id, r.root, r.depth, r["size"]) for r in got.measures.collect()} == {(i, root, d, sizes[i]) for i, root, d, _ in want}
    assert max(d for _, _, d, _ in want) == 64 and len(got.jumps) == 7


def test_ancestors_and_descendants(spark, forest, rows):
    want, _, _ = walked(rows)
    walk = chains.chains(forest)
    assert {tuple(r) for r in chains.chain_ancestors(walk).collect()} == {(i, a, len(p) - 1 - k) for i, _, _, p in want for k, a in enumerate(p[:-1])}
    top = next(p[0] for _, _, d, p in want if d == 64)
    below = {r.id for r in chains.descendants_of(spark.createDataFrame([(top,)], "id string"), walk).collect()}
    assert below == {i for i, root, d, _ in want if root == top and d}


def test_preorder_paths_and_text(forest, rows):
    want, sizes, kids = walked(rows)
    assert {(r.id, r.position, r.depth, r["size"]) for r in chains.preorder(forest, ["place"]).collect()} == {(i, k, d, sizes[i]) for k, (i, _, d, _) in enumerate(want)}
    place = {k[0]: j for group in kids.values() for j, k in enumerate(sorted(group, key=lambda k: (k[4], k[0])))}
    last = {sorted(group, key=lambda k: (k[4], k[0]))[-1][0] for group in kids.values()}
    names = {r[0]: (r[2], r[3]) for r in rows}
    got = {r.id: r for r in chains.chain_paths(forest, ["place"]).collect()}
    assert all(got[i].path == p and got[i].names == [names[a][0] for a in p] and got[i].places == [place[a] for a in p] for i, _, _, p in want)
    lines = [r.line for r in chains.ordered_tree_lines(forest, ["place"], 5).orderBy("position").collect()]
    bar = lambda a, end: ("    ", "└── ")[end] if a in last else ("│   ", "├── ")[end]
    assert lines == ["".join(bar(a, False) for a in p[:-1]) + bar(i, True) + f"{names[i][0]} [{names[i][1]}]" for i, _, d, p in want if d <= 5]


def test_rings_and_empty_forests(spark):
    ring = [(str(i), str((i + 1) % 8), "x", "task", 0) for i in range(8)] + [("r", None, "r", "task", 0)]
    with pytest.raises(ValueError, match="ring"):
        chains.chains(spark.createDataFrame(ring, NODE))
    empty = spark.createDataFrame([], NODE)
    assert chains.preorder(empty, ["place"]).count() == 0 and chains.chain_paths(empty, ["place"]).count() == 0


def test_ranks_of_a_group_that_lies_in_many_ranges(spark):
    df = spark.createDataFrame([("a", i, i % 5) for i in range(500)] + [("b", 1, 7), (None, 2, 3), (None, 1, 4)], "g string, o int, v int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.o): (r.pos, r.n, r.before) for r in ordering.ranked(df, F.col("g"), [F.col("o").desc()], "v").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[("b", 1)] == (0, 1, 0) and got[(None, 2)] == (0, 2, 0) and got[(None, 1)] == (1, 2, 3)
    assert all(got[("a", i)] == (499 - i, 500, sum(j % 5 for j in range(i + 1, 500))) for i in range(500))


def test_contraction_alone_gives_what_doubling_gives(spark, forest, rows):
    want, sizes, _ = walked(rows)
    edges = chains.edges_of(forest)
    add = lambda a, b: a + b
    got = chains.folded(edges, F.lit(1), lambda w: F.lit(0), add, sizes=True, few=40)
    assert {(r.id, r.root, r.total, r["size"]) for r in got.collect()} == {(i, root, d, sizes[i]) for i, root, d, _ in want}
    lists = chains.folded(edges, F.array("up"), lambda w: F.slice(w, 1, 0), lambda a, b: F.concat(b, a), few=40)
    assert {r.id: r.total for r in lists.collect()} == {i: p[-2::-1] for i, _, _, p in want}
    ring = spark.createDataFrame([(str(i), str((i + 1) % 8), "x", "task", 0) for i in range(8)], NODE)
    with pytest.raises(ValueError, match="ring"):
        chains.folded(chains.edges_of(ring), F.lit(1), lambda w: F.lit(0), add, few=1)


def written_by(f):
    """Rows of each table that is written while f runs."""
    found, plain = [], chains.materialize

    def watched(df, *more):
        out = plain(df, *more)
        found.append(out.count())
        return out

    chains.materialize = watched
    try:
        f()
    finally:
        chains.materialize = plain
    return found


def test_turns_write_less_than_a_table_for_each_doubling(spark):
    deep = spark.range(4000).select("id", F.when(F.col("id") > 2, F.col("id") - 1 - F.col("id") % 3).alias("parent_id"))
    many = written_by(lambda: chains.folded(chains.edges_of(deep), F.lit(1), lambda w: F.lit(0), lambda a, b: a + b, few=400))
    assert sum(many) < 10 * 4000  # doubling writes 11 times all rows here, and once more for each doubled depth


def test_ancestors_of_leaves_are_not_gathered_by_turns(spark):
    wide = spark.range(2000).select("id", F.when(F.col("id") > 0, F.lit(0).cast("long")).alias("parent_id"))
    sums = written_by(lambda: chains.chain_ancestors(chains.Chains(None, chains.edges_of(wide))).count())
    assert sum(sums) < 2100


def moved_by(f, monkeypatch):
    """Rows of all tables that are written while f runs, by chains and by ordering."""
    found = []
    for module in (chains, ordering):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, plain=plain: (out := plain(df), found.append(out.count()))[0])
    f()
    return sum(found)


def bushy(spark):
    """A root, 40 nodes below it, and 50 leaves below each of these."""
    rows = [("root", None, "r", "domain", 0)] + [(f"a{i}", "root", f"a{i}", "task", i % 3) for i in range(40)]
    return spark.createDataFrame(rows + [(f"b{i}", f"a{i % 40}", f"b{i}", "atomic", i % 7) for i in range(2000)], NODE).repartition(4)


def test_preorder_writes_leaves_once(spark, monkeypatch):
    forest = bushy(spark)
    assert moved_by(lambda: chains.preorder(forest, ["place"]).count(), monkeypatch) < 2041 + 1000


def test_paths_write_leaves_once(spark, monkeypatch):
    forest = bushy(spark)
    assert moved_by(lambda: chains.chain_paths(forest, ["place"]).count(), monkeypatch) < 2041 + 1000


def test_text_writes_no_leaves_below_it(spark, monkeypatch):
    forest = bushy(spark)
    assert moved_by(lambda: chains.ordered_tree_lines(forest, ["place"], 1).count(), monkeypatch) < 1000


def hexed(rows):
    """The same rows under ids of 32 hexadecimal digits, in no order."""
    import hashlib

    short = lambda i: i and hashlib.md5(i.encode()).hexdigest()
    return [(short(i), short(p), *more) for i, p, *more in rows]


def test_places_across_spans_lost_children_and_hexadecimal_ids(spark, rows, monkeypatch):
    monkeypatch.setattr(chains, "_SPAN", 3)  # sibling groups reach over many spans of 8 places
    own = hexed(rows)
    forest = spark.createDataFrame(own, NODE).repartition(4)
    want, sizes, kids = walked(own)
    assert {(r.id, r.position, r.depth, r["size"]) for r in chains.preorder(forest, ["place"]).collect()} == {(i, k, d, sizes[i]) for k, (i, _, d, _) in enumerate(want)}
    place = {k[0]: j for group in kids.values() for j, k in enumerate(sorted(group, key=lambda k: (k[4], k[0])))}
    got = {r.id: r for r in chains.chain_paths(forest, ["place"]).collect()}
    assert len(got) == len(want)
    assert all(got[i].path == p and got[i].root == root and got[i].depth == d and got[i].places == [place[a] for a in p] for i, root, d, p in want)


def test_repeated_and_null_ids_give_what_joins_of_ids_give(spark):
    bag = lambda df: sorted(map(str, df.collect()))
    twice = spark.createDataFrame([("a", None, "a", "x", 0), ("b", "a", "b", "x", 1), ("b", "a", "b", "x", 1), ("c", "b", "c", "x", 2), ("d", "a", "d", "x", 0)], NODE)
    assert bag(chains.preorder(twice, ["place"])) == bag(chains._preorder_by_ids(twice, ["place"], "id", "parent_id", None))
    null = spark.createDataFrame([("a", None, "a", "x", 0), (None, "a", "b", "x", 1), ("c", "a", "c", "x", 2), ("d", "c", "d", "x", 0), (None, None, "e", "x", 0), ("f", "none", "f", "x", None)], NODE)
    assert bag(chains.preorder(null, ["place"])) == bag(chains._preorder_by_ids(null, ["place"], "id", "parent_id", None))
    assert bag(chains.chain_paths(null, ["place"])) == bag(chains._paths_by_ids(null, ["place"], "id", "parent_id", "name"))


def test_only_columns_of_lower_case_hexadecimal_are_shortened(spark):
    def types(*ids):
        df, back = chains._shortened(spark.createDataFrame([(i, None) for i in ids], "id string, parent_id string"), "id", "parent_id")
        assert {r[0] for r in df.select(back(F.col("id"))).collect()} == set(ids)
        return df.schema["id"].dataType.simpleString()

    assert types("0aff", "", "10", None) == "binary"
    assert types("0aff", "0A") == types("0af") == types("0a\n") == types("0a", "x") == "string"


def test_settled_leaves_the_setting_as_it_was(spark):
    from grovespark import scratch

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    assert scratch.settled(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    assert spark.conf.get(name, None) == was
