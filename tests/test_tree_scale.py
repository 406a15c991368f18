"""What the walks of large forests move and hold, and their results on odd rows."""

import re

import pytest

from grovespark.operators import tree
from grovespark.queries import graph_stats, leaves

SCHEMA = "id string, parent_id string, name string, node_type string"
ROWS = [("b", None, "B", "domain"), ("b", None, "again", "domain"), ("a", None, "A", "domain"), ("a/x", "a", "X", "task"), ("a/x/1", "a/x", "one", "atomic"), ("a/x/1", "a/x", "copy", "atomic"), ("a/x/1/s", "gone", "astray", "atomic"), (None, "a/x", "none", "atomic"), ("", None, "empty", "task"), ("a//q", "a/", "gap", "task")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ancestors_without_splitting_each_step(odd):
    got = sorted(tuple(r) for r in tree.path_ancestors(odd).collect())
    want = sorted((i, "/".join(p[:-k]), k) for i, *_ in ROWS if i is not None for p in [i.split("/")] for k in range(1, len(p)))
    assert got == want
    assert "lambda" not in plan(tree.path_ancestors(odd))


def test_descendants_neither_lost_nor_doubled(odd):
    ids = lambda roots: sorted(r.id for r in tree.descendants(odd, odd.where(roots)).collect())
    assert ids("id = 'a'") == ["a//q", "a/x", "a/x/1", "a/x/1", "a/x/1/s"]
    assert ids("id in ('a', 'a/x', 'a/x/1')") == ["a//q", "a/x", "a/x/1", "a/x/1", "a/x/1/s"]
    # the nodes themselves are neither grouped nor dealt out
    assert not re.search(r"^Aggregate", plan(tree.descendants(odd, odd.where("id = 'a'"))))


@pytest.mark.parametrize("few", [0, 50_000])
def test_descendants_of_many_roots(odd, monkeypatch, few):
    monkeypatch.setattr(tree, "FEW", few)
    assert sorted(r.id for r in tree.descendants(odd, odd.where("id in ('a', 'a/x', 'b')")).collect()) == ["a//q", "a/x", "a/x/1", "a/x/1", "a/x/1/s"]


def test_dfs_order_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(tree, "RANGE", 3)
    ids = ["a", "a/b", "a/b/c", "a\x00", "a\x00/b", "a\x01", "a\x01\x01", "a\x00\x00", "a\x01/b", "a b/c", "a-b", "a/é", "a/z", "", "/"]
    got = {r.id: r.position for r in tree.dfs_order(spark.createDataFrame([(i,) for i in ids], "id string")).collect()}
    assert sorted(got, key=got.get) == sorted(ids, key=lambda i: [s.encode() for s in i.split("/")]) and sorted(got.values()) == list(range(len(ids)))


def test_leaves_deeper_than_all_parents_are_not_moved(odd):
    want = sorted((str(i), t) for i, _, _, t in ROWS if i is None or i not in {p for _, p, _, _ in ROWS})
    assert sorted((str(r.id), r.node_type) for r in leaves(odd).collect()) == want
    assert "substring_index" in plan(leaves(odd))


def test_graph_stats_moves_no_sure_leaves(odd):
    assert graph_stats(odd).first().n_leaves == sum(i is None or i not in {p for _, p, _, _ in ROWS} for i, *_ in ROWS)
    assert "substring_index" in plan(graph_stats(odd))
    none = odd.where("parent_id is null")
    assert graph_stats(none).first().n_leaves == none.count()


def test_lists_of_children_move_no_sure_leaves(odd):
    got = tree.rebuild_children(odd)
    assert "substring_index" in plan(got)
    lists = sorted((str(r.id), r["name"], len(r.children_ids)) for r in got.collect())
    assert lists == sorted((str(i), n, sum(p == i for _, p, _, _ in ROWS) if i is not None else 0) for i, _, n, _ in ROWS)


def test_lines_are_dealt_out_by_order_once(spark, sf):
    from grovespark.plans.forest import project

    text = project(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L?, l_linenumber", text)
