import json
import re

import pytest
from pyspark.sql import functions as F

from grovespark.operators import tree
from grovespark.sources import nodes_io

ROWS = [("b", None, "B", "domain"), ("a", None, "A", "domain"), ("a/x", "a", "X", "task"), ("a/x/2", "a/x", "two", "subtask"), ("a/x/10", "a/x", "ten", "subtask"), ("a/x/10/z", "a/x/10", "zed", "atomic"), ("a-b", None, "AB", "domain"), ("a-b/q", "a-b", 'Q"uote', "task")]


@pytest.fixture(scope="module")
def forest(spark):
    return spark.createDataFrame(ROWS, "id string, parent_id string, name string, node_type string")


def walk(ids):
    """Pre-order over path ids, siblings by segment."""
    return sorted(ids, key=lambda i: i.split("/"))


def test_orders(forest):
    got = {r.id: r.position for r in tree.dfs_order(forest, stem=2).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == walk(r[0] for r in ROWS) and sorted(got.values()) == list(range(len(ROWS)))
    assert [r.id for r in tree.bfs_order(forest, 4).collect()] == ["a", "a-b", "b", "a-b/q"]


def test_text_and_nested(forest):
    lines = [r.line for r in tree.tree_lines(forest, 3).orderBy("path").collect()]
    assert lines == ["├── A [domain]", "│   └── X [task]", "│       ├── ten [subtask]", "│       │   └── zed [atomic]", "│       └── two [subtask]", "├── AB [domain]", '│   └── Q"uote [task]', "└── B [domain]"]
    trees = {r.id: json.loads(r.json) for r in tree.nested_json(forest, 0, 3).collect()}
    assert set(trees) == {"a", "b", "a-b"} and trees["b"]["children"] == []
    assert [c["id"] for c in trees["a"]["children"][0]["children"]] == ["a/x/10", "a/x/2"] and trees["a-b"]["children"][0]["name"] == 'Q"uote'


@pytest.mark.parametrize("by", ["path", "parent"])
def test_descendants(forest, by):
    assert {r.id for r in tree.descendants(forest, forest.where("id = 'a'"), by=by).collect()} == {"a/x", "a/x/2", "a/x/10", "a/x/10/z"}
    assert tree.descendants(forest, forest.where("id = 'zz'"), by=by).count() == 0


def test_ring_of_parents_is_an_error(spark):
    ring = spark.createDataFrame([("p", "q"), ("q", "p")], "id string, parent_id string")
    with pytest.raises(ValueError, match="ring"):
        tree.descendants(ring, ring.where("id = 'p'"), by="parent", max_depth=5)


def test_prune_repairs_references(forest):
    bad = F.col("name") == "ten"
    kept = {r.id: r.children_ids for r in tree.prune(forest, bad).collect()}
    assert "a/x/10/z" not in kept and kept["a/x"] == ["a/x/2"]
    assert "a/x/10/z" in {r.id for r in tree.prune(forest, bad, cascade="none").collect()}
    assert {r.id for r in tree.prune(tree.rebuild_children(forest), bad, cascade="children", dry_run=True).collect()} == {"a/x/10", "a/x/10/z"}


def test_fix_depth_empties_lists(forest):
    rows = {r.id: r for r in tree.fix_depth(forest, 2).collect()}
    assert rows["a/x/10"].node_type == "atomic" and rows["a/x/10"].children_ids == [] and "a/x/10/z" not in rows


def test_upsert_rejects_children_of_rejected_parents(spark, forest):
    changes = spark.createDataFrame([("z/y", "z", "Y", "task", 1), ("z/y/x", "z/y", "X", "subtask", 2), ("a/n", "a", "old", "task", 1), ("a/n", "a", "new", "task", 3), ("a/n/m", "a/n", "M", "subtask", 4), ("c", None, "C", "domain", 5)], "id string, parent_id string, name string, node_type string, ordinal int")
    out, rejected = nodes_io.upsert_nodes(tree.rebuild_children(forest), changes, "ordinal")
    rows = {r.id: r for r in out.collect()}
    assert {r.id for r in rejected.collect()} == {"z/y", "z/y/x"}
    assert rows["a/n"].name == "new" and rows["a"].children_ids == ["a/n", "a/x"] and rows["a/n"].children_ids == ["a/n/m"] and "c" in rows


def test_exports(spark, forest, tmp_path):
    nodes_io.export_flat(forest, str(tmp_path / "flat"))
    assert spark.read.json(str(tmp_path / "flat")).count() == len(ROWS)
    nodes_io.export_nested(forest, str(tmp_path / "nested"), 0, 3)
    assert spark.read.json(str(tmp_path / "nested")).count() == 3
    assert {r.id: len(r.children_ids) for r in nodes_io.light_rows(forest).collect()}["a/x"] == 2
    nodes_io.export_tiered(forest.withColumn("tier", F.col("node_type")), str(tmp_path / "tiers"))
    assert spark.read.json(str(tmp_path / "tiers")).where("tier = 'domain'").count() == 3


def test_breadcrumbs_gather_trails_of_parents_alone(spark, forest):
    rows = [*ROWS, ("a/x/10/z/lost/deep", "a/x/10/z/lost", "far", "atomic"), ("b/n", "b", None, "task"), ("b/n/m", "b/n", "M", "task")]
    got = {r.id: r.breadcrumb for r in tree.breadcrumb(spark.createDataFrame(rows, forest.schema)).collect()}
    assert got["a/x/10/z/lost/deep"] == "A > X > ten > zed > far" and got["b/n"] == "B" and got["b/n/m"] == "B > M" and got["a-b"] == "AB" and len(got) == len(rows)
    # leaves take no part in the spreading of paths: it reads distinct parents
    plan = tree.breadcrumb(forest)._jdf.queryExecution().optimizedPlan().toString()
    under = plan[plan.index("Generate"):]
    assert "Aggregate" in under


def test_forest_meets_orders_last(spark, sf):
    from grovespark.plans.forest import project

    plan = project(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    first = lambda on: re.search(rf"Join Inner, \([^\n]*{on}#", plan).start()
    assert first("l_orderkey") < first("p_partkey")
