from pyspark.sql import functions as F

from grovespark.operators import responses as X

CUT = '{"is_atomic": false, "subtasks": [{"name": "Wash cup", "description": "d", "is_atomic": true}, {"name": "Dry'


def test_attach_and_mark(spark):
    parents = spark.createDataFrame([("a", "domain"), ("a/b", "task"), ("a/c", "task"), ("a/d", "task")], "id string, node_type string")
    fenced = 'Here:\n```json\n{"is_atomic": false, "subtasks": [{"name": "Make tea"}, {"name": " "}, {"name": "make  tea"}]}\n```'
    said = spark.createDataFrame([("a", fenced), ("a/b", CUT), ("a/c", '{"is_atomic": true, "subtasks": []}'), ("a/d", "no idea")], "id string, response string")
    made = X.attach_children(parents, said, F.lower("name").startswith("wash"))
    assert {(r.id, r.node_type) for r in made.collect()} == {("a/make_tea", "task"), ("a/b/wash_cup", "atomic")}
    assert {r.id: r.node_type for r in X.mark_atomic(parents, said).collect()} == {"a": "domain", "a/b": "task", "a/c": "atomic", "a/d": "task"}


def test_merge_and_completion(spark):
    nodes = spark.createDataFrame([("a", None, "A"), ("a/x", "a", "Wash cup")], "id string, parent_id string, name string")
    batch = spark.createDataFrame([("a", "wash cup ", 1), ("a", "Dry cup", 2), ("b", "dry cup", 3), ("b", "Wash cup", 4), ("a", "", 5)], "parent_id string, name string, ordinal int")
    assert {r.id for r in X.merge_batch(nodes, batch).collect()} == {"a/dry_cup"}
    assert {r.id for r in X.merge_batch(nodes, batch, "siblings").collect()} == {"a/dry_cup", "b/dry_cup", "b/wash_cup"}
    done = X.attach_completion(nodes, spark.createDataFrame([("a", '{"preconditions": "dry"}')], "id string, response string"))
    assert {(r.id, r.completion and r.completion.preconditions) for r in done.collect()} == {("a", "dry"), ("a/x", None)}
