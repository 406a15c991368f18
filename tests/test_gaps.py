from grovespark.operators import gaps, reports, seeds
from grovespark.sources.nodes_io import COMPLETION

NODE = "id string, parent_id string, name string, node_type string"


def forest(spark):
    rows = [("a", None, "A", "domain"), ("b", None, "B", "domain"), ("e", None, None, "domain")]
    rows += [(f"a/t{i}", "a", f"task {i}", "task") for i in range(5)] + [("a/t0/s", "a/t0", "part", "subtask"), ("b/u", "b", "u", "task"), ("a/t0/s/x", "a/t0/s", "deep", "atomic")]
    rows += [(f"a/t1/s{i}", "a/t1", f"s{i}", "subtask") for i in range(6)]
    return spark.createDataFrame(rows, NODE)


def test_gap_requests_of_three_kinds(spark):
    categories = spark.createDataFrame([("z", "zap"), ("c", "cut, carve"), ("d", "dig")], "category string, phrases string")
    rows = {(r.kind, r.id): r for r in gaps.gap_requests(forest(spark), categories, 1, 4, names=3, lines=4, groups=2).collect()}
    assert set(rows) == {("domain", "a"), ("domain", "b"), ("domain", "e"), ("sparse", "a/t0"), ("missing", None)}
    hints = "\n\nKinds of action:\nc: cut, carve\nd: dig"
    assert rows["domain", "a"].prompt == "Which tasks of the domain A are missing?\nIt has 5:\n  - task 0\n  - task 1\n  - task 2\n  ...\n\nIts tree:\nA\n  task 0\n    part\n  task 1\n..." + hints
    assert rows["domain", "e"].n_children == 0 and rows["domain", "e"].prompt == "Which tasks of the domain  are missing?\nIt has 0:\n\n\nIts tree:\n" + hints
    assert rows["sparse", "a/t0"].prompt == "Which parts of the task task 0 are missing?\nIt has 1:\n  - part" + hints
    assert rows["missing", None].n_children == 3 and "There are 3:\n  - \n  - A\n  - B\n\nThe tree:\nA\n  task 0\n  task 1\n  task 2\n..." in rows["missing", None].prompt


def test_gap_requests_of_nothing(spark):
    none = spark.createDataFrame([], NODE)
    rows = gaps.gap_requests(none, spark.createDataFrame([], "category string, phrases string")).collect()
    assert [(r.id, r.kind, r.n_children) for r in rows] == [(None, "missing", 0)] and rows[0].prompt.startswith("Which domains are missing?\nThere are 0:\n")


def test_templates_are_filled_once(spark):
    rows = spark.createDataFrame([(1, "k", "{id} {x", "v"), (2, "k", None, "v"), (3, "none", "n", "v"), (4, None, "n", "v")], "id int, kind string, name string, __other string")
    templates = spark.createDataFrame([("k", "<{name}|{id}|{what}>{"), ("k", "later")], "kind string, template string")
    out = {r.id: r.prompt for r in gaps.rendered(rows, templates, "kind", ["id", "name"]).collect()}
    assert out == {1: "<{id} {x|1|{what}>{", 2: "<|2|{what}>{", 3: None, 4: None}


def test_savings(spark):
    usage = spark.createDataFrame([("x", "m", True, 1_000_000, 0, 0), ("x", "m", False, 0, 500_000, 0), ("x", "m", None, 0, 500_000, 1_000_000), ("x", "other", True, 9, 9, 9), ("y", None, True, 9, 9, 9)], "who string, model string, cached boolean, tokens_in long, tokens_out long, tokens_thinking long")
    prices = spark.createDataFrame([("m", 1.0, 10.0, 2.0)], "model string, input double, output double, thinking double")
    out = {tuple(r) for r in gaps.cache_savings(usage, prices, ["who"]).collect()}
    assert out == {("x", 4, 2, 12.0, 1.0), ("y", 1, 1, 0.0, 0.0)}
    assert gaps.cache_savings(usage.limit(0), prices, ["who"]).count() == 0


def test_feedback_and_stems(spark):
    rejected = spark.createDataFrame([("Open the Door", "vague"), ("open lids", "vague"), (None, None), ("door", "long")], "name string, reason string")
    assert [tuple(r) for r in gaps.feedback_patterns(rejected, "name", "reason", top=2).collect()] == [("word", "door", 2), ("word", "open", 2), ("reason", "vague", 2), ("reason", "long", 1)]
    phrases = spark.createDataFrame([("cut_a",), ("cut_b",), ("cut_b",), ("cut",), ("dig_a",), (None,)], "p string")
    assert {tuple(r) for r in gaps.stem_members(phrases, "p").collect()} == {("cut", 3, "cut_a"), ("cut", 3, "cut_b"), ("cut", 3, "cut")}


def test_completed_reasonings_and_seeds(spark):
    nodes = spark.createDataFrame([("a", None, "domain", None, ["s"], ("", None, "i")), ("a/b", "a", "task", "d", ["s"], ("p", None, None)), ("a/c", "a", "task", "", ["s"], None)], f"id string, parent_id string, node_type string, description string, sources array<string>, completion {COMPLETION}")
    out = {r.metric: r.value for r in reports.publish_stats(nodes).collect()}
    assert (out["total"], out["completed"], out["leaves"]) == (3, 1, 2) and "completed" not in {r.metric for r in reports.publish_stats(nodes.drop("completion")).collect()}
    rejects = spark.createDataFrame([(3, "c", "llm_judge", "late"), (1, "a", "llm_judge", "r1"), (2, "b", "llm_judge", ""), (4, "d", "bad", "x"), (5, "e", None, "x")], "o int, name string, reason string, reasoning string")
    assert [tuple(r) for r in reports.judge_reasonings(rejects, "o").orderBy("place").collect()] == [(1, "a", "r1"), (2, "c", "late")]
    t = spark.createDataFrame([("x", ["a", "b"]), ("x", None), (None, [])], "g string, l array<string>")
    count = lambda t: {r.name: r.n for r in seeds.seed_counts({"t": t}, {"g": (t, "g")}, {"l": (t, "l")}).collect()}
    assert count(t) == {"t": 3, "g": 1, "l": 2} and count(t.limit(0)) == {"t": 0, "g": 0, "l": 0}


def test_rows_stay_where_they_are_when_templates_are_filled(spark):
    rows = spark.range(10).selectExpr("id", "'atomic' AS kind")
    out = gaps.rendered(rows, spark.createDataFrame([("atomic", "<{id}>")], "kind string, template string"), "kind", ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.prompt for r in out.collect()} == {f"<{i}>" for i in range(10)}
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
