import hashlib

from pyspark.sql import functions as F

from grovespark.functions import text as T
from grovespark.operators import decisions, lexicon, reports, requests, responses


def test_run_batch_asks_each_missing_key_once(spark):
    asked = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k2", "b"), ("k3", "boom")], "key string, prompt string")
    cache = spark.createDataFrame([("k1", "kept")], "key string, result string")

    def answer(prompt):
        if prompt == "boom":
            raise ValueError("no")
        return prompt.upper()

    rows = {r.key: r for r in requests.run_batch(asked, cache, answer, partitions=2).collect()}
    assert len(rows) == 3 and rows["k1"].cached and rows["k1"].result == "kept"
    assert rows["k2"].result == "B" and not rows["k2"].cached and rows["k3"].error == "ValueError: no"
    assert requests.run_batch(asked.limit(0), cache, answer).count() == 0


def test_second_judge_is_fail_open(spark):
    judged = spark.createDataFrame([(1, "ok"), (2, "ok"), (3, "bad"), (4, "ok")], "id int, verdict string")
    said = spark.createDataFrame([(1, True, None), (2, False, "vague"), (3, True, None)], "id int, accept boolean, reason string")
    assert {r.id: r.final for r in requests.second_verdict(judged, said, "id").collect()} == {1: "ok", 2: "judge:vague", 3: "bad", 4: "ok"}


def test_cache_key_cost_and_prompt(spark):
    row = spark.createDataFrame([("p", None, "m", 0.7, True, "a/b")], "prompt string, sys string, model string, t double, th boolean, id string")
    key, text = row.select(requests.cache_key(F.col("prompt"), F.col("sys"), F.col("model"), F.col("t"), F.col("th")), requests.prompt_text(F.col("prompt"), F.col("id"))).first()
    assert key == hashlib.sha256(b'{"model":"m","prompt":"p","system_prompt":"","temperature":0.7,"use_thinking":true}').hexdigest()
    assert text == "Task: p\nDEPTH 1 - Decompose into major action phases.\n\nJSON:"
    usage = spark.createDataFrame([("x", "models/gemini-2.5-pro", 1_000_000, 100_000, 0), ("x", "other", 5, 5, 5)], "who string, model string, tokens_in long, tokens_out long, tokens_thinking long")
    prices = spark.createDataFrame(requests.PRICES, "model string, input double, output double, thinking double")
    assert tuple(requests.usage_cost(usage, prices, ["who"]).first()) == ("x", 2, 2.25)


def test_bucket_moves_and_marks(spark):
    placed = spark.createDataFrame([("a", "paint wall", "trainable"), ("b", "plan day", "archived"), ("c", "wash cup", "trainable")], "id string, name string, bucket string")
    moves = spark.createDataFrame([("a", "trainable", "archived", 1, 1), ("b", "trainable", "archived", 1, 2), ("c", "trainable", "archived", 1, 3), ("c", "trainable", "ambiguous", 2, 4)], "id string, from string, to string, ts int, tie int")
    rows = {r.id: r for r in decisions.bucket_move(placed, moves).collect()}
    assert (rows["a"].bucket, rows["a"].reason) == ("archived", "Manually archived: paint")
    assert rows["b"].wrong_source and rows["b"].bucket == "archived" and (rows["c"].bucket, rows["c"].reason) == ("ambiguous", None)
    log = spark.createDataFrame([("v", 1, 1, "keep"), ("v", 2, 2, "remove")], "verb string, ts int, tie int, decision string")
    assert decisions.marks(log, "verb", "decision", "ts", "tie").first().decision == "remove"


def test_lexicon_checks(spark):
    rows = spark.createDataFrame([("c", p) for p in ("is_open", "think_hard", "do_it", "x" * 41, "two words", "pick", "pick_up", "pick_off", "pick", "pick_out")], "category string, phrase string")
    found = {(r.issue, r.phrase) for r in lexicon.problems(rows.select("phrase").distinct(), lexicon.phrase_checks(F.col("phrase"))).collect()}
    assert found == {("state_predicates", "is_open"), ("abstract_cognitive", "think_hard"), ("vague_starters", "do_it"), ("too_long", "x" * 41), ("contains_space", "two words")}
    stats = {r.metric: r.value for r in lexicon.statistics(rows, spark.createDataFrame([("pick",)], "phrase string")).collect()}
    assert (stats["total"], stats["unique"], stats["duplicated"], stats["stems_with_variants"], stats["overlap"]) == (10, 9, 1, 1, 1)
    assert {(r.word, r.n_variants) for r in lexicon.disambiguation(spark.createDataFrame([("pick",), ("do",)], "word string"), rows).collect()} == {("pick", 3)}
    want = spark.createDataFrame([("g", "pick"), ("g", "zap")], "group string, phrase string")
    assert {r.phrase: r.found for r in lexicon.covered(want, rows, "substring").collect()} == {"pick": True, "zap": False}
    assert lexicon.coverage_by_group(lexicon.covered(want, rows), 50).first().passed


def test_responses_by_status_and_merges(spark):
    texts = [("a", '{"is_atomic": false, "subtasks": [{"name": "x"}]}'), ("b", '```json\n{"is_atomic": false, "subtasks": [{"name": "x"}, {"name": "y"'), ("c", 'see "task": "cut bread" and "name": "eat"'), ("d", "nothing")]
    rows = {r.id: r for r in responses.read_responses(spark.createDataFrame(texts, "id string, response string")).collect()}
    assert {k: r.status for k, r in rows.items()} == {"a": "ok", "b": "salvaged", "c": "regex", "d": "failed"}
    assert [x["name"] for x in rows["c"].r.subtasks] == ["cut bread", "eat"] and rows["d"].r is None
    nodes = spark.createDataFrame([("home", None, "Home", "domain"), ("home/wash", "home", "Wash", "task")], "id string, parent_id string, name string, node_type string")
    batch = spark.createDataFrame([("HOME", "Kitchen", "Cut bread", 1), ("HOME", "Bath", "wash", 2), ("Yard", "Lawn", "Mow", 3), ("Yard", "Lawn", "mow ", 4)], "domain string, category string, name string, ordinal int")
    assert {r.id: r.node_type for r in responses.merge_subtrees(nodes, batch).collect()} == {"home/kitchen": "task", "home/kitchen/cut_bread": "subtask", "yard": "domain", "yard/lawn": "task", "yard/lawn/mow": "subtask"}
    many = spark.createDataFrame([("home", f"n{i}", i) for i in range(9)], "parent_id string, name string, ordinal int")
    assert {r.name for r in responses.gap_fill(nodes, many, most=3).collect()} == {"n0", "n1", "n2"}


def test_scalars(spark):
    row = spark.createDataFrame([("robot_arm", 30, 120, "2024-01-02T03:04:05", "nonsense")], "name string, n int, s int, t string, bad string")
    got = row.select(T.title_case(F.col("name"), "Quality"), T.per_minute(F.col("n"), F.col("s")), T.eta_seconds(F.col("n"), F.lit(60), F.col("s")), T.iso_time(F.col("t")), T.iso_time(F.col("bad")), T.truncate(F.col("name"), 5), T.json_counts(F.array(F.lit("a")), F.array(F.lit(1))), T.percent(F.lit(1), F.lit(3))).first()
    assert tuple(got)[:3] == ("Robot Arm (Quality)", 15.0, 120.0) and got[3].hour == 3 and got[4] is None and tuple(got)[5:] == ("robot...", '{"a":1}', 33.33)


def test_graded_checks(spark):
    metrics = spark.createDataFrame([("a", 95.0), ("b", 12.0)], "check_name string, value double")
    graded = reports.graded(metrics, [("f", "a", "min", 90.0, 50.0), ("f", "b", "max", 10.0, 20.0), ("f", "c", "min", 1.0, 0.0)])
    assert {r.check_name: r.status for r in graded.collect()} == {"a": "PASS", "b": "WARN", "c": "FAIL"}
    assert tuple(reports.check_totals(graded).first()) == ("f", 1, 1, 1)
