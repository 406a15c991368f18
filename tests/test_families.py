import re

from pyspark.sql import functions as F

from grovespark.functions import families as W
from grovespark.operators import judging

NAMES = ["compute joint torque", "remember the list", "flexion of wrist", "flexion of the arm", "grasp cup", "pick up the cup from table", "spray water", "apply to wall", "calibrate arm", "stack boxes using a gripper", "decide", "Pick-up box", "wash dishes", "paint wall slowly and with great care", "open door", None, ""]


def frame(spark):
    return spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "id int, name string")


def test_first_pattern_of_each_family_wins(spark):
    rules = W.rule_table(spark)
    for family, patterns in W.RULES.items():
        got = {r.id: r.pattern for r in W.matched(frame(spark), rules, family, F.col("name")).collect()}
        assert got == {i: next((p for p in patterns if n is not None and re.search(p, n.lower())), None) for i, n in enumerate(NAMES)}
    assert {r.id for r in W.matched(frame(spark), rules, "robot_internal", F.col("name")).where("pattern is not null").collect()} == {0, 2}


def test_sql_functions_and_view(spark):
    W.register_rules(spark)
    assert spark.sql("SELECT first_robot_internal('Compute Joint Torque') AS p").first().p == "joint.?torque"
    assert spark.sql("SELECT first_trash('grasp cup') AS p").first().p is None
    assert spark.sql("SELECT count(*) AS n FROM rules").first().n == sum(map(len, W.RULES.values()))


def test_phrase_sets(spark):
    rows = frame(spark).select("id", judging.cognitive_verb(F.col("name")).alias("c"), judging.obvious_atomic(F.col("name")).alias("o")).collect()
    assert {r.id for r in rows if r.c} == {1, 10}
    assert {r.id for r in rows if r.o} == {4, 11, 14}
    lexicon = spark.createDataFrame([("pick_up",), ("wash",)], "phrase string")
    assert {r.id for r in judging.valid_atomic(frame(spark), lexicon, 2).collect()} == {5, 11, 12}


def test_labels_signs_and_verdicts(spark):
    rows = {r.id: r for r in judging.quality_label(frame(spark)).collect()}
    assert (rows[6].quality, rows[6].score) == ("BAD", 0.0) and rows[6].bad_pattern == r"^spray\s+\w+$"
    assert (rows[9].quality, rows[9].good_signs) == ("GOOD", ["verb:stack", "tool:using a"])
    assert rows[5].good_signs == ["verb:pick", "object"] and rows[10].quality == "UNCERTAIN"
    said = frame(spark).withColumn("description", F.lit("")).withColumn("parent_id", F.lit("p"))
    rejects = {r.id: (r.reason, r.pattern) for r in judging.reject_records(said).collect()}
    assert rejects[0] == ("robot_internal", "joint.?torque") and rejects[1] == ("cognitive_verb", None)


def test_value_scores_and_reasons(spark):
    rows = {r.id: r for r in judging.value_scores(frame(spark).where("name is not null")).collect()}
    assert (rows[8].total, rows[8].tier, rows[8].reasoning) == (0, "TRASH", "Trash: matches pattern 'calibrate'")
    assert (rows[12].total, rows[12].tier, rows[12].reasoning) == (74, "HIGH", "Premium: dishes - wash dishes")
    assert (rows[13].market, rows[13].impressiveness, rows[13].total, rows[13].tier) == (9, 10, 81, "PREMIUM")
    assert (rows[14].total, rows[14].tier, rows[14].reasoning) == (50, "MEDIUM", "Needs manual review")


def test_split_and_classes(spark):
    nodes = spark.createDataFrame([(1, "analyze data"), (2, "grasp cup"), (3, "hum quietly")], "id int, name string").selectExpr("*", "'p' AS parent_id", "'atomic' AS node_type")
    assert {r.id: r.side for r in judging.curate_split(nodes).collect()} == {1: "cognitive", 3: "ambiguous"}
    assert {r.verb: (r.n_nodes, r["class"]) for r in judging.verb_groups(nodes.withColumn("id", F.col("id").cast("string"))).collect()} == {"analyze": (1, "cognitive"), "grasp": (1, "physical"), "hum": (1, "ambiguous")}
