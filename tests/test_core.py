from pyspark.sql import functions as F

from grovespark.functions import rules as R
from grovespark.functions import text as T
from grovespark.operators import curate, tree


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_slug_and_names(spark):
    assert one(spark, T.slug(F.lit('Pick-Up  the "Cup"!'))) == "pick_up_the_cup"
    assert one(spark, T.parent_path(F.lit("a/b/c"))) == "a/b" and one(spark, T.parent_path(F.lit("a"))) is None
    assert one(spark, T.first_verb(F.lit("Grasp (firmly)"))) == "grasp"


def test_generic_template(spark):
    cases = {("spray surface", ""): 2, ("spray machine handle", ""): None, ("push vacuum cleaner over passenger's seat", ""): 3, ("attending sports practice", ""): 4, ("use a commercial stand mixer", ""): 5, ("check equipment", ""): 6, ("manage_workflow", ""): 7, ("open door", "Open door"): 8, ("open door", "Step 2: open it"): 1}
    df = spark.createDataFrame(list(cases), "name string, d string")
    for r in df.select("name", "d", R.generic_template(F.col("name"), F.col("d")).alias("c")).collect():
        assert r.c == cases[(r.name, r.d)], r


def test_score_value(spark):
    for name, total in {"plant seed": 0, "wash dishes": 74, "paint wall": 81, "open jar": 50}.items():
        assert one(spark, R.value_total(R.value_action(F.lit(name)))) == total
    assert one(spark, R.tier_of(F.lit(74))) == "HIGH"


def test_tree(spark):
    n = spark.createDataFrame([("a", None, "a", "domain"), ("a/b", "a", "bad", "task"), ("a/b/c", "a/b", "c", "atomic"), ("a/d", "a", "d", "task")], "id string, parent_id string, name string, node_type string")
    assert {r.id for r in tree.prune(n, F.col("name") == "bad").collect()} == {"a", "a/d"}
    assert {r.id for r in tree.prune(n, F.col("name") == "bad", "none").collect()} == {"a", "a/b/c", "a/d"}
    assert {r.id for r in tree.descendants(n, n.where("id = 'a'")).collect()} == {"a/b", "a/b/c", "a/d"}
    assert {r.id: r.children_ids for r in tree.rebuild_children(n).collect()}["a"] == ["a/b", "a/d"]


def test_reject_cutoff(spark):
    rows = spark.createDataFrame([("p", i, ok) for i, ok in enumerate([True, False, False, True, False, True])], "p string, i int, ok boolean")
    assert [r.i for r in curate.reject_cutoff(rows, "p", "i", ~F.col("ok")).orderBy("i").collect()] == [0, 3]
