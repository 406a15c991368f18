"""What op9 works out for every line or pair is worked out once. Counted in plans, as results are the same either way."""

from pyspark.sql import functions as F

from grovespark.llm import buckets, line_dedup


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_second_signatures_are_not_made_again_by_each_reader_of_the_keys(spark, monkeypatch):
    seen = []

    def classes(keyed, *rest):
        seen.extend([plan(keyed), {r.id for r in keyed.select("id").collect()}])
        return spark.createDataFrame([], "node long, component long")

    monkeypatch.setattr(line_dedup, "bucket_classes", classes)
    rows = [(1, "one line of several words here\n" + "x" * 40), (2, "   \n\xa0\nshort")]
    occurrences, _ = line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "regexp_extract_all" not in seen[0]
    assert seen[1] == {r.id for r in occurrences.collect()} and occurrences.count() == 3


def test_a_pair_has_each_of_its_sets_made_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(buckets, "materialize", lambda df: seen.append(df) or df)
    line = " ".join(f"word{i}of" for i in range(12))
    texts = spark.createDataFrame([(1, line), (2, line + " a"), (3, line[:40])], "id long, norm string")
    bodies = texts.select("id", line_dedup.body_of(F.col("norm")).alias("body"))
    elements = lambda body: line_dedup.shingles(body, 8)
    once = plan(bodies.select(elements(F.col("body")).alias("x"))).count("xxhash64(")
    got = buckets.verified(spark.createDataFrame([(2, 1), (3, 1)], "a long, b long"), bodies, elements, 0.8)
    assert [tuple(r) for r in got.collect()] == [(2, 1)] and plan(seen[0]).count("xxhash64(") == 2 * once
