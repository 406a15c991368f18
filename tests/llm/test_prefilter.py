from pyspark.sql import functions as F

from grovespark.llm.prefilter import likely


def test_likely_keeps_every_row_with_a_partner(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("k"), F.col("id").alias("__n"))
    keys = rows.where("__n % 50 = 0").select("k").unionByName(spark.createDataFrame([(None,)], "k bigint"))
    kept = {r["__n"] for r in likely(rows.unionByName(spark.createDataFrame([(None, -1)], "k bigint, __n bigint")), keys, "k").collect()}
    assert {n for n in range(5000) if n % 50 == 0} <= kept
    assert -1 not in kept and len(kept) < 1000


def test_likely_without_keys_keeps_nothing(spark):
    rows = spark.range(10).select(F.xxhash64("id").alias("k"))
    assert likely(rows, rows.limit(0), "k").count() == 0
