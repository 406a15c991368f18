from pyspark.sql import functions as F

from grovespark.llm import charlm


def test_a_rare_group_keeps_its_ngrams_beside_a_million_types(spark):
    word = F.translate(F.lpad(F.conv(F.col("id").cast("string"), 10, 32), 4, "0"), "0123456789", "αβγδεζηθικ")
    many = spark.range(32**4).select(F.lit("many").alias("lang"), F.concat_ws(" ", word, word).alias("text"))
    rare = spark.createDataFrame([("rare", "жзи")], "lang string, text string")
    counts = charlm.count_ngrams(many.unionByName(rare), "lang")
    assert counts.where("grp = 'many'").count() > 1_000_000
    assert charlm.of_group(counts, "rare")["n"].sum() == 4
    assert charlm.groups_of(counts) == ["many", "rare"]
