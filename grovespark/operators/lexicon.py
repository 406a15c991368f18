"""Phrases and names: prefix lookup in a lexicon, verdicts, stems and problems of phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions.text import norm_name
from grovespark.scratch import materialize


def prefix_match(nodes: DataFrame, phrases: DataFrame, most_words: int, name: str = "name", key: str = "id") -> DataFrame:
    """(key, phrase): the longest phrase that the name equals or starts with, before a space.

    A name's word prefixes are at most most_words rows, so the lookup is an equi-join and not a comparison with
    every phrase. Null names match nothing.
    """
    low = norm_name(F.translate(name, "_-", "  "))
    prefixes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda k: F.call_function("substring_index", low, F.lit(" "), k)))
    hits = nodes.select(key, F.explode(prefixes).alias("phrase")).join(phrases.distinct(), "phrase")
    return hits.groupBy(key).agg(F.max_by("phrase", F.length("phrase")).alias("phrase"))


def stems(phrases: DataFrame, column: str, least: int = 3) -> DataFrame:
    """Text before the first underscore, with at least so many distinct phrases."""
    distinct = phrases.select(F.col(column).alias("v")).where("v is not null").distinct()
    return distinct.groupBy(F.substring_index("v", "_", 1).alias("stem")).agg(F.count("*").alias("n_variants"), F.min("v").alias("first_variant"), F.max("v").alias("last_variant")).where(F.col("n_variants") >= least)


def problems(phrases: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per phrase and check that it fails, with column issue; one pass."""
    found = F.array(*[F.when(bad, F.lit(issue)) for issue, bad in checks.items()])
    return phrases.withColumn("issue", F.explode(F.filter(found, lambda x: x.isNotNull())))


# Words and lengths of the lexicon's checks.
COGNITIVE_STEMS = ["remember", "memorize", "forget", "recall", "think", "mental", "imagine", "believe", "know", "understand"]
VAGUE_STARTERS = ["do_", "use_", "make_", "get_", "be_"]
LONGEST_PHRASE = 40


def phrase_checks(p: Column) -> dict[str, Column]:
    """The five checks of a lexicon phrase."""
    vague = F.coalesce(*[F.when(p.startswith(v), F.lit(True)) for v in VAGUE_STARTERS], F.lit(False))
    return {"state_predicates": p.startswith("is_"), "abstract_cognitive": F.substring_index(p, "_", 1).isin(COGNITIVE_STEMS), "vague_starters": vague, "too_long": F.length(p) > LONGEST_PHRASE, "contains_space": p.contains(" ")}


def duplicates(rows: DataFrame) -> DataFrame:
    """(phrase, n_listed) of the phrases that the raw lexicon rows list more than once."""
    return rows.groupBy("phrase").agg(F.count("*").alias("n_listed")).where("n_listed > 1")


def category_summary(rows: DataFrame, first: int = 8) -> DataFrame:
    """(category, n_phrases, phrases): distinct phrases of each category and the first of them; ranks are cut before the shuffle."""
    from grovespark.operators.curate import first_per_group

    distinct = rows.select("category", "phrase").distinct()
    few = first_per_group(distinct, "category", ["phrase"], first).groupBy("category").agg(F.array_join(F.array_sort(F.collect_list("phrase")), ", ").alias("phrases"))
    return distinct.groupBy("category").agg(F.count("*").alias("n_phrases")).join(few, "category")


def statistics(rows: DataFrame, cognitive: DataFrame) -> DataFrame:
    """(metric, value): totals, distinct, duplicated and varied phrases, problems, and the overlap with the cognitive set."""
    checks = phrase_checks(F.col("phrase"))
    listed = rows.groupBy("phrase").agg(F.count("*").alias("n")).withColumn("stem", F.substring_index("phrase", "_", 1))
    totals = listed.agg(F.sum("n").alias("total"), F.count("*").alias("unique"), F.count_if(F.col("n") > 1).alias("duplicated"), *[F.count_if(c).alias(k) for k, c in checks.items()])
    varied = listed.groupBy("stem").agg(F.count("*").alias("k")).agg(F.count_if(F.col("k") >= 3).alias("v"))
    both = listed.select("phrase").join(cognitive.select("phrase").distinct(), "phrase", "left_semi").agg(F.count("*").alias("v"))
    names = ["total", "unique", "duplicated", *checks]
    wide = totals.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.coalesce(n, F.lit(0)).cast("long").alias("value")) for n in names])).alias("m")).select("m.*")
    one = lambda df, name: df.select(F.lit(name).alias("metric"), F.col("v").cast("long").alias("value"))
    return wide.unionByName(one(varied, "stems_with_variants")).unionByName(one(both, "overlap"))


#: Characters of a gram of the substring index; shorter phrases are grams of their own length.
GRAM = 4


def _grams(text: str, lengths: list[int]) -> Column:
    """The distinct parts of the text of each of these lengths."""
    each = lambda k: F.when(F.length(text) >= k, F.transform(F.sequence(F.lit(1), F.length(text) - k + 1), lambda i: F.substring(F.col(text), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[each(k) for k in lengths])))


def held_phrases(wanted: DataFrame, actual: DataFrame) -> DataFrame:
    """The distinct wanted(phrase) that some actual(phrase) holds as a substring.

    Actual phrases are indexed by their grams. A wanted phrase looks up its rarest gram alone, by an equi-join, and only
    phrases that hold it are searched; one with a gram that no phrase has is gone before that. Null and empty are held by
    none.
    """
    wanted = wanted.select("phrase").where("phrase <> ''").distinct().select("phrase", F.least(F.length("phrase"), F.lit(GRAM)).alias("k"))
    wanted = materialize(wanted)
    lengths = sorted(r.k for r in wanted.select("k").distinct().collect())  # at most GRAM
    if not lengths:
        return wanted.select("phrase")
    asked = wanted.select("phrase", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("phrase") - F.col("k") + 1), lambda i: F.substring(F.col("phrase"), i, F.col("k"))))).alias("gram"))
    index = materialize(actual.select(F.col("phrase").alias("__a")).where("__a is not null").distinct().select("__a", F.explode(_grams("__a", lengths)).alias("gram")))
    known = index.groupBy("gram").agg(F.count("*").alias("n"))
    rated = asked.join(known, "gram", "left").groupBy("phrase").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("m"))
    rarest = rated.where("m.n > 0").select("phrase", F.col("m.gram").alias("gram"))
    return rarest.join(index, "gram").where(F.col("__a").contains(F.col("phrase"))).select("phrase").distinct()


def covered(expected: DataFrame, actual: DataFrame, match: str = "exact") -> DataFrame:
    """expected(group, phrase) with found: whether an actual phrase equals it, or (match 'substring') holds it."""
    if match == "exact":
        hits = actual.select("phrase").distinct()
    else:
        hits = held_phrases(expected, actual)
    return expected.join(hits.withColumn("__f", F.lit(True)), "phrase", "left").select("group", "phrase", F.coalesce("__f", F.lit(False)).alias("found"))


def coverage_by_group(marked: DataFrame, least: int) -> DataFrame:
    """(group, n_expected, n_found, pct, missing, passed) of covered phrases; the group passes from `least` percent on."""
    pct = F.round(100.0 * F.count_if(F.col("found")) / F.count("*"), 2)
    gaps = F.array_join(F.array_sort(F.collect_set(F.when(~F.col("found"), F.col("phrase")))), ",")
    return marked.groupBy("group").agg(F.count("*").alias("n_expected"), F.count_if(F.col("found")).alias("n_found"), pct.alias("pct"), gaps.alias("missing")).withColumn("passed", F.col("pct") >= least)


def disambiguation(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(word, n_variants): single words that are phrases themselves, and how many phrases go on from them with `_`.

    Phrases are reduced to their first part, so this is an equi-join and not a comparison of all with all.
    """
    variants = phrases.select("phrase").distinct().where(F.col("phrase").contains("_")).select(F.substring_index("phrase", "_", 1).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    known = words.select("word").distinct().join(phrases.select(F.col("phrase").alias("word")).distinct(), "word", "left_semi")
    return known.join(variants, "word", "left").select("word", F.coalesce("n", F.lit(0).cast("long")).alias("n_variants"))
