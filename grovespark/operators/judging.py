"""Judgements of node names: phrase sets, good signs, labels, verb classes, verdicts with their reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions import families as W
from grovespark.functions import rules as R
from grovespark.functions.text import first_verb, norm_name


def spaced(name: Column) -> Column:
    """Lower case, underscores and hyphens as blanks."""
    return F.lower(F.translate(name, "_-", "  "))


def starts_with_phrase(text: Column, phrases: list[str]) -> Column:
    """Whether text equals one of the phrases or goes on after it with a blank: one set lookup for each phrase length."""
    lengths = sorted({len(p.split(" ")) for p in phrases})
    tests = [F.substring_index(text, " ", k).isin([p for p in phrases if len(p.split(" ")) == k]) for k in lengths]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def cognitive_verb(name: Column) -> Column:
    return starts_with_phrase(spaced(name), W.COGNITIVE_VERBS)


def obvious_atomic(name: Column) -> Column:
    """Starts with a verb that is atomic as it stands, in at most four words."""
    low = F.btrim(spaced(name))
    return starts_with_phrase(low, W.OBVIOUS_ATOMIC_VERBS) & (F.size(F.split(low, r"\s+")) <= 4)


def valid_atomic(nodes: DataFrame, lexicon: DataFrame, most_words: int, key: str = "id") -> DataFrame:
    """The nodes whose name equals, or starts with, a phrase of the lexicon (phrase, underscores as blanks), as a semi-join."""
    low = spaced(F.col("name"))
    prefixes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda k: F.call_function("substring_index", low, F.lit(" "), k)))
    known = lexicon.select(F.translate("phrase", "_", " ").alias("__p")).distinct()
    hits = nodes.select(F.col(key).alias("__k"), F.explode(prefixes).alias("__p")).join(known, "__p", "left_semi").select("__k").distinct()
    return nodes.join(hits, F.col(key) == F.col("__k"), "left_semi")


def validated(nodes: DataFrame, verdict: str = "verdict", name: str = "name", description: str = "description") -> DataFrame:
    """nodes with the verdict: robot_internal:<pattern>, generic_template, cognitive_verb or ok, the first that applies.

    Names are lowered in a column of their own, once for each row.
    """
    low = nodes.withColumn("__low", F.lower(name))
    marked = R.with_template(low.withColumn("__internal", R.match_rules(F.col("__low"), W.ROBOT_INTERNAL)), "__check", name, description)
    said = F.coalesce(F.concat(F.lit("robot_internal:"), "__internal"), F.when(F.col("__check").isNotNull(), "generic_template"), F.when(cognitive_verb(F.col(name)), "cognitive_verb"), F.lit("ok"))
    return marked.withColumn(verdict, said).drop("__low", "__internal", "__check")


def settled(rows: DataFrame, column: str) -> DataFrame:
    """rows with the column worked out once: a filter on it stays above, where it would else repeat the expression below."""
    return rows.withColumn(column, F.explode_outer(F.array(column)))


def reject_records(nodes: DataFrame, parent: str = "parent_id") -> DataFrame:
    """(id, name, description, reason, pattern, parent_context) of the nodes whose name does not validate."""
    judged = settled(validated(nodes, "__v"), "__v").where("__v <> 'ok'")
    pattern = F.when(F.col("__v").contains(":"), F.expr("substring(__v, locate(':', __v) + 1)"))
    return judged.select("id", "name", "description", F.substring_index("__v", ":", 1).alias("reason"), pattern.alias("pattern"), F.col(parent).alias("parent_context"))


def bad_pattern(name: Column) -> Column:
    """The first bad-name pattern that is found; null for none."""
    return R.match_rules(F.lower(name), W.ALL_BAD)


def good_signs(name: Column) -> Column:
    """Signs of a sound name, the first of each kind: a manipulation verb, a tool phrase, a specific object."""
    low = F.lower(name)
    verb = R.guarded(low, W.MANIPULATION_VERBS, lambda t: F.coalesce(*[F.when(t.startswith(v) | t.contains(f" {v} "), F.lit(f"verb:{v}")) for v in W.MANIPULATION_VERBS]))
    tool = R.first_phrase(low, {t: f"tool:{t}" for t in W.TOOL_PHRASES})
    thing = F.when(R.match_rules(low, W.SPECIFIC_OBJECTS).isNotNull(), F.lit("object"))
    return F.filter(F.array(verb, tool, thing), lambda x: x.isNotNull())


def quality_label(nodes: DataFrame) -> DataFrame:
    """Adds bad_pattern, good_signs, quality (BAD, GOOD, UNCERTAIN) and score (0, number of signs, 0.5)."""
    marked = nodes.withColumn("bad_pattern", bad_pattern(F.col("name"))).withColumn("good_signs", good_signs(F.col("name")))
    bad, good = F.col("bad_pattern").isNotNull(), F.size("good_signs") > 0
    marked = marked.withColumn("quality", F.when(bad, "BAD").when(good, "GOOD").otherwise("UNCERTAIN"))
    return marked.withColumn("score", F.when(bad, 0.0).when(good, F.size("good_signs").cast("double")).otherwise(0.5))


def lacks_good_verb(name: Column) -> Column:
    return ~R.contains_any(F.lower(name), W.MANIPULATION_VERBS)


def issues(nodes: DataFrame) -> DataFrame:
    """Adds issues: every bad pattern that is found, and for atomic nodes the lack of a manipulation verb."""
    lack = F.when((F.col("node_type") == "atomic") & lacks_good_verb(F.col("name")), F.array(F.lit("lacks manipulation verb"))).otherwise(F.array().cast("array<string>"))
    return nodes.withColumn("issues", F.concat(R.match_rules_all(F.lower("name"), W.ALL_BAD), lack))


def verb_class(verb: Column) -> Column:
    """cognitive, physical or ambiguous, by set membership; cognitive wins."""
    return F.when(verb.isin(W.REVIEW_COGNITIVE), "cognitive").when(verb.isin(W.REVIEW_PHYSICAL), "physical").otherwise("ambiguous")


def curate_split(nodes: DataFrame) -> DataFrame:
    """(id, name, parent_id, side) of atomic nodes that want a look: cognitive but not physical, or neither."""
    low = F.lower("name")
    test = lambda words, also: reduce(lambda a, b: a | b, [low.startswith(v) | (low.contains(f" {v} ") | low.contains(f"_{v}") if also else F.lit(False)) for v in words])
    physical, cognitive = test(W.SPLIT_PHYSICAL, True), test(W.SPLIT_COGNITIVE, False)
    side = F.when(~physical & cognitive, "cognitive").when(~physical & ~cognitive, "ambiguous")
    return nodes.where("node_type = 'atomic'").select("id", "name", "parent_id", side.alias("side")).where("side is not null")


def verb_groups(nodes: DataFrame, samples: int = 5) -> DataFrame:
    """(verb, n_nodes, class, sample): nodes by first verb, with the least ids of each; no group gathers more than a task's
    few, as the samples are cut before they are shuffled."""
    from grovespark.operators.curate import first_per_group

    named = nodes.select(first_verb(F.col("name")).alias("verb"), "id").where("verb is not null")
    few = first_per_group(named, "verb", ["id"], samples).groupBy("verb").agg(F.array_sort(F.collect_list("id")).alias("sample"))
    return named.groupBy("verb").agg(F.count("*").alias("n_nodes")).join(few, "verb").withColumn("class", verb_class(F.col("verb")))


def value_scores(nodes: DataFrame) -> DataFrame:
    """(id, market, impressiveness, utility, difficulty, generality, total, tier, reasoning)."""
    low = F.col("__low")
    premium = [(k, p) for k, phrases in R.PREMIUM_PHRASES.items() for p in phrases]
    trash = F.concat(F.lit("Trash: matches pattern '"), R.match_rules(low, R.TRASH_PATTERNS), F.lit("'"))
    first = R.first_phrase(low, {p: f"Premium: {k} - {p}" for k, p in premium})
    demo = R.first_phrase(low, {p: f"Impressive demo: {p}" for p in R.DEMONSTRATIONS})
    said = nodes.select("id", F.lower("name").alias("__low")).select("id", F.coalesce(trash, first, demo, F.lit("Needs manual review")).alias("reasoning"))
    action = F.when(F.col("reasoning").startswith("Trash"), "trash").when(F.col("reasoning").startswith("Premium"), "premium").when(F.col("reasoning").startswith("Impressive"), "demo").otherwise("default")
    acted = said.withColumn("__a", action)
    names = ("market", "impressiveness", "utility", "difficulty", "generality")
    score = lambda i: F.coalesce(*[F.when(F.col("__a") == a, F.lit(v[i])) for a, v in R.SCORES.items()])
    scored = acted.select("id", *[score(i).alias(c) for i, c in enumerate(names)], R.value_total(F.col("__a")).alias("total"), "reasoning")
    return scored.withColumn("tier", R.tier_of(F.col("total")))


def domain_kind(id_: Column, prefixes: dict[str, str]) -> Column:
    """The kind whose prefix the id has; null for none."""
    return F.coalesce(*[F.when(id_.startswith(p), F.lit(kind)) for p, kind in prefixes.items()])


def domains_named(nodes: DataFrame, part: str) -> DataFrame:
    return nodes.where((F.col("node_type") == "domain") & norm_name(F.col("name")).contains(part.lower()))
