"""The first test of a rule list lets through all that a pattern finds, and coverage finds what a search of all finds."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grovespark.functions import families as W
from grovespark.functions import rules as R
from grovespark.operators import judging, lexicon

PATTERNS = [p for patterns in W.RULES.values() for p in patterns]


@pytest.mark.parametrize("pattern,literal", [("joint.?torque", "torque"), ("check.*status", "status"), (r"^spray\s+\w+$", "spray"), ("colou?r", "colo"), ("flexion(?!.*(arm|leg))", "flexion"), (r"\bheavy-duty\b", "heavy-duty"), ("a|b", ""), ("[ab]c", ""), (r"\w+", ""), ("ab*c", "a")])
def test_needed_literals(pattern, literal):
    assert R.needed_literal(pattern) == literal


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(PATTERNS), st.text("abcdefghijklmnopqrstuvwxyz -'", max_size=12), st.randoms())
def test_what_a_pattern_finds_holds_its_literal(pattern, noise, rng):
    plain = re.sub(r"\(\?!.*\)", "", pattern)
    text = noise + re.sub(r"\\s\+|\\w\+|\.[*+?]|\\b", lambda m: {"\\s+": " ", "\\w+": "wo", "\\b": ""}.get(m[0], rng.choice(["x", " ", "-"])), plain).strip("^$")
    if re.search(pattern, text):
        assert R.needed_literal(pattern) in text and re.search(R.alternation([R.needed_literal(p) for p in PATTERNS]), text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc -'.+", min_size=1, max_size=4), min_size=1, max_size=8), st.text("abc -'.+", max_size=12))
def test_the_trie_finds_any_of_its_phrases(phrases, text):
    assert bool(re.search(R.alternation(phrases), text)) == any(p in text for p in phrases)


def test_all_families_give_what_each_pattern_alone_gives(spark):
    rng = random.Random(1)
    words = sorted({w for p in PATTERNS for w in re.findall(r"[a-z]{3,}", p)})
    names = [" ".join(rng.sample(words, rng.randrange(1, 5))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    for patterns in (W.ROBOT_INTERNAL, W.ALL_BAD, R.TRASH_PATTERNS):
        got = df.select("id", R.match_rules(F.lower("name"), patterns).alias("first"), R.match_rules_all(F.lower("name"), patterns).alias("all")).collect()
        for r in got:
            found = [p for p in patterns if names[r.id] is not None and re.search(p, names[r.id])]
            assert (r["first"], r["all"]) == (found[0] if found else None, found)


def test_a_verdict_is_worked_out_once(spark):
    """The filter on the verdict stays above it: below, it would repeat all patterns."""
    df = spark.createDataFrame([("1", "p", "joint torque", ""), ("2", "p", "open door", "a text that says much more")], "id string, parent_id string, name string, description string")
    out = judging.reject_records(df)
    assert [r.id for r in out.collect()] == ["1"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("robot_internal:") == 1


def test_held_phrases_against_a_search_of_all(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde_") for _ in range(rng.randrange(1, 9)))
    wanted, actual = {word() for _ in range(200)}, {word() + word() for _ in range(300)}
    of = lambda words: spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "phrase string")
    got = {r.phrase for r in lexicon.held_phrases(of(wanted), of(actual)).collect()}
    assert got == {w for w in wanted if any(w in a for a in actual)}
    assert lexicon.held_phrases(of([]), of(actual)).count() == 0
    plan = lexicon.held_phrases(of(wanted), of(actual))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_coverage_of_a_domain_table(spark):
    want = spark.createDataFrame([("kitchen", "chop"), ("kitchen", "stir"), ("farm", "dig")], "group string, phrase string")
    have = spark.createDataFrame([("chop_onion",), ("dig",), ("digest",)], "phrase string")
    got = {r.group: (r.n_expected, r.n_found, r.missing, r.passed) for r in lexicon.coverage_by_group(lexicon.covered(want, have, "substring"), 60).collect()}
    assert got == {"kitchen": (2, 1, "stir", False), "farm": (1, 1, "", True)}
