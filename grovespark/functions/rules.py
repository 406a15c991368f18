"""Ordered rule lists and the columns that judge names by them.

From every pattern the literal that all its matches hold is drawn out. One expression, a trie of these literals, is
tried first, and only text that holds one of them is given to the patterns, in order, each behind its own literal.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions.text import norm_name, words_of

# They must equal the lists of the taxonomy's makers for the same verdicts.
OVERSPECIFIC_MODIFIERS = ["commercial", "industrial", "professional-grade", "enterprise", "heavy-duty", "hospital-grade", "medical-grade", "laboratory-grade"]
NON_PHYSICAL_VERBS = ["attending", "observing", "participating", "joining", "watching"]
VAGUE_ACTION_PATTERNS = [r"^spray\s+\w+$", r"^apply\s+to\s+\w+$", r"^treat\s+\w+$", r"^coat\s+\w+$"]
CONFUSING_PATTERNS = [r"over\s+\w+'s\s+", r"\w+'s\s+\w+\s+of\s+"]
GENERIC_VERBS = ["check", "verify", "inspect", "prepare", "gather", "secure", "adjust", "position", "clean", "move", "handle", "process", "ensure", "confirm", "validate", "assess", "evaluate", "review", "analyze", "monitor"]
VAGUE_VERBS = ["manage", "coordinate", "facilitate", "oversee", "maintain", "support", "assist", "help", "address", "deal", "engage", "participate", "involve", "consider", "determine", "establish", "implement", "develop", "continue", "proceed", "perform", "conduct", "execute", "handle", "process", "ensure"]
GENERIC_NOUNS = ["target", "source", "materials", "equipment", "tools", "surface", "container", "workspace", "components", "area", "items", "objects", "things", "stuff", "resources", "supplies", "elements", "system", "setup", "environment"]
ABSTRACT_NOUNS = ["situation", "workflow", "process", "activity", "task", "operation", "procedure", "action", "step", "phase", "information", "data", "status", "state", "condition", "quality", "issue", "problem", "matter", "thing"]
STEP_PATTERN = r"^step\s+\d+\s*:"
TRASH_PATTERNS = ["calibrate", "initialize", "configure", "check.*status", "monitor.*level", "wait for", "pause", "standby", "generic", "template", "placeholder", "test", "debug", "troubleshoot", "document", "report", "log", "plan", "schedule", "coordinate", "analyze", "evaluate", "assess"]
PREMIUM_PHRASES = {
    "coffee": ["make coffee", "brew coffee", "espresso", "latte", "cappuccino"],
    "cooking": ["cook meal", "prepare dish", "plate food", "garnish"],
    "cleaning_impressive": ["pick up broken glass", "clean up spill", "vacuum carpet", "mop floor"],
    "laundry": ["fold clothes", "hang clothes", "iron shirt", "sort laundry"],
    "dishes": ["load dishwasher", "wash dishes", "dry dishes", "put away dishes"],
    "bed_making": ["make bed", "change sheets", "fluff pillows"],
    "patient_care": ["transfer patient", "position patient", "assist walking", "help patient sit"],
    "medication": ["dispense medication", "prepare medication", "deliver medication"],
    "hygiene_assist": ["help patient bathe", "brush patient teeth", "comb patient hair"],
    "assembly": ["assemble component", "insert part", "tighten fastener", "align parts"],
    "quality_inspection": ["inspect surface", "measure dimension", "check alignment"],
    "packaging": ["pack box", "seal package", "apply label", "stack pallets"],
    "picking": ["pick item", "grasp product", "retrieve object"],
    "sorting": ["sort package", "organize items", "categorize products"],
    "inventory": ["count items", "scan barcode", "track inventory"],
    "harvesting": ["pick fruit", "harvest vegetable", "collect crop"],
    "planting": ["plant seed", "transplant seedling", "dig hole"],
    "crop_care": ["prune plant", "water plant", "remove weeds"],
    "food_prep": ["chop vegetable", "slice meat", "mix ingredients", "knead dough"],
    "plating": ["plate dish", "garnish plate", "portion food"],
    "serving": ["serve food", "pour drink", "carry tray"],
    "stocking": ["stock shelf", "organize display", "arrange products"],
    "checkout": ["scan item", "bag groceries", "handle payment"],
}
DEMONSTRATIONS = ["pick up broken glass", "thread needle", "origami", "juggle", "solve rubik cube", "play instrument", "paint", "calligraphy", "arrange flowers", "crack egg", "flip pancake", "pour without spilling", "stack blocks", "tie shoelace", "button shirt"]
#: Scores of market, impressiveness, utility, difficulty and generality by action; weights of a total out of 100.
SCORES = {"trash": (0, 0, 0, 0, 0), "premium": (8, 7, 8, 6, 7), "demo": (9, 10, 5, 8, 6), "default": (5, 5, 5, 5, 5)}
WEIGHTS = (3, 3, 2, 1, 1)
TIERS = [("PREMIUM", 80), ("HIGH", 60), ("MEDIUM", 40), ("LOW", 20), ("TRASH", 0)]


def needed_literal(pattern: str) -> str:
    """The longest literal that every match of the pattern holds; empty if the pattern's form doesn't show one.

    Look-aheads are dropped, a character that may be missing is no part of a literal, and alternatives, groups and
    character classes have none.
    """
    plain = re.sub(r"\(\?!.*\)", "", pattern)
    if re.search(r"[|()\[\]{}]", plain):
        return ""
    plain = re.sub(r"\\?.[?*]", "\0", plain)
    return max(re.split(r"\\[A-Za-z]|[\0.^$+]", plain), key=len)


def alternation(phrases: list[str]) -> str:
    """A pattern that finds any of the phrases: a trie, so that a place in the text is tried against each first letter
    and not against each phrase. A phrase that holds another one adds nothing."""
    least = [p for p in dict.fromkeys(phrases) if not any(q != p and q in p for q in phrases)]
    tree: dict = {}
    for p in least:
        at = tree
        for c in p:
            at = at.setdefault(c, {})

    def written(node: dict) -> str:
        tail = [re.escape(c).replace("\\ ", " ").replace("\\-", "-").replace("\\'", "'") + written(child) for c, child in sorted(node.items())]
        return "" if not tail else tail[0] if len(tail) == 1 else f"(?:{'|'.join(tail)})"

    return written(tree)


def may_match(lowered: Column, patterns: list[str]) -> Column:
    """False only where no pattern can be found: the first test of a rule list."""
    needed = [needed_literal(p) for p in patterns]
    return lowered.rlike(alternation(needed)) if needed and all(needed) else F.lit(True)


def _hit(text: Column, pattern: str) -> Column:
    if (needed := needed_literal(pattern)) == pattern:
        return text.contains(pattern)
    return (text.contains(needed) & text.rlike(pattern)) if needed else text.rlike(pattern)


def guarded(lowered: Column, patterns: list[str], find: Callable[[Column], Column]) -> Column:
    """find(text) where the first test lets the text through, in lists long enough for it to pay.

    The few that pass are judged inside a lambda, which Spark evaluates as it stands: in line, a hundred patterns would
    grow the generated code of the whole stage beyond what the JVM compiles.
    """
    if len(patterns) <= 4:
        return find(lowered)
    return F.when(may_match(lowered, patterns), F.get(F.transform(F.array(lowered), find), F.lit(0)))


def match_rules(lowered: Column, patterns: list[str]) -> Column:
    """The first pattern of the list that is found in the text; null if none is."""
    if not patterns:
        return F.lit(None).cast("string")
    return guarded(lowered, patterns, lambda t: F.coalesce(*[F.when(_hit(t, p), F.lit(p)) for p in patterns]))


def match_rules_all(lowered: Column, patterns: list[str]) -> Column:
    """All patterns of the list that are found, in its order; null text has none."""
    found = guarded(lowered, patterns, lambda t: F.filter(F.array(*[F.when(_hit(t, p), F.lit(p)) for p in patterns]), lambda x: x.isNotNull()))
    return F.coalesce(found, F.array().cast("array<string>"))


def first_phrase(text: Column, labels: dict[str, str]) -> Column:
    """The label of the first phrase (letters, digits and blanks), in the order given, that the text holds; null for none."""
    return guarded(text, list(labels), lambda t: F.coalesce(*[F.when(t.contains(p), F.lit(v)) for p, v in labels.items()]))


def contains_any(text: Column, phrases: list[str]) -> Column:
    return F.coalesce(text.rlike(alternation(phrases)), F.lit(False))


def step_description(description: Column) -> Column:
    return F.coalesce(F.lower(F.btrim(description)).rlike(STEP_PATTERN), F.lit(False))


def generic_template(name: Column, description: Column) -> Column:
    """Number of the first of eight checks that takes the name for a template, null for a sound name.

    Over a table, with_template costs less.
    """
    return _checks(norm_name(name), F.lower(F.btrim(F.coalesce(description, F.lit("")))), words_of(name))


def with_template(rows: DataFrame, column: str, name: str = "name", description: str = "description") -> DataFrame:
    """rows with generic_template in a column; text is made ready once for each row, not once for each check."""
    low = rows.withColumns({"__norm": norm_name(F.col(name)), "__said": F.lower(F.btrim(F.coalesce(description, F.lit("")))), "__words": words_of(F.col(name))})
    return low.withColumn(column, _checks(F.col("__norm"), F.col("__said"), F.col("__words"))).drop("__norm", "__said", "__words")


def _checks(low: Column, said: Column, words: Column) -> Column:
    verb, rest = F.get(words, F.lit(0)), F.array_join(F.slice(words, 2, 1_000_000), " ")
    noun, n = F.get(words, F.lit(1)), F.size(words)
    checks = [
        said.startswith("step") & said.rlike(STEP_PATTERN),
        match_rules(low, VAGUE_ACTION_PATTERNS).isNotNull(),
        match_rules(low, CONFUSING_PATTERNS).isNotNull(),
        verb.isin(NON_PHYSICAL_VERBS),
        contains_any(low, OVERSPECIFIC_MODIFIERS),
        (n == 2) & verb.isin(sorted({*GENERIC_VERBS, *VAGUE_VERBS})) & noun.isin(GENERIC_NOUNS),
        (n >= 2) & verb.isin(VAGUE_VERBS) & contains_any(rest, ABSTRACT_NOUNS),
        (said != "") & (F.length(said) < 20) & (said.contains(low) | low.contains(said)),
    ]
    return F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(checks, 1)])


def value_action(lowered: Column) -> Column:
    premium = [p for phrases in PREMIUM_PHRASES.values() for p in phrases]
    return F.when(match_rules(lowered, TRASH_PATTERNS).isNotNull(), "trash").when(contains_any(lowered, premium), "premium").when(contains_any(lowered, DEMONSTRATIONS), "demo").otherwise("default")


def value_total(action: Column) -> Column:
    total = lambda a: sum(s * w for s, w in zip(SCORES[a], WEIGHTS, strict=True))
    return F.coalesce(*[F.when(action == a, F.lit(total(a))) for a in SCORES])


def tier_of(total: Column) -> Column:
    return F.coalesce(*[F.when(total >= least, F.lit(t)) for t, least in TIERS])
