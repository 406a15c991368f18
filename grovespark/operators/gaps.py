"""What to ask a model for where a forest has gaps: requests with bounded context, and prompts from a table of templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.operators.curate import first_per_group

_BREAK = "\n"


def _listed(items: Column, most: int) -> Column:
    """A line for each of the first items of an array, and a last line if it holds more."""
    lines = F.transform(F.slice(items, 1, most), lambda x: F.concat(F.lit("  - "), x))
    return F.array_join(F.concat(lines, F.when(F.size(items) > most, F.array(F.lit("  ..."))).otherwise(F.array().cast("array<string>"))), _BREAK)


def outlines(nodes: DataFrame, deepest: int, lines: int) -> DataFrame:
    """(domain, outline): the first lines of each domain's tree down to a depth (the domain's is 0), in pre-order of path
    segments, indented; `...` follows where it goes on. A domain gives at most lines + 1 rows of each task to the shuffle."""
    path = F.split("id", "/")
    shown = nodes.where(F.size(path) <= deepest + 1).select(path.alias("path"), F.concat(F.repeat(F.lit("  "), F.size(path) - 1), F.coalesce("name", F.lit(""))).alias("line"))
    few = first_per_group(shown.withColumn("domain", F.col("path")[0]), "domain", ["path", "line"], lines + 1)
    rows = few.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("path", "line"))).alias("l"))
    text = F.array_join(F.transform(F.slice("l", 1, lines), lambda x: x["line"]), _BREAK)
    return rows.select("domain", F.concat(text, F.when(F.size("l") > lines, "\n...").otherwise("")).alias("outline"))


def gap_requests(nodes: DataFrame, categories: DataFrame, least: int = 1, most: int = 4, names: int = 50, lines: int = 40, groups: int = 40) -> DataFrame:
    """(id, kind, n_children, prompt): a request for each domain, for each task with least to most children (`sparse`), and
    one, with a null id, for domains that are missing.

    A prompt names the first `names` children by (name, id). Those for domains show the first `lines` lines of the domain's
    tree, that for missing domains the first of all domains and tasks; each ends with the first `groups` of
    categories(category, phrases) by category. So prompts are bounded, while counts are of all. Domains without children
    are asked for; null names are empty. No nodes give the one request for missing domains.
    """
    named = nodes.withColumn("name", F.coalesce("name", F.lit("")))
    first = lambda df, key: first_per_group(df, key, ["child", "cid"], names + 1).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("child", "cid"))), lambda x: x["child"]).alias("l"))
    kids = named.where("parent_id is not null").select(F.col("parent_id").alias("__p"), F.col("name").alias("child"), F.col("id").alias("cid"))
    counts = kids.groupBy("__p").agg(F.count("*").alias("n_children")).join(first(kids, "__p"), "__p")
    asked = named.where(F.col("node_type").isin("domain", "task")).select("id", "name", "node_type").join(counts, F.col("id") == F.col("__p"), "left").drop("__p")
    asked = asked.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("l", F.coalesce("l", F.array().cast("array<string>")))
    kind = F.when(F.col("node_type") == "domain", "domain").when(F.col("n_children").between(least, most), "sparse")
    asked = asked.withColumn("kind", kind).where("kind is not null")

    # one row of at most `groups` lines
    hints = categories.orderBy("category").limit(groups).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category", "phrases"))), lambda x: F.concat(x["category"], F.lit(": "), x["phrases"])), _BREAK).alias("hints"))
    has = F.concat(F.lit("\nIt has "), F.col("n_children").cast("string"), F.lit(":\n"), _listed(F.col("l"), names))
    tail = F.concat(F.lit("\n\nKinds of action:\n"), "hints")
    domains = asked.where("kind = 'domain'").join(outlines(named, 2, lines), F.col("id") == F.col("domain"), "left")
    domains = domains.select("id", "kind", "n_children", F.concat(F.lit("Which tasks of the domain "), "name", F.lit(" are missing?"), has, F.lit("\n\nIts tree:\n"), F.coalesce("outline", F.lit(""))).alias("prompt"))
    sparse = asked.where("kind = 'sparse'").select("id", "kind", "n_children", F.concat(F.lit("Which parts of the task "), "name", F.lit(" are missing?"), has).alias("prompt"))

    tops = named.where("node_type = 'domain'").select("name", "id")
    number = tops.agg(F.count("*").alias("n_children"))
    known = tops.orderBy("name", "id").limit(names + 1).agg(F.transform(F.array_sort(F.collect_list(F.struct("name", "id"))), lambda x: x["name"]).alias("l"))
    path = F.split("id", "/")
    head = named.where(F.size(path) <= 2).select(path.alias("path"), F.concat(F.repeat(F.lit("  "), F.size(path) - 1), "name").alias("line")).orderBy("path", "line").limit(lines + 1)
    tree = head.agg(F.array_sort(F.collect_list(F.struct("path", "line"))).alias("t"))
    shown = F.concat(F.array_join(F.transform(F.slice("t", 1, lines), lambda x: x["line"]), _BREAK), F.when(F.size("t") > lines, "\n...").otherwise(""))
    whole = F.concat(F.lit("Which domains are missing?\nThere are "), F.col("n_children").cast("string"), F.lit(":\n"), _listed(F.col("l"), names), F.lit("\n\nThe tree:\n"), shown)
    missing = number.join(F.broadcast(known)).join(F.broadcast(tree)).select(F.lit(None).cast("string").alias("id"), F.lit("missing").alias("kind"), "n_children", whole.alias("prompt"))
    rows = domains.unionByName(sparse).unionByName(missing)
    return rows.join(F.broadcast(hints)).select("id", "kind", "n_children", F.concat("prompt", tail).alias("prompt"))


def rendered(rows: DataFrame, templates: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """rows with prompt: the template(kind, template) of the row's kind with each {column} replaced by its value, once, so
    that a value which looks like a place is left as it is. Nulls are empty; a kind without a template gives a null prompt,
    a kind with several the least one. Templates go to every task, so rows stay where they are: most are of one kind."""
    one = templates.groupBy(F.col("kind").alias("__k")).agg(F.min("template").alias("__t"))
    value = lambda part: F.coalesce(*[F.when(part == F.lit(f"{{{c}}}"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns], part)
    parts = F.split("__t", r"(?=\{)|(?<=\})")
    return rows.join(F.broadcast(one), F.col(kind) == F.col("__k"), "left").withColumn("prompt", F.array_join(F.transform(parts, value), "")).drop("__k", "__t")


def cache_savings(usage: DataFrame, prices: DataFrame, by: list[str]) -> DataFrame:
    """(by, n_requests, n_cached, spent, saved) of usage(model, cached, tokens_in, tokens_out, tokens_thinking): what the
    requests cost that went out, and what those would have cost that a cache answered. Unknown models cost nothing, a null
    `cached` went out. Tokens are summed by model before they meet the prices."""
    hit = F.coalesce("cached", F.lit(False))
    summed = usage.groupBy(*by, "model").agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"), *[F.sum(F.when(hit == held, F.col(f"tokens_{k}")).otherwise(0)).alias(f"{k}_{held}") for k in ("in", "out", "thinking") for held in (True, False)])
    priced = summed.join(prices.select("model", F.col("input").alias("__in"), F.col("output").alias("__out"), F.col("thinking").alias("__thinking")), "model", "left")
    cost = lambda held: F.round(F.sum(F.coalesce(sum(F.col(f"{k}_{held}") * F.col(f"__{k}") for k in ("in", "out", "thinking")) / 1e6, F.lit(0.0))), 6)
    return priced.groupBy(*by).agg(F.sum("n").alias("n_requests"), F.sum("hits").alias("n_cached"), cost(False).alias("spent"), cost(True).alias("saved"))


def feedback_patterns(rejected: DataFrame, name: str, reason: str, top: int = 10, longer: int = 3) -> DataFrame:
    """(kind, item, n): the commonest words of rejected names that have more than `longer` characters, and the commonest
    reasons; ties go to the lesser item. Null names and reasons count for nothing."""
    words = rejected.select(F.explode(F.split(F.lower(name), r"\s+")).alias("item")).where(F.length("item") > longer)
    reasons = rejected.select(F.col(reason).alias("item")).where("item is not null")
    best = lambda df, kind: df.groupBy("item").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(top).select(F.lit(kind).alias("kind"), "item", "n")
    return best(words, "word").unionByName(best(reasons, "reason"))


def stem_members(phrases: DataFrame, column: str, least: int = 3) -> DataFrame:
    """(stem, n_variants, phrase): each distinct phrase of the stems (text before the first underscore) that have at least so
    many. A row for each phrase, so that a stem of very many phrases is never one row."""
    distinct = phrases.select(F.col(column).alias("phrase")).where("phrase is not null").distinct().withColumn("stem", F.substring_index("phrase", "_", 1))
    common = distinct.groupBy("stem").agg(F.count("*").alias("n_variants")).where(F.col("n_variants") >= least)
    return distinct.join(common, "stem").select("stem", "n_variants", "phrase")
