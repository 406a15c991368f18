"""Registered queries for requests where the forest has gaps, prompts by template, savings, feedback and stems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import rules as R
from grovespark.operators import gaps, lexicon, reports, requests, seeds
from grovespark.queries import _GENERIC, _WORDS, query
from grovespark.query_more import _ASKED, _LEXICON, _PRICED, _REJECTS, _lexicon, _rejects, _requests, _seed_tables, _table
from grovespark.sources.nodes_io import COMPLETION

_NAMES, _LINES, _GROUPS = 20, 30, 4


def _bullets(items: str, number: str) -> str:
    return f"array_to_string(list_transform({items}[1:{_NAMES}], lambda x: '  - ' || x), chr(10)) || CASE WHEN {number} > {_NAMES} THEN chr(10) || '  ...' ELSE '' END"


def _lines(items: str) -> str:
    return f"array_to_string({items}[1:{_LINES}], chr(10)) || CASE WHEN len({items}) > {_LINES} THEN chr(10) || '...' ELSE '' END"


@query(f""", ks AS (SELECT parent_id AS p, count(*) AS k, list(name ORDER BY name, id) AS l FROM n WHERE parent_id IS NOT NULL GROUP BY 1),
 hs AS (SELECT string_agg(category || ': ' || phrases, chr(10) ORDER BY category) AS hints FROM (SELECT category, array_to_string(list(phrase ORDER BY phrase)[1:8], ', ') AS phrases FROM (SELECT DISTINCT category, phrase FROM {_LEXICON}) GROUP BY 1 ORDER BY 1 LIMIT {_GROUPS})),
 ot AS (SELECT string_split(id, '/') AS s, name FROM n WHERE node_type <> 'atomic'),
 ol AS (SELECT s[1] AS d, list(repeat('  ', len(s) - 1) || name ORDER BY s) AS l FROM ot WHERE len(s) <= 3 GROUP BY 1),
 top AS (SELECT count(*) AS k, list(name ORDER BY name, id) AS l FROM n WHERE node_type = 'domain'),
 tree AS (SELECT list(repeat('  ', len(s) - 1) || name ORDER BY s) AS t FROM ot WHERE len(s) <= 2),
 rs AS (SELECT id, 'domain' AS kind, k AS n_children, 'Which tasks of the domain ' || name || ' are missing?' || chr(10) || 'It has ' || k || ':' || chr(10) || {_bullets('ks.l', 'k')} || chr(10) || chr(10) || 'Its tree:' || chr(10) || {_lines('ol.l')} AS prompt FROM n JOIN ks ON p = id JOIN ol ON d = id WHERE node_type = 'domain'
 UNION ALL SELECT id, 'sparse', k, 'Which parts of the task ' || name || ' are missing?' || chr(10) || 'It has ' || k || ':' || chr(10) || {_bullets('ks.l', 'k')} FROM n JOIN ks ON p = id WHERE node_type = 'task' AND k BETWEEN 1 AND 60
 UNION ALL SELECT NULL, 'missing', k, 'Which domains are missing?' || chr(10) || 'There are ' || k || ':' || chr(10) || {_bullets('top.l', 'k')} || chr(10) || chr(10) || 'The tree:' || chr(10) || {_lines('t')} FROM top, tree)
 SELECT id, kind, n_children, prompt || chr(10) || chr(10) || 'Kinds of action:' || chr(10) || hints AS prompt FROM rs, hs""")
def gap_requests(n):
    return gaps.gap_requests(n, lexicon.category_summary(_lexicon(n)), most=60, names=_NAMES, lines=_LINES, groups=_GROUPS)


_TEMPLATES = [("domain", "Name the tasks of {name}."), ("task", "Say when {name} ({id}) is done: before, after and throughout."), ("atomic", "State what must hold before {name}, and after it.\n{description}")]


@query("SELECT id, CASE node_type WHEN 'domain' THEN 'Name the tasks of ' || name || '.' WHEN 'task' THEN 'Say when ' || name || ' (' || id || ') is done: before, after and throughout.' WHEN 'atomic' THEN 'State what must hold before ' || name || ', and after it.' || chr(10) || coalesce(description, '') END AS prompt FROM n")
def template_prompts(n):
    templates = n.sparkSession.createDataFrame(_TEMPLATES, "kind string, template string")
    return gaps.rendered(n, templates, "node_type", ["name", "id", "description"]).select("id", "prompt")


@query(f"SELECT role, count(*) AS n_requests, count(*) FILTER (WHERE hit) AS n_cached, round(sum(CASE WHEN hit THEN 0 ELSE cost END), 6) AS spent, round(sum(CASE WHEN hit THEN cost ELSE 0 END), 6) AS saved FROM (SELECT role, key IN (SELECT key FROM {_ASKED} WHERE conv_id % 3 = 0) AS hit, (length(text) * pi + turn * po + conv_id * pt) / 1e6 AS cost FROM conversations JOIN {_ASKED} USING (conv_id) JOIN {_PRICED} ON k = conv_id % 4 WHERE text IS NOT NULL) GROUP BY role", forest=False)
def cache_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as requests; those whose key a conversation of every third id has are answered by the cache."""
    keys = _requests(spark, sf_dir)
    held = keys.where("conv_id % 3 = 0").select("key").distinct().withColumn("cached", F.lit(True))
    names = F.array(*[F.lit(m) for m, *_ in requests.PRICES])
    turns = _table(spark, sf_dir, "conversations").where("text is not null").join(keys, "conv_id").join(held, "key", "left")
    usage = turns.select("role", "cached", F.get(names, (F.col("conv_id") % 4).cast("int")).alias("model"), F.length("text").alias("tokens_in"), F.col("turn").alias("tokens_out"), F.col("conv_id").alias("tokens_thinking"))
    return gaps.cache_savings(usage, spark.createDataFrame(requests.PRICES, "model string, input double, output double, thinking double"), ["role"])


@query(f", rj AS (SELECT name, 'check ' || ({_GENERIC}) AS reason FROM (SELECT *, {_WORDS} AS w FROM n)), wd AS (SELECT unnest(regexp_split_to_array(lower(name), '\\s+')) AS item FROM rj WHERE reason IS NOT NULL) SELECT * FROM (SELECT 'word' AS kind, item, count(*) AS n FROM wd WHERE length(item) > 3 GROUP BY item ORDER BY n DESC, item LIMIT 10) UNION ALL SELECT * FROM (SELECT 'reason', reason, count(*) AS n FROM rj WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 10)")
def feedback_patterns(n):
    checked = R.with_template(n, "__check").where("__check is not null")
    return gaps.feedback_patterns(checked.withColumn("reason", F.concat(F.lit("check "), F.col("__check").cast("string"))), "name", "reason")


@query(f", lx AS (SELECT DISTINCT phrase, string_split(phrase, '_')[1] AS stem FROM {_LEXICON}) SELECT stem, count(*) OVER (PARTITION BY stem) AS n_variants, phrase FROM lx QUALIFY count(*) OVER (PARTITION BY stem) >= 3")
def verb_stem_members(n):
    return gaps.stem_members(_lexicon(n), "phrase")


@query("SELECT 'completed' AS metric, CAST(count(*) FILTER (WHERE coalesce(description, '') <> '' OR node_type = 'task') AS DOUBLE) AS value FROM n WHERE node_type <> 'domain' UNION ALL SELECT 'total', count(*) FROM n UNION ALL SELECT 'leaves', count(*) FROM n WHERE id NOT IN (SELECT parent_id FROM n WHERE parent_id IS NOT NULL)")
def publish_completed(n):
    """Descriptions stand for preconditions, names of tasks for postconditions; a domain has an invariant alone."""
    below = F.col("node_type") != "domain"
    parts = F.struct(F.when(below, F.col("description")).alias("preconditions"), F.when(F.col("node_type") == "task", F.col("name")).alias("postconditions"), F.col("name").alias("invariants"))
    return reports.publish_stats(n.withColumn("completion", parts.cast(COMPLETION))).where("metric in ('completed', 'total', 'leaves')")


@query(f"SELECT row_number() OVER (ORDER BY id) AS place, name, reasoning FROM (SELECT id, name, 'found ' || pattern AS reasoning FROM {_REJECTS} WHERE right(id, 1) <> '1' ORDER BY id LIMIT 20)")
def judge_reasonings(n):
    """The judge is silent on ids that end with 1."""
    said = F.when(~F.col("id").endswith("1"), F.concat(F.lit("found "), "pattern"))
    return reports.judge_reasonings(_rejects(n).withColumns({"reason": F.lit("llm_judge"), "reasoning": said}), "id")


@query("SELECT 'occupations' AS name, count(*) AS n FROM customer UNION ALL SELECT 'statements', count(*) FROM orders UNION ALL SELECT 'major_groups', count(DISTINCT c_nationkey) FROM customer UNION ALL SELECT 'life_tasks', coalesce(CAST(sum(k) AS BIGINT), 0) FROM (SELECT count(DISTINCT c_mktsegment) AS k FROM customer GROUP BY c_nationkey)", forest=False)
def seed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, occupations, statements = _seed_tables(spark, sf_dir)
    life = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("example_tasks"))
    return seeds.seed_counts({"occupations": occupations, "statements": statements}, {"major_groups": (occupations, "major_group")}, {"life_tasks": (life, "example_tasks")})
