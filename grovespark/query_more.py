"""Registered queries: rule families, curation, seeds, walks of the tree, lexicon and request reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import families as W
from grovespark.functions import rules as R
from grovespark.functions import text as T
from grovespark.operators import curate, decisions, judging, lexicon, reports, requests, responses, seeds, tree
from grovespark.queries import _GENERIC, _WORDS, _any, _in, _quoted, _TRASH_FIRST, query
from grovespark.sources import nodes_io

_WORD1 = r"regexp_replace(regexp_split_to_array(lower(name), '[\s,.(]')[1], '[^a-z_]', '', 'g')"
_TYPES = "(VALUES ('domain'),('task'),('subtask'),('atomic'))"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _matches(text: str, pattern: str) -> str:
    """RE2 has no negative lookahead: a(?!b) is written as a, and not a before b."""
    if "(?!" in pattern:
        head, rest = pattern[:-1].split("(?!")
        return f"(regexp_matches({text}, '{head}') AND NOT regexp_matches({text}, '{head}{rest}'))"
    return f"regexp_matches({text}, '{_quoted(pattern)}')"


def _first(text: str, patterns: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {_matches(text, p)} THEN '{_quoted(p)}'" for p in patterns) + " END"


def _phrase(text: str, phrases: list[str]) -> str:
    return f"regexp_matches({text}, '^({'|'.join(phrases)})( |$)')"


_LOW = "translate(lower(name), '_-', '  ')"
_BAD = _first("lower(name)", W.ALL_BAD)
_INTERNAL = _first("lower(name)", W.ROBOT_INTERNAL)
_COGNITIVE = _phrase(_LOW, W.COGNITIVE_VERBS)
_VERDICT = f"CASE WHEN ({_INTERNAL}) IS NOT NULL THEN 'robot_internal:' || ({_INTERNAL}) WHEN ({_GENERIC}) IS NOT NULL THEN 'generic_template' WHEN {_COGNITIVE} THEN 'cognitive_verb' ELSE 'ok' END"
_LEXICON = "(SELECT string_split(id,'/')[1] AS category, CASE WHEN node_type = 'atomic' THEN regexp_replace(lower(name), ' ', '_') ELSE lower(name) END AS phrase FROM n WHERE node_type IN ('atomic','subtask'))"


def _lexicon(n: DataFrame) -> DataFrame:
    """Raw lexicon rows (category, phrase): atomic names in snake form, names of the levels above as they stand."""
    phrase = F.when(F.col("node_type") == "atomic", F.regexp_replace(F.lower("name"), " ", "_", )).otherwise(F.lower("name"))
    first = F.when(F.col("node_type") == "atomic", F.expr("concat(substring_index(lower(name), ' ', 1), if(instr(name, ' ') > 0, concat('_', substring(lower(name), instr(name, ' ') + 1)), ''))")).otherwise(phrase)
    return n.where("node_type in ('atomic', 'subtask')").select(T.domain_of(F.col("id")).alias("category"), first.alias("phrase"))


@query(f"SELECT id, pattern FROM (SELECT id, {_INTERNAL} AS pattern FROM n) WHERE pattern IS NOT NULL")
def robot_internal(n):
    return W.matched(n.select("id", "name"), W.rule_table(n.sparkSession), "robot_internal", F.col("name")).where("pattern is not null").select("id", "pattern")


@query(f"SELECT id, pattern FROM (SELECT id, {_BAD} AS pattern FROM n) WHERE pattern IS NOT NULL")
def bad_name(n):
    return n.select("id", judging.bad_pattern(F.col("name")).alias("pattern")).where("pattern is not null")


@query(f"SELECT id FROM n WHERE {_COGNITIVE}")
def cognitive_verb(n):
    return n.where(judging.cognitive_verb(F.col("name"))).select("id")


@query(f"SELECT id FROM n WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT lower(p_name) AS p FROM part) WHERE starts_with({_LOW}, 'paint ' || p) OR starts_with({_LOW}, 'wash ' || p))")
def valid_atomic(n):
    # the lexicon is a table: two verbs, each with every part name
    names = _table_of(n, "part").select(F.lower("p_name").alias("p")).distinct()
    phrases = names.select(F.explode(F.array(F.concat(F.lit("paint_"), "p"), F.concat(F.lit("wash_"), "p"))).alias("phrase"))
    return judging.valid_atomic(n, phrases, most_words=3).select("id")


def _table_of(n: DataFrame, name: str) -> DataFrame:
    from grovespark.plans.forest import directory_of

    return _table(n.sparkSession, directory_of(n), name)


@query(f"SELECT id FROM n WHERE {_phrase('trim(' + _LOW + ')', W.OBVIOUS_ATOMIC_VERBS)} AND len(regexp_split_to_array(trim({_LOW}), '\\s+')) <= 4")
def obvious_atomic(n):
    return n.where(judging.obvious_atomic(F.col("name"))).select("id")


@query(f"SELECT id, {_VERDICT} AS verdict FROM (SELECT *, {_WORDS} AS w FROM n) WHERE node_type = 'atomic'")
def validate_name(n):
    return judging.validated(n.where("node_type = 'atomic'")).select("id", "verdict")


@query(f"SELECT id, string_split(v, ':')[1] AS reason, CASE WHEN contains(v, ':') THEN substr(v, strpos(v, ':') + 1) END AS pattern, parent_id AS parent_context FROM (SELECT id, parent_id, {_VERDICT} AS v FROM (SELECT *, {_WORDS} AS w FROM n)) WHERE v <> 'ok'")
def regex_judge(n):
    return judging.reject_records(n).select("id", "reason", "pattern", "parent_context")


_VERB_SIGN = "CASE " + " ".join(f"WHEN starts_with(lower(name), '{v}') OR contains(lower(name), ' {v} ') THEN 'verb:{v}'" for v in W.MANIPULATION_VERBS) + " END"
_TOOL_SIGN = "CASE " + " ".join(f"WHEN contains(lower(name), '{t}') THEN 'tool:{t}'" for t in W.TOOL_PHRASES) + " END"
_THING_SIGN = f"CASE WHEN {' OR '.join(_matches('lower(name)', p) for p in W.SPECIFIC_OBJECTS)} THEN 'object' END"
_SIGNS = f"list_filter([{_VERB_SIGN}, {_TOOL_SIGN}, {_THING_SIGN}], lambda x: x IS NOT NULL)"
_QUALITY = f"SELECT id, node_type, name, CASE WHEN bad IS NOT NULL THEN 'BAD' WHEN len(signs) > 0 THEN 'GOOD' ELSE 'UNCERTAIN' END AS quality, CASE WHEN bad IS NOT NULL THEN 0.0 WHEN len(signs) > 0 THEN len(signs)::DOUBLE ELSE 0.5 END AS score FROM (SELECT *, {_BAD} AS bad, {_SIGNS} AS signs FROM n)"


@query(f"SELECT id, array_to_string(signs, ',') AS signs FROM (SELECT id, {_SIGNS} AS signs FROM n) WHERE len(signs) > 0")
def good_indicators(n):
    return n.select("id", judging.good_signs(F.col("name")).alias("s")).where(F.size("s") > 0).select("id", F.array_join("s", ",").alias("signs"))


@query(f"SELECT id, quality, CAST(score AS DOUBLE) AS score FROM ({_QUALITY})")
def quality_label(n):
    return judging.quality_label(n).select("id", "quality", "score")


@query(f"SELECT quality AS verdict, count(*) AS n_nodes, CAST(floor(100.0 * count(*) / sum(count(*)) OVER ()) AS BIGINT) AS pct FROM ({_QUALITY}) WHERE node_type = 'atomic' AND starts_with(id, 'a') GROUP BY 1")
def label_report(n):
    chosen = n.where((F.col("node_type") == "atomic") & F.col("id").startswith("a"))
    return reports.shares(judging.quality_label(chosen).select(F.col("quality").alias("verdict")), "verdict", "n_nodes")


@query(f"SELECT id FROM n WHERE node_type = 'atomic' AND NOT {_any('lower(name)', W.MANIPULATION_VERBS)}")
def lacks_good_verb(n):
    return n.where((F.col("node_type") == "atomic") & judging.lacks_good_verb(F.col("name"))).select("id")


@query(f"SELECT issue, count(*) AS n_nodes FROM (SELECT unnest(list_filter([{', '.join(f'CASE WHEN {_matches(chr(108) + chr(111) + chr(119), p)} THEN {chr(39)}{_quoted(p)}{chr(39)} END' for p in W.ALL_BAD)}, CASE WHEN node_type = 'atomic' AND NOT {_any('low', W.MANIPULATION_VERBS)} THEN 'lacks manipulation verb' END], lambda x: x IS NOT NULL)) AS issue FROM (SELECT *, lower(name) AS low FROM n)) GROUP BY 1")
def assess_issues(n):
    return judging.issues(n).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n_nodes"))


@query(f"SELECT verb, count(*) AS n_nodes, CASE WHEN verb IN {_in(W.REVIEW_COGNITIVE)} THEN 'cognitive' WHEN verb IN {_in(W.REVIEW_PHYSICAL)} THEN 'physical' ELSE 'ambiguous' END AS class FROM (SELECT {_WORD1} AS verb FROM n) WHERE length(verb) > 1 GROUP BY verb")
def verb_class(n):
    verbs = n.select(T.first_verb(F.col("name")).alias("verb")).where("verb is not null").groupBy("verb").agg(F.count("*").alias("n_nodes"))
    return verbs.withColumn("class", judging.verb_class(F.col("verb")))


@query(f"SELECT verb, n_nodes, class, sample FROM (SELECT verb, count(*) AS n_nodes, array_to_string(list_sort(list(id))[1:5], ',') AS sample, CASE WHEN verb IN {_in(W.REVIEW_COGNITIVE)} THEN 'cognitive' WHEN verb IN {_in(W.REVIEW_PHYSICAL)} THEN 'physical' ELSE 'ambiguous' END AS class FROM (SELECT id, {_WORD1} AS verb FROM n WHERE node_type = 'atomic') WHERE length(verb) > 1 GROUP BY verb)")
def verb_groups(n):
    return judging.verb_groups(n.where("node_type = 'atomic'")).select("verb", "n_nodes", "class", F.array_join("sample", ",").alias("sample"))


_PHYS = "(" + " OR ".join(f"starts_with(l, '{v}') OR contains(l, ' {v} ') OR contains(l, '_{v}')" for v in W.SPLIT_PHYSICAL) + ")"
_COGN = "(" + " OR ".join(f"starts_with(l, '{v}')" for v in W.SPLIT_COGNITIVE) + ")"


@query(f"SELECT id, name, parent_id, CASE WHEN c THEN 'cognitive' ELSE 'ambiguous' END AS side FROM (SELECT *, {_PHYS} AS p, {_COGN} AS c FROM (SELECT *, lower(name) AS l FROM n WHERE node_type = 'atomic')) WHERE NOT p")
def curate_split(n):
    return judging.curate_split(n)


_PREMIUM = "CASE " + " ".join(f"WHEN contains(lower(name), '{p}') THEN 'Premium: {k} - {p}'" for k, v in R.PREMIUM_PHRASES.items() for p in v) + " END"
_DEMO = "CASE " + " ".join(f"WHEN contains(lower(name), '{p}') THEN 'Impressive demo: {p}'" for p in R.DEMONSTRATIONS) + " END"
_ACT = "CASE split_part(reasoning, ':', 1) WHEN 'Trash' THEN 'trash' WHEN 'Premium' THEN 'premium' WHEN 'Impressive demo' THEN 'demo' ELSE 'default' END"
_SCORED = f"SELECT id, s[1] AS market, s[2] AS impressiveness, s[3] AS utility, s[4] AS difficulty, s[5] AS generality, s[1]*3+s[2]*3+s[3]*2+s[4]+s[5] AS total, reasoning FROM (SELECT *, CASE {_ACT} " + " ".join(f"WHEN '{a}' THEN {list(v)}" for a, v in R.SCORES.items()) + f" END AS s FROM (SELECT id, coalesce('Trash: matches pattern ''' || ({_TRASH_FIRST}) || '''', {_PREMIUM}, {_DEMO}, 'Needs manual review') AS reasoning FROM n WHERE node_type <> 'domain'))"
_TIER = "CASE WHEN total >= 80 THEN 'PREMIUM' WHEN total >= 60 THEN 'HIGH' WHEN total >= 40 THEN 'MEDIUM' WHEN total >= 20 THEN 'LOW' ELSE 'TRASH' END"


@query(f"SELECT *, {_TIER} AS tier FROM ({_SCORED})")
def score_value(n):
    return judging.value_scores(n.where("node_type <> 'domain'"))


@query(f"SELECT tier, id, total FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY total DESC, id) AS r FROM (SELECT id, total, {_TIER} AS tier FROM ({_SCORED}))) WHERE r <= 100")
def sort_tier(n):
    scored = judging.value_scores(n.where("node_type <> 'domain'"))
    return curate.first_per_group(scored.select("tier", "id", "total"), "tier", [F.desc("total"), "id"], 100)


@query("SELECT id, CASE WHEN starts_with(id, 'a') THEN 'work' WHEN starts_with(id, 'e') THEN 'life' END AS kind FROM n WHERE node_type = 'domain'")
def domain_kind(n):
    return n.where("node_type = 'domain'").select("id", judging.domain_kind(F.col("id"), {"a": "work", "e": "life"}).alias("kind"))


@query("SELECT id, name FROM n WHERE node_type = 'domain' AND contains(lower(trim(name)), 'a')")
def domain_filter(n):
    return judging.domains_named(n, "a").select("id", "name")


@query(f"SELECT id, name FROM n WHERE node_type <> 'domain' AND contains(lower(name), 'small') AND ({_TRASH_FIRST}) IS NULL ORDER BY id LIMIT 200")
def search_bucket(n):
    kept = n.where((F.col("node_type") != "domain") & F.lower("name").contains("small"))
    return kept.where(R.match_rules(F.lower("name"), R.TRASH_PATTERNS).isNull()).orderBy("id").limit(200).select("id", "name")


@query(f"SELECT id, {_WORD1} AS verb FROM n WHERE node_type IN ('atomic','subtask','task') AND {_WORD1} IN ('paint','wash')")
def verb_selected(n):
    verbs = n.sparkSession.createDataFrame([("Paint",), ("wash",)], "verb string")
    return decisions.verb_selected(n, verbs)


# ratings: the events of a user are ratings of the customer node with that number
_RATINGS = "(SELECT c.id, e.event_type AS tier, e.ts, e.event_id AS tie FROM events e JOIN (SELECT id, CAST(split_part(id, 'customer_', 2) AS BIGINT) AS k FROM n WHERE len(string_split(id,'/')) = 3) c ON c.k = e.user_id)"
_LAST = f"(SELECT id, arg_max(tier, (ts, tie)) AS rating FROM {_RATINGS} GROUP BY id)"


def _ratings(n: DataFrame) -> DataFrame:
    people = n.where(F.size(F.split("id", "/")) == 3).select("id", F.substring_index("id", "customer_", -1).cast("long").alias("user_id"))
    return _table_of(n, "events").join(people, "user_id").select("id", F.col("event_type").alias("tier"), "ts", F.col("event_id").alias("tie"))


@query(f"SELECT id, any_value(name) AS name, any_value(rating) AS rating FROM (SELECT id, name, NULL AS rating FROM n UNION ALL SELECT id, NULL, rating FROM {_LAST}) GROUP BY id HAVING any_value(rating) IS NOT NULL AND any_value(name) IS NOT NULL")
def export_decisions(n):
    return decisions.export_decisions(n, _ratings(n))[0]


@query(f"SELECT rating, count(*) AS n_nodes FROM {_LAST} GROUP BY rating")
def decision_counts(n):
    return decisions.export_decisions(n, _ratings(n))[1]


@query(f"SELECT string_split(n.id,'/')[1] AS domain, n.id, name, coalesce(k, 0) AS n_children, rating FROM n LEFT JOIN {_LAST} l ON l.id = n.id LEFT JOIN (SELECT parent_id AS p, count(*) AS k FROM n GROUP BY 1) ON p = n.id WHERE node_type = 'subtask'")
def review_tree(n):
    return decisions.review_tree(n, _ratings(n), "subtask")


@query(f"SELECT id FROM n WHERE node_type = 'subtask' AND len(string_split(id,'/')) = 3 AND NOT EXISTS (SELECT 1 FROM {_RATINGS} r WHERE r.id = n.id)")
def exclude_seen(n):
    return curate.exclude_seen(n.where((F.col("node_type") == "subtask") & (F.size(F.split("id", "/")) == 3)), _ratings(n), "id").select("id")


@query("SELECT DISTINCT 'europe/' || lower(n_name) AS id FROM nation WHERE EXISTS (SELECT 1 FROM n WHERE n.id = 'europe/' || lower(n_name))")
def matching_ids(n):
    ids = _table_of(n, "nation").select(F.concat(F.lit("europe/"), F.lower("n_name")).alias("id"))
    return decisions.matching_ids(ids, n).distinct()


_MOVES = "(SELECT id, arg_max({0}, (ts, tie)) AS v FROM (SELECT id, ts, tie, CASE WHEN tie % 2 = 0 THEN 'trainable' ELSE 'archived' END AS f, CASE WHEN tie % 3 = 0 THEN 'ambiguous' ELSE 'archived' END AS t FROM " + _RATINGS + ") GROUP BY id)"


@query(f"SELECT id, CASE WHEN f = b THEN t ELSE b END AS bucket, CASE WHEN f = b AND t = 'archived' THEN 'Manually archived: ' || regexp_split_to_array(lower(name), '[\\s,.(]')[1] END AS reason, coalesce(f = b, false) AS moved, coalesce(f <> b, false) AS wrong_source FROM (SELECT id, any_value(name) AS name, any_value(b) AS b, any_value(f) AS f, any_value(t) AS t FROM (SELECT id, name, CASE WHEN ({_TRASH_FIRST}) IS NULL THEN 'trainable' ELSE 'archived' END AS b, NULL AS f, NULL AS t FROM n UNION ALL SELECT id, NULL, NULL, v, NULL FROM {_MOVES.format('f')} UNION ALL SELECT id, NULL, NULL, NULL, v FROM {_MOVES.format('t')}) GROUP BY id)")
def bucket_move(n):
    placed = n.withColumn("bucket", F.when(R.match_rules(F.lower("name"), R.TRASH_PATTERNS).isNull(), "trainable").otherwise("archived"))
    moves = _ratings(n).withColumn("from", F.when(F.col("tie") % 2 == 0, "trainable").otherwise("archived")).withColumn("to", F.when(F.col("tie") % 3 == 0, "ambiguous").otherwise("archived"))
    return decisions.bucket_move(placed, moves)


@query("SELECT user_id, CASE WHEN e % 2 = 0 THEN 'keep' ELSE 'remove' END AS decision FROM (SELECT user_id, arg_max(event_id, (ts, event_id)) AS e FROM events GROUP BY 1)", forest=False)
def mark_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _table(spark, sf_dir, "events").withColumn("decision", F.when(F.col("event_id") % 2 == 0, "keep").otherwise("remove"))
    return decisions.marks(log, "user_id", "decision", "ts", "event_id")


@query(f"SELECT id, CASE WHEN o IS NULL OR (v IS NOT NULL AND (v.ts, v.d) > (o.ts, o.d)) THEN v.d ELSE o.d END AS decision FROM (SELECT n.id, v, o FROM (SELECT id, {_WORD1} AS verb FROM n) n LEFT JOIN (SELECT 'household' AS verb, {{'ts': TIMESTAMP '2024-01-10', 'd': 'remove'}} AS v) USING (verb) LEFT JOIN (SELECT id, max({{'ts': ts, 'd': tier}}) AS o FROM {_RATINGS} GROUP BY id) r ON r.id = n.id) WHERE v IS NOT NULL OR o IS NOT NULL")
def bulk_decision(n):
    by_verb = n.sparkSession.sql("SELECT 'household' AS verb, 'remove' AS decision, TIMESTAMP_NTZ '2024-01-10 00:00:00' AS ts")
    own = _ratings(n).select("id", F.col("tier").alias("decision"), "ts")
    return decisions.bulk_decisions(n, by_verb.withColumn("ts", F.col("ts").cast(own.schema["ts"].dataType)), own)


@query(f"SELECT category, count(DISTINCT id) AS n_ids FROM (SELECT id, string_split(id,'/')[1] AS category FROM n WHERE {_WORD1} IN ('paint','wash')) GROUP BY 1")
def removal_categories(n):
    verbs = n.sparkSession.createDataFrame([("paint",), ("wash",)], "verb string")
    return decisions.removal_categories(decisions.verb_selected(n, verbs), n, T.domain_of(F.col("id")))


# seeds: nations are the domains, customers the occupations, orders the task statements
@query(r"""SELECT id, parent_id, node_type, name, tags FROM (
 SELECT 'work_' || lower(n_name) AS id, NULL AS parent_id, 'domain' AS node_type, n_name AS name, '' AS tags FROM nation
 UNION ALL SELECT 'work_' || lower(n_name) || '/' || replace(lower(c_name), '#', ''), 'work_' || lower(n_name), 'task', c_name, '' FROM customer JOIN nation ON n_nationkey = c_nationkey
 UNION ALL SELECT 'work_' || lower(n_name) || '/' || replace(lower(c_name), '#', '') || '/' || regexp_replace(lower(o_orderpriority), '[- ]+', '_', 'g') || '_' || o_orderkey, 'work_' || lower(n_name) || '/' || replace(lower(c_name), '#', ''), 'atomic', o_orderpriority || ' ' || o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 'core' ELSE 'supplemental' END || ',onet_task' FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)""", forest=False)
def bootstrap_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains, occupations, statements = _seed_tables(spark, sf_dir)
    return seeds.bootstrap_forest(domains, occupations, statements).select("id", "parent_id", "node_type", "name", F.array_join("tags", ",").alias("tags"))


def _seed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    domains = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.concat(F.lit("work_"), F.lower("n_name")).alias("id"), F.col("n_name").alias("name"))
    occupations = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("description"), F.col("c_nationkey").cast("string").alias("major_group"))
    statements = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), F.col("o_custkey").cast("string").alias("occupation_code"), F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("task"), F.when(F.col("o_orderstatus") == "F", "Core").otherwise("Supplemental").alias("task_type"))
    return domains, occupations, statements


@query(r"""WITH c AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)
 SELECT 'life_' || lower(r_name) AS id, NULL AS parent_id, 'domain' AS node_type FROM region
 UNION ALL SELECT 'life_' || lower(r_name) || '/' || lower(n_name), 'life_' || lower(r_name), 'task' FROM nation JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT 'life_' || lower(r_name) || '/' || lower(n_name) || '/' || lower(c_mktsegment), 'life_' || lower(r_name) || '/' || lower(n_name), 'subtask' FROM c JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""", forest=False)
def bootstrap_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = _table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit("life_"), F.lower("r_name")).alias("id"), F.col("r_name").alias("name"))
    examples = _table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct().groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_mktsegment")).alias("example_tasks"))
    nations = _table(spark, sf_dir, "nation").join(examples, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(domains.select("r_regionkey", F.col("id").alias("domain_id")), F.col("n_regionkey") == F.col("r_regionkey"))
    categories = nations.select(F.col("n_nationkey").cast("string").alias("code"), "domain_id", F.col("n_name").alias("name"), F.lit("").alias("description"), "example_tasks")
    return seeds.bootstrap_life(domains, categories).select("id", "parent_id", "node_type")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS task_id FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 3", forest=False)
def tasks_for_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, occupations, statements = _seed_tables(spark, sf_dir)
    return seeds.tasks_for_occupation(statements, seeds.occupations_by_group(occupations, "3")).select("task_id")


@query("SELECT r_regionkey AS gwa_id, n_nationkey AS iwa_id, count(*) AS n_dwas FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2", forest=False)
def dwas_for_iwa(spark: SparkSession, sf_dir: str) -> DataFrame:
    general = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("gwa_id"))
    middle = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("iwa_id"), F.col("n_regionkey").alias("gwa_id"))
    detailed = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("dwa_id"), F.col("c_nationkey").alias("iwa_id"))
    return seeds.activities_below(general, middle, detailed).groupBy("gwa_id", "iwa_id").agg(F.count("*").alias("n_dwas"))


@query("SELECT 'domains' AS \"table\", count(*) AS n_rows FROM nation UNION ALL SELECT 'occupations', count(*) FROM customer UNION ALL SELECT 'statements', count(*) FROM orders", forest=False)
def seed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.seed_stats(dict(zip(("domains", "occupations", "statements"), _seed_tables(spark, sf_dir), strict=True)))


_KEPT = "(SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM n b WHERE contains(lower(b.name), 'building') AND b.node_type = 'subtask' AND (b.id = n.id OR b.id = n.parent_id OR b.id = array_to_string(string_split(n.id,'/')[1:3], '/'))))"


@query(f"SELECT k.id, coalesce(c, 0)::INT AS n_children FROM {_KEPT} k LEFT JOIN (SELECT parent_id AS p, count(*) AS c FROM {_KEPT} GROUP BY 1) ON p = k.id")
def prune(n):
    return tree.prune(n, (F.col("node_type") == "subtask") & F.lower("name").contains("building")).select("id", F.size("children_ids").alias("n_children"))


@query("SELECT id, CASE WHEN d = 3 THEN 'atomic' ELSE node_type END AS node_type, CASE WHEN d = 3 THEN 0 ELSE coalesce(c, 0) END::INT AS n_children FROM (SELECT *, len(string_split(id,'/'))-1 AS d FROM n) LEFT JOIN (SELECT parent_id AS p, count(*) AS c FROM n GROUP BY 1) ON p = id WHERE d <= 3")
def fix_depth(n):
    return tree.fix_depth(n, 3).select("id", "node_type", F.size("children_ids").alias("n_children"))


@query("SELECT id, len(string_split(id,'/'))-1 AS depth, string_split(id,'/')[1] AS root FROM n")
def paths(n):
    return tree.paths(n).select("id", F.col("depth").cast("long").alias("depth"), "root")


@query("SELECT id FROM n ORDER BY len(string_split(id,'/')), id LIMIT 1000")
def bfs_order(n):
    return tree.bfs_order(n.select("id"), 1000)


@query("SELECT id, row_number() OVER (ORDER BY string_split(id,'/')) - 1 AS position FROM n")
def dfs_order(n):
    return tree.dfs_order(n)


@query("SELECT id, row_number() OVER (ORDER BY string_split(id,'/')[1], lower(name), id) AS position FROM n WHERE node_type = 'task'")
def sort_tree(n):
    from pyspark.sql import Window

    # the task level is a few rows for each domain; ranks are worked out within domains and shifted by what is before
    tasks = n.where("node_type = 'task'").select("id", T.domain_of(F.col("id")).alias("d"), F.lower("name").alias("l"))
    counts = tasks.groupBy("d").agg(F.count("*").alias("k"))
    before = counts.select("d", F.coalesce(F.sum("k").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    return tasks.join(before, "d").select("id", (F.row_number().over(Window.partitionBy("d").orderBy("l", "id")) + F.col("b")).cast("long").alias("position"))


_SHOWN = "(SELECT *, id = max(id) OVER (PARTITION BY coalesce(parent_id, '')) AS is_last FROM n WHERE len(string_split(id,'/')) <= 3)"


@query(f"SELECT s.id, coalesce(CASE WHEN b.is_last THEN '    ' WHEN b.id IS NOT NULL THEN '│   ' END, '') || coalesce(CASE WHEN a.is_last THEN '    ' WHEN a.id IS NOT NULL THEN '│   ' END, '') || CASE WHEN s.is_last THEN '└── ' ELSE '├── ' END || s.name || ' [' || s.node_type || ']' AS line FROM {_SHOWN} s LEFT JOIN {_SHOWN} a ON a.id = s.parent_id LEFT JOIN {_SHOWN} b ON b.id = a.parent_id")
def tree_text(n):
    return tree.tree_lines(n, 2).select(F.array_join("path", "/").alias("id"), "line")


def _json_sql(alias: str, kids: str) -> str:
    return f"'{{\"id\":' || to_json({alias}.id)::VARCHAR || ',\"name\":' || to_json({alias}.name)::VARCHAR || ',\"node_type\":' || to_json({alias}.node_type)::VARCHAR || ',\"children\":[' || {kids} || ']}}'"


@query(f", l4 AS (SELECT a.parent_id AS p, string_agg({_json_sql('a', chr(39) * 2)}, ',' ORDER BY a.id) AS k FROM n a WHERE node_type = 'atomic' GROUP BY 1), l3 AS (SELECT o.parent_id AS p, string_agg({_json_sql('o', 'coalesce(l4.k, ' + chr(39) * 2 + ')')}, ',' ORDER BY o.id) AS k FROM n o LEFT JOIN l4 ON l4.p = o.id WHERE len(string_split(o.id,'/')) = 4 GROUP BY 1) SELECT c.id, {_json_sql('c', 'coalesce(l3.k, ' + chr(39) * 2 + ')')} AS json FROM n c LEFT JOIN l3 ON l3.p = c.id WHERE len(string_split(c.id,'/')) = 3")
def export_nested(n):
    return tree.nested_json(n, 2, 4)


@query("SELECT id, name, node_type, parent_id, coalesce(k, '') AS children FROM n LEFT JOIN (SELECT parent_id AS p, string_agg(id, ',' ORDER BY id) AS k FROM n GROUP BY 1) ON p = id")
def export_light(n):
    return nodes_io.light_rows(n).select("id", "name", "node_type", "parent_id", F.array_join("children_ids", ",").alias("children"))


@query("SELECT id, name, node_type, parent_id, CASE WHEN node_type IN ('subtask','atomic') THEN array_to_string(sources, ',') END AS tags FROM n")
def export_flat(n):
    return nodes_io.flat_rows(n.withColumn("tags", F.array_join("sources", ","))).select("id", "name", "node_type", "parent_id", "tags")


@query("SELECT metric, item, CAST(value AS DOUBLE) AS value FROM (SELECT 'total' AS metric, '' AS item, count(*) AS value FROM n UNION ALL SELECT 'avg_depth', '', round(avg(len(string_split(id,'/'))), 2) FROM n UNION ALL SELECT 'max_depth', '', max(len(string_split(id,'/'))) FROM n UNION ALL SELECT node_type, '', count(*) FROM n GROUP BY node_type UNION ALL (SELECT 'domain_nodes', string_split(id,'/')[1] AS d, count(*) AS c FROM n GROUP BY d ORDER BY c DESC, d LIMIT 15) UNION ALL (SELECT 'top_verb', v, count(*) AS c FROM (SELECT regexp_split_to_array(lower(name), '[\\s_]')[1] AS v FROM n WHERE node_type = 'atomic') WHERE length(v) > 1 GROUP BY v ORDER BY c DESC, v LIMIT 20) UNION ALL SELECT 'verbs', '', count(DISTINCT v) FROM (SELECT regexp_split_to_array(lower(name), '[\\s_]')[1] AS v FROM n WHERE node_type = 'atomic') WHERE length(v) > 1)")
def web_stats(n):
    return reports.web_stats(n)


@query("SELECT count(*) AS total, count(*) FILTER (WHERE node_type = 'domain') AS domain, count(*) FILTER (WHERE node_type = 'task') AS task, count(*) FILTER (WHERE node_type = 'subtask') AS subtask, count(*) FILTER (WHERE node_type = 'atomic') AS atomic, count(*) FILTER (WHERE contains(id, '_1')) AS quality, count(*) FILTER (WHERE starts_with(id, 'asia')) AS family FROM n")
def home_stats(n):
    return reports.home_stats(n, "_1", "asia")


@query("SELECT string_split(id,'/')[1] AS id, count(*) FILTER (WHERE d = 2) AS n_children, count(*) FILTER (WHERE d = 3) AS n_grandchildren, count(*) FILTER (WHERE d = 2 AND contains(id, '_1')) AS n_quality FROM (SELECT id, len(string_split(id,'/')) AS d FROM n) GROUP BY 1")
def domain_card(n):
    return reports.domain_cards(n, "_1")


@query("SELECT metric, CAST(value AS DOUBLE) AS value FROM (SELECT 'total' AS metric, count(*) AS value FROM n UNION ALL SELECT 'atomic', count(*) FROM n WHERE node_type = 'atomic' UNION ALL SELECT 'leaves', count(*) FROM n WHERE NOT EXISTS (SELECT 1 FROM n c WHERE c.parent_id = n.id) UNION ALL SELECT 'described', count(*) FROM n WHERE coalesce(description, '') <> '' UNION ALL SELECT 'max_depth', max(len(string_split(id,'/'))) FROM n UNION ALL SELECT 'avg_depth', round(avg(len(string_split(id,'/'))), 4) FROM n UNION ALL SELECT 'type:' || node_type, count(*) FROM n GROUP BY 1 UNION ALL SELECT 'source:' || s, count(*) FROM (SELECT unnest(sources) AS s FROM n) GROUP BY 1)")
def publish_stats(n):
    return reports.publish_stats(n)


@query("SELECT s AS source, count(*) AS n_nodes, round(100.0 * count(*) / (SELECT count(*) FROM n), 2) AS pct FROM (SELECT unnest(sources) s FROM n) GROUP BY s")
def source_counts(n):
    return reports.source_shares(n)


_REJECTS = f"(SELECT id, name, string_split(v, ':')[1] AS reason, CASE WHEN contains(v, ':') THEN substr(v, strpos(v, ':') + 1) END AS pattern FROM (SELECT id, name, 'bad:' || ({_BAD}) AS v FROM n) WHERE v IS NOT NULL)"


def _rejects(n: DataFrame) -> DataFrame:
    return n.select("id", "name", judging.bad_pattern(F.col("name")).alias("pattern")).where("pattern is not null").withColumn("reason", F.lit("bad"))


@query(f"SELECT section, item, CAST(k AS BIGINT) AS n FROM (SELECT 'reason' AS section, reason AS item, count(*) AS k FROM {_REJECTS} GROUP BY 2 UNION ALL (SELECT 'pattern', pattern, count(*) AS c FROM {_REJECTS} WHERE pattern IS NOT NULL GROUP BY 2 ORDER BY c DESC, pattern LIMIT 10) UNION ALL (SELECT 'recent', name, row_number() OVER (ORDER BY id DESC) AS r FROM {_REJECTS} ORDER BY id DESC LIMIT 20))")
def reject_analysis(n):
    return reports.reject_analysis(_rejects(n), "id")


@query(f"SELECT reason, count(*) AS n_rejects, count(DISTINCT pattern) AS n_patterns, array_to_string(list(name ORDER BY id)[1:10], ' | ') AS samples FROM {_REJECTS} GROUP BY reason")
def reject_patterns(n):
    return reports.reject_patterns(_rejects(n), "id")


@query("SELECT id, string_split(id,'/')[1] AS domain, coalesce(k, 0) AS n_children, coalesce(f, '') AS first_names FROM n LEFT JOIN (SELECT parent_id AS p, count(*) AS k, array_to_string(list(name ORDER BY name, id)[1:10], ', ') AS f FROM n GROUP BY 1) ON p = id WHERE node_type = 'task'")
def structure_analysis(n):
    return reports.structure_analysis(n)


@query(f"SELECT phrase, count(*) AS n_listed FROM {_LEXICON} GROUP BY 1 HAVING count(*) > 1")
def verb_duplicates(n):
    return lexicon.duplicates(_lexicon(n))


@query(f"SELECT stem, count(*) AS n_variants, min(phrase) AS first_variant, max(phrase) AS last_variant FROM (SELECT DISTINCT phrase, string_split(phrase, '_')[1] AS stem FROM {_LEXICON}) GROUP BY 1 HAVING count(*) >= 3")
def verb_stems(n):
    return lexicon.stems(_lexicon(n), "phrase", 3)


_CHECKS = {"state_predicates": "starts_with(phrase, 'is_')", "abstract_cognitive": f"string_split(phrase, '_')[1] IN {_in(lexicon.COGNITIVE_STEMS)}", "vague_starters": " OR ".join(f"starts_with(phrase, '{v}')" for v in lexicon.VAGUE_STARTERS), "too_long": "length(phrase) > 40", "contains_space": "contains(phrase, ' ')"}


@query(f"SELECT issue, phrase FROM (SELECT DISTINCT phrase FROM {_LEXICON}) JOIN (VALUES {', '.join(f'({chr(39)}{k}{chr(39)})' for k in _CHECKS)}) i(issue) ON CASE issue {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {c}' for k, c in _CHECKS.items())} END")
def verb_problems(n):
    phrases = _lexicon(n).select("phrase").distinct()
    return lexicon.problems(phrases, lexicon.phrase_checks(F.col("phrase"))).select("issue", "phrase")


_COGNITIVE_ROWS = "(SELECT unnest(" + str(W.COGNITIVE_VERBS) + ") AS phrase)"


@query(f", lx AS (SELECT phrase, count(*) AS k, string_split(phrase, '_')[1] AS stem FROM {_LEXICON} GROUP BY 1) SELECT 'total' AS metric, CAST(sum(k) AS BIGINT) AS value FROM lx UNION ALL SELECT 'unique', count(*) FROM lx UNION ALL SELECT 'duplicated', count(*) FROM lx WHERE k > 1 " + " ".join(f"UNION ALL SELECT '{k}', count(*) FROM lx WHERE {c}" for k, c in _CHECKS.items()) + f" UNION ALL SELECT 'stems_with_variants', count(*) FROM (SELECT stem FROM lx GROUP BY 1 HAVING count(*) >= 3) UNION ALL SELECT 'overlap', count(*) FROM lx WHERE phrase IN (SELECT phrase FROM {_COGNITIVE_ROWS})")
def verb_statistics(n):
    return lexicon.statistics(_lexicon(n), W.lexicon_table(n.sparkSession).where("set_name = 'cognitive'"))


@query(f"SELECT category, count(*) AS n_phrases, array_to_string(list(phrase ORDER BY phrase)[1:8], ', ') AS phrases FROM (SELECT DISTINCT category, phrase FROM {_LEXICON}) GROUP BY 1")
def verb_category_summary(n):
    return lexicon.category_summary(_lexicon(n))


@query(f"SELECT phrase FROM {_COGNITIVE_ROWS} INTERSECT SELECT string_split(phrase, '_')[1] FROM {_LEXICON}")
def lexicon_overlap(n):
    cognitive = W.lexicon_table(n.sparkSession).where("set_name = 'cognitive'").select("phrase")
    return cognitive.intersect(_lexicon(n).select(F.substring_index("phrase", "_", 1).alias("phrase")))


_EXPECTED = "(SELECT g AS \"group\", unnest(v) AS phrase FROM (VALUES ('cognitive', " + str(W.COGNITIVE_VERBS) + "), ('manipulation', " + str(W.MANIPULATION_VERBS) + ")) t(g, v))"


def _expected(n: DataFrame) -> DataFrame:
    return W.lexicon_table(n.sparkSession).where("set_name in ('cognitive', 'manipulation')").select(F.col("set_name").alias("group"), "phrase")


@query("SELECT regexp_split_to_array(lower(name), '[\\s_]')[1] AS phrase FROM n WHERE node_type = 'atomic' UNION SELECT string_split(lower(p_name), ' ')[1] FROM part")
def union_distinct_verbs(n):
    heard = n.where("node_type = 'atomic'").select(F.split(F.lower("name"), r"[\s_]")[0].alias("phrase"))
    return heard.union(_table_of(n, "part").select(F.split(F.lower("p_name"), " ")[0])).distinct()


# expected verbs by domain: each kind of part expects the words of its parts' names, and the whole names
_WANTED = "(SELECT p_type AS \"group\", unnest(list_append(string_split(lower(p_name), ' '), lower(p_name))) AS phrase FROM part)"


def _wanted(n: DataFrame) -> DataFrame:
    words = F.explode(F.concat(F.split(F.lower("p_name"), " "), F.array(F.lower("p_name"))))
    return _table_of(n, "part").select(F.col("p_type").alias("group"), words.alias("phrase")).distinct()


@query(f", ac AS (SELECT DISTINCT phrase AS a FROM {_LEXICON}), e AS (SELECT DISTINCT * FROM {_WANTED}), f AS (SELECT phrase, bool_or(contains(a, phrase)) AS hit FROM (SELECT DISTINCT phrase FROM e) CROSS JOIN ac GROUP BY phrase) SELECT \"group\", count(*) AS n_expected, count(*) FILTER (WHERE hit) AS n_found, CAST(floor(10000 * count(*) FILTER (WHERE hit) / count(*)) AS BIGINT) AS basis_points, coalesce(string_agg(CASE WHEN NOT hit THEN phrase END, ',' ORDER BY phrase), '') AS missing FROM e JOIN f USING (phrase) GROUP BY 1")
def coverage_by_domain(n):
    marked = lexicon.covered(_wanted(n), _lexicon(n).select("phrase").distinct(), "substring")
    out = lexicon.coverage_by_group(marked, 90)
    return out.select("group", "n_expected", "n_found", F.expr("n_found * 10000 div n_expected").alias("basis_points"), "missing")


@query(f"SELECT phrase FROM {_EXPECTED} EXCEPT SELECT string_split(phrase, '_')[1] FROM {_LEXICON}")
def missing_verbs(n):
    return _expected(n).select("phrase").subtract(_lexicon(n).select(F.substring_index("phrase", "_", 1).alias("phrase")))


@query(f", ac AS (SELECT DISTINCT phrase AS a FROM {_LEXICON}) SELECT \"group\", count(*) AS n_expected, count(*) FILTER (WHERE f) AS n_found, round(100.0 * count(*) FILTER (WHERE f) / count(*), 2) AS pct, coalesce(string_agg(DISTINCT CASE WHEN NOT f THEN phrase END, ',' ORDER BY CASE WHEN NOT f THEN phrase END), '') AS missing, round(100.0 * count(*) FILTER (WHERE f) / count(*), 2) >= 10 AS passed FROM (SELECT \"group\", phrase, EXISTS (SELECT 1 FROM ac WHERE contains(a, phrase)) AS f FROM {_EXPECTED}) GROUP BY 1")
def coverage_report(n):
    actual = _lexicon(n).select("phrase").distinct()
    return lexicon.coverage_by_group(lexicon.covered(_expected(n), actual, "substring"), 10)


@query(f", ac AS (SELECT DISTINCT phrase FROM {_LEXICON}), w AS (SELECT DISTINCT string_split(phrase, '_')[1] AS word FROM ac) SELECT word, (SELECT count(*) FROM ac a WHERE starts_with(a.phrase, word || '_')) AS n_variants FROM w WHERE word IN (SELECT phrase FROM ac)")
def disambiguation(n):
    phrases = _lexicon(n)
    return lexicon.disambiguation(phrases.select(F.substring_index("phrase", "_", 1).alias("word")), phrases)


@query("SELECT id, 'Task: ' || name || chr(10) || 'DEPTH ' || d || ' - ' || CASE " + " ".join(f"WHEN d >= {d} THEN '{t}'" for d, t in requests.DEPTH_HINTS) + " END || chr(10) || chr(10) || 'JSON:' AS prompt FROM (SELECT *, len(string_split(id,'/')) - 1 AS d FROM n WHERE node_type <> 'atomic')")
def prompt_text(n):
    return n.where("node_type <> 'atomic'").select("id", requests.prompt_text(F.col("name"), F.col("id")).alias("prompt"))


@query("SELECT id, kind, k AS n_children, 'Add to ' || name || ' (' || k || '): ' || f AS prompt FROM (SELECT n.*, k, f, CASE WHEN node_type = 'domain' THEN 'domain' WHEN node_type = 'task' AND k BETWEEN 1 AND 60 THEN 'sparse' END AS kind FROM n JOIN (SELECT parent_id AS p, count(*) AS k, array_to_string(list(name ORDER BY name, id)[1:50], ', ') AS f FROM n GROUP BY 1) ON p = id) WHERE kind IS NOT NULL")
def gap_candidates(n):
    return requests.gap_candidates(n, most=60)


_ASKED = "(SELECT conv_id, sha256('{\"model\":\"m' || (conv_id % 4) || '\",\"prompt\":' || conv_id % 50 || ',\"system_prompt\":\"\",\"temperature\":0.7,\"use_thinking\":false}') AS key FROM (SELECT DISTINCT conv_id FROM conversations))"


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id").distinct()
    key = requests.cache_key(F.col("conv_id") % 50, F.lit(None).cast("string"), F.concat(F.lit("m"), F.col("conv_id") % 4), F.lit(0.7), F.lit(False))
    return rows.withColumn("key", key)


@query(f"SELECT conv_id, key FROM {_ASKED}", forest=False)
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir)


@query(f"SELECT key, count(*) FILTER (WHERE conv_id % 2 = 1) AS n_requests, bool_or(conv_id % 3 = 0) AS hit FROM {_ASKED} GROUP BY key HAVING count(*) FILTER (WHERE conv_id % 2 = 1) > 0", forest=False)
def response_cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _requests(spark, sf_dir)
    return curate.cache_lookup(rows.where("conv_id % 2 = 1"), rows.where("conv_id % 3 = 0"), "key")


_PRICED = "(VALUES " + ", ".join(f"({k}, {a}, {b}, {c})" for k, (_, a, b, c) in enumerate(requests.PRICES)) + ") p(k, pi, po, pt)"


@query(f"SELECT role, count(*) AS n_requests, round(sum((length(text) * pi + turn * po + conv_id * pt) / 1e6), 6) AS cost FROM conversations JOIN {_PRICED} ON k = conv_id % 4 WHERE text IS NOT NULL GROUP BY role", forest=False)
def usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(m) for m, *_ in requests.PRICES])
    usage = _table(spark, sf_dir, "conversations").where("text is not null").select("role", F.get(names, (F.col("conv_id") % 4).cast("int")).alias("model"), F.length("text").alias("tokens_in"), F.col("turn").alias("tokens_out"), F.col("conv_id").alias("tokens_thinking"))
    return requests.usage_cost(usage, spark.createDataFrame(requests.PRICES, "model string, input double, output double, thinking double"), ["role"])


@query("SELECT minute, n_events, done, ((done * 20000 + (e + 1)) // (2 * (e + 1))) / 10000.0 AS rate, CASE WHEN done < 20000 THEN round((20000 - done) / (done / (e + 1)), 2) ELSE 0.0 END AS eta FROM (SELECT *, CAST(sum(n_events) OVER (ORDER BY minute) AS BIGINT) AS done, CAST(epoch(minute - (SELECT date_trunc('minute', min(ts)) FROM events)) / 60 AS BIGINT) AS e FROM (SELECT date_trunc('minute', ts) AS minute, count(*) AS n_events FROM events GROUP BY 1))", forest=False)
def progress_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.progress_rates(_table(spark, sf_dir, "events"), "ts", 20000)


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 60", forest=False)
def bounded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.first_per_group(_table(spark, sf_dir, "events"), "event_type", [F.desc("ts"), F.desc("event_id")], 60).select("event_type", "event_id")


@query("SELECT event_type, n, per_minute, n_errors, n_last, mean, least, most FROM (SELECT event_type, count(*) AS n, round(count(*) / greatest((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60, 1.0), 4) AS per_minute, count(*) FILTER (WHERE value < 1) AS n_errors FROM events GROUP BY 1) JOIN (SELECT event_type, count(*) AS n_last, round(avg(value), 4) AS mean, min(value) AS least, max(value) AS most FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 1000 GROUP BY 1) USING (event_type)", forest=False)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_metrics(_table(spark, sf_dir, "events"), "event_type", "ts", "event_id", "value", 1000, F.col("value") < 1)


@query("SELECT id, name FROM n WHERE node_type = 'task' UNION ALL SELECT lower(n_name), n_name FROM nation")
def union_batches(n):
    more = _table_of(n, "nation").select(F.lower("n_name").alias("id"), F.col("n_name").alias("name"), F.lit(1).alias("extra"))
    return curate.union_batches(n.where("node_type = 'task'").select("id", "name"), more).select("id", "name")


_QA = [("data", "step", "max", 5.0, 15.0), ("data", "empty", "max", 10.0, 20.0), ("data", "template", "max", 10.0, 20.0), ("data", "good_verb", "min", 50.0, 30.0), ("verbs", "state_predicates", "max", 0.0, 5.0), ("verbs", "contains_space", "max", 0.0, 50.0), ("verbs", "duplicated", "max", 0.0, 100.0), ("verbs", "overlap", "max", 0.0, 0.0), ("domains", "covered", "min", 90.0, 50.0)]


@query(f""", lx AS (SELECT phrase, count(*) AS k FROM {_LEXICON} GROUP BY 1), m AS (
 SELECT 'step' AS check_name, round(100.0 * count(*) FILTER (WHERE regexp_matches(lower(trim(description)), '^step\\s+\\d+\\s*:')) / count(*), 2) AS value FROM n
 UNION ALL SELECT 'empty', round(100.0 * count(*) FILTER (WHERE coalesce(description, '') = '') / count(*), 2) FROM n
 UNION ALL SELECT 'template', round(100.0 * count(*) FILTER (WHERE ({_GENERIC}) IS NOT NULL) / count(*), 2) FROM (SELECT *, {_WORDS} AS w FROM n)
 UNION ALL SELECT 'good_verb', round(100.0 * count(*) FILTER (WHERE {_any('lower(name)', W.MANIPULATION_VERBS)}) / count(*), 2) FROM n
 UNION ALL SELECT 'state_predicates', count(*) FROM lx WHERE starts_with(phrase, 'is_') UNION ALL SELECT 'contains_space', count(*) FROM lx WHERE contains(phrase, ' ')
 UNION ALL SELECT 'duplicated', count(*) FROM lx WHERE k > 1 UNION ALL SELECT 'overlap', count(*) FROM lx WHERE phrase IN (SELECT phrase FROM {_COGNITIVE_ROWS})
 UNION ALL SELECT 'covered', round(100.0 * count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lx WHERE contains(lx.phrase, e.phrase))) / count(*), 2) FROM {_EXPECTED} e)
 SELECT family, check_name, CAST(value AS DOUBLE) AS value, CASE WHEN (side = 'min' AND value >= ok) OR (side = 'max' AND value <= ok) THEN 'PASS' WHEN (side = 'min' AND value >= warn) OR (side = 'max' AND value <= warn) THEN 'WARN' ELSE 'FAIL' END AS status
 FROM (VALUES {', '.join(map(str, _QA))}) c(family, check_name, side, ok, warn) LEFT JOIN m USING (check_name)""")
def qa_suite(n):
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 2)
    data = n.agg(share(R.step_description(F.col("description"))).alias("step"), share(F.coalesce("description", F.lit("")) == "").alias("empty"), share(R.generic_template(F.col("name"), F.col("description")).isNotNull()).alias("template"), share(~judging.lacks_good_verb(F.col("name"))).alias("good_verb"))
    verbs = lexicon.statistics(_lexicon(n), W.lexicon_table(n.sparkSession).where("set_name = 'cognitive'")).select(F.col("metric").alias("check_name"), F.col("value").cast("double").alias("value"))
    marked = lexicon.covered(_expected(n), _lexicon(n).select("phrase").distinct(), "substring")
    domains = marked.agg(share(F.col("found")).alias("value")).select(F.lit("covered").alias("check_name"), "value")
    metrics = reports.long_form(data, data.columns).withColumnRenamed("metric", "check_name").unionByName(verbs).unionByName(domains)
    return reports.graded(metrics, _QA)


@query("SELECT id, nullif(name, '') AS name, node_type, nullif(description, '') AS description, parent_id FROM n")
def import_publish(n):
    whole = tree.rebuild_children(n).withColumn("completion", F.lit(None).cast(nodes_io.COMPLETION))
    return nodes_io.from_published(nodes_io.to_published(whole)).select("id", "name", "node_type", "description", "parent_id")


@query("""WITH fresh AS (SELECT lower(trim(p_name)) AS nm, min({'o': p_partkey, 'd': 'new ' || p_type, 'c': p_type || ' things', 'n': p_name}) AS m FROM part WHERE lower(trim(p_name)) NOT IN (SELECT lower(trim(n_name)) FROM nation) GROUP BY 1),
 p AS (SELECT m.o AS o, replace(lower(m.d), ' ', '_') AS did, m.d AS d, replace(lower(m.d), ' ', '_') || '/' || replace(lower(m.c), ' ', '_') AS cid, m.c AS c, m.n AS n FROM fresh)
 SELECT did AS id, NULL AS parent_id, min(d) AS name, 'domain' AS node_type FROM p GROUP BY did UNION ALL SELECT cid, did, min(c), 'task' FROM p GROUP BY cid, did
 UNION ALL SELECT cid || '/' || replace(lower(n), ' ', '_'), cid, arg_min(n, o), 'subtask' FROM p GROUP BY 1, 2""", forest=False)
def merge_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a nested batch, by new domains and categories, into a forest of nations."""
    forest = _table(spark, sf_dir, "nation").select(T.slug(F.col("n_name")).alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("n_name").alias("name"), F.lit("domain").alias("node_type"))
    batch = _table(spark, sf_dir, "part").select(F.concat(F.lit("new "), "p_type").alias("domain"), F.concat("p_type", F.lit(" things")).alias("category"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ordinal"))
    return responses.merge_subtrees(forest, batch).select("id", "parent_id", "name", "node_type")


@query("SELECT 'asia/' || replace(p, ' ', '_') AS id, 'asia' AS parent_id, p AS name FROM (SELECT DISTINCT lower(trim(p_name)) AS p FROM part) WHERE p NOT IN (SELECT lower(trim(name)) FROM n)")
def merge_batches(n):
    batch = _table_of(n, "part").select(F.lit("asia").alias("parent_id"), F.lower("p_name").alias("name"), F.col("p_partkey").alias("ordinal"))
    return responses.merge_batch(n, batch)


@query("SELECT id, parent_id, name FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY o) AS r FROM (SELECT d || '/' || replace(p, ' ', '_') AS id, d AS parent_id, p AS name, o FROM (SELECT lower(trim(p_name)) AS p, min(p_partkey) AS o FROM part GROUP BY 1) CROSS JOIN (VALUES ('asia'), ('europe')) v(d))) WHERE r <= 15")
def gap_fill_merge(n):
    parents = F.explode(F.array(F.lit("asia"), F.lit("europe"))).alias("parent_id")
    batch = _table_of(n, "part").select(parents, F.lower("p_name").alias("name"), F.col("p_partkey").alias("ordinal"))
    return responses.gap_fill(n, batch, 15).select("id", "parent_id", "name")


def _answers(n: DataFrame) -> DataFrame:
    """A response for each domain, that lists the nations of its region."""
    nations, regions = _table_of(n, "nation"), _table_of(n, "region")
    kids = F.struct(F.concat(F.lit("more "), "n_name").alias("name"), F.lit("d").alias("description"), (F.col("n_nationkey") % 2 == 0).alias("is_atomic"))
    listed = nations.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", kids.alias("k")))).alias("l"))
    body = F.to_json(F.struct(F.lit(False).alias("is_atomic"), F.transform("l", lambda x: x["k"]).alias("subtasks")))
    return listed.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(T.slug(F.col("r_name")).alias("id"), F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("response"))


@query("SELECT replace(lower(r_name), ' ', '_') || '/more_' || lower(n_name) AS id, replace(lower(r_name), ' ', '_') AS parent_id, 'more ' || n_name AS name, 'task' AS node_type FROM nation JOIN region ON r_regionkey = n_regionkey")
def attach_children(n):
    return responses.attach_children(n.where("node_type = 'domain'"), _answers(n), F.lit(True)).select("id", "parent_id", "name", "node_type")


@query("SELECT id, CASE WHEN node_type = 'task' AND CAST(split_part(name, '_', 2) AS INT) % 2 = 0 THEN 'atomic' ELSE node_type END AS node_type FROM n WHERE node_type IN ('task', 'domain')")
def mark_atomic(n):
    said = n.where("node_type = 'task'").select("id", F.to_json(F.struct((F.substring_index("name", "_", -1).cast("int") % 2 == 0).alias("is_atomic"), F.array(F.struct(F.lit("x").alias("name"))).alias("subtasks"))).alias("response"))
    return responses.mark_atomic(n.where("node_type in ('task', 'domain')"), said).select("id", "node_type")


@query("SELECT id, CASE WHEN node_type = 'task' THEN name END AS pre, CASE WHEN node_type = 'task' THEN '' END AS post FROM n WHERE node_type IN ('task', 'domain')")
def attach_completion(n):
    said = n.where("node_type = 'task'").select("id", F.to_json(F.struct(F.col("name").alias("preconditions"))).alias("response"))
    return responses.attach_completion(n.where("node_type in ('task', 'domain')"), said).select("id", F.col("completion.preconditions").alias("pre"), F.col("completion.postconditions").alias("post"))


@query("SELECT id, CASE WHEN starts_with(id, 'asia') THEN name || '!' ELSE name END AS name FROM n")
def upsert_nodes(n):
    # the nodes of one domain come anew under other names, with nodes whose parents are missing beside them
    asia = n.where("id like 'asia%'").select("id", "parent_id", F.concat("name", F.lit("!")).alias("name"), F.lit(1).alias("ordinal"))
    lost = _table_of(n, "nation").select(F.concat(F.lit("nowhere/"), F.lower("n_name"), F.lit("/x")).alias("id"), F.concat(F.lit("nowhere/"), F.lower("n_name")).alias("parent_id"), F.col("n_name").alias("name"), F.lit(2).alias("ordinal"))
    out, _ = nodes_io.upsert_nodes(n.select("id", "parent_id", "name"), asia.unionByName(lost), "ordinal")
    return out.select("id", "name")
