"""Registered queries over the projected forest and the event log, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grovespark.functions import rules as R
from grovespark.functions import text as T
from grovespark.operators import curate, judging, tree
from grovespark.plans.forest import NODES_SQL, nodes

QUERIES, ORACLES = {}, {}


def query(sql: str, forest: bool = True):
    """Registers a query with its SQL; with forest, n is the projected forest on both sides."""

    def register(f):
        QUERIES[f.__name__] = (lambda spark, d: f(nodes(spark, d))) if forest else f
        ORACLES[f.__name__] = f"WITH {NODES_SQL} {sql}" if forest else sql
        return f

    return register


def _any(column: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in phrases) + ")"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_quoted = lambda p: p.replace("'", "''")
_TRASH_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(lower(name), '{p}') THEN '{p}'" for p in R.TRASH_PATTERNS) + " END"
_ACTION = f"CASE WHEN {_TRASH_FIRST} IS NOT NULL THEN 'trash' WHEN {_any('lower(name)', [p for v in R.PREMIUM_PHRASES.values() for p in v])} THEN 'premium' WHEN {_any('lower(name)', R.DEMONSTRATIONS)} THEN 'demo' ELSE 'default' END"
_WORDS = r"list_filter(regexp_split_to_array(translate(lower(trim(name)), '_-', '  '), '\s+'), lambda w: w <> '')"
_GENERIC = f"""CASE WHEN regexp_matches(lower(trim(coalesce(description,''))), '{R.STEP_PATTERN}') THEN 1
 WHEN {' OR '.join(f"regexp_matches(lower(trim(name)), '{p}')" for p in R.VAGUE_ACTION_PATTERNS)} THEN 2
 WHEN {' OR '.join(f"regexp_matches(lower(trim(name)), '{_quoted(p)}')" for p in R.CONFUSING_PATTERNS)} THEN 3
 WHEN w[1] IN {_in(R.NON_PHYSICAL_VERBS)} THEN 4
 WHEN {_any('lower(trim(name))', R.OVERSPECIFIC_MODIFIERS)} THEN 5
 WHEN len(w) = 2 AND w[1] IN {_in(R.GENERIC_VERBS + R.VAGUE_VERBS)} AND w[2] IN {_in(R.GENERIC_NOUNS)} THEN 6
 WHEN len(w) >= 2 AND w[1] IN {_in(R.VAGUE_VERBS)} AND {_any("array_to_string(w[2:], ' ')", R.ABSTRACT_NOUNS)} THEN 7
 WHEN coalesce(description,'') <> '' AND length(trim(description)) < 20 AND (contains(lower(trim(description)), lower(trim(name))) OR contains(lower(trim(name)), lower(trim(description)))) THEN 8 END"""


@query("SELECT id, name, node_type FROM n WHERE node_type = 'task'")
def by_type(n):
    return n.where("node_type = 'task'").select("id", "name", "node_type")


@query("SELECT id, name FROM n WHERE list_contains(sources, 'llm_generated')")
def by_source(n):
    return n.where(F.array_contains("sources", "llm_generated")).select("id", "name")


@query("SELECT id, node_type FROM n LEFT JOIN (SELECT parent_id AS p FROM n WHERE parent_id IS NOT NULL GROUP BY 1) ON p = id WHERE p IS NULL")
def leaves(n):
    return tree.childless(n.select("id", "node_type"), n)


@query("SELECT id, name FROM n WHERE parent_id IS NULL")
def roots(n):
    return n.where("parent_id is null").select("id", "name")


@query("SELECT id, name FROM n WHERE starts_with(id, 'asia/')")
def by_id_prefix(n):
    return n.where(F.col("id").startswith("asia/")).select("id", "name")


@query("SELECT id, name FROM n WHERE contains(lower(name), 'dish') ORDER BY id LIMIT 100")
def search_nodes(n):
    return n.where(F.lower("name").contains("dish")).orderBy("id").limit(100).select("id", "name")


@query("SELECT id FROM n WHERE regexp_matches(lower(trim(description)), '^step\\s+\\d+\\s*:')")
def step_description(n):
    return n.where(R.step_description(F.col("description"))).select("id")


@query("SELECT id FROM n WHERE coalesce(description, '') = ''")
def empty_description(n):
    return n.where(F.coalesce("description", F.lit("")) == "").select("id")


@query(f"SELECT * FROM (SELECT id, {_TRASH_FIRST} AS rule FROM n) WHERE rule IS NOT NULL")
def match_rules(n):
    return n.select("id", F.lower("name").alias("low")).select("id", R.match_rules(F.col("low"), R.TRASH_PATTERNS).alias("rule")).where("rule is not null")


@query("SELECT rule, count(*) AS n_nodes FROM n JOIN (VALUES " + ", ".join(f"('{p}')" for p in R.TRASH_PATTERNS) + ") r(rule) ON regexp_matches(lower(name), rule) GROUP BY rule")
def issue_histogram(n):
    return n.select(F.lower("name").alias("low")).select(F.explode(R.match_rules_all(F.col("low"), R.TRASH_PATTERNS)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n_nodes"))


@query(f"SELECT id, check_no FROM (SELECT id, {_GENERIC} AS check_no FROM (SELECT *, {_WORDS} AS w FROM n)) WHERE check_no IS NOT NULL")
def generic_template(n):
    return judging.settled(R.with_template(n.select("id", "name", "description"), "check_no"), "check_no").where("check_no is not null").select("id", "check_no")


@query(f"SELECT tier, count(t) AS n_nodes, round(100.0 * count(t) / greatest(1, sum(count(t)) OVER ()), 2) AS pct FROM (VALUES ('PREMIUM'),('HIGH'),('MEDIUM'),('LOW'),('TRASH')) d(tier) LEFT JOIN (SELECT CASE {_ACTION} WHEN 'trash' THEN 'TRASH' WHEN 'premium' THEN 'HIGH' WHEN 'demo' THEN 'PREMIUM' ELSE 'MEDIUM' END AS t FROM n WHERE node_type <> 'domain') ON t = tier GROUP BY tier")
def tier_report(n):
    tiers = F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), F.lit(0).cast("long").alias("k")) for t, _ in R.TIERS])).alias("t")
    # one zero row per tier makes the counts complete without a join
    zeros = n.sparkSession.range(1).select(tiers).select("t.tier", "t.k")
    counts = judging.value_scores(n.where("node_type <> 'domain'")).select("tier", F.lit(1).cast("long").alias("k")).unionByName(zeros).groupBy("tier").agg(F.sum("k").alias("n_nodes"))
    total = F.sum("n_nodes").over(Window.partitionBy(F.lit(1)))
    return counts.select("tier", "n_nodes", F.round(100.0 * F.col("n_nodes") / F.greatest(F.lit(1), total), 2).alias("pct"))


@query("SELECT t AS node_type, count(n.id) AS n_nodes FROM (VALUES ('domain'),('task'),('subtask'),('atomic')) d(t) LEFT JOIN n ON node_type = t GROUP BY t")
def count_by_type(n):
    kinds = n.sparkSession.createDataFrame([("domain",), ("task",), ("subtask",), ("atomic",)], "node_type string")
    return kinds.join(n.groupBy("node_type").agg(F.count("*").alias("c")), "node_type", "left").select("node_type", F.coalesce("c", F.lit(0)).cast("long").alias("n_nodes"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE node_type='domain') AS domains, max(len(string_split(id,'/'))-1)::INT AS max_depth, round(avg(len(string_split(id,'/'))-1),4) AS avg_depth, count(*) FILTER (WHERE p IS NULL) AS n_leaves FROM n LEFT JOIN (SELECT DISTINCT parent_id AS p FROM n) ON p = id")
def graph_stats(n):
    d = T.depth(F.col("id"))
    return tree.leaf_marks(n.select("id", "parent_id", "node_type")).agg(F.count("*").alias("total"), F.count_if(F.col("node_type") == "domain").alias("domains"), F.max(d).alias("max_depth"), F.round(F.avg(d), 4).alias("avg_depth"), F.count_if("is_leaf").alias("n_leaves"))


@query(f"SELECT string_split(id,'/')[1] AS domain, count(*) AS total, count(*) FILTER (WHERE list_contains(sources,'llm_generated')) AS generated, count(*) FILTER (WHERE regexp_matches(lower(trim(description)), '^step\\s+\\d+\\s*:')) AS step, count(*) FILTER (WHERE ({_GENERIC}) IS NOT NULL) AS template, count(*) FILTER (WHERE coalesce(description,'')='') AS empty FROM (SELECT *, {_WORDS} AS w FROM n) GROUP BY 1")
def quality_summary(n):
    judged = R.with_template(n.withColumn("domain", T.domain_of(F.col("id"))), "check_no")
    return judged.groupBy("domain").agg(F.count("*").alias("total"), F.count_if(F.array_contains("sources", "llm_generated")).alias("generated"), F.count_if(R.step_description(F.col("description"))).alias("step"), F.count_if(F.col("check_no").isNotNull()).alias("template"), F.count_if(F.coalesce("description", F.lit("")) == "").alias("empty"))


@query("SELECT n.id, coalesce(nm,'unknown') AS parent_name, coalesce(nt,'unknown') AS parent_type FROM n LEFT JOIN (SELECT id AS i, any_value(name) AS nm, any_value(node_type) AS nt FROM n GROUP BY 1) ON i = parent_id")
def parent_lookup(n):
    return tree.parent_lookup(n).select("id", "parent_name", "parent_type")


@query("SELECT parent_id AS id, count(*) AS n_children, string_agg(id, ',' ORDER BY id) AS children FROM n WHERE parent_id IS NOT NULL GROUP BY parent_id")
def rebuild_children(n):
    return tree.rebuild_children(n).where(F.size("children_ids") > 0).select("id", F.size("children_ids").cast("long").alias("n_children"), F.array_join("children_ids", ",").alias("children"))


@query("SELECT id, parent_id FROM n WHERE node_type = 'atomic' AND parent_id IN (SELECT id FROM n WHERE description = 'F' GROUP BY 1)")
def orphans(n):
    # a forest from which the finished orders were taken out without their lines
    left = n.where("node_type <> 'subtask' or coalesce(description, '') <> 'F'")
    return tree.orphans(left).select("id", "parent_id")


@query(", up AS (SELECT id, parent_id AS ancestor_id, 1 AS distance FROM n WHERE parent_id IS NOT NULL), u2 AS (SELECT u.id, n.parent_id AS ancestor_id, 2 AS distance FROM up u JOIN n ON n.id=u.ancestor_id WHERE n.parent_id IS NOT NULL), u3 AS (SELECT u.id, n.parent_id AS ancestor_id, 3 AS distance FROM u2 u JOIN n ON n.id=u.ancestor_id WHERE n.parent_id IS NOT NULL), u4 AS (SELECT u.id, n.parent_id AS ancestor_id, 4 AS distance FROM u3 u JOIN n ON n.id=u.ancestor_id WHERE n.parent_id IS NOT NULL) SELECT * FROM up UNION ALL SELECT * FROM u2 UNION ALL SELECT * FROM u3 UNION ALL SELECT * FROM u4")
def ancestors(n):
    return tree.path_ancestors(n)


@query("SELECT id FROM n WHERE starts_with(id, 'europe/')")
def descendants(n):
    return tree.descendants(n, n.where("id = 'europe'"))


@query("SELECT min(id) AS id, lower(trim(name)) AS norm FROM n GROUP BY 2")
def first_wins_dedup(n):
    return curate.first_wins(n.select("id", T.norm_name(F.col("name")).alias("norm")), F.col("norm"), "id")


@query("SELECT id FROM n WHERE node_type = 'atomic' ORDER BY CASE WHEN list_contains(sources,'llm_generated') THEN 0 ELSE 1 END, md5(id || '7'), id LIMIT 50")
def review_sample(n):
    return curate.review_sample(n.where("node_type = 'atomic'"), "id", F.array_contains("sources", "llm_generated"), 50, "7").select("id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1", forest=False)
def latest_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    return curate.latest(events, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("SELECT conv_id, turn FROM (SELECT *, coalesce(sum(CASE WHEN length(text) % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY 1, 2)) WHERE b < 3 AND length(text) % 3 <> 0", forest=False)
def reject_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    return curate.reject_cutoff(turns, "conv_id", "turn", F.length("text") % 3 == 0).select("conv_id", "turn")


@query("SELECT time_bucket(INTERVAL '1 minute', ts) AS minute, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2", forest=False)
def rate_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.groupBy(F.window("ts", "1 minute")["start"].alias("minute"), "event_type").agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total"))
