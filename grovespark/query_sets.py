"""More registered queries: lookups and reports over the forest, reviews and requests, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import rules as R
from grovespark.functions import text as T
from grovespark.operators import curate, lexicon, reports, tree
from grovespark.plans.forest import VERBS
from grovespark.sources import nodes_io
from grovespark.queries import _GENERIC, _TRASH_FIRST, _WORDS, query

_DEPTH = "(len(string_split(id,'/'))-1)"
_KIDS = "(SELECT parent_id AS p, count(*) AS k FROM n WHERE parent_id IS NOT NULL GROUP BY 1)"
_WORD = "string_split(lower(name), ' ')[1]"
_VALUES = ", ".join(f"('{v}')" for v in VERBS)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"SELECT id, k AS n_children FROM n JOIN {_KIDS} ON p = id WHERE node_type IN ('task','subtask') AND k >= 5")
def high_level(n):
    return tree.child_counts(n).where(F.col("node_type").isin("task", "subtask") & (F.col("n_children") >= 5)).select("id", "n_children")


@query(f"SELECT id, {_DEPTH} AS depth FROM n WHERE node_type NOT IN ('domain','atomic') AND {_DEPTH} < 4 AND coalesce(description, '') <> 'F' AND NOT EXISTS (SELECT 1 FROM {_KIDS} WHERE p = id) ORDER BY depth, id LIMIT 500")
def frontier(n):
    open_ = n.where(~F.col("node_type").isin("domain", "atomic") & (T.depth(F.col("id")) < 4))
    processed = n.where("description = 'F'").select("id")
    return curate.exclude_seen(tree.childless(open_, n), processed, "id").select("id", T.depth(F.col("id")).alias("depth")).orderBy("depth", "id").limit(500)


@query(f"SELECT id FROM n WHERE node_type = 'subtask' AND NOT EXISTS (SELECT 1 FROM {_KIDS} WHERE p = id)")
def childless_of_type(n):
    return tree.childless(n.where("node_type = 'subtask'"), n).select("id")


@query(f"SELECT id, CAST(k AS BIGINT) AS n_children FROM n JOIN {_KIDS} ON p = id WHERE k BETWEEN 1 AND 4")
def sparse_branches(n):
    return tree.child_counts(n).where("n_children between 1 and 4").select("id", "n_children")


@query("SELECT parent_id AS id, CAST(row_number() OVER (PARTITION BY parent_id ORDER BY id) - 1 AS INTEGER) AS pos, id AS child_id FROM n WHERE parent_id IS NOT NULL")
def children_of(n):
    return tree.children_of(tree.rebuild_children(n), n).select("id", "pos", "child_id")


@query("SELECT parent_id AS id, string_agg(id, ',' ORDER BY id) AS children FROM n WHERE parent_id IS NOT NULL AND NOT contains(lower(name), 'building') GROUP BY parent_id")
def dangling_refs(n):
    gone = n.where(F.lower("name").contains("building")).select("id")
    return tree.drop_references(tree.rebuild_children(n), gone).where(F.size("children_ids") > 0).select("id", F.array_join("children_ids", ",").alias("children"))


@query(", s AS (SELECT id, unnest(list_transform(range(1, len(string_split(id,'/')) + 1), lambda k: {'k': k, 'up': array_to_string(string_split(id,'/')[1:k], '/')}), recursive := true) FROM n), nm AS (SELECT id AS i, any_value(name) AS name FROM n GROUP BY 1) SELECT id, string_agg(name, ' > ' ORDER BY k) AS breadcrumb FROM s JOIN nm ON i = up GROUP BY id")
def breadcrumb(n):
    return tree.breadcrumb(n)


@query(f"SELECT id, name, node_type, coalesce(description, '') AS description, coalesce(parent_id, '') AS parent_id, coalesce(k, '') AS children, '' AS preconditions, '' AS postconditions, '' AS invariants, {_DEPTH} + 1 AS depth, k IS NULL AS is_leaf, node_type = 'atomic' AS is_atomic FROM n LEFT JOIN (SELECT parent_id AS p, string_agg(id, ',' ORDER BY id) AS k FROM n WHERE parent_id IS NOT NULL GROUP BY 1) ON p = id")
def export_publish(n):
    whole = tree.rebuild_children(n).withColumn("completion", F.lit(None).cast(nodes_io.COMPLETION))
    return nodes_io.to_published(whole).withColumn("children", F.array_join("children_ids", ",")).drop("children_ids")


@query(f"SELECT bucket, node_type, count(*) AS n_nodes FROM (SELECT CASE WHEN {_TRASH_FIRST} IS NULL THEN 'trainable' ELSE 'archived' END AS bucket, node_type FROM n) GROUP BY GROUPING SETS ((bucket), (bucket, node_type))")
def bucket_stats(n):
    bucket = F.when(R.match_rules(F.lower("name"), R.TRASH_PATTERNS).isNull(), "trainable").otherwise("archived")
    return n.select(bucket.alias("bucket"), "node_type").groupingSets([[F.col("bucket")], [F.col("bucket"), F.col("node_type")]], "bucket", "node_type").agg(F.count("*").alias("n_nodes"))


@query("SELECT domain, node_type, count(*) AS n_nodes FROM (SELECT string_split(id,'/')[1] AS domain, node_type FROM n) GROUP BY ROLLUP (domain, node_type)")
def category_breakdown(n):
    return n.select(T.domain_of(F.col("id")).alias("domain"), "node_type").rollup("domain", "node_type").agg(F.count("*").alias("n_nodes"))


@query(f"SELECT id, arg_max(phrase, length(phrase)) AS phrase FROM n JOIN (VALUES {_VALUES}) v(phrase) ON lower(trim(name)) = phrase OR starts_with(lower(trim(name)), phrase || ' ') GROUP BY id")
def phrase_prefix_match(n):
    phrases = n.sparkSession.createDataFrame([(v,) for v in VERBS], "phrase string")
    return lexicon.prefix_match(n, phrases, most_words=max(len(v.split()) for v in VERBS)).select("id", "phrase")


@query("SELECT word, count(*) AS n_words FROM (SELECT unnest(regexp_split_to_array(lower(name), '\\s+')) AS word FROM n WHERE regexp_matches(lower(trim(description)), '^step\\s+\\d+\\s*:')) WHERE length(word) > 3 GROUP BY word ORDER BY n_words DESC, word LIMIT 10")
def feedback_keywords(n):
    words = n.where(R.step_description(F.col("description"))).select(F.explode(F.split(F.lower("name"), r"\s+")).alias("word"))
    return words.where(F.length("word") > 3).groupBy("word").agg(F.count("*").alias("n_words")).orderBy(F.desc("n_words"), "word").limit(10)


@query("SELECT node_type, id FROM (SELECT node_type, id, row_number() OVER (PARTITION BY node_type ORDER BY id) AS r FROM n) WHERE r <= 5")
def sample_per_group(n):
    return curate.first_per_group(n, "node_type", ["id"], 5).select("node_type", "id")


@query("SELECT event_type, count(*) AS n_users FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 GROUP BY 1", forest=False)
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return curate.latest(events, "user_id", "ts", "event_id").groupBy("event_type").agg(F.count("*").alias("n_users"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS approved, count(*) FILTER (WHERE quality = 0) AS rejected, round(100.0 * count(*) FILTER (WHERE quality = 1) / greatest(count(*), 1), 2) AS rate FROM labels", forest=False)
def approval_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = F.count_if(F.col("quality") == 1)
    return _table(spark, sf_dir, "labels").agg(F.count("*").alias("total"), yes.alias("approved"), F.count_if(F.col("quality") == 0).alias("rejected"), F.round(100.0 * yes / F.greatest(F.count("*"), F.lit(1)), 2).alias("rate"))


@query("""SELECT user_id, min(ts) AS session_start, count(*) AS n_events FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM
 (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""", forest=False)
def review_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sessions(_table(spark, sf_dir, "events"), "user_id", "ts", "30 minutes").select("user_id", "session_start", "n_events")


