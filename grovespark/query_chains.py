"""Registered queries along parent_id, with recursive SQL forms, and reports by domain, bucket and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import rules as R
from grovespark.functions import text as T
from grovespark.operators import chains, judging, reports
from grovespark.queries import _GENERIC, _TRASH_FIRST, _WORDS, _any, query
from grovespark.functions import families as W

# the projected forest under opaque ids, and an order among siblings that follows neither ids nor names
_OPAQUE = "o AS MATERIALIZED (SELECT md5(id) AS id, md5(parent_id) AS parent_id, name, node_type, md5('o' || id) AS ord FROM n)"
_WALK = "w AS MATERIALIZED (SELECT id, id AS root, 0 AS depth, [ord] AS ords, [id] AS path, [name] AS names FROM o WHERE parent_id IS NULL UNION ALL SELECT o.id, w.root, w.depth + 1, list_append(w.ords, o.ord), list_append(w.path, o.id), list_append(w.names, o.name) FROM w JOIN o ON o.parent_id = w.id)"


def _opaque(n: DataFrame) -> DataFrame:
    return n.select(F.md5(F.col("id").cast("binary")).alias("id"), F.md5(F.col("parent_id").cast("binary")).alias("parent_id"), "name", "node_type", F.md5(F.concat(F.lit("o"), "id").cast("binary")).alias("ord"))


def recursive(sql: str):
    """query for a recursive form over the opaque forest."""

    def register(f):
        from grovespark import queries as core

        query("")(f)
        core.ORACLES[f.__name__] = f"WITH RECURSIVE {core.NODES_SQL}, {_OPAQUE}, {_WALK} {sql}"
        return f

    return register


@recursive("SELECT d.id, a.id AS ancestor_id, CAST(d.depth - a.depth AS BIGINT) AS distance FROM (SELECT id, depth, unnest(path) AS up FROM w) d JOIN w a ON a.id = d.up WHERE d.id <> a.id")
def parent_chain_ancestors(n):
    return chains.ancestors_of(chains.edges_of(_opaque(n)))


_PLACES = "pl AS (SELECT id, row_number() OVER (PARTITION BY parent_id ORDER BY ord, id) - 1 AS pos FROM o)"


@recursive(f", {_PLACES} SELECT w.id, root, CAST(depth AS BIGINT) AS depth, array_to_string(path, '/') AS path, array_to_string(names, ' > ') AS names, (SELECT string_agg(CAST(pos AS VARCHAR), '.' ORDER BY k) FROM (SELECT unnest(w.path) AS up, generate_subscripts(w.path, 1) AS k) s JOIN pl ON pl.id = s.up) AS places FROM w")
def parent_chain_paths(n):
    return chains.chain_paths(_opaque(n), ["ord"]).select("id", "root", "depth", F.array_join("path", "/").alias("path"), F.array_join("names", " > ").alias("names"), F.array_join(F.transform("places", lambda p: p.cast("string")), ".").alias("places"))


@recursive("SELECT id, row_number() OVER (ORDER BY ords) - 1 AS position, CAST(depth AS BIGINT) AS depth, sz AS size FROM w JOIN (SELECT up, count(*) AS sz FROM (SELECT unnest(path) AS up FROM w) GROUP BY up) ON up = id")
def sibling_preorder(n):
    return chains.preorder(_opaque(n), ["ord"])


@recursive(f", ls AS (SELECT id, ord = max(ord) OVER (PARTITION BY parent_id) AS is_last FROM o) SELECT w.id, p AS position, coalesce((SELECT string_agg(CASE WHEN ls.is_last THEN '    ' ELSE '│   ' END, '' ORDER BY k) FROM (SELECT unnest(w.path[:-2]) AS up, generate_subscripts(w.path[:-2], 1) AS k) s JOIN ls ON ls.id = s.up), '') || CASE WHEN l.is_last THEN '└── ' ELSE '├── ' END || o.name || ' [' || o.node_type || ']' AS line FROM (SELECT *, row_number() OVER (ORDER BY ords) - 1 AS p FROM w) w JOIN o ON o.id = w.id JOIN ls l ON l.id = w.id WHERE depth <= 2")
def sibling_tree_text(n):
    return chains.ordered_tree_lines(_opaque(n), ["ord"], 2)


# orders as a deep forest: within a nation and market segment an order follows one of the three before it
_DEEP = "RECURSIVE g AS (SELECT o_orderkey AS id, c_nationkey * 10 + (ascii(c_mktsegment) % 10) AS seg FROM orders JOIN customer ON c_custkey = o_custkey), o AS MATERIALIZED (SELECT id, lag(id, CAST(1 + id % 3 AS INTEGER)) OVER (PARTITION BY seg ORDER BY id) AS parent_id FROM g)"
_DEEP = _DEEP.replace("lag(id, CAST(1 + id % 3 AS INTEGER)) OVER (PARTITION BY seg ORDER BY id)", "CASE id % 3 WHEN 0 THEN lag(id, 1) OVER s WHEN 1 THEN lag(id, 2) OVER s ELSE lag(id, 3) OVER s END").replace("FROM g)", "FROM g WINDOW s AS (PARTITION BY seg ORDER BY id))")


def _deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    rows = read("orders").join(read("customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("id"), (F.col("c_nationkey") * 10 + F.ascii("c_mktsegment") % 10).alias("seg"))
    w = Window.partitionBy("seg").orderBy("id")
    up = F.when(F.col("id") % 3 == 0, F.lag("id", 1).over(w)).when(F.col("id") % 3 == 1, F.lag("id", 2).over(w)).otherwise(F.lag("id", 3).over(w))
    return rows.select("id", up.alias("parent_id"))


@query(f"WITH {_DEEP}, w AS (SELECT id, id AS root, 0 AS depth FROM o WHERE parent_id IS NULL UNION ALL SELECT o.id, w.root, w.depth + 1 FROM w JOIN o ON o.parent_id = w.id) SELECT id, root, CAST(depth AS BIGINT) AS depth FROM w", forest=False)
def chain_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.depths(_deep(spark, sf_dir))


@query(f"WITH {_DEEP}, w AS (SELECT id, [-id] AS ords FROM o WHERE parent_id IS NULL UNION ALL SELECT o.id, list_append(w.ords, -o.id) FROM w JOIN o ON o.parent_id = w.id) SELECT id, row_number() OVER (ORDER BY ords) - 1 AS position FROM w", forest=False)
def deep_preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.preorder(_deep(spark, sf_dir).withColumn("down", -F.col("id")), ["down"]).select("id", "position")


_STEP = "regexp_matches(lower(trim(coalesce(description, ''))), '^step\\s+\\d+\\s*:')"
_LIMITS = [("*", "step", "max", 10.0, 20.0), ("*", "empty", "max", 10.0, 20.0), ("*", "template", "max", 10.0, 20.0), ("*", "good_verb", "min", 50.0, 30.0), ("asia", "empty", "max", 1.0, 2.0), ("all", "good_verb", "min", 90.0, 80.0)]


@query(f""", f AS (SELECT string_split(id,'/')[1] AS d, {_STEP} AS step, coalesce(description, '') = '' AS empty, ({_GENERIC}) IS NOT NULL AS template, {_any('lower(name)', W.MANIPULATION_VERBS)} AS good_verb FROM (SELECT *, {_WORDS} AS w FROM n)),
 m AS (SELECT coalesce(d, 'all') AS scope, unnest([{', '.join(f"{{'c': '{c}', 'v': (count(*) FILTER (WHERE {c}) * 10000 // count(*)) / 100.0}}" for c in ('step', 'empty', 'template', 'good_verb'))}]) AS x FROM f GROUP BY GROUPING SETS ((), (d))),
 l AS (SELECT * FROM (VALUES {', '.join(map(str, _LIMITS))}) t(scope, c, side, ok, warn)),
 g AS (SELECT m.scope, x.c AS check_name, CAST(x.v AS DOUBLE) AS value, coalesce(o.side, a.side) AS side, coalesce(o.ok, a.ok) AS ok, coalesce(o.warn, a.warn) AS warn FROM m LEFT JOIN l o ON o.scope = m.scope AND o.c = x.c LEFT JOIN l a ON a.scope = '*' AND a.c = x.c)
 SELECT scope, check_name, value, CASE WHEN (side = 'min' AND value >= ok) OR (side = 'max' AND value <= ok) THEN 'PASS' WHEN (side = 'min' AND value >= warn) OR (side = 'max' AND value <= warn) THEN 'WARN' ELSE 'FAIL' END AS status FROM g""")
def qa_by_domain(n):
    marked = R.with_template(n.withColumn("domain", T.domain_of(F.col("id"))), "__t")
    checks = {"step": R.step_description(F.col("description")), "empty": F.coalesce("description", F.lit("")) == "", "template": F.col("__t").isNotNull(), "good_verb": ~judging.lacks_good_verb(F.col("name"))}
    limits = n.sparkSession.createDataFrame(_LIMITS, "scope string, check_name string, side string, ok double, warn double")
    return reports.graded_by_scope(reports.measured(marked, checks, "domain"), limits)


_KNOWN = "EXISTS (SELECT 1 FROM (SELECT DISTINCT lower(p_name) AS p FROM part) WHERE starts_with(translate(lower(name), '_-', '  '), 'paint ' || p) OR starts_with(translate(lower(name), '_-', '  '), 'wash ' || p))"


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE g) AS generated, count(*) FILTER (WHERE g AND e) AS empty_description, count(*) FILTER (WHERE g AND s) AS step_description, count(*) FILTER (WHERE g AND t) AS template, count(*) FILTER (WHERE g AND a AND NOT k) AS invalid_atomic, count(*) FILTER (WHERE g AND a AND k) AS valid_atomic, count(*) FILTER (WHERE g AND NOT e AND NOT s AND NOT t AND NOT (a AND NOT k)) AS good FROM (SELECT list_contains(sources, 'llm_generated') AS g, coalesce(description, '') = '' AS e, {_STEP} AS s, ({_GENERIC}) IS NOT NULL AS t, node_type = 'atomic' AS a, {_KNOWN} AS k FROM (SELECT *, {_WORDS} AS w FROM n))")
def quality_counters(n):
    from grovespark.query_more import _table_of

    names = _table_of(n, "part").select(F.lower("p_name").alias("p")).distinct()
    phrases = names.select(F.explode(F.array(F.concat(F.lit("paint_"), "p"), F.concat(F.lit("wash_"), "p"))).alias("phrase"))
    return reports.quality_counters(n, phrases, 3)


_BUCKET = f"CASE WHEN ({_TRASH_FIRST}) IS NULL THEN 'trainable' WHEN contains(lower(name), 'test') THEN 'ambiguous' ELSE 'archived' END"


@query(f"SELECT bucket, node_type, verb, count(*) AS n_nodes FROM (SELECT {_BUCKET} AS bucket, node_type, regexp_split_to_array(lower(name), '[\\s,.(]')[1] AS verb FROM n) GROUP BY GROUPING SETS ((bucket), (bucket, node_type), (bucket, verb))")
def bucket_verbs(n):
    low = n.select("node_type", F.lower("name").alias("low"))
    found = low.select("node_type", R.match_rules(F.col("low"), R.TRASH_PATTERNS).isNull().alias("free"), F.col("low").contains("test").alias("tests"), F.split("low", r"[\s,.(]")[0].alias("verb"))
    placed = found.select("node_type", "verb", F.when(F.col("free"), "trainable").when(F.col("tests"), "ambiguous").otherwise("archived").alias("bucket"))
    sets = [["bucket"], ["bucket", "node_type"], ["bucket", "verb"]]
    return placed.groupingSets([[F.col(c) for c in s] for s in sets], "bucket", "node_type", "verb").agg(F.count("*").alias("n_nodes"))


@query("SELECT category, node_type, count(DISTINCT domain) AS n_domains, count(*) AS n_nodes FROM (SELECT left(id, 1) AS category, node_type, string_split(id,'/')[1] || '/' || coalesce(string_split(id,'/')[2], '') AS domain FROM n) GROUP BY ROLLUP (category, node_type)")
def category_domains(n):
    rows = n.select(F.substring("id", 1, 1).alias("category"), "node_type", F.concat(T.domain_of(F.col("id")), F.lit("/"), F.coalesce(F.get(F.split("id", "/"), F.lit(1)), F.lit(""))).alias("domain"))
    return reports.domain_breakdown(rows, ["category", "node_type"], "domain").withColumnsRenamed({"n_distinct": "n_domains", "n_rows": "n_nodes"})
