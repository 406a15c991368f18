"""A forest projected from the star-schema tables, and the same rows in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions.text import slug
from grovespark.scratch import settled as materialize

VERBS = ["pick up", "inspect", "calibrate", "pour", "handle", "move", "test", "grasp", "plan", "spray", "wash", "paint"]


_STORED: dict[tuple[str, str], DataFrame] = {}


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projected forest as a written table, made once an application: a forest is stored data, and queries that use
    it several times should scan it and not derive it anew."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        _STORED[key] = materialize(project(spark, sf_dir))
        _STORED[key]._of = sf_dir
    return _STORED[key]


def directory_of(forest: DataFrame) -> str:
    """Where the tables of a forest that nodes() gave are."""
    return forest._of


def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, parent_id, name, node_type, description, sources): domain, task, two levels of subtask, atomic."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    onet = F.array(F.lit("onet"))
    none = F.lit(None).cast("string")
    row = lambda df, kind, said: df.select("id", "parent_id", "name", F.lit(kind).alias("node_type"), said.alias("description"), onet.alias("sources"))
    dom = read("region").select(F.col("r_regionkey").alias("rk"), slug(F.col("r_name")).alias("id"), none.alias("parent_id"), F.col("r_name").alias("name"))
    tsk = read("nation").join(dom.select("rk", F.col("id").alias("parent_id")), F.col("n_regionkey") == F.col("rk")).select(F.col("n_nationkey").alias("nk"), F.concat_ws("/", "parent_id", slug(F.col("n_name"))).alias("id"), "parent_id", F.col("n_name").alias("name"))
    cus = read("customer").join(tsk.select("nk", F.col("id").alias("parent_id")), F.col("c_nationkey") == F.col("nk")).select(F.col("c_custkey").alias("ck"), F.concat(F.col("parent_id"), F.lit("/customer_"), "c_custkey").alias("id"), "parent_id", F.concat_ws(" ", "c_mktsegment", "c_name").alias("name"))
    ord_ = read("orders").join(cus.select("ck", F.col("id").alias("parent_id")), F.col("o_custkey") == F.col("ck")).select(F.col("o_orderkey").alias("ok"), F.concat(F.col("parent_id"), F.lit("/o_"), "o_orderkey").alias("id"), "parent_id", F.col("o_orderpriority").alias("name"), "o_orderstatus")
    # lines are dealt out by order first: they are sorted once, and go on to their order from where they lie; where parts are
    # too many to be sent to every task, lines meet them while they are numbers and move by order with no more than their name
    line = F.min(F.struct(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("e"), F.col("l_returnflag").alias("f"))).alias("m")
    li = read("lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(line).select("l_orderkey", "l_linenumber", F.col("m.p").alias("p"), (F.col("m.f") == "R").alias("returned"))
    what = F.when(F.col("p_type") == "SMALL", "materials").when(F.col("p_type") == "LARGE", "equipment").when(F.col("p_type") == "PROMO", "dishes").otherwise(F.col("p_name"))
    name = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, VERBS)), (F.col("p") % 12 + 1).cast("int")), what)
    named = li.join(read("part").select("p_partkey", "p_name", "p_type"), F.col("p") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "returned", name.alias("name"))
    # orders last: the lines of one are written side by side, which keeps ids small on disk and sums by parent local
    atm = named.join(ord_.select("ok", F.col("id").alias("parent_id")), F.col("l_orderkey") == F.col("ok"))
    atm = atm.select(F.concat(F.col("parent_id"), F.lit("/l_"), "l_linenumber").alias("id"), "parent_id", "name", "l_orderkey", "l_linenumber", F.when(F.col("returned"), onet).otherwise(F.array(F.lit("llm_generated"))).alias("sources"))
    said = F.when(F.col("l_orderkey") % 11 == 0, F.concat(F.lit("Step "), "l_linenumber", F.lit(": "), "name")).when(F.col("l_orderkey") % 13 == 0, "").otherwise(F.concat("name", F.lit(" for order "), "l_orderkey"))
    atm = atm.select("id", "parent_id", "name", F.lit("atomic").alias("node_type"), said.alias("description"), "sources")
    parts = [row(dom, "domain", none), row(tsk, "task", none), row(cus, "subtask", none), row(ord_, "subtask", F.col("o_orderstatus")), atm]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SLUG = r"regexp_replace(regexp_replace(lower({0}),'[^\w\s-]','','g'),'[-\s]+','_','g')"

NODES_SQL = f"""
li AS (SELECT l_orderkey, l_linenumber, min(struct_pack(p:=l_partkey,s:=l_suppkey,q:=l_quantity,e:=l_extendedprice,f:=l_returnflag)) m FROM lineitem GROUP BY 1,2),
dom AS (SELECT r_regionkey k, {_SLUG.format("r_name")} id, r_name nm FROM region),
tsk AS (SELECT n_nationkey k, dom.id||'/'||{_SLUG.format("n_name")} id, dom.id pid, n_name nm FROM nation JOIN dom ON k=n_regionkey),
cus AS (SELECT c_custkey k, tsk.id||'/customer_'||c_custkey id, tsk.id pid, c_mktsegment||' '||c_name nm FROM customer JOIN tsk ON k=c_nationkey),
ord AS (SELECT o_orderkey k, cus.id||'/o_'||o_orderkey id, cus.id pid, o_orderpriority nm, o_orderstatus ds FROM orders JOIN cus ON k=o_custkey),
atm AS (SELECT ord.id||'/l_'||l_linenumber id, ord.id pid,
  {VERBS}[(m.p%12)::INT+1]||' '||CASE p_type WHEN 'SMALL' THEN 'materials' WHEN 'LARGE' THEN 'equipment' WHEN 'PROMO' THEN 'dishes' ELSE p_name END nm,
  CASE WHEN m.f='R' THEN ['onet'] ELSE ['llm_generated'] END src, l_orderkey, l_linenumber
  FROM li JOIN ord ON k=l_orderkey JOIN part ON p_partkey=m.p),
n AS MATERIALIZED (SELECT id, NULL::VARCHAR parent_id, nm AS name, 'domain' node_type, NULL::VARCHAR description, ['onet'] sources FROM dom
  UNION ALL SELECT id, pid, nm, 'task', NULL, ['onet'] FROM tsk UNION ALL SELECT id, pid, nm, 'subtask', NULL, ['onet'] FROM cus
  UNION ALL SELECT id, pid, nm, 'subtask', ds, ['onet'] FROM ord
  UNION ALL SELECT id, pid, nm, 'atomic', CASE WHEN l_orderkey%11=0 THEN 'Step '||l_linenumber||': '||nm WHEN l_orderkey%13=0 THEN '' ELSE nm||' for order '||l_orderkey END, src FROM atm)"""
