"""Reading and writing forests: manifests, record lines, seed tables, published and tiered sets, versions.

Readers give lazy DataFrames; writers are single Spark jobs whose commit protocol makes them whole or absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grovespark.operators.tree import nested_json, rebuild_children
from grovespark.scratch import materialize
from grovespark.sources.manifest import manifest_entries

COMPLETION = "struct<preconditions:string,postconditions:string,invariants:string>"
NODE = f"id string, name string, node_type string, description string, parent_id string, children_ids array<string>, sources array<string>, tags array<string>, completion {COMPLETION}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of manifest files, {..., "nodes": {id: node}} or {id: node}, of any size: many tasks read one file.

    A node without an id takes its key. An id that is listed twice gives two rows; an entry that is no node is an error.
    """
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in spark.createDataFrame([], NODE).schema)
    entries = manifest_entries(spark, path)
    nodes = F.from_json("entries", f"map<string, struct<{fields}>>")
    sound = F.when(nodes.isNull(), F.raise_error(F.concat(F.lit("no node: "), F.substring("entries", 1, 200)))).otherwise(nodes)
    rows = entries.select(F.explode(F.map_entries(sound)).alias("e")).select(F.col("e.key").alias("__id"), "e.value.*")
    return rows.withColumn("id", F.coalesce("id", "__id")).drop("__id")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of a line each; blank lines are skipped, a missing path is an empty table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_yaml_tree(spark: SparkSession, path: str) -> DataFrame:
    """(file, id, name, node_type, parent_id, description, language, typical_duration, confidence, sources, tags, corrupt)
    of all *.yaml below path; broken files are marked. rebuild_children of the sound rows gives the index anew."""
    fields = ["id", "name", "node_type", "parent_id", "description", "language", "typical_duration", "confidence"]
    lists = ["sources", "tags"]

    def run(batches):
        import pandas as pd
        import yaml

        for batch in batches:
            rows = []
            for file, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    node = yaml.safe_load(content)
                except yaml.YAMLError:
                    node = None
                sound = isinstance(node, dict) and bool(node.get("id"))
                own = node if sound else {}
                rows.append((file, *[None if own.get(f) is None else str(own[f]) for f in fields], *[[str(x) for x in own.get(f) or []] for f in lists], not sound))
            yield pd.DataFrame(rows, columns=["file", *fields, *lists, "corrupt"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.yaml").load(path)
    return files.select("path", "content").mapInPandas(run, ", ".join(["file string", *[f"{f} string" for f in fields], *[f"{f} array<string>" for f in lists], "corrupt boolean"]))


def major_group(code: Column) -> Column:
    return F.when(code.contains("-"), F.split(code, "-")[0]).otherwise(F.substring(code, 1, 2))


def read_tsv_seed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A seed table with a header: every value trimmed, rows without a key dropped, major_group derived from the key."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="")
    trimmed = raw.select([F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in raw.columns])
    return trimmed.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("major_group", major_group(F.col(key)))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def flat_rows(nodes: DataFrame) -> DataFrame:
    """All nodes for a JSON-lines export; the embodiment fields of nodes that can act only."""
    acts = F.col("node_type").isin("subtask", "atomic")
    own = [c for c in ("completion", "tags") if c in nodes.columns]
    return nodes.withColumns({c: F.when(acts, F.col(c)) for c in own})


def export_flat(nodes: DataFrame, path: str) -> None:
    """One JSON line for each node; null fields are left out."""
    flat_rows(nodes).write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def light_rows(nodes: DataFrame) -> DataFrame:
    """The five columns that a browser of a large forest needs; children_ids by id."""
    return rebuild_children(nodes.select("id", "name", "node_type", "parent_id"))


def export_nested(nodes: DataFrame, path: str, root_depth: int, max_depth: int) -> None:
    """One line of nested JSON for the subtree of each node at root_depth."""
    nested_json(nodes, root_depth, max_depth).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def to_published(nodes: DataFrame) -> DataFrame:
    """Completion flattened, nulls as empty strings, depth from 1, is_leaf and is_atomic."""
    part = lambda f: F.coalesce(F.col(f"completion.{f}"), F.lit("")).alias(f)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return nodes.select("id", *map(text, ("name", "node_type", "description", "parent_id")), F.coalesce("children_ids", F.array().cast("array<string>")).alias("children_ids"), part("preconditions"), part("postconditions"), part("invariants"), F.size(F.split("id", "/")).alias("depth"), (F.coalesce(F.size("children_ids"), F.lit(0)) <= 0).alias("is_leaf"), (F.col("node_type") == "atomic").alias("is_atomic"))


def from_published(rows: DataFrame) -> DataFrame:
    """The inverse: empty strings as nulls, completion only where a part is set; rows without an id go."""
    real = lambda c: F.nullif(F.col(c), F.lit(""))
    parts = [real(c).alias(c) for c in ("preconditions", "postconditions", "invariants")]
    completion = F.when(F.coalesce(*[real(c) for c in ("preconditions", "postconditions", "invariants")]).isNotNull(), F.struct(*parts))
    return rows.where(F.coalesce("id", F.lit("")) != "").select("id", *[real(c).alias(c) for c in ("name", "node_type", "description", "parent_id")], "children_ids", completion.alias("completion"))


def export_tiered(nodes: DataFrame, path: str, tier: str = "tier") -> None:
    """One folder per tier; rows are not gathered, so a tier with most rows is written by many tasks."""
    nodes.write.mode("overwrite").partitionBy(tier).json(path)


def upsert_nodes(nodes: DataFrame, changes: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, rejected): the change with the greatest order wins for each id; a change is rejected where a node of its
    chain of parents is neither there nor among the changes that stay. children_ids, if nodes has them, are rebuilt.

    Changes hang from each other as deep as they go, so the parents are asked for level by level until none is rejected.
    """
    last = materialize(changes.groupBy("id").agg(F.max(F.struct(order, *[c for c in changes.columns if c not in ("id", order)])).alias("m")).select("id", "m.*").drop(order))
    there = nodes.select(F.col("id").alias("__p"))
    placed = last
    while True:
        known = there.unionByName(placed.select(F.col("id").alias("__p")))
        kept = materialize(placed.where("parent_id is null").unionByName(placed.where("parent_id is not null").join(known, F.col("parent_id") == F.col("__p"), "left_semi")))
        if kept.count() == placed.count():
            break
        placed = kept
    rejected = last.join(placed.select("id"), "id", "left_anti")
    out = nodes.join(placed.select("id"), "id", "left_anti").unionByName(placed, allowMissingColumns=True)
    return rebuild_children(out) if "children_ids" in nodes.columns else out, rejected


def commit_snapshot(df: DataFrame, path: str, version: int) -> DataFrame:
    """Writes version v=N beside the earlier ones, which stay as backups; refuses to replace one. Returns it."""
    df.write.mode("errorifexists").parquet(f"{path}/v={version}")
    return df.sparkSession.read.parquet(f"{path}/v={version}")
