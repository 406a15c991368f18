"""Model responses to nodes: reading their JSON, attaching children, merging batches, completion criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grovespark.functions.text import norm_name, slug

RESPONSE = "struct<is_atomic: boolean, subtasks: array<struct<name: string, description: string, is_atomic: boolean>>>"


def unfenced(text: Column) -> Column:
    """Text inside a Markdown code fence, also one that was cut off before its end; otherwise the text itself."""
    inner = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*(?:```|\z)", 1)
    return F.when(text.contains("```"), inner).otherwise(F.trim(text))


def parse(text: Column, schema: str = RESPONSE) -> Column:
    """The response as a struct: as it stands, else cut after its last whole object and closed; null if neither reads."""
    body = unfenced(text)
    cut = F.concat(F.regexp_extract(body, r"(?s)^(.*\})", 1), F.lit("]}"))
    read = lambda t: F.from_json(t, f"{schema[:-1]}, _bad: string>", {"columnNameOfCorruptRecord": "_bad"})
    sound = lambda p: F.when(p["_bad"].isNull(), p)
    return F.coalesce(sound(read(body)), sound(read(cut)))


def read_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """responses with r, the struct, and status: ok as it stands, salvaged after the cut, regex where only names could be
    found, failed. A struct found by pattern has the names alone."""
    body = unfenced(F.col(text))
    whole = F.from_json(body, f"{RESPONSE[:-1]}, _bad: string>", {"columnNameOfCorruptRecord": "_bad"})
    names = F.regexp_extract_all(body, F.lit(r'"(?:task|name)"\s*:\s*"([^"]+)"'), F.lit(1))
    found = F.struct(F.lit(None).cast("boolean").alias("is_atomic"), F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("boolean").alias("is_atomic"))).alias("subtasks"))
    read = responses.withColumn("__r", parse(F.col(text))).withColumn("__ok", whole["_bad"].isNull() & whole.isNotNull())
    status = F.when(F.col("__r").isNull(), F.when(F.size(names) > 0, "regex").otherwise("failed")).when(F.col("__ok"), "ok").otherwise("salvaged")
    kept = F.struct(F.col("__r.is_atomic").alias("is_atomic"), F.transform("__r.subtasks", lambda x: F.struct(x["name"].alias("name"), x["description"].alias("description"), x["is_atomic"].alias("is_atomic"))).alias("subtasks"))
    out = read.withColumn("status", status)
    return out.withColumn("r", F.when(F.col("status") == "regex", found).when(F.col("__r").isNotNull(), kept)).drop("__r", "__ok")


def merge_subtrees(nodes: DataFrame, batch: DataFrame, source: str = "llm_generated") -> DataFrame:
    """New nodes (id, parent_id, name, node_type, sources) of batch(domain, category, name, ordinal).

    A domain that is there, by its normalised name, is used; another is made. A category is made only where it brings a
    task whose normalised name the forest does not have; of names that the batch repeats the first counts; ids that are
    there already stay as they are.
    """
    known = nodes.select(norm_name(F.col("name")).alias("__n")).distinct()
    fresh = batch.withColumn("__n", norm_name(F.col("name"))).where("__n <> ''").join(known, "__n", "left_anti")
    first = fresh.groupBy("__n").agg(F.min(F.struct("ordinal", "domain", "category", "name")).alias("m")).select("m.*")
    there = nodes.where("node_type = 'domain'").select(norm_name(F.col("name")).alias("__d"), F.col("id").alias("__id")).groupBy("__d").agg(F.min("__id").alias("__id"))
    placed = first.withColumn("__d", norm_name(F.col("domain"))).join(there, "__d", "left").withColumn("did", F.coalesce("__id", slug(F.col("domain"))))
    placed = placed.withColumn("cid", F.concat_ws("/", "did", slug(F.col("category")))).withColumn("tid", F.concat_ws("/", "cid", slug(F.col("name"))))
    level = lambda df, id_, up, name, kind: df.select(F.col(id_).alias("id"), up.cast("string").alias("parent_id"), F.col(name).alias("name"), F.lit(kind).alias("node_type"), "ordinal")
    rows = level(placed, "did", F.lit(None), "domain", "domain").unionByName(level(placed, "cid", F.col("did"), "category", "task")).unionByName(level(placed, "tid", F.col("cid"), "name", "subtask"))
    once = rows.groupBy("id").agg(F.min(F.struct("ordinal", "parent_id", "name", "node_type")).alias("m")).select("id", "m.parent_id", "m.name", "m.node_type")
    return once.join(nodes.select("id"), "id", "left_anti").withColumn("sources", F.array(F.lit(source)))


def gap_fill(nodes: DataFrame, batch: DataFrame, most: int = 15, tags: tuple[str, ...] = ("gap_fill",)) -> DataFrame:
    """merge_batch among siblings, at most so many new nodes for each parent, the first by ordinal, with tags."""
    made = merge_batch(nodes, batch, "siblings").join(batch.groupBy("parent_id", "name").agg(F.min("ordinal").alias("ordinal")), ["parent_id", "name"])
    ranked = made.withColumn("__r", F.row_number().over(Window.partitionBy("parent_id").orderBy("ordinal"))).where(F.col("__r") <= most)
    return ranked.select("id", "parent_id", "name", F.array(*map(F.lit, tags)).alias("tags"))


def attach_children(parents: DataFrame, responses: DataFrame, valid_atomic: Column, text: str = "response", source: str = "llm_generated") -> DataFrame:
    """New child nodes (id, parent_id, pos, name, node_type, description, sources) of parents(id, node_type).

    A child of a domain is a task; one claimed atomic is atomic where valid_atomic (over column name) holds; all others
    are subtasks. Responses that can't be read, blank names and repeated ids give no rows.
    """
    read = responses.select(F.col("id").alias("parent_id"), parse(F.col(text)).alias("r")).where("r is not null")
    kids = read.select("parent_id", F.posexplode("r.subtasks").alias("pos", "s")).select("parent_id", "pos", F.trim("s.name").alias("name"), "s.description", F.coalesce("s.is_atomic", F.lit(False)).alias("claimed")).where("name <> ''")
    typed = kids.join(parents.select(F.col("id").alias("parent_id"), F.col("node_type").alias("__t")), "parent_id")
    kind = F.when(F.col("__t") == "domain", "task").when(F.col("claimed") & F.coalesce(valid_atomic, F.lit(False)), "atomic").otherwise("subtask")
    made = typed.select(F.concat_ws("/", "parent_id", slug(F.col("name"))).alias("id"), "parent_id", "pos", "name", kind.alias("node_type"), "description", F.array(F.lit(source)).alias("sources"))
    return made.groupBy("id").agg(F.min(F.struct("parent_id", "pos", "name", "node_type", "description", "sources")).alias("m")).select("id", "m.*")


def mark_atomic(nodes: DataFrame, responses: DataFrame, text: str = "response") -> DataFrame:
    """Nodes whose response says atomic, or lists nothing, become atomic; nodes without a readable response stay."""
    read = responses.select(F.col("id"), parse(F.col(text)).alias("r")).where("r is not null")
    ends = read.where(F.coalesce("r.is_atomic", F.lit(False)) | (F.coalesce(F.size("r.subtasks"), F.lit(0)) <= 0)).select("id", F.lit(True).alias("__ends")).distinct()
    return nodes.join(ends, "id", "left").withColumn("node_type", F.when(F.col("__ends"), "atomic").otherwise(F.col("node_type"))).drop("__ends")


def merge_batch(nodes: DataFrame, batch: DataFrame, scope: str = "global") -> DataFrame:
    """Rows of batch(parent_id, name, ordinal) that are new, as (id, parent_id, name): names already there, in the whole
    forest or (scope 'siblings') under the same parent, are skipped, the first of a repeated name wins, ids stay unique."""
    keys = ["__n"] if scope == "global" else ["__n", "parent_id"]
    known = nodes.withColumn("__n", norm_name(F.col("name"))).select(*keys)
    fresh = batch.withColumn("__n", norm_name(F.col("name"))).where("__n <> ''").join(known, keys, "left_anti")
    firsts = fresh.groupBy(*keys).agg(F.min(F.struct("ordinal", "parent_id", "name")).alias("m")).select("m.ordinal", "m.parent_id", "m.name")
    made = firsts.withColumn("id", F.concat_ws("/", "parent_id", slug(F.col("name")))).join(nodes.select("id"), "id", "left_anti")
    w = Window.partitionBy("id").orderBy("ordinal")
    return made.withColumn("__r", F.row_number().over(w)).where("__r = 1").select("id", "parent_id", "name")


def attach_completion(nodes: DataFrame, responses: DataFrame, text: str = "response") -> DataFrame:
    """Adds completion(preconditions, postconditions, invariants) from responses by id; unreadable parts are empty strings."""
    fields = ("preconditions", "postconditions", "invariants")
    said = F.from_json(unfenced(F.col(text)), ", ".join(f"{f} string" for f in fields))
    read = responses.groupBy("id").agg(F.max(text).alias(text)).select("id", F.struct(*[F.coalesce(said[f], F.lit("")).alias(f) for f in fields]).alias("completion"))
    return nodes.drop("completion").join(read, "id", "left")
