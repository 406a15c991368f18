"""Forests from seed tables: occupations with task statements, life domains with example tasks, and their lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.functions.text import make_id, slug

_COLUMNS = ["id", "parent_id", "name", "node_type", "description", "sources", "source_ids", "tags"]


def _rows(df: DataFrame, kind: str, source: str, said, source_id=None, tags=None) -> DataFrame:
    none = F.array().cast("array<string>")
    listed = F.array(source_id.cast("string")) if source_id is not None else none
    return df.select("id", "parent_id", "name", F.lit(kind).alias("node_type"), said.cast("string").alias("description"), F.array(F.lit(source)).alias("sources"), listed.alias("source_ids"), (none if tags is None else tags).alias("tags")).select(_COLUMNS)


def bootstrap_forest(domains: DataFrame, occupations: DataFrame, statements: DataFrame, source: str = "onet") -> DataFrame:
    """Nodes of domains(code, id, name), occupations(code, title, description, major_group) and statements(task_id,
    occupation_code, task, task_type): domain, task and atomic level.

    Occupations without a domain and statements without an occupation give no rows. Descriptions are cut at 500
    characters and the slugs of statements at 200; names stay whole. The few domains are what Spark may broadcast.
    """
    top = domains.select("id", F.lit(None).cast("string").alias("parent_id"), "name", "code")
    occ = occupations.join(domains.select(F.col("code").alias("major_group"), F.col("id").alias("parent_id")), "major_group")
    occ = occ.select(make_id(F.col("parent_id"), F.col("title")).alias("id"), "parent_id", F.col("title").alias("name"), F.substring(F.coalesce("description", F.lit("")), 1, 500).alias("said"), "code")
    low = statements.join(occ.select(F.col("code").alias("occupation_code"), F.col("id").alias("parent_id")), "occupation_code")
    low = low.select(F.concat_ws("/", "parent_id", slug(F.substring("task", 1, 200))).alias("id"), "parent_id", F.col("task").alias("name"), "task_id", "task_type")
    tags = F.array(F.when(F.col("task_type") == "Core", "core").otherwise("supplemental"), F.lit("onet_task"))
    out = _rows(top, "domain", source, F.concat(F.lit("Occupations in "), "name"), F.col("code"))
    return out.unionByName(_rows(occ, "task", source, F.col("said"), F.col("code"))).unionByName(_rows(low, "atomic", source, F.lit(None), F.col("task_id"), tags))


def bootstrap_life(domains: DataFrame, categories: DataFrame, source: str = "human_curated") -> DataFrame:
    """Nodes of domains(id, name) and categories(code, domain_id, name, description, example_tasks): domain, task and subtask level."""
    top = domains.select("id", F.lit(None).cast("string").alias("parent_id"), "name")
    cat = categories.join(domains.select(F.col("id").alias("domain_id")), "domain_id").select(make_id(F.col("domain_id"), F.col("name")).alias("id"), F.col("domain_id").alias("parent_id"), "name", "description", "code", "example_tasks")
    low = cat.select(F.col("id").alias("parent_id"), F.explode("example_tasks").alias("name")).select(make_id(F.col("parent_id"), F.col("name")).alias("id"), "parent_id", "name")
    out = _rows(top, "domain", source, F.concat(F.lit("Personal activities: "), "name"))
    return out.unionByName(_rows(cat, "task", source, F.col("description"), F.col("code"))).unionByName(_rows(low, "subtask", source, F.lit(None)))


def tasks_for_occupation(statements: DataFrame, codes: DataFrame) -> DataFrame:
    return statements.join(codes.select(F.col("code").alias("occupation_code")).distinct(), "occupation_code", "left_semi")


def activities_below(general: DataFrame, middle: DataFrame, detailed: DataFrame) -> DataFrame:
    """(gwa_id, iwa_id, dwa_id): the chain general(gwa_id), middle(iwa_id, gwa_id), detailed(dwa_id, iwa_id)."""
    return middle.join(general.select("gwa_id"), "gwa_id").join(detailed.select("dwa_id", "iwa_id"), "iwa_id").select("gwa_id", "iwa_id", "dwa_id")


def occupations_by_group(occupations: DataFrame, group: str) -> DataFrame:
    return occupations.where(F.col("major_group") == group)


def seed_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of each seed table."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def seed_counts(tables: dict[str, DataFrame], distinct: dict[str, tuple[DataFrame, str]], listed: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, n): rows of each table; distinct values of columns that are not null (groups); entries of array columns (the
    example tasks of life categories). Empty tables count 0."""
    name = lambda df, k: df.select(F.lit(k).alias("name"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    parts = [name(df.agg(F.count("*").alias("n")), k) for k, df in tables.items()]
    parts += [name(df.agg(F.count_distinct(c).alias("n")), k) for k, (df, c) in distinct.items()]
    parts += [name(df.agg(F.sum(F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)).alias("n")), k) for k, (df, c) in listed.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
