"""Review decisions: selections by verb, moves between buckets, marks, ratings joined to nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions.text import domain_of, first_verb
from grovespark.operators.curate import latest


def verb_selected(nodes: DataFrame, verbs: DataFrame, types: tuple[str, ...] = ("atomic", "subtask", "task")) -> DataFrame:
    """(id, verb) of the nodes whose cleaned first word is among verbs(verb)."""
    words = nodes.where(F.col("node_type").isin(*types)).select("id", first_verb(F.col("name")).alias("verb"))
    return words.join(verbs.select(F.lower("verb").alias("verb")).distinct(), "verb", "left_semi").select("id", "verb")


def bucket_move(placed: DataFrame, moves: DataFrame) -> DataFrame:
    """(id, bucket, reason, moved, wrong_source) of placed(id, name, bucket) after the latest of moves(id, from, to, ts, tie).

    A move whose node is not in the bucket it names changes nothing and is flagged. A node that goes to the archive gets
    a reason that names its first word; others have none.
    """
    last = latest(moves.select("id", "ts", "tie", "from", "to"), "id", "ts", "tie").select("id", F.col("from").alias("__f"), F.col("to").alias("__t"))
    both = placed.join(last, "id", "left")
    moves_ = F.coalesce(F.col("__f") == F.col("bucket"), F.lit(False))
    verb = F.split(F.lower("name"), r"[\s,.(]")[0]
    reason = F.when(moves_ & (F.col("__t") == "archived"), F.concat(F.lit("Manually archived: "), verb))
    return both.select("id", F.when(moves_, F.col("__t")).otherwise(F.col("bucket")).alias("bucket"), reason.alias("reason"), moves_.alias("moved"), (F.col("__f").isNotNull() & ~moves_).alias("wrong_source"))


def marks(log: DataFrame, key: str, decision: str, ts: str, tie: str) -> DataFrame:
    """The latest decision of each key, so that a mark for one side takes the key from the other."""
    return latest(log.select(key, ts, tie, decision), key, ts, tie).select(key, decision)


def bulk_decisions(nodes: DataFrame, by_verb: DataFrame, single: DataFrame) -> DataFrame:
    """(id, decision): a decision for a verb(verb, decision, ts) holds for all its nodes, unless the node(id, decision, ts)
    has a later one of its own. Decisions of one verb or node at one time: the greatest counts."""
    verbs = by_verb.groupBy("verb").agg(F.max(F.struct("ts", "decision")).alias("v"))
    own = single.groupBy("id").agg(F.max(F.struct("ts", "decision")).alias("o"))
    named = nodes.select("id", first_verb(F.col("name")).alias("verb")).join(verbs, "verb", "left").join(own, "id", "left")
    return named.select("id", F.greatest("v", "o").alias("d")).where("d is not null").select("id", "d.decision")


def removal_categories(selected: DataFrame, nodes: DataFrame, category: Column) -> DataFrame:
    """(category, n_ids): distinct selected ids that are nodes."""
    return nodes.join(selected.select("id").distinct(), "id", "left_semi").groupBy(category.alias("category")).agg(F.count_distinct("id").alias("n_ids"))


def rated_nodes(nodes: DataFrame, ratings: DataFrame, how: str = "inner") -> DataFrame:
    """nodes with the tier of their latest rating(id, tier, ts, tie). inner drops unknown ids and unrated nodes."""
    last = latest(ratings.select("id", "ts", "tie", "tier"), "id", "ts", "tie").select("id", F.col("tier").alias("rating"))
    return nodes.join(last, "id", how)


def export_decisions(nodes: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, counts): the rated nodes (id, name, rating), and how many have each rating."""
    rows = rated_nodes(nodes, ratings).select("id", "name", "rating")
    return rows, rows.groupBy("rating").agg(F.count("*").alias("n_nodes"))


def review_tree(nodes: DataFrame, ratings: DataFrame, node_type: str) -> DataFrame:
    """(domain, id, name, n_children, rating) of the nodes of a type; rating is null for unrated ones."""
    kids = nodes.where("parent_id is not null").groupBy(F.col("parent_id").alias("__p")).agg(F.count("*").alias("n_children"))
    rows = rated_nodes(nodes.where(F.col("node_type") == node_type), ratings, "left")
    return rows.join(kids, F.col("id") == F.col("__p"), "left").select(domain_of(F.col("id")).alias("domain"), "id", "name", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "rating")


def matching_ids(ids: DataFrame, nodes: DataFrame) -> DataFrame:
    return ids.join(nodes.select("id"), "id", "left_semi")
