"""Deduplication, latest decisions, cut-offs, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key by order: a pre-aggregated minimum, so a key with a third of all rows is no problem."""
    cols = [c for c in df.columns if c != order]
    return df.groupBy(key.alias("__key")).agg(F.min(F.struct(order, *cols)).alias("r")).select("r.*").select(df.columns)


def latest(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The last row of each key by (ts, tie): a pre-aggregated maximum."""
    rest = [c for c in df.columns if c not in (ts, tie)]
    return df.groupBy(F.col(key).alias("__key")).agg(F.max(F.struct(ts, tie, *rest)).alias("r")).select("r.*").select(df.columns)


def reject_cutoff(df: DataFrame, group: str, order: str, rejected: Column, most: int = 3) -> DataFrame:
    """Accepted rows that come before the group's most-th rejection; later rows drop unjudged."""
    before = F.sum(F.when(rejected, 1).otherwise(0)).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__before", F.coalesce(before, F.lit(0))).where((F.col("__before") < most) & ~F.coalesce(rejected, F.lit(False))).drop("__before")


def review_sample(df: DataFrame, key: str, preferred: Column, n: int, seed: str = "0") -> DataFrame:
    """n rows, preferred ones first, in an order that a seed fixes."""
    return df.orderBy(F.when(preferred, 0).otherwise(1), F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def exclude_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key).distinct(), key, "left_anti")


def first_per_group(rows: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group; the rank limit is applied before the shuffle, so a hot group moves k rows a task."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def cache_lookup(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """(key, n_requests, hit): requests by key, and whether a response is there; both sides are reduced before the join."""
    asked = requests.groupBy(key).agg(F.count("*").alias("n_requests"))
    known = cache.select(key).distinct().withColumn("__hit", F.lit(True))
    return asked.join(known, key, "left").select(key, "n_requests", F.coalesce("__hit", F.lit(False)).alias("hit"))


def union_batches(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of all batches by column name; columns that a batch lacks are null."""
    for batch in more:
        first = first.unionByName(batch, allowMissingColumns=True)
    return first
