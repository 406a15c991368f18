"""Ranks, running sums and places for groups that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from grovespark.scratch import settled as materialize


def ranked(rows: DataFrame, group: Column, order: list[Column], sum_of: str | None = None) -> DataFrame:
    """rows with pos, the rank from 0 within the group by order, and n, the size of the group; with sum_of also before, the
    sum of that column over the rows ranked earlier. A null group is a group too; ties in order are ranked by chance.

    Rows are dealt out by ranges of (group, order) and numbered within them, so a large group lies in as many tasks as
    its share of the rows; windows run over one row for each group and range.
    """
    dealt = rows.withColumn("__g", group).repartitionByRange(F.col("__g"), *order).sortWithinPartitions(F.col("__g"), *order)
    numbered = materialize(dealt.withColumn("__seq", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__seq", 33))
    value = F.col(sum_of) if sum_of else F.lit(0)
    chunk = numbered.groupBy("__g", "__part").agg(F.count("*").alias("__k"), F.min("__seq").alias("__first"), F.sum(value).alias("__v"))
    whole = Window.partitionBy("__g")
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.select("__g", "__part", "__first", F.coalesce(F.sum("__k").over(earlier), F.lit(0)).alias("__off"), F.sum("__k").over(whole).alias("n"), F.coalesce(F.sum("__v").over(earlier), F.lit(0)).alias("__sum"))
    chunk = chunk.withColumnRenamed("__g", "__h").withColumnRenamed("__part", "__at")
    out = numbered.join(chunk, F.col("__g").eqNullSafe(F.col("__h")) & (F.col("__part") == F.col("__at")))
    out = out.withColumn("pos", F.col("__seq") - F.col("__first") + F.col("__off"))
    if sum_of:
        within = Window.partitionBy("__g", "__part").orderBy("__seq").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("before", F.col("__sum") + F.coalesce(F.sum(sum_of).over(within), F.lit(0)))
    return out.select(*rows.columns, "pos", "n", *(["before"] if sum_of else []))


def numbered(rows: DataFrame, by: list[Column], keep: list[str]) -> DataFrame:
    """The columns `keep` of rows with k, their places from 0 in the order of `by`, ties by chance; written in that order, in
    as many ranges as a shuffle has partitions. Only the sizes of the ranges are summed in one place."""
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    seq = materialize(dealt.select(*keep, F.monotonically_increasing_id().alias("__seq"))).withColumn("__part", F.shiftright("__seq", 33))
    sizes = seq.groupBy(F.col("__part").alias("__of")).agg(F.count("*").alias("__n"))
    before = materialize(sizes.select("__of", running(F.col("__n"), Window.orderBy("__of")).alias("__off")))
    return seq.join(F.broadcast(before), F.col("__part") == F.col("__of")).select(*keep, (F.col("__off") + F.col("__seq").bitwiseAND(F.lit((1 << 33) - 1))).alias("k"))


def running(value: Column, order: WindowSpec) -> Column:
    """The sum of value over the rows before this one."""
    return F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
