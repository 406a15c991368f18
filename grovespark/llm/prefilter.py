"""A bitmap that spares rows without a partner the shuffle of a join, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the greatest bitmap. It is broadcast as words of 64 bits, so this bounds them to 2^20 rows.
MOST_BITS = 26


#: Rows of a table that is broadcast without a bitmap, a few MB; larger ones go by a shuffled join.
MOST_ROWS = 100_000


def light(table: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if a count shows that it has no more than MOST_ROWS rows, else as it is."""
    return F.broadcast(table) if table.limit(MOST_ROWS + 1).count() <= MOST_ROWS else table


def likely(df: DataFrame, keys: DataFrame, on: str, split: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Rows of df whose bigint column `on`, a hash, may be in keys: all that are, and few others.

    The bitmap has sixteen bits and more for each key, up to MOST_BITS in all; with more keys than that it prunes less,
    and a join that follows is right all the same. Null keys go. keys should be a written table, as it is read twice.
    split: also the other rows, those with a null key among them, as a second table.
    """
    bits = min(MOST_BITS, max(12, (16 * keys.count()).bit_length()))
    word = lambda c: F.col(c).bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    bit = lambda c: F.expr(f"shiftleft(1L, cast(shiftrightunsigned({c}, {bits}) & 63 as int))")
    marks = keys.where(F.col(on).isNotNull()).select(word(on).alias("__word"), bit(on).alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    hit = F.col("__bits").bitwiseAND(bit(on)) != 0
    found = df.withColumn("__word", word(on)).join(F.broadcast(marks), "__word").where(hit).select(df.columns)
    if not split:
        return found
    return found, df.withColumn("__word", word(on)).join(F.broadcast(marks), "__word", "left").where(~F.coalesce(hit, F.lit(False))).select(df.columns)
