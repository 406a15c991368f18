"""Manifests of any size: one JSON object of nodes, cut at its entries by the tasks that read its bytes.

A text source whose lines end with a closing brace splits a file by byte ranges, so a piece holds at most one brace that
closes an object, at its end. Whether a piece begins within a string follows from the number of quotes before it, how deep
it begins from the braces outside strings before it: sums over the blocks of a file (one row each) and within a block.
Entries end where pieces end, so the pieces of an entry are put together and parsed, and no task holds more than an entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grovespark.scratch import materialize

_BLOCK = ["file", "block"]


def _earlier(value: str) -> Column:
    """The sum of a column over the earlier blocks of the file."""
    return F.coalesce(F.sum(value).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _within(value: Column | str) -> Column:
    """The sum of a column over the earlier pieces of the block."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*_BLOCK).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _whole() -> Column:
    """A piece with the quote of the string that it begins in."""
    return F.concat(F.when(F.col("inside"), '"').otherwise(""), "value")


def _masked(text: Column) -> Column:
    """The text with its escapes overwritten, as long as before. No escape ends with a brace, so none is cut in two."""
    return F.regexp_replace(text, r"(?s)\\.", "__")


def _outside(masked: Column) -> Column:
    """The text with each string as one quote."""
    return F.regexp_replace(masked, r'"[^"]*("|$)', '"')


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, value, inside, quotes, opens, closes, deep): pieces in the order (block, seq) of their file, whether
    they begin within a string, and how deep they begin from the start of their block."""
    read = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    read = materialize(read.withColumn("seq", F.monotonically_increasing_id()).withColumn("quotes", _count(_masked(F.col("value")), '"')))
    starts = read.groupBy(*_BLOCK).agg(F.sum("quotes").alias("q")).select(*_BLOCK, _earlier("q").alias("q"))
    told = read.join(starts, _BLOCK).withColumn("inside", (F.col("q") + _within("quotes")) % 2 == 1).drop("q")
    ends_inside = F.col("inside") != (F.col("quotes") % 2 == 1)
    told = told.withColumn("opens", _count(_outside(_masked(_whole())), "{")).withColumn("closes", F.when(ends_inside, 0).otherwise(1))
    return materialize(told.withColumn("deep", _within(F.col("opens") - F.col("closes"))))


def _openings(placed: DataFrame, level: int) -> DataFrame:
    """The pieces that open an object at this level, with the key before it (null in lists) and the text behind its brace."""
    found = placed.where((F.col("depth") < level) & (F.col("depth") + F.col("opens") >= level))
    found = found.withColumn("text", _whole()).withColumn("masked", _masked(F.col("text")))
    strings = _count(F.call_function("substring_index", _outside(F.col("masked")), F.lit("{"), (level - F.col("depth")).cast("int")), '"')
    found = found.withColumn("strings", strings)
    to_last = F.call_function("substring_index", F.col("masked"), F.lit('"'), (2 * F.col("strings")).cast("int"))
    found = found.withColumn("skip", F.when(F.col("strings") == 0, 0).otherwise(F.length(to_last) + 1))
    rest = F.call_function("substr", F.col("masked"), (F.col("skip") + 1).cast("int"))
    key = F.when((F.col("strings") > 0) & rest.rlike(r"^\s*:\s*\{"), F.get(F.split("masked", '"'), (2 * F.col("strings") - 1).cast("int")))
    return found.select("file", "block", "seq", key.alias("key"), F.call_function("substr", F.col("text"), (F.col("skip") + F.instr(rest, "{") + 1).cast("int")).alias("behind"))


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, entries): JSON objects with an entry each (and the entries before it whose values are no objects) of the
    object under the first key `nodes` of a manifest, or else of the whole manifest.

    Files that end within a string or an object are an error, but the last brace may be missing. Empty files and objects
    give at most rows of an empty object. Runs jobs when called, as the state at each block comes from all blocks before.
    """
    pieces = _pieces(spark, path)
    step = F.col("opens") - F.col("closes")
    wrong = pieces.groupBy("file").agg(F.sum(step).alias("depth"), (F.sum("quotes") % 2).alias("odd")).where("odd = 1 or depth not in (0, -1)").first()
    if wrong:
        raise ValueError(f"{wrong.file} ends within {'a string' if wrong.odd else 'an object'}")
    starts = pieces.groupBy(*_BLOCK).agg(F.sum(step).alias("d")).select(*_BLOCK, _earlier("d").alias("d"))
    placed = pieces.join(starts, _BLOCK).withColumn("depth", F.col("d") + F.col("deep")).withColumn("end", F.col("d") + F.col("deep") + step).drop("d")

    first = lambda df, name: df.groupBy("file").agg(F.min(F.struct("block", "seq", "behind")).alias(name))
    layout = first(_openings(placed, 1), "whole").join(first(_openings(placed, 2).where("key = 'nodes'"), "nodes"), "file", "left")
    layout = layout.select("file", F.when(F.col("nodes").isNull(), 1).otherwise(2).alias("level"), F.coalesce("nodes", "whole").alias("m"))
    layout = materialize(layout.select("file", "level", "m.behind", F.struct("m.block", "m.seq").alias("from")))

    # from the piece that opens the object to the one that closes it
    at, closed = F.struct("block", "seq"), lambda level: (F.col("closes") == 1) & (F.col("end") <= level)
    later = placed.join(layout, "file").where(at >= F.col("from"))
    last = later.where(closed(F.col("level") - 1)).groupBy("file").agg(F.min(at).alias("to"))
    held = later.join(last, "file").where(at <= F.col("to"))
    before = held.where(closed(F.col("level"))).groupBy(*_BLOCK).agg(F.count("*").alias("n"))
    before = held.select(*_BLOCK).distinct().join(before, _BLOCK, "left").select(*_BLOCK, _earlier("n").alias("n"))
    entry = F.col("n") + _within(closed(F.col("level")).cast("int"))
    text = F.concat(F.when(at == F.col("from"), F.col("behind")).otherwise(F.col("value")), F.when(at == F.col("to"), "").otherwise("}"))
    cut = held.join(before, _BLOCK).select("file", entry.alias("entry"), "block", "seq", text.alias("text"))
    joined = cut.groupBy("file", "entry").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("p"))
    body = F.regexp_replace(F.array_join(F.transform("p", lambda p: p["text"]), ""), r"^[\s,]+", "")
    return joined.select("file", F.concat(F.lit("{"), body, F.lit("}")).alias("entries"))
