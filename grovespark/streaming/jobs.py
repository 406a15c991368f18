"""Structured Streaming forms of the judging, counting and review operators. All but the sinks are lazy plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from grovespark.sources import versions


def judge(stream: DataFrame, verdict: Column, accepted: str, rejected: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Parts a stream by a verdict (`ok` or a reason) into two Parquet tables.

    A batch that runs again after a failure overwrites its own folder, batch=<id>, so no row is written twice.
    """

    def write(batch: DataFrame, n: int) -> None:
        batch.persist()
        batch.where("verdict = 'ok'").write.mode("overwrite").parquet(f"{accepted}/batch={n}")
        batch.where("verdict <> 'ok'").write.mode("overwrite").parquet(f"{rejected}/batch={n}")
        batch.unpersist()

    return stream.withColumn("verdict", verdict).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def flush_each(stream: DataFrame, flush: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Gives every micro-batch, with its number, to a function of the caller."""
    return stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def counts(stream: DataFrame, column: str) -> DataFrame:
    """Live counts per value; for update or complete mode. State is one row per value."""
    return stream.groupBy(column).agg(F.count("*").alias("n"))


def rate(stream: DataFrame, ts: str, by: str, width: str = "1 minute", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events per window, tumbling or sliding; rows later than the watermark are left out and its state is dropped."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(window.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def first_wins(stream: DataFrame, key: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """The first row of each key; keys are remembered for as long as the watermark allows repeats."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def latest(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """The latest value of each key by event time, not arrival; for update mode. State is one row per key."""
    return stream.groupBy(key).agg(F.max(F.struct(ts, value)).alias("last")).select(key, F.col(f"last.{ts}").alias(ts), F.col(f"last.{value}").alias(value))


def sessions(stream: DataFrame, user: str, ts: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A row per session of a user, given out when the watermark has passed its end."""
    return stream.withWatermark(ts, late).groupBy(user, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def reject_cutoff(stream: DataFrame, parent: str, order: str, rejected: str, limit: int = 3) -> DataFrame:
    """Accepted rows (parent, order) that come before the limit-th rejection of their parent; for append mode.

    State is one number per parent. Order is arrival: within a micro-batch by `order`, across batches as they come.
    """
    import pandas as pd

    def step(key, batches, state):
        seen = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        before = seen + rows[rejected].cumsum() - rows[rejected]
        state.update((int(seen + rows[rejected].sum()),))
        kept = rows[(before < limit) & ~rows[rejected]]
        yield pd.DataFrame({parent: [key[0]] * len(kept), order: kept[order].to_numpy()})

    kinds = f"{parent} {stream.schema[parent].dataType.simpleString()}, {order} {stream.schema[order].dataType.simpleString()}"
    return stream.select(parent, order, F.col(rejected).cast("boolean").alias(rejected)).groupBy(parent).applyInPandasWithState(step, kinds, "n bigint", "append", "NoTimeout")


def rating_moves(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(value, delta): what each new rating does to the counters, one more for its value and one less for the value that
    the key had; for append mode. Sums of delta by value are the live counters. Ratings older than the last one of their
    key change nothing. State is one rating per key.
    """
    import pandas as pd

    def step(key_, batches, state):
        had, last = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(ts, kind="stable")
        newest = rows.iloc[-1]
        if last is None or newest[ts].value > last:
            state.update((newest[value], newest[ts].value))
            if newest[value] != had:
                moves = [(newest[value], 1)] + ([(had, -1)] if had is not None else [])
                yield pd.DataFrame(moves, columns=[value, "delta"])

    kind = stream.schema[value].dataType.simpleString()
    return stream.select(key, ts, value).groupBy(key).applyInPandasWithState(step, f"{value} {kind}, delta int", f"had {kind}, at bigint", "append", "NoTimeout")


def fold_counters(moves: DataFrame, path: str, checkpoint: str, value: str, delta: str = "delta", **trigger) -> StreamingQuery:
    """Keeps the counters (value, n) of a stream of moves (value, delta) as versions of a stored table, each move once.

    Micro-batch n commits version n: the version before it with the batch's deltas. A batch that runs again after a
    failure finds its version there and changes nothing; values whose count is zero stay with it.
    """

    def fold(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        last = versions.latest_version(spark, path)
        if last is not None and last >= n:
            # the moves were counted, but the state behind them is made by running the batch
            batch.write.format("noop").mode("overwrite").save()
            return
        change = batch.groupBy(value).agg(F.sum(delta).cast("long").alias("n"))
        if last is not None:
            change = change.unionByName(versions.read_version(spark, path, last))
        versions.commit_version(change.groupBy(value).agg(F.sum("n").alias("n")), path, n)

    return flush_each(moves, fold, checkpoint, **trigger)
