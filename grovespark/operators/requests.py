"""Requests to models: keys, prompts, gap requests, cost, and running a user's function over what no cache holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions.text import norm_name

# What a million tokens of input, output and thinking cost, by model.
PRICES = [("models/gemini-2.0-flash", 0.10, 0.40, 0.0), ("models/gemini-2.5-flash", 0.075, 0.30, 0.075), ("models/gemini-2.5-pro", 1.25, 10.00, 1.25), ("models/gemini-3.0-flash", 0.10, 0.40, 0.10)]
# What a prompt says at each depth, deepest first.
DEPTH_HINTS = [(4, "This is deep in the hierarchy. Mark as ATOMIC unless it truly contains multiple distinct physical actions."), (2, "Decompose only if this contains multiple observable actions."), (0, "Decompose into major action phases.")]


def cache_key(prompt: Column, system: Column, model: Column, temperature: Column, thinking: Column) -> Column:
    """SHA-256 of the request as JSON with sorted keys; a null system prompt counts as empty. Non-ASCII text stays as it is."""
    said = F.to_json(F.struct(model.alias("model"), prompt.alias("prompt"), F.coalesce(system, F.lit("")).alias("system_prompt"), temperature.cast("double").alias("temperature"), thinking.alias("use_thinking")))
    return F.sha2(said, 256)


def prompt_text(name: Column, id_: Column) -> Column:
    """The request to break a node down, with a hint that goes by its depth."""
    depth = F.size(F.split(id_, "/")) - 1
    hint = F.coalesce(*[F.when(depth >= d, F.concat(F.lit("DEPTH "), depth.cast("string"), F.lit(f" - {text}"))) for d, text in DEPTH_HINTS])
    return F.concat(F.lit("Task: "), name, F.lit("\n"), hint, F.lit("\n\nJSON:"))


def usage_cost(usage: DataFrame, prices: DataFrame, by: list[str]) -> DataFrame:
    """(by, n_requests, cost) of usage(model, tokens_in, tokens_out, tokens_thinking); models without a price cost nothing.

    prices(model, input, output, thinking) is a handful of rows; the join reduces usage by model first, so it is small.
    """
    summed = usage.groupBy(*by, "model").agg(F.count("*").alias("n"), *[F.sum(f"tokens_{k}").alias(k) for k in ("in", "out", "thinking")])
    priced = summed.join(prices.select("model", F.col("input").alias("pi"), F.col("output").alias("po"), F.col("thinking").alias("pt")), "model", "left")
    cost = F.coalesce((F.col("in") * F.col("pi") + F.col("out") * F.col("po") + F.col("thinking") * F.col("pt")) / 1e6, F.lit(0.0))
    return priced.groupBy(*by).agg(F.sum("n").alias("n_requests"), F.round(F.sum(cost), 6).alias("cost"))


def gap_candidates(nodes: DataFrame, least: int = 1, most: int = 4, names: int = 50) -> DataFrame:
    """(id, kind, n_children, prompt) of domains and of sparse branches (least to most children): what to ask for more of.

    A prompt names at most `names` children, the first by name; the rank is cut before children come together.
    """
    from grovespark.operators.curate import first_per_group

    kids = nodes.where("parent_id is not null").select(F.col("parent_id").alias("__p"), F.col("name").alias("child"), F.col("id").alias("cid"))
    counts = kids.groupBy("__p").agg(F.count("*").alias("n_children"))
    few = first_per_group(kids, "__p", ["child", "cid"], names).groupBy("__p").agg(F.array_join(F.array_sort(F.collect_list("child")), ", ").alias("listed"))
    asked = nodes.where(F.col("node_type").isin("domain", "task")).join(counts, F.col("id") == F.col("__p")).drop("__p")
    kind = F.when(F.col("node_type") == "domain", "domain").when(F.col("n_children").between(least, most), "sparse")
    chosen = asked.withColumn("kind", kind).where("kind is not null").join(few, F.col("id") == F.col("__p"))
    return chosen.select("id", "kind", "n_children", F.concat(F.lit("Add to "), "name", F.lit(" ("), F.col("n_children").cast("string"), F.lit("): "), "listed").alias("prompt"))


def run_batch(requests: DataFrame, cache: DataFrame, fn: Callable[[str], str], key: str = "key", prompt: str = "prompt", partitions: int | None = None) -> DataFrame:
    """(key, result, error, latency_ms, cached): cached results, and fn over the prompts that no cache row has.

    Each missing key is asked once. fn runs in the tasks; its exceptions become error rows, lost tasks run again.
    """
    asked = requests.groupBy(key).agg(F.min(prompt).alias(prompt))
    known = cache.groupBy(key).agg(F.min("result").alias("result"))
    hits = asked.join(known, key).select(key, "result", F.lit(None).cast("string").alias("error"), F.lit(0.0).alias("latency_ms"), F.lit(True).alias("cached"))
    misses = asked.join(known.select(key), key, "left_anti")
    if partitions:
        misses = misses.repartition(partitions, key)

    def run(batches: Iterator) -> Iterator:
        import time

        for pdf in batches:
            out = []
            for text in pdf[prompt]:
                start = time.perf_counter()
                try:
                    out.append((fn(text), None, 1000 * (time.perf_counter() - start)))
                except Exception as e:  # noqa: BLE001  a request that fails is a row, not a failed job
                    out.append((None, f"{type(e).__name__}: {e}", 1000 * (time.perf_counter() - start)))
            pdf["result"], pdf["error"], pdf["latency_ms"] = zip(*out, strict=True) if out else ([], [], [])
            pdf["cached"] = False
            yield pdf[[key, "result", "error", "latency_ms", "cached"]]

    kind = requests.schema[key].dataType.simpleString()
    return hits.unionByName(misses.mapInPandas(run, f"{key} {kind}, result string, error string, latency_ms double, cached boolean"))


def second_verdict(judged: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """judged with `final`: a second judge's verdict (key, accept, reason) counts only where the first one said ok; a
    verdict that is missing accepts."""
    said = verdicts.groupBy(key).agg(F.min(F.struct("accept", "reason")).alias("s"))
    no = F.concat(F.lit("judge:"), F.coalesce("s.reason", F.lit("")))
    return judged.join(said, key, "left").withColumn("final", F.when(F.col("verdict") != "ok", F.col("verdict")).when(~F.coalesce("s.accept", F.lit(True)), no).otherwise("ok")).drop("s")


def sibling_names(nodes: DataFrame) -> DataFrame:
    """(parent_id, name): normalised names that a parent has already."""
    return nodes.where("parent_id is not null").select("parent_id", norm_name(F.col("name")).alias("name")).distinct()
