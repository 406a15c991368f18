"""Reports over logs and labels: shares, progress, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shares(rows: DataFrame, column: str, count: str) -> DataFrame:
    """Count and whole percent of each value; the window runs over one row per value."""
    counts = rows.groupBy(column).agg(F.count("*").alias(count))
    return counts.withColumn("pct", F.floor(100.0 * F.col(count) / F.sum(count).over(Window.partitionBy(F.lit(1)))))


def progress(events: DataFrame, ts: str) -> DataFrame:
    """Events of each minute and all up to it. Running sums go over minutes of a day and over days, never over events."""
    minutes = events.groupBy(F.date_trunc("minute", ts).alias("minute")).agg(F.count("*").alias("n_events")).withColumn("day", F.to_date("minute"))
    days = minutes.groupBy("day").agg(F.sum("n_events").alias("d"))
    before = F.coalesce(F.sum("d").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.sum("n_events").over(Window.partitionBy("day").orderBy("minute"))
    return minutes.withColumn("within", within).join(days.select("day", before.alias("before")), "day").withColumn("done", F.col("before") + F.col("within"))


def sessions(events: DataFrame, user: str, ts: str, gap: str) -> DataFrame:
    """(user, session_start, session_end, n_events): runs of events of a user with no longer pause than gap."""
    w = F.session_window(ts, gap)
    return events.groupBy(user, w.alias("w")).agg(F.count("*").alias("n_events")).select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def measured(rows: DataFrame, checks: dict[str, Column], by: str) -> DataFrame:
    """(scope, check_name, value): the percent of rows for which each check holds, over all (scope `all`) and for each
    value of `by`, in one aggregation. Percents are whole hundredths, rounded down."""
    flags = rows.select(F.col(by).alias("__by"), *[F.coalesce(c, F.lit(False)).alias(f"__c{i}") for i, c in enumerate(checks.values())])
    share = lambda i: F.expr(f"count_if(__c{i}) * 10000 div count(*)") / 100
    each = flags.groupingSets([[], [F.col("__by")]], "__by").agg(F.grouping("__by").alias("__all"), *[share(i).alias(f"__v{i}") for i in range(len(checks))])
    listed = F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"__v{i}").alias("value")) for i, name in enumerate(checks)]))
    return each.select(F.when(F.col("__all") == 1, "all").otherwise(F.col("__by")).alias("scope"), listed.alias("c")).select("scope", "c.*")


def graded_by_scope(metrics: DataFrame, checks: DataFrame) -> DataFrame:
    """(scope, check_name, value, status) of metrics(scope, check_name, value) by checks(scope, check_name, side, ok, warn):
    rows of limits. A scope takes its own row of a check where there is one, else the row of scope `*`."""
    own = metrics.join(checks.where("scope <> '*'"), ["scope", "check_name"], "left")
    default = checks.where("scope = '*'").select("check_name", *[F.col(c).alias(f"__{c}") for c in ("side", "ok", "warn")])
    both = own.join(F.broadcast(default), "check_name", "left") if default.limit(10_001).count() <= 10_000 else own.join(default, "check_name", "left")
    side, ok, warn = (F.coalesce(c, f"__{c}") for c in ("side", "ok", "warn"))
    reaches = lambda limit: F.when(side == "min", F.col("value") >= limit).otherwise(F.col("value") <= limit)
    return both.select("scope", "check_name", "value", F.when(reaches(ok), "PASS").when(reaches(warn), "WARN").otherwise("FAIL").alias("status"))


def quality_counters(nodes: DataFrame, lexicon: DataFrame, most_words: int) -> DataFrame:
    """One row: all nodes, those generated, and of the generated ones: without a description, with step text, templates,
    atomic ones whose name the lexicon knows and doesn't know, and good ones, which have no fault."""
    from grovespark.functions import rules as R
    from grovespark.operators.judging import valid_atomic

    known = valid_atomic(nodes.where("node_type = 'atomic'"), lexicon, most_words).select(F.col("id").alias("__id"), F.lit(True).alias("__valid"))
    marked = R.with_template(nodes.join(known, F.col("id") == F.col("__id"), "left"), "__check")
    made, atomic, valid = F.array_contains("sources", "llm_generated"), F.col("node_type") == "atomic", F.coalesce("__valid", F.lit(False))
    faults = {"empty_description": F.coalesce("description", F.lit("")) == "", "step_description": R.step_description(F.col("description")), "template": F.col("__check").isNotNull(), "invalid_atomic": atomic & ~valid}
    flags = marked.select(made.alias("__made"), (atomic & valid).alias("valid_atomic"), *[c.alias(k) for k, c in faults.items()])
    good = ~F.greatest(*[F.col(k) for k in faults])
    count = lambda c: F.count_if(F.col("__made") & c)
    return flags.agg(F.count("*").alias("total"), F.count_if("__made").alias("generated"), *[count(F.col(k)).alias(k) for k in (*faults, "valid_atomic")], count(good).alias("good"))


def domain_breakdown(rows: DataFrame, levels: list[str], distinct: str) -> DataFrame:
    """(levels, n_distinct, n_rows) for all, and for each prefix of levels: distinct values of a column inside a rollup.

    Rows are first brought down to one for each levels and value; a value may lie under several of the last levels, so each
    prefix counts those anew, from what is left after the first step.
    """
    once = rows.groupBy(*levels, distinct).agg(F.count("*").alias("__k"))
    sets = [[F.col(c) for c in levels[:i]] + [F.col(distinct)] for i in range(len(levels) + 1)]
    step = once.groupingSets(sets, *[F.col(c) for c in levels], F.col(distinct)).agg(F.grouping_id().alias("__set"), F.sum("__k").alias("__k"))
    return step.groupBy("__set", *levels).agg(F.count(distinct).alias("n_distinct"), F.sum("__k").alias("n_rows")).drop("__set")


def long_form(row: DataFrame, names: list[str]) -> DataFrame:
    """(metric, value) rows of a one-row table of numbers."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("m")).select("m.*")


def web_stats(nodes: DataFrame, domains: int = 15, verbs: int = 20) -> DataFrame:
    """(metric, item, value): totals, counts by type, depths, the largest domains and the commonest first words of atomic nodes."""
    depth = F.size(F.split("id", "/"))
    word = F.split(F.lower("name"), r"[\s_]")[0]
    words = nodes.where("node_type = 'atomic'").select(word.alias("item")).where(F.length("item") > 1).groupBy("item").agg(F.count("*").alias("n"))
    whole = nodes.agg(F.count("*").alias("total"), F.round(F.avg(depth), 2).alias("avg_depth"), F.max(depth).alias("max_depth"), *[F.count_if(F.col("node_type") == t).alias(t) for t in ("domain", "task", "subtask", "atomic")])
    out = long_form(whole, whole.columns).select("metric", F.lit("").alias("item"), "value")
    part = lambda df, name: df.select(F.lit(name).alias("metric"), "item", F.col("n").cast("double").alias("value"))
    top = nodes.groupBy(F.substring_index("id", "/", 1).alias("item")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(domains)
    out = out.unionByName(part(top, "domain_nodes")).unionByName(part(words.orderBy(F.desc("n"), "item").limit(verbs), "top_verb"))
    return out.unionByName(words.agg(F.count("*").alias("n")).select(F.lit("verbs").alias("metric"), F.lit("").alias("item"), F.col("n").cast("double").alias("value")))


def home_stats(nodes: DataFrame, quality: str = "_quality", family: str = "robotics_") -> DataFrame:
    """One row: nodes by type, those whose id holds `quality`, those whose id begins with `family`."""
    kinds = [F.count_if(F.col("node_type") == t).alias(t) for t in ("domain", "task", "subtask", "atomic")]
    return nodes.agg(F.count("*").alias("total"), *kinds, F.count_if(F.col("id").contains(quality)).alias("quality"), F.count_if(F.col("id").startswith(family)).alias("family"))


def domain_cards(nodes: DataFrame, quality: str = "_quality") -> DataFrame:
    """(id, n_children, n_grandchildren, n_quality) of each domain, in one pass over path ids."""
    d = F.size(F.split("id", "/")) - 1
    return nodes.groupBy(F.substring_index("id", "/", 1).alias("id")).agg(F.count_if(d == 1).alias("n_children"), F.count_if(d == 2).alias("n_grandchildren"), F.count_if((d == 1) & F.col("id").contains(quality)).alias("n_quality"))


def publish_stats(nodes: DataFrame) -> DataFrame:
    """(metric, value): totals, leaves, atomic and described nodes, depths, and counts by type and by source; where nodes have
    a completion, `completed` counts those with a precondition or a postcondition."""
    parents = nodes.where("parent_id is not null").select(F.col("parent_id").alias("__p")).distinct()
    marked = nodes.join(parents, F.col("id") == F.col("__p"), "left")
    depth = F.size(F.split("id", "/"))
    said = lambda part: F.coalesce(F.col(f"completion.{part}"), F.lit("")) != ""
    done = [F.count_if(said("preconditions") | said("postconditions")).alias("completed")] if "completion" in nodes.columns else []
    whole = marked.agg(F.count("*").alias("total"), *done, F.count_if(F.col("node_type") == "atomic").alias("atomic"), F.count_if(F.col("__p").isNull()).alias("leaves"), F.count_if(F.coalesce("description", F.lit("")) != "").alias("described"), F.max(depth).alias("max_depth"), F.round(F.avg(depth), 4).alias("avg_depth"))
    out = long_form(whole, whole.columns)
    for column, name in ((F.col("node_type"), "type"), (F.explode("sources"), "source")):
        out = out.unionByName(nodes.select(column.alias("k")).groupBy("k").agg(F.count("*").cast("double").alias("value")).select(F.concat(F.lit(f"{name}:"), "k").alias("metric"), "value"))
    return out


def source_shares(nodes: DataFrame) -> DataFrame:
    """(source, n_nodes, pct of all nodes)."""
    counts = nodes.select("id", F.explode("sources").alias("source")).groupBy("source").agg(F.count("*").alias("n_nodes"))
    total = nodes.agg(F.count("*").alias("__t"))
    return counts.join(F.broadcast(total)).select("source", "n_nodes", F.round(100.0 * F.col("n_nodes") / F.col("__t"), 2).alias("pct"))


def reject_analysis(rejects: DataFrame, order: str, patterns: int = 10, recent: int = 20) -> DataFrame:
    """(section, item, n): rejects by reason, the commonest patterns, and the last names (n is their place from the end)."""
    part = lambda df, section: df.select(F.lit(section).alias("section"), "item", "n")
    reasons = rejects.groupBy(F.col("reason").alias("item")).agg(F.count("*").alias("n"))
    found = rejects.where("pattern is not null").groupBy(F.col("pattern").alias("item")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(patterns)
    last = rejects.orderBy(F.desc(order)).limit(recent).select(F.col("name").alias("item"), F.row_number().over(Window.orderBy(F.desc(order))).cast("long").alias("n"))
    return part(reasons, "reason").unionByName(part(found, "pattern")).unionByName(part(last, "recent"))


def reject_patterns(rejects: DataFrame, order: str, samples: int = 10) -> DataFrame:
    """(reason, n_rejects, n_patterns, samples): the first names of each reason; ranks are cut before the shuffle."""
    from grovespark.operators.curate import first_per_group

    few = first_per_group(rejects, "reason", [order], samples).groupBy("reason").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "name"))), lambda x: x["name"]).alias("samples"))
    counts = rejects.groupBy("reason").agg(F.count("*").alias("n_rejects"), F.count_distinct("pattern").alias("n_patterns"))
    return counts.join(few, "reason").select("reason", "n_rejects", "n_patterns", F.array_join("samples", " | ").alias("samples"))


def judge_reasonings(rejects: DataFrame, order: str, most: int = 20, reason: str = "llm_judge") -> DataFrame:
    """(place, name, reasoning): what the judge said of the first nodes that it rejected, by order; a judge that said nothing
    (null or empty) is passed over. Only the first rows of each task come together."""
    said = rejects.where((F.col("reason") == reason) & (F.coalesce("reasoning", F.lit("")) != "")).orderBy(order).limit(most)
    return said.select(F.row_number().over(Window.orderBy(order)).cast("long").alias("place"), "name", "reasoning")


def structure_analysis(nodes: DataFrame, names: int = 10) -> DataFrame:
    """(id, domain, n_children, first_names) of every task: how many children it has and the first of their names."""
    from grovespark.operators.curate import first_per_group

    kids = nodes.where("parent_id is not null").select(F.col("parent_id").alias("__p"), F.col("name").alias("child"), F.col("id").alias("cid"))
    counts = kids.groupBy("__p").agg(F.count("*").alias("n_children"))
    few = first_per_group(kids, "__p", ["child", "cid"], names).groupBy("__p").agg(F.array_join(F.array_sort(F.collect_list("child")), ", ").alias("first_names"))
    tasks = nodes.where("node_type = 'task'").join(counts, F.col("id") == F.col("__p"), "left").drop("__p").join(few, F.col("id") == F.col("__p"), "left")
    return tasks.select("id", F.substring_index("id", "/", 1).alias("domain"), F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), F.coalesce("first_names", F.lit("")).alias("first_names"))


def graded(metrics: DataFrame, checks: list[tuple[str, str, str, float, float]]) -> DataFrame:
    """(family, check_name, value, status) of metrics(check_name, value): checks are (family, name, 'min' or 'max', value
    from which it passes, value from which it warns). A check without a metric fails."""
    spark = metrics.sparkSession
    wanted = spark.createDataFrame(checks, "family string, check_name string, side string, ok double, warn double")
    both = wanted.join(metrics, "check_name", "left")
    reaches = lambda limit: F.when(F.col("side") == "min", F.col("value") >= F.col(limit)).otherwise(F.col("value") <= F.col(limit))
    status = F.when(reaches("ok"), "PASS").when(reaches("warn"), "WARN").otherwise("FAIL")
    return both.select("family", "check_name", "value", status.alias("status"))


def check_totals(graded_: DataFrame) -> DataFrame:
    """(family, n_pass, n_warn, n_fail)."""
    return graded_.groupBy("family").agg(*[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("PASS", "WARN", "FAIL")])


def progress_rates(events: DataFrame, ts: str, goal: int) -> DataFrame:
    """progress with the rate (events a minute since the first minute) and the minutes left until `goal` events at it."""
    done = progress(events, ts)
    start = done.agg(F.min("minute").alias("__s"))
    elapsed = (F.unix_timestamp("minute") - F.unix_timestamp("__s")) / 60 + 1
    # a quotient of whole numbers as a decimal: a double may lie on either side of a half
    exact = (F.col("done").cast("decimal(18,0)") / elapsed.cast("decimal(18,0)")).cast("decimal(38,12)")
    rated = done.join(F.broadcast(start)).withColumn("rate", F.round(exact, 4).cast("double"))
    return rated.withColumn("eta", F.when(F.col("done") < goal, F.round(F.try_divide(goal - F.col("done"), F.col("done") / elapsed), 2)).otherwise(0.0)).select("minute", "n_events", "done", "rate", "eta")


def run_metrics(events: DataFrame, name: str, ts: str, tie: str, value: str, last: int = 1000, error: Column | None = None) -> DataFrame:
    """(name, n, n_last, mean, least, most, per_minute, n_errors): figures of the last rows of each name, and its whole rate."""
    from grovespark.operators.curate import first_per_group

    recent = first_per_group(events, name, [F.desc(ts), F.desc(tie)], last).groupBy(name).agg(F.count("*").alias("n_last"), F.round(F.avg(value), 4).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"))
    span = F.greatest((F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))) / 60, F.lit(1.0))
    bad = F.lit(False) if error is None else error
    return events.groupBy(name).agg(F.count("*").alias("n"), F.round(F.count("*") / span, 4).alias("per_minute"), F.count_if(bad).alias("n_errors")).join(recent, name)
