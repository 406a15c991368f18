"""Hierarchy operators over nodes(id, parent_id, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grovespark.scratch import materialize


FEW = 50_000  # ids that every task may hold
RANGE = 500_000  # ids that one task sorts


def _slashes(path: str) -> Column:
    """How many steps lie above a path; counted, as splitting every path costs more than what is done with it."""
    return F.octet_length(path) - F.octet_length(F.replace(F.col(path), F.lit("/"), F.lit("")))


def rebuild_children(nodes: DataFrame, order: str = "id") -> DataFrame:
    """Adds children_ids, ordered; empty for leaves. One parent's list is as long as its children."""
    child = F.struct("id") if order == "id" else F.struct(F.col(order).alias("o"), "id")
    kids = nodes.where("parent_id is not null").groupBy("parent_id").agg(F.transform(F.array_sort(F.collect_list(child)), lambda x: x["id"]).alias("children_ids"))
    asked, sure = _by_depth(nodes.drop("children_ids"), nodes.select(F.col("parent_id").alias("__p")))
    none = F.array().cast("array<string>")
    listed = asked.join(kids.withColumnRenamed("parent_id", "__p"), F.col("id") == F.col("__p"), "left").drop("__p").withColumn("children_ids", F.coalesce("children_ids", none))
    return listed.unionByName(sure.withColumn("children_ids", none))


def orphans(nodes: DataFrame) -> DataFrame:
    known = nodes.select(F.col("id").alias("__p"))
    return nodes.where("parent_id is not null").join(known, F.col("parent_id") == F.col("__p"), "left_anti")


def parent_lookup(nodes: DataFrame) -> DataFrame:
    up = nodes.select(F.col("id").alias("__p"), F.col("name").alias("parent_name"), F.col("node_type").alias("parent_type"))
    return nodes.join(up, F.col("parent_id") == F.col("__p"), "left").drop("__p").fillna("unknown", ["parent_name", "parent_type"])


def path_ancestors(nodes: DataFrame) -> DataFrame:
    """(id, ancestor_id, distance) from materialised path ids: no join, no recursion; nearest has distance 1."""
    up = nodes.select("id", _slashes("id").alias("__n")).where("__n > 0").select("id", "__n", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("distance"))
    return up.select("id", F.call_function("substring_index", F.col("id"), F.lit("/"), F.col("__n") - F.col("distance") + 1).alias("ancestor_id"), "distance")


def _below(nodes: DataFrame, hits: DataFrame) -> DataFrame:
    """Ids of the nodes that have one of hits(id), which are distinct, among the proper prefixes of their path.

    Hits lie on few depths (at most as many as the tree has; a job counts them). At each one every node meets at most one
    hit, by its prefix of that length, and is marked, so nothing has to be made distinct after; few hits go to every task.
    """
    depths = hits.where("id is not null").groupBy(_slashes("id").alias("d")).agg(F.count("*").alias("k")).orderBy("d").collect()
    rows = nodes.select("id", _slashes("id").alias("__n"), F.lit(False).alias("__in"))
    for d, k in depths:
        at = hits.where(_slashes("id") == d).select(F.col("id").alias("__hit"))
        at = F.broadcast(at) if k <= FEW else at
        # a path that is no deeper asks for what no hit of this depth can be, each for its own, so they do not meet in one task
        asked = F.when(F.col("__n") > d, F.substring_index("id", "/", d + 1)).otherwise(F.concat("id", F.lit("/")))
        rows = rows.join(at, asked == F.col("__hit"), "left").select("id", "__n", (F.col("__in") | F.col("__hit").isNotNull()).alias("__in"))
    return rows.where("__in").select("id")


def descendants(nodes: DataFrame, roots: DataFrame, by: str = "path", max_depth: int = 64) -> DataFrame:
    """Ids below roots(id): by path prefixes, or (by 'parent') along parent_id, one join for each level.

    The second way writes each level down, so its jobs run when it is called; a forest deeper than max_depth is an error.
    """
    if by == "path":
        return _below(nodes, roots.select("id").distinct())
    edges = nodes.where("parent_id is not null").select("id", "parent_id")
    frontier, found = roots.select(F.col("id").alias("up")).distinct(), None
    for _ in range(max_depth):
        below = materialize(edges.join(frontier, F.col("parent_id") == F.col("up"), "left_semi").select("id"))
        if below.isEmpty():
            return found if found is not None else roots.select("id").limit(0)
        found = below if found is None else found.unionByName(below)
        frontier = below.select(F.col("id").alias("up"))
    raise ValueError(f"the forest is deeper than {max_depth} levels, or its parents form a ring")


def prune(nodes: DataFrame, bad: Column, cascade: str = "parent", dry_run: bool = False) -> DataFrame:
    """Nodes left after the bad ones go, with children_ids repaired; cascade 'none' keeps their descendants, 'parent' takes
    them too, 'children' takes those that the children lists name. dry_run: the ids that would go instead."""
    hit = materialize(nodes.where(F.coalesce(bad, F.lit(False))).select("id"))
    if cascade == "none":
        gone = hit
    elif cascade == "parent":
        gone = hit.unionByName(_below(nodes, hit)).distinct()
    elif cascade == "children":
        listed = nodes.select(F.explode("children_ids").alias("id"), F.col("id").alias("parent_id"))
        gone = hit.unionByName(descendants(listed, hit, by="parent")).distinct()
    else:
        raise ValueError(f"no cascade {cascade}")
    return gone if dry_run else rebuild_children(nodes.join(gone, "id", "left_anti"))


def fix_depth(nodes: DataFrame, limit: int) -> DataFrame:
    """Nodes deeper than limit go; those at the limit become atomic; children_ids are repaired, so atomic ones have none."""
    deep = F.size(F.split("id", "/")) - 1
    kept = nodes.where(deep <= limit).withColumn("node_type", F.when(deep == limit, "atomic").otherwise(F.col("node_type")))
    return rebuild_children(kept)


def _by_depth(nodes: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes that lie no deeper than the deepest of parents(__p), the others): equal ids have as many slashes, so the
    others are leaves for certain and need not be moved to ask who has them as a parent. One number goes to every task."""
    deepest = parents.agg(F.max(_slashes("__p"))).scalar()
    cut = F.call_function("substring_index", F.col("id"), F.lit("/"), deepest + 1)
    deeper = F.coalesce(F.octet_length(cut) < F.octet_length("id"), F.lit(True))
    return nodes.where(~deeper), nodes.where(deeper)


def _childless_marked(some: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds is_leaf to some: no node has this id as its parent."""
    parents = nodes.where("parent_id is not null").select(F.col("parent_id").alias("__p")).distinct()
    asked, sure = _by_depth(some, parents)
    # ids begin alike, so sorting them costs more than a table of the few that are parents
    marked = asked.join(parents.hint("shuffle_hash"), F.col("id") == F.col("__p"), "left").withColumn("is_leaf", F.col("__p").isNull()).drop("__p")
    return marked.unionByName(sure.withColumn("is_leaf", F.lit(True)))


def leaf_marks(nodes: DataFrame) -> DataFrame:
    """Adds is_leaf."""
    return _childless_marked(nodes, nodes)


def child_counts(nodes: DataFrame) -> DataFrame:
    """Adds n_children to the nodes that have any."""
    counts = nodes.where("parent_id is not null").groupBy(F.col("parent_id").alias("__p")).agg(F.count("*").alias("n_children"))
    return nodes.join(counts, F.col("id") == F.col("__p")).drop("__p")


def childless(some: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of some that no node of the forest has as its parent."""
    # no anti-join: that would go below the split by depth, and move all
    return _childless_marked(some, nodes).where("is_leaf").drop("is_leaf")


def children_of(listed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, pos, child_id) of children lists, in order; children that are not nodes are left out."""
    known = nodes.select(F.col("id").alias("child_id"))
    return listed.select("id", F.posexplode("children_ids").alias("pos", "child_id")).join(known, "child_id", "left_semi")


def drop_references(listed: DataFrame, gone: DataFrame) -> DataFrame:
    """Children lists without the ids that are gone, in order; lists come together again after one anti-join."""
    left = listed.select("id", F.posexplode("children_ids").alias("pos", "child")).join(gone.select(F.col("id").alias("child")), "child", "left_anti")
    lists = left.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "child"))), lambda x: x["child"]).alias("children_ids"))
    return listed.drop("children_ids").join(lists, "id", "left").withColumn("children_ids", F.coalesce("children_ids", F.array().cast("array<string>")))


def breadcrumb(nodes: DataFrame, separator: str = " > ") -> DataFrame:
    """(id, breadcrumb): names from the root to the node; as many names meet in a group as the tree is deep. Trails are
    gathered for the paths that nodes lie under, and each node, most of which have none below, meets one trail."""
    parts = F.split("id", "/")
    rows = nodes.select("id", "name", F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).alias("__p"))
    parents = rows.where("__p is not null").select(F.col("__p").alias("id")).distinct()
    steps = path_ancestors(parents).unionByName(parents.select("id", F.col("id").alias("ancestor_id"), F.lit(0).alias("distance")))
    named = steps.join(nodes.select(F.col("id").alias("ancestor_id"), "name"), "ancestor_id")
    trail = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), "name")))
    trails = named.groupBy(F.col("id").alias("__of")).agg(F.transform(trail, lambda x: x["name"]).alias("__above"))
    above = F.coalesce("__above", F.array().cast("array<string>"))
    return rows.join(trails, F.col("__p") == F.col("__of"), "left").select("id", F.array_join(F.concat(above, F.array("name")), separator).alias("breadcrumb"))


def publish_rows(nodes: DataFrame) -> DataFrame:
    """(id, depth from 1, description without nulls, is_leaf, is_atomic)."""
    return leaf_marks(nodes).select("id", F.size(F.split("id", "/")).alias("depth"), F.coalesce("description", F.lit("")).alias("description"), "is_leaf", (F.col("node_type") == "atomic").alias("is_atomic"))


def paths(nodes: DataFrame) -> DataFrame:
    """(id, depth, root, path): path holds the segments, so that ordering by it is pre-order with siblings by segment."""
    parts = F.split("id", "/")
    return nodes.select("id", (F.size(parts) - 1).alias("depth"), F.substring_index("id", "/", 1).alias("root"), parts.alias("path"))


def bfs_order(nodes: DataFrame, limit: int | None = None) -> DataFrame:
    """Shallowest first, then by id; with a limit only so many rows move to one place."""
    ordered = nodes.orderBy(F.size(F.split("id", "/")), "id")
    return ordered if limit is None else ordered.limit(limit)


def dfs_order(nodes: DataFrame, stem: int = 3) -> DataFrame:
    """(id, position): the place of each node in a pre-order walk from 0, domains and siblings by segment.

    Ids are dealt out by ranges of the walk, about RANGE to one, and numbered where they lie; what lies before a range is
    added after. So no task holds more of a larger forest, however its subtrees are shaped; stem no longer matters.
    Ids are written on the way, so jobs run when it is called.
    """
    # as text: the separator below all other characters, and the two lowest of these told apart
    key = F.col("id")
    for old, new in (("\x01", "\x01\x02"), ("\x00", "\x01\x01"), ("/", "\x00")):
        key = F.replace(key, F.lit(old), F.lit(new))
    rows = nodes.select("id", key.alias("__k"))
    ranges = 1 + nodes.count() // RANGE
    dealt = rows.repartitionByRange(ranges, "__k").sortWithinPartitions("__k")
    numbered = materialize(dealt.select("id", F.monotonically_increasing_id().alias("__seq"))).withColumn("__part", F.shiftright("__seq", 33))
    chunk = numbered.groupBy("__part").agg(F.count("*").alias("n"), F.min("__seq").alias("__first"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.select(F.col("__part").alias("__at"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__first")).alias("__add"))
    return numbered.join(F.broadcast(chunk), F.col("__part") == F.col("__at")).select("id", (F.col("__seq") + F.col("__add")).cast("long").alias("position"))


def tree_lines(nodes: DataFrame, max_depth: int = 3) -> DataFrame:
    """(path, line): the tree as text down to a depth, roots and siblings by id; order by path to read it.

    The last sibling is a pre-aggregated maximum; a line is put together from at most max_depth + 1 ancestors.
    """
    shown = nodes.where(F.size(F.split("id", "/")) - 1 <= max_depth)
    last = shown.groupBy(F.coalesce("parent_id", F.lit("")).alias("__p")).agg(F.max("id").alias("__last"))
    flagged = shown.select("id", "name", "node_type", F.coalesce("parent_id", F.lit("")).alias("__p")).join(last, "__p").select("id", "name", "node_type", (F.col("id") == F.col("__last")).alias("is_last"))
    steps = path_ancestors(shown).join(flagged.select(F.col("id").alias("ancestor_id"), "is_last"), "ancestor_id")
    bars = steps.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), F.when(F.col("is_last"), "    ").otherwise("│   ").alias("bar")))), lambda x: x["bar"]), "").alias("bars"))
    line = F.concat(F.coalesce("bars", F.lit("")), F.when(F.col("is_last"), "└── ").otherwise("├── "), "name", F.lit(" ["), "node_type", F.lit("]"))
    return flagged.join(bars, "id", "left").select(F.split("id", "/").alias("path"), line.alias("line"))


def nested_json(nodes: DataFrame, root_depth: int, max_depth: int) -> DataFrame:
    """(id, json): the subtree of each node at root_depth as one nested JSON text, children by id, folded level by level
    from the deepest. A text is as long as its subtree; a forest of large trees is exported from a deeper level."""
    rows = nodes.select("id", "parent_id", "name", "node_type", (F.size(F.split("id", "/")) - 1).alias("d"))
    text = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    own = F.concat(F.lit('{"id":'), text("id"), F.lit(',"name":'), text("name"), F.lit(',"node_type":'), text("node_type"), F.lit(',"children":['))
    level = None
    for d in range(max_depth, root_depth - 1, -1):
        here = rows.where(F.col("d") == d).withColumn("head", own)
        if level is not None:
            kids = level.groupBy("parent_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "json"))), lambda x: x["json"]), ",").alias("kids")).withColumnRenamed("parent_id", "__p")
            here = here.join(kids, F.col("id") == F.col("__p"), "left")
            level = here.select("id", "parent_id", F.concat("head", F.coalesce("kids", F.lit("")), F.lit("]}")).alias("json"))
        else:
            level = here.select("id", "parent_id", F.concat("head", F.lit("]}")).alias("json"))
    return level.select("id", "json")
