"""Walks along parent_id for ids that say nothing of their place: depths, roots, ancestors, paths and orders.

All by contraction: nodes without children are taken out, then every other node of a chain is, until roots are left; then
all are put back in the reverse order, each beside the node that it hung from. A share of the forest goes at each turn,
however deep it is, so all turns together move a few times the forest. A ring of parents is an error. A node whose parent
is null or not in the table is a root.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from grovespark.operators.ordering import numbered, ranked, running
from grovespark.scratch import discard
from grovespark.scratch import settled as materialize


def _doubled(left: DataFrame, start, plus, sizes: bool, rows: int) -> DataFrame:
    """folded for left(id, up, w, s), whose ups are nodes: after k turns a node knows what lies within 2^k above it."""
    top = F.col("up").isNull()
    own = lambda *first: [*first, "root", "w", *(["s"] if sizes else [])]
    state = left.select("id", F.col("up").alias("jump"), F.coalesce("up", "id").alias("root"), F.when(top, start(F.col("w"))).otherwise(F.col("w")).alias("w"), *(["s"] if sizes else []))
    for _ in range(rows.bit_length() + 2):
        open_ = state.where("jump is not null")
        if open_.isEmpty():
            return state.select("id", "root", F.col("w").alias("total"), *([F.col("s").alias("size")] if sizes else []))
        up = state.select(F.col("id").alias("__at"), F.col("jump").alias("__jump"), F.col("root").alias("__root"), F.col("w").alias("__w"))
        moved = open_.join(up, F.col("jump") == F.col("__at")).select("id", F.col("__jump").alias("jump"), F.col("__root").alias("root"), plus(F.col("__w"), F.col("w")).alias("w"), *(["s"] if sizes else []))
        both = moved.unionByName(state.where("jump is null"))
        if sizes:
            below = open_.groupBy(F.col("jump").alias("__of")).agg(F.sum("s").alias("__below"))
            both = both.join(below, F.col("id") == F.col("__of"), "left").withColumn("s", F.col("s") + F.coalesce("__below", F.lit(0)))
        state = materialize(both.select(*own("id", "jump")))
    raise ValueError("the parents form a ring")


def folded(edges: DataFrame, step: Column, start: Callable[[Column], Column], plus: Callable[[Column, Column], Column], sizes: bool | str = False, few: int = 100_000) -> DataFrame:
    """(id, root, total, size) of edges(id, up, ...): total puts together start(step) of the root and step of every node
    below it down to the node itself, by an associative plus(above, below). size, if asked for, counts the node and all
    below it, or sums the column that `sizes` names over them. edges is read several times. Once no more than `few` nodes are left, their pointers are doubled instead,
    which moves all of them at each turn but takes fewer turns."""
    own = lambda *more: ["id", "up", "w", *(["s"] if sizes else []), *more]
    counted = F.col(sizes) if isinstance(sizes, str) else F.lit(1).cast("long")
    turns, left, first = [], edges, True
    while True:
        # nodes without children go
        parents = left.where("up is not null").select(F.col("up").alias("__of")).distinct()
        read = [c for c in left.columns if c != "via"]
        marked = materialize(left.join(parents, F.col("id") == F.col("__of"), "left").select(*read, F.col("__of").isNotNull().alias("inner")))
        said = marked.select("id", "up", step.alias("w"), *([counted.alias("s")] if sizes else []), "inner") if first else marked
        bare = said.where(~F.col("inner") & F.col("up").isNotNull()).select(*own())
        kept = said.where(F.col("inner") | F.col("up").isNull()).select(*own("inner"))
        if sizes:
            more = bare.groupBy(F.col("up").alias("__of")).agg(F.sum("s").alias("__more"))
            kept = kept.join(more, F.col("id") == F.col("__of"), "left").withColumn("s", F.col("s") + F.coalesce("__more", F.lit(0))).select(*own("inner"))
        gone = None
        if first:  # parents that are no nodes are found among the few that are left
            known = kept.where("inner").select(F.col("id").alias("__k"))
            after = kept.join(known, F.col("up") == F.col("__k"), "left").withColumn("up", F.col("__k")).select(*own())
        else:
            # of the rest those go that draw 0 while the node above draws 1, so that none hangs from another
            kept = materialize(kept.drop("inner")) if sizes else kept.drop("inner")
            draw = lambda c: F.shiftright(F.xxhash64(F.lit(len(turns)), c), 17).bitwiseAND(F.lit(1))
            goes = F.col("up").isNotNull() & (draw("id") == 0) & (draw("up") == 1)
            gone, stay = kept.where(goes), kept.where(~goes)
            over = gone.select(F.col("id").alias("__at"), F.col("up").alias("__up"), F.col("w").alias("__w"))
            after = stay.join(over, F.col("up") == F.col("__at"), "left")
            after = after.select("id", F.coalesce("__up", "up").alias("up"), F.when(F.col("__at").isNull(), F.col("w")).otherwise(plus(F.col("__w"), F.col("w"))).alias("w"), *(["s"] if sizes else []), F.col("__at").alias("via"))
            if sizes:
                more = gone.groupBy(F.col("up").alias("__of")).agg(F.sum("s").alias("__more"))
                after = after.join(more, F.col("id") == F.col("__of"), "left").withColumn("s", F.col("s") + F.coalesce("__more", F.lit(0))).drop("__of", "__more")
        left = materialize(after)
        turns.append((bare, gone, left, [marked, kept]))
        first = False
        rows, open_, rings = left.agg(F.count("*"), F.count("up"), F.count_if(F.col("up") == F.col("id"))).first()
        if rings:
            raise ValueError("the parents form a ring")
        if not open_ or rows <= few:
            break
    found = _doubled(left.select(*own()), start, plus, sizes, rows)
    for k, (bare, gone, after, used) in reversed(list(enumerate(turns))):
        above = lambda t: t.select(F.col("id").alias("__at"), F.col("root").alias("__root"), F.col("total").alias("__total"))
        below = lambda t, how="inner": t.join(above(found), F.col("up") == F.col("__at"), how).select("id", F.coalesce("__root", "id").alias("root"), F.when(F.col("__at").isNull(), start(F.col("w"))).otherwise(plus(F.col("__total"), F.col("w"))).alias("total"), *([F.col("s").alias("size")] if sizes else []))  # noqa: E731, B023
        old = found
        if gone is not None:
            back = below(gone)
            if sizes:
                under = after.where("via is not null").select("id", "via").join(found.select("id", F.col("size").alias("__size")), "id").groupBy("via").agg(F.sum("__size").alias("__more"))
                back = back.join(under, F.col("id") == F.col("via"), "left").withColumn("size", F.col("size") + F.coalesce("__more", F.lit(0))).drop("via", "__more")
            found = materialize(found.unionByName(back))
            discard(old)
            old = found
        # those taken out first may hang from what is no node
        found = found.unionByName(below(bare, "left" if k == 0 else "inner"))
        if k:
            found = materialize(found)
            discard(old, after, *used)
    return found


@dataclass(frozen=True)
class Chains:
    """measures(id, root, depth, size): size counts the node and all below it; edges(id, up): up is as it was given."""

    measures: DataFrame
    edges: DataFrame

    @cached_property
    def jumps(self) -> list[DataFrame]:
        """jumps[k](id, jump): the ancestor 2^k up of the nodes that have one; log2 of the depth joins of nearly all nodes."""
        known = self.edges.select(F.col("id").alias("jump"))
        hop, out = materialize(self.edges.join(known, F.col("up") == F.col("jump")).select("id", "jump")), []
        while not hop.isEmpty():
            out.append(hop)
            hop = materialize(hop.join(hop.select(F.col("id").alias("__at"), F.col("jump").alias("__jump")), F.col("jump") == F.col("__at")).select("id", F.col("__jump").alias("jump")))
        return out


def edges_of(nodes: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    return nodes.select(F.col(key).alias("id"), F.col(parent).alias("up"))


_add = lambda above, below: above + below


def depths(nodes: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """(id, root, depth) of every node, depth from 0; ids are unique and not null."""
    return folded(materialize(edges_of(nodes, key, parent)), F.lit(1).cast("long"), lambda w: F.lit(0).cast("long"), _add).withColumnRenamed("total", "depth")


def chains(nodes: DataFrame, key: str = "id", parent: str = "parent_id") -> Chains:
    """Depth from 0, root and subtree size of every node; ids are unique and not null."""
    edges = materialize(edges_of(nodes, key, parent))
    measures = folded(edges, F.lit(1).cast("long"), lambda w: F.lit(0).cast("long"), _add, sizes=True)
    return Chains(materialize(measures.withColumnRenamed("total", "depth")), edges)


def chain_lists(edges: DataFrame) -> DataFrame:
    """(id, root, total): total lists the ancestors from the parent up to the root; a list is as long as its node is deep."""
    return folded(edges, F.array("up"), lambda w: F.slice(w, 1, 0), lambda above, below: F.concat(below, above))


def chain_ancestors(walk: Chains) -> DataFrame:
    """(id, ancestor_id, distance), nearest at 1: as many rows as all depths together."""
    return ancestors_of(walk.edges)


def ancestors_of(edges: DataFrame) -> DataFrame:
    """chain_ancestors of edges(id, up) that are cheap to read; lists of ancestors are spread out where they end."""
    return chain_lists(edges).select("id", F.posexplode("total").alias("__k", "ancestor_id")).select("id", "ancestor_id", (F.col("__k") + 1).cast("long").alias("distance"))


def siblings(nodes: DataFrame, order: list[str], key: str = "id", parent: str = "parent_id", carry: list[str] = [], sum_of: str | None = None) -> DataFrame:
    """(id, parent, pos, n) and the columns of carry: the place of each node among the children of its parent, from 0, and
    their number; roots are siblings of one another. order names columns; the id parts what they leave equal. sum_of: also
    before, that column of carry summed over earlier siblings."""
    known = nodes.select(F.col(key).alias("__up"))
    placed = nodes.select(F.col(key).alias("id"), F.col(parent).alias("__p"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *carry).join(known, F.col("__p") == F.col("__up"), "left").drop("__p")
    out = ranked(placed, F.col("__up"), [*[F.col(f"__o{i}") for i in range(len(order))], F.col("id")], sum_of)
    return out.select("id", F.col("__up").alias("parent"), "pos", "n", *carry, *(["before"] if sum_of else []))


_SPAN = 12  # 2^12 places are one span: what a window over places sees at once


def _shortened(nodes: DataFrame, key: str, parent: str, more: list[str] = []) -> tuple[DataFrame, Callable[[Column], Column]]:
    """nodes with hexadecimal texts as bytes, half as long and in the same order, and what turns an id back. A column stays
    as it is unless all its values are lower-case hexadecimal of even length."""
    texts = [c for c in dict.fromkeys([key, parent, *more]) if nodes.schema[c].dataType.simpleString() == "string"]
    plain = lambda c: c
    if not texts:
        return nodes, plain
    fits = lambda c: F.col(c).rlike(r"^[0-9a-f]*\z") & (F.length(c) % 2 == 0)
    fit = nodes.agg(*[F.bool_and(fits(c)).alias(c) for c in texts]).first().asDict()
    both = key in fit and parent in fit and bool(fit[key]) and fit[parent] is not False
    short = [c for c in texts if (both if c in (key, parent) else fit[c])]
    return nodes.withColumns({c: F.unhex(c) for c in short}), (lambda c: F.lower(F.hex(c))) if both else plain


def _heads(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, bool, int]:
    """groups(of, n, ...) beside the row(id, ...) whose children they are, if there is one (copies is null if there is none);
    whether an id comes twice, and how many groups hang from what is no row."""
    known = rows.where("id is not null").withColumn("copies", F.count("*").over(Window.partitionBy("id")))
    heads = materialize(groups.join(known, F.col("of") == F.col("id"), "full").where("n is not null or copies > 1").drop("id"))
    copies, lost = heads.agg(F.max("copies"), F.count_if(F.col("of").isNotNull() & F.col("copies").isNull())).first()
    return heads, (copies or 0) > 1, lost


@dataclass(frozen=True)
class _Places:
    """rows(id, ..., k): nodes in the order of parent and siblings, so that the children of one have places without a gap.
    inner(id, up, k, n, own): nodes that have children, called by the place of the first of them; up: so is the parent called;
    n: how many children there are, from place id on. Roots come first. `roots` and `all` are numbers of rows."""

    rows: DataFrame
    inner: DataFrame
    roots: int
    all: int


def _places(nodes: DataFrame, order: list[Column], said: list[str]) -> _Places | None:
    """Of nodes(id, up, ...); said: columns that rows keep, and inner, with the id, in own (if there are any). None if
    ids repeat."""
    while True:
        rows = numbered(nodes, [F.col("up"), *order], ["id", "up", *said])
        groups = rows.groupBy(F.col("up").alias("of")).agg(F.min("k").alias("first"), F.count("*").alias("n"))
        heads, twice, lost = _heads(rows.select("id", *said, "k"), groups)
        if twice:
            return None
        if not lost:
            break
        # children of what is no node are roots
        none = heads.where("of is not null and copies is null").select(F.col("of").alias("__none"))
        nodes = nodes.join(none, F.col("up") == F.col("__none"), "left").withColumn("up", F.when(F.col("__none").isNull(), F.col("up"))).drop("__none")
    roots, last = heads.agg(F.max(F.when(F.col("of").isNull(), F.col("n"))), F.max(F.col("first") + F.col("n"))).first()
    own = [F.struct(F.col("of").alias("id"), *said).alias("own")] if said else []
    inner = heads.where("copies is not null").select(F.shiftright("k", _SPAN).alias("span"), F.col("k").alias("at"), F.lit(1).alias("kind"), "first", "n", *own)
    events = _spread(heads.select("first", "n", F.col("first").alias("mark"))).unionByName(inner, allowMissingColumns=True)
    up = F.last("mark", ignorenulls=True).over(_run().rowsBetween(Window.unboundedPreceding, 0))
    inner = events.select("kind", "first", up.alias("up"), F.col("at").alias("k"), "n", *(["own"] if said else [])).where("kind = 1")
    inner = materialize(inner.select(F.col("first").alias("id"), (F.when(F.col("up") > 0, F.col("up")) if roots else F.col("up")).alias("up"), "k", "n", *(["own"] if said else [])))
    discard(heads)
    return _Places(rows.drop("up"), inner, roots or 0, last or 0)


def _run() -> WindowSpec:
    return Window.partitionBy("span").orderBy("at", "kind")


def _spread(marks: DataFrame) -> DataFrame:
    """(span, at, kind, mark) of marks(first, n, mark), which hold for n places from first on: in each span that they reach."""
    spans = F.sequence(F.shiftright("first", _SPAN), F.shiftright(F.col("first") + F.col("n") - 1, _SPAN))
    out = marks.select("first", "mark", F.explode(spans).alias("span"))
    return out.select("span", F.greatest("first", F.shiftleft("span", _SPAN)).alias("at"), F.lit(0).alias("kind"), "mark")


def _root_marks(places: _Places, mark: Column) -> DataFrame:
    return _spread(places.rows.sparkSession.range(1 if places.roots else 0).select(F.lit(0).cast("long").alias("first"), F.lit(places.roots).cast("long").alias("n"), mark.alias("mark")))


def preorder(nodes: DataFrame, order: list[str], key: str = "id", parent: str = "parent_id", walk: Chains | None = None) -> DataFrame:
    """(id, position, depth, size): the walk from 0 that goes down before it goes on, siblings by the columns of order.

    Nodes get places in the order of parent and siblings, and all that follows is done with numbers, most of it for nodes
    that have children. A node comes one after its parent and after all that its earlier siblings hold: its position is
    its place and what nodes of earlier places hold, less that of the first sibling, summed along the chain. Where ids
    repeat, or a walk is given, ids are joined instead, which moves more.
    """
    short, back = _shortened(nodes, key, parent, order)
    by = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)]
    told = short.select(F.col(key).alias("id"), F.col(parent).alias("up"), *by)
    # a node without an id counts where sizes are summed, but has no position: it comes after its siblings
    places = None if walk is not None else _places(told, [F.col("id").isNull(), *[F.col(f"__o{i}") for i in range(len(order))], F.col("id")], [])
    if places is None:
        return _preorder_by_ids(nodes, order, key, parent, walk)
    long = lambda c: c.cast("long")
    held = folded(places.inner, F.struct("k", "n", F.col("up").alias("g")), lambda w: w, lambda above, below: below, sizes="n")
    held = materialize(held.select("id", F.col("total.g").alias("up"), "total.k", "total.n", F.col("size").alias("below"), F.shiftright("total.k", _SPAN).alias("span")))
    spans = nodes.sparkSession.range((places.all >> _SPAN) + 1).select(F.col("id").alias("of"))
    sums = held.groupBy("span").agg(F.sum("below").alias("v"))
    before = materialize(spans.join(sums, F.col("of") == F.col("span"), "left").select("of", running(F.col("v"), Window.orderBy("of")).alias("before")))
    summed = lambda events: events.withColumn("c", running(F.col("below"), _run())).join(F.broadcast(before), F.col("span") == F.col("of")).withColumn("c", F.col("before") + F.col("c")).drop("of", "before")
    own = held.select("span", F.col("k").alias("at"), F.lit(1).alias("kind"), "id", "up", "n", "below")
    first = held.select(F.shiftright("id", _SPAN).alias("span"), F.col("id").alias("at"), F.lit(0).alias("kind"), "id")
    steps = summed(first.unionByName(own, allowMissingColumns=True)).groupBy("id").agg(F.max("up").alias("up"), F.max("n").alias("n"), F.sum(F.when(F.col("kind") == 1, F.col("at") + F.col("c") + 1).otherwise(-F.col("at") - F.col("c"))).alias("v"))
    step = lambda d: F.struct("v", long(F.lit(d)).alias("d"), "n")
    join = lambda above, below: F.struct((above["v"] + below["v"]).alias("v"), (above["d"] + below["d"]).alias("d"), below["n"].alias("n"))
    found = folded(materialize(steps), step(1), lambda w: F.struct(w["v"].alias("v"), long(F.lit(0)).alias("d"), w["n"].alias("n")), join)
    marks = _spread(found.select(F.col("id").alias("first"), "total.n", F.struct("total.v", (F.col("total.d") + 1).alias("d")).alias("mark")))
    marks = marks.unionByName(_root_marks(places, F.struct(long(F.lit(0)).alias("v"), long(F.lit(0)).alias("d"))))
    rows = places.rows.select(F.shiftright("k", _SPAN).alias("span"), F.col("k").alias("at"), F.lit(1).alias("kind"), "id")
    more = held.select("span", F.col("k").alias("at"), F.lit(2).alias("kind"), "below")
    events = marks.unionByName(rows, allowMissingColumns=True).unionByName(more, allowMissingColumns=True)
    events = events.withColumns({"mark": F.last("mark", ignorenulls=True).over(_run().rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("kind").over(_run()), "holds": F.lead("below").over(_run())})
    out = summed(events).where("kind = 1 and id is not null")
    return out.select(back(F.col("id")).alias("id"), (F.col("mark.v") + F.col("at") + F.col("c")).alias("position"), F.col("mark.d").alias("depth"), (F.when(F.col("next") == 2, F.col("holds")).otherwise(F.lit(0)) + 1).alias("size"))


def chain_paths(nodes: DataFrame, order: list[str], key: str = "id", parent: str = "parent_id", name: str = "name") -> DataFrame:
    """(id, root, depth, path, names, places): ids, names and sibling places from the root to the node.

    Lists are gathered for nodes that have children, and meet the children by their places; ids that repeat are joined."""
    short, back = _shortened(nodes, key, parent, order)
    by = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)]
    told = short.select(F.col(key).alias("id"), F.col(parent).alias("up"), *by, F.col(name).alias("name"))
    places = _places(told, [*[F.col(f"__o{i}") for i in range(len(order))], F.col("id")], ["name"])
    if places is None:
        return _paths_by_ids(nodes, order, key, parent, name)
    one = lambda i, n, pos: F.array(F.struct(i.alias("id"), n.alias("name"), pos.alias("pos")))
    own = one(F.col("own.id"), F.col("own.name"), F.col("k") - F.coalesce("up", F.lit(0)))
    join = lambda above, below: F.struct(F.concat(above["l"], below["l"]).alias("l"), below["n"].alias("n"))
    found = folded(places.inner, F.struct(own.alias("l"), "n"), lambda w: w, join)
    mark = lambda first, l: F.struct(first.alias("first"), l.alias("l"))  # noqa: E731, E741
    marks = _spread(found.select(F.col("id").alias("first"), "total.n", mark(F.col("id"), F.col("total.l")).alias("mark")))
    none = F.array().cast(found.schema["total"].dataType["l"].dataType)
    marks = marks.unionByName(_root_marks(places, mark(F.lit(0).cast("long"), none)))
    rows = places.rows.select(F.shiftright("k", _SPAN).alias("span"), F.col("k").alias("at"), F.lit(1).alias("kind"), "id", "name")
    events = marks.unionByName(rows, allowMissingColumns=True)
    events = events.withColumn("mark", F.last("mark", ignorenulls=True).over(_run().rowsBetween(Window.unboundedPreceding, 0))).where("kind = 1")
    full = events.select("id", F.concat("mark.l", one(F.col("id"), F.col("name"), F.col("at") - F.col("mark.first"))).alias("total"))
    part = lambda f, do=lambda c: c: F.transform("total", lambda x: do(x[f]))
    return full.select(back(F.col("id")).alias("id"), back(F.col("total")[0]["id"]).alias("root"), (F.size("total") - 1).cast("long").alias("depth"), part("id", back).alias("path"), part("name").alias("names"), part("pos").alias("places"))


def _preorder_by_ids(nodes: DataFrame, order: list[str], key: str, parent: str, walk: Chains | None) -> DataFrame:
    """preorder by joins of ids: positions are sums along the chain of sums over siblings."""
    walk = walk or chains(nodes, key, parent)
    sized = nodes.join(walk.measures.select(F.col("id").alias("__id"), "size"), F.col(key) == F.col("__id")).drop("__id")
    placed = materialize(siblings(sized, order, key, parent, ["size"], "size").select("id", F.col("parent").alias("up"), "size", "before"))
    step = F.struct((F.col("before") + 1).alias("p"), F.lit(1).cast("long").alias("d"), "size")
    join = lambda above, below: F.struct((above["p"] + below["p"]).alias("p"), (above["d"] + below["d"]).alias("d"), below["size"].alias("size"))
    total = folded(placed, step, lambda w: F.struct((w["p"] - 1).alias("p"), F.lit(0).cast("long").alias("d"), w["size"].alias("size")), join)
    return total.select("id", F.col("total.p").alias("position"), F.col("total.d").alias("depth"), F.col("total.size").alias("size"))


def _paths_by_ids(nodes: DataFrame, order: list[str], key: str, parent: str, name: str) -> DataFrame:
    """chain_paths by joins of ids."""
    said = siblings(nodes, order, key, parent, [name])
    row = F.array(F.struct("id", F.col(name).alias("name"), "pos"))
    edges = materialize(said.select("id", F.col("parent").alias("up"), row.alias("own")))
    paths = folded(edges, F.col("own"), lambda w: w, lambda above, below: F.concat(above, below))
    part = lambda f: F.transform("total", lambda x: x[f])
    return paths.select("id", "root", (F.size("total") - 1).cast("long").alias("depth"), part("id").alias("path"), part("name").alias("names"), part("pos").alias("places"))


def _shown(nodes: DataFrame, max_depth: int, key: str, parent: str) -> DataFrame | None:
    """nodes with depth and size, down to max_depth: sizes are summed over nodes that have children, and the children of
    those that lie high enough are shown, beside the roots. None if ids repeat."""
    rows = nodes.select(F.col(key).alias("id"), F.col(parent).alias("up"))
    heads, twice, lost = _heads(rows, rows.groupBy(F.col("up").alias("of")).agg(F.count("*").alias("n")))
    if twice:
        return None
    held = folded(heads.where("copies is not null").select(F.col("of").alias("id"), "up", "n"), F.lit(1).cast("long"), lambda w: F.lit(0).cast("long"), _add, sizes="n")
    top = materialize(held.where(F.col("total") <= max_depth).select(F.col("id").alias("__id"), F.col("total").alias("__depth"), F.col("size").alias("__below")))
    high = materialize(top.where(F.col("__depth") < max_depth).select(F.col("__id").alias("__up"), (F.col("__depth") + 1).alias("depth")))  # small enough, as a rule, to be sent to all
    none = heads.where("of is not null and copies is null").select(F.col("of").alias("__none"))
    free = nodes.where(F.col(parent).isNull())
    if lost:
        free = free.unionByName(nodes.join(none, F.col(parent) == F.col("__none"), "left_semi"))
    free = free.where(F.lit(max_depth >= 0)).withColumn("depth", F.lit(0).cast("long"))
    shown = free.unionByName(nodes.join(high, F.col(parent) == F.col("__up")).drop("__up")).where(F.col(key).isNotNull())
    return materialize(shown.join(top, F.col(key) == F.col("__id"), "left").withColumn("size", F.coalesce("__below", F.lit(0)) + 1).drop("__id", "__depth", "__below"))


def ordered_tree_lines(nodes: DataFrame, order: list[str], max_depth: int = 3, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """(position, id, line): the forest as text down to a depth, siblings by the columns of order; by position to read it.

    A line has a bar for each ancestor that is not the last of its siblings. Places and bars follow from nodes no deeper
    than the line, so only the sizes are gathered from all.
    """
    short, back = _shortened(nodes, key, parent, order)
    short = short.select(*dict.fromkeys([key, parent, *order, "name", "node_type"]))
    shown = _shown(short, max_depth, key, parent)
    if shown is None:
        measures = chains(short, key, parent).measures.where(F.col("depth") <= max_depth).select(F.col("id").alias("__id"), "depth", "size")
        shown = materialize(short.join(measures, F.col(key) == F.col("__id")).drop("__id"))
    placed = materialize(siblings(shown, order, key, parent, ["depth", "size", "name", "node_type"], "size"))
    last = F.col("pos") == F.col("n") - 1
    step = F.struct((F.col("before") + 1).alias("p"), F.when(last, "    ").otherwise("│   ").alias("bars"))
    edges = placed.select("id", F.col("parent").alias("up"), "before", "pos", "n")
    join = lambda above, below: F.struct((above["p"] + below["p"]).alias("p"), F.concat(above["bars"], below["bars"]).alias("bars"))
    total = folded(edges, step, lambda w: F.struct((w["p"] - 1).alias("p"), w["bars"].alias("bars")), join)
    full = placed.join(total.select(F.col("id").alias("__id"), "total"), F.col("id") == F.col("__id"))
    bars = F.substring(F.col("total.bars"), F.lit(1), F.length("total.bars") - 4)
    line = F.concat(bars, F.when(last, "└── ").otherwise("├── "), "name", F.lit(" ["), "node_type", F.lit("]"))
    return full.select(F.col("total.p").alias("position"), back(F.col("id")).alias("id"), line.alias("line"))


def descendants_of(roots: DataFrame, walk: Chains) -> DataFrame:
    """Distinct ids below roots(id), without the roots themselves unless one lies below another."""
    return chain_ancestors(walk).join(roots.select(F.col("id").alias("ancestor_id")).distinct(), "ancestor_id", "left_semi").select("id").distinct()
