"""The trie of all conversation prefixes, from monoid fingerprints of turns.

A sequence of turns is the element (n, s) of a monoid: its length, and the sum of turn * BASE^position over four prime
fields. (n1, s1)(n2, s2) = (n1 + n2, s1 + BASE^n1 * s2), so a conversation that begins with the turns of another and goes
on with a part of its own is put together from products that are stored once for every conversation: no rebuilt text is
ever made. A node of the trie is a depth and a product. That equal products are equal sequences is verified from what is
stored: all members of a node must end in one and the same turn digest, and all turns of a digest must be equal in role
and text (then equality goes down the parents to the root). Should a digest or product meet by chance, all is made anew
with other bases.

Positions and products are made within ranges of (conversation, turn) and put together across them, so that a
conversation with a third of all turns is spread over as many tasks as its share of the rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grovespark.llm.prefilter import likely
from grovespark.llm.scratch import discard, materialize
from grovespark.session import ensure_on_workers

#: Primes below 2^31, so that a product of two residues fits a long, and the base of each field.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1566083941, 1812433253, 1664525017)
LANES = range(len(PRIMES))
#: Depths whose sums are made in one group.
BLOCK = 12
#: Ids of members that are joined to one text.
IDS = 7


def _base(lane: int, trial: int) -> int:
    return pow(BASES[lane], 2 * trial + 1, PRIMES[lane])


def _power(exponent: Column, lane: int, trial: int, bits: int) -> Column:
    """BASE^exponent in a lane's field, for exponents below 2^bits."""
    p, b = PRIMES[lane], _base(lane, trial)
    squares = F.array(*[F.lit(pow(b, 1 << j, p)).cast("long") for j in range(bits)])
    used = F.transform(squares, lambda c, j: F.when(F.getbit(exponent, j) == 1, c).otherwise(F.lit(1).cast("long")))
    return F.aggregate(used, F.lit(1).cast("long"), lambda a, c: a * c % p)


def _pack(sums: list[Column]) -> list[Column]:
    """Four residues as two longs."""
    return [F.shiftleft(sums[0], 31).bitwiseOR(sums[1]), F.shiftleft(sums[2], 31).bitwiseOR(sums[3])]


def ordered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str, trial: int) -> DataFrame:
    """(conv, seq, d0, d1, bytes, role, text) written in order of (conv, turn, role, text); seq grows in that order and
    has no gap within a conversation and a range. Only ranges are cut by the beginning of a text, ties go by all of it."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), clean(role).alias("role"), clean(text).alias("text"))
    nulls_first = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.withColumn("head", F.substring("text", 1, 32)).repartitionByRange(*nulls_first, F.col("head")).sortWithinPartitions(*nulls_first, "text")
    digest = [F.xxhash64("role", "text", F.lit(2 * trial + k)).alias(f"d{k}") for k in (0, 1)]
    return materialize(dealt.select("conv", F.monotonically_increasing_id().alias("seq"), *digest, F.octet_length("text").cast("long").alias("bytes"), "role", "text"))


def same_turns(turns: DataFrame) -> bool:
    """Whether turns of equal digests are equal. Only texts whose digest occurs again are compared, and a text that very
    many turns share is brought down to one row in each task before it moves."""
    at = turns.withColumn("__at", F.xxhash64("d0", "d1"))
    again = materialize(at.groupBy("d0", "d1").agg(F.count("*").alias("n"), F.first("__at").alias("__at")).where("n > 1").select("__at"))
    ends = likely(at, again, "__at").groupBy("d0", "d1").agg(F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
    return ends.where("a <> b").isEmpty()


def turn_products(turns: DataFrame, trial: int) -> DataFrame:
    """(conv, pos, d0, d1, bytes, s0.., q0..): position from 1; the sums of the first pos turns, and of those before it."""
    local = turns.select("conv", F.shiftright("seq", 33).alias("part"), "seq", "d0", "d1", "bytes")
    own = Window.partitionBy("conv", "part")
    bits = max(1, turns.count().bit_length())
    at = local.withColumn("i", F.col("seq") - F.min("seq").over(own) + 1)
    term = lambda k: F.pmod(F.col("d0" if k < 2 else "d1"), F.lit(PRIMES[k])) * _power(F.col("i"), k, trial, bits) % PRIMES[k]
    at = at.withColumns({f"t{k}": term(k) for k in LANES})
    run = own.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    at = materialize(at.withColumns({f"s{k}": F.sum(f"t{k}").over(run) % PRIMES[k] for k in LANES}))
    # each range's element, and the product of those before it in its conversation: as many rows as ranges it lies in
    chunk = at.groupBy("conv", "part").agg(F.count("*").alias("n"), *[(F.sum(f"t{k}") % PRIMES[k]).alias(f"c{k}") for k in LANES])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
    chunk = chunk.withColumns({f"w{k}": _power(F.col("off"), k, trial, bits) for k in LANES})
    chunk = chunk.withColumns({f"o{k}": F.coalesce(F.sum(F.col(f"c{k}") * F.col(f"w{k}") % PRIMES[k]).over(before), F.lit(0)) % PRIMES[k] for k in LANES})
    full = at.join(chunk.select("conv", "part", "off", *[f"{x}{k}" for x in "wo" for k in LANES]), ["conv", "part"])
    after = lambda k: (F.col(f"o{k}") + F.col(f"w{k}") * F.col(f"s{k}")) % PRIMES[k]
    ahead = lambda k: (F.col(f"o{k}") + F.col(f"w{k}") * F.pmod(F.col(f"s{k}") - F.col(f"t{k}"), F.lit(PRIMES[k]))) % PRIMES[k]
    out = materialize(full.select("conv", (F.col("off") + F.col("i")).alias("pos"), "d0", "d1", "bytes", *[after(k).alias(f"s{k}") for k in LANES], *[ahead(k).alias(f"q{k}") for k in LANES]))
    discard(at)
    return out


def rebuilt_prefixes(products: DataFrame, trial: int, group: int = 5, most: int = 9) -> DataFrame:
    """(conv, d, a, b, pa, pb, d0, d1, bytes, is_end): every prefix of every rebuilt conversation, from depth 0 on.

    Conversation c is rebuilt as the first h turns of c - c % group and its own turns after its first h, where h is
    crc32(decimal c) % most. (a, b) is the prefix' product, (pa, pb) that of the prefix before it.
    """
    stored = F.struct("pos", *[f"s{k}" for k in LANES], *[f"q{k}" for k in LANES], "d0", "d1", "bytes")
    first = F.array_sort(F.collect_list(F.when(F.col("pos") < most, stored)))
    convs = materialize(products.groupBy("conv").agg(F.max("pos").alias("n"), first.alias("first")))  # below `most` turns each
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = convs.select(F.col("conv").alias("head"), F.col("n").alias("head_n"), F.col("first").alias("lead"))
    info = convs.withColumns({"h": h, "head": F.col("conv") - F.col("conv") % group}).join(base, "head", "left")
    info = info.withColumn("hn", F.least("h", F.coalesce("head_n", F.lit(0))))
    sum_at = lambda table, at, k: F.coalesce(F.get(F.col(table), (at - 1).cast("int"))[f"s{k}"], F.lit(0))
    # BASE^(hn - h) for the few differences that occur
    shift = lambda k: F.get(F.array(*[F.lit(pow(_base(k, trial), -x, PRIMES[k])).cast("long") for x in range(most)]), (F.col("h") - F.col("hn")).cast("int"))
    known = {f"l{k}": sum_at("lead", F.col("hn"), k) for k in LANES} | {f"u{k}": sum_at("first", F.least("h", "n"), k) for k in LANES} | {f"x{k}": shift(k) for k in LANES}
    info = materialize(info.withColumns(known | {"size": F.col("hn") + F.greatest(F.col("n") - F.col("h"), F.lit(0))}).drop("first"))
    prefix = lambda s, q: [c.alias(n) for c, n in zip(_pack(s) + _pack(q), ("a", "b", "pa", "pb"))]
    none, zeros = F.lit(0).cast("long"), [F.lit(0).cast("long")] * 4
    columns = ("conv", "d", "a", "b", "pa", "pb", "d0", "d1", "bytes", "is_end")
    roots = info.select("conv", none.alias("d"), *prefix(zeros, zeros), none.alias("d0"), none.alias("d1"), none.alias("bytes"), (F.col("size") == 0).alias("is_end"))
    shared = info.where("hn > 0").select("conv", "size", F.explode(F.slice("lead", 1, F.col("hn").cast("int"))).alias("t"))
    shared = shared.select("conv", F.col("t.pos").alias("d"), *prefix([F.col(f"t.s{k}") for k in LANES], [F.col(f"t.q{k}") for k in LANES]), "t.d0", "t.d1", "t.bytes", (F.col("size") == F.col("t.pos")).alias("is_end"))
    own = products.join(info.where("n > h").drop("lead", "n", "head", "head_n"), "conv").where("pos > h")
    put = lambda c, k: (F.col(f"l{k}") + F.col(f"x{k}") * F.pmod(F.col(f"{c}{k}") - F.col(f"u{k}"), F.lit(PRIMES[k]))) % PRIMES[k]
    d = F.col("hn") + F.col("pos") - F.col("h")
    own = own.select("conv", d.alias("d"), *prefix([put("s", k) for k in LANES], [put("q", k) for k in LANES]), "d0", "d1", "bytes", (F.col("size") == d).alias("is_end"))
    out = materialize(roots.select(*columns).unionByName(shared.select(*columns)).unionByName(own.select(*columns)))
    discard(convs, info)
    return out


def _below(rows: DataFrame, owned: DataFrame) -> DataFrame:
    """rows with, for each conversation, the sums of what it owns at their depth and deeper.

    Sums are made in blocks of 2^BLOCK depths, and the later blocks' totals are added to the conversations that have some.
    """
    marked = rows.join(owned, ["conv", "d"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("weight", "leaf")} | {"block": F.shiftright("d", BLOCK)})
    inner = Window.partitionBy("conv", "block").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = marked.select("conv", "d", "a", "b", "block", F.sum("weight").over(inner).alias("weight"), F.sum("leaf").over(inner).alias("leaf"))
    deep = owned.withColumn("block", F.shiftright("d", BLOCK)).groupBy("conv", "block").agg(F.sum("weight").alias("w"), F.sum("leaf").alias("l")).where("block > 0")
    # a block's totals count for all blocks before it
    later = deep.select("conv", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block") - 1)).alias("block"), "w", "l").groupBy("conv", "block").agg(F.sum("w").alias("w"), F.sum("l").alias("l"))
    full = summed.join(later, ["conv", "block"], "left")
    return full.select("d", "a", "b", (F.col("weight") + F.coalesce("w", F.lit(0))).alias("weight"), (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"))


def _hash_runs(frames):
    """SHA-256 of the texts of each run of equal (d, a, b), joined by commas; a run may go on in the next frame."""
    at, digest = None, None
    for pdf in frames:
        done = []
        for key, text in zip(zip(pdf["d"], pdf["a"], pdf["b"]), pdf["ids"]):
            if key != at:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield pd.DataFrame(done, columns=["d", "a", "b", "ends"])
    if at is not None:
        yield pd.DataFrame([(*at, digest.hexdigest())], columns=["d", "a", "b", "ends"])


def member_digests(ends: DataFrame) -> DataFrame:
    """(d, a, b, ends): SHA-256 of the ascending ids of ends(d, a, b, conv), in decimal and joined by commas.

    Ids are joined to texts of at most 2^IDS neighbours; a node with several texts has them hashed one after another,
    which holds one at a time in memory however many there are.
    """
    key = ["d", "a", "b"]
    texts = ends.groupBy(*key, F.shiftright("conv", IDS).alias("at")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    texts = materialize(texts)
    counted = materialize(texts.groupBy(*key).agg(F.count("*").alias("n"), F.min("ids").alias("ids")))
    single = counted.where("n = 1").select(*key, F.sha2("ids", 256).alias("ends"))
    many = texts.join(counted.where("n > 1").select(*key), key, "left_semi")
    ensure_on_workers(ends.sparkSession)
    ordered = many.repartition(*key).sortWithinPartitions(*key, "at").select(*key, "ids")
    return single.unionByName(ordered.mapInPandas(_hash_runs, "d long, a long, b long, ends string"))


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trials: int = 4) -> DataFrame:
    """(conv, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Turns are ordered by turn, null first; equal turn numbers by role and text, so repeated rows are turns of their own.
    A null role or text is empty. Rows with a null conversation take no part; a table without others gives no node.
    c % 5 of a negative id has the sign of c, as in SQL.
    """
    for trial in range(trials):
        turns = ordered_turns(df, conv, turn, role, text, trial)
        if not same_turns(turns):
            discard(turns)
            continue
        products = turn_products(turns, trial)
        rows = rebuilt_prefixes(products, trial)
        key = ["d", "a", "b"]
        nodes = rows.groupBy(*key).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.count_if("is_end").alias("n_ends"), F.max("bytes").alias("bytes"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), *[f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("d0", "d1", "pa", "pb")])
        nodes = materialize(nodes)
        discard(turns, products)
        if nodes.where(" or ".join(f"min_{c} <> max_{c}" for c in ("d0", "d1", "pa", "pb"))).isEmpty():
            break
        discard(nodes, rows)
    else:
        raise RuntimeError(f"digests of different turns were equal with {trials} bases")
    owned = nodes.select("conv", "d", ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    totals = _below(rows.select("conv", *key), owned).groupBy(*key).agg(F.sum("weight").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent_conv_id"))
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    digests = member_digests(rows.where("is_end").select(*key, "conv"))
    full = nodes.join(totals, key).join(children, key, "left").join(digests, key, "left").join(parents, ["d", "pa", "pb"], "left")
    return full.select(
        F.col("conv").alias(conv), F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
