"""Fuzzy line dedup by MinHash, with DataFrame functions alone.

Lines are compared in normal form (lower case, white space collapsed) by their character shingles. Every line has a
signature of those that begin at word starts, and a line of few words for its length a second one of all of them; their
distinct sorted hashes fall into bands by their leading bits, and a band's key is made of the hashes that follow one
another from its smallest on (one-permutation MinHash). Lines that share a key, and whose sketches of the bands' minima allow for it, are verified
by the exact Jaccard similarity of all shingles of the whole line; distributed union-find joins what is verified, and
the first line of each component stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.llm.buckets import bucket_classes
from grovespark.llm.prefilter import likely
from grovespark.llm.scratch import discard, materialize

#: Characters of a shingle, in signatures and where pairs are verified.
WIDTH = 8
#: Bands of the finest division, by the three leading bits; eight values of shiftright(hash, 61).
BANDS = range(-4, 4)
#: Least quotient of the signature sizes of two lines that are compared. It lies far below the 0.8 of the whole sets,
#: as the shingles at word starts are a sample.
RATIO = 0.6
#: A line with fewer word starts than one for so many characters has a signature of all its shingles too. All lines have
#: the other signature, so two lines on both sides of this step share that one.
FEW = 16
#: Places of a body whose shingles are made together.
CHUNK = 1024


def normal_form(low: Column) -> Column:
    """Of a line in lower case. Most lines hold single spaces alone and need no pattern."""
    odd = low.contains("  ") | low.rlike(r"[\t\r\x0b\f\u00a0]")
    return F.when(odd, F.trim(F.regexp_replace(low, r"[\s\u00a0]+", " "))).otherwise(F.trim(low))


def _at_words(norm: Column, width: int) -> Column:
    # what is consumed ends with the word, so that the search goes on at the next word and not inside this one
    return F.regexp_extract_all(norm, F.lit(f"(?s)(?=({'.' * width}))[^ ]*+.?+"), F.lit(1))


def _everywhere(norm: Column, width: int) -> Column:
    return F.regexp_extract_all(norm, F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1))


def _banded(df: DataFrame, keep: list[str], kind: str = "") -> DataFrame:
    """keep columns with n, sketch and keys of the sorted distinct hashes in column `hashes`; keys of two kinds don't meet.

    By the number of hashes there are keys of eight, four or two bands, of four, three or two hashes. Lines that are
    alike may lie on both sides of a step between these, so lines up to 5/4 above a step have the keys of both sides.
    Step by step, and over small arrays of places, so that each array is made once and generated code stays small.
    """
    bands = df.withColumn("bands", F.transform("hashes", lambda h: F.shiftright(h, 61)))
    placed = bands.select(*keep, "hashes", F.array(*[F.array_position("bands", F.lit(b).cast("long")).cast("int") for b in BANDS]).alias("q8"))
    first = lambda q, k: F.when(F.get(q, F.lit(2 * k)) > 0, F.get(q, F.lit(2 * k))).otherwise(F.get(q, F.lit(2 * k + 1)))
    placed = placed.withColumn("q4", F.array(*[first("q8", k) for k in range(4)]))
    placed = placed.withColumn("q2", F.array(*[first("q4", k) for k in range(2)]))
    key = lambda q, depth: F.transform(q, lambda p, k: F.when(p > 0, F.xxhash64(F.lit(f"{kind}{q}.{depth}"), k, F.slice("hashes", p, F.lit(depth)))))
    low = lambda p: F.when(p > 0, F.get("hashes", p - 1).bitwiseAND(F.lit(255))).otherwise(F.lit(0).cast("long"))
    sketch = F.aggregate("q8", F.lit(0).cast("long"), lambda s, p: F.shiftleft(s, 8).bitwiseOR(low(p)))
    n, both = F.size("hashes"), F.concat
    keys = F.when(n >= 39, key("q8", 4)).when(n >= 31, both(key("q8", 4), key("q8", 3))).when(n >= 20, key("q8", 3)).when(n >= 16, both(key("q8", 3), key("q4", 3)))
    keys = keys.when(n >= 10, key("q4", 3)).when(n >= 8, both(key("q4", 3), key("q2", 2))).otherwise(key("q2", 2))
    return placed.select(*keep, n.alias("n"), sketch.alias("sketch"), keys.alias("keys"))


def line_table(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, tx, pos, norm) of every line that is not blank; tx tells apart rows that share a key. A line of white space
    other than spaces is there with an empty norm."""
    cut = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.xxhash64(text).alias("tx"), F.split(F.lower(text), "\n", -1).alias("lines"))
    # posexplode_outer: posexplode would have the text split thrice, for filters that Spark infers
    rows = cut.select(key, "tx", F.posexplode_outer("lines").alias("pos", "low"))
    return rows.where(F.trim("low") != "").select(key, "tx", "pos", normal_form(F.col("low")).alias("norm"))


def signatures(lines: DataFrame, key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """(key, tx, pos, id, norm, few, n, sketch, keys) from word starts: id is the hash of the normal form, equal for equal
    lines; few: the line has few words for its length."""
    short = F.length("norm") <= width
    first = lines.select(key, "tx", "pos", "norm", F.when(short, F.array("norm")).otherwise(_at_words(F.col("norm"), width)).alias("found"))
    few = F.size("found") * FEW < F.length("norm")
    hashed = first.select(key, "tx", "pos", F.xxhash64("norm").alias("id"), "norm", few.alias("few"), _hashes(F.col("found")).alias("hashes"))
    return _banded(hashed, [key, "tx", "pos", "id", "norm", "few"])


def _hashes(found: Column) -> Column:
    return F.sort_array(F.array_distinct(F.transform(found, lambda s: F.xxhash64(s))))


def full_signatures(lines: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, n, sketch, keys) from all shingles, of the lines (id, norm) that have few words for their length."""
    return _banded(lines.select("id", _hashes(_everywhere(F.col("norm"), width)).alias("hashes")), ["id"], "all.")


def body_of(norm: Column) -> Column:
    """A normal form as UTF-16, in which a shingle can be cut out without reading what lies before it."""
    return F.encode(norm, "UTF-16BE")


def shingles(body: Column, width: int) -> Column:
    """Distinct hashes of all character shingles (of UTF-16 units) of a body; one no longer than a shingle is its own.

    Bodies are gone through in chunks that overlap, so that the work grows with the length and not with its square.
    """
    half = lambda x: (F.length(x) / 2).cast("int")
    n, cut = half(body), lambda x, at, size: F.substring(x, 2 * at + 1, F.lit(2 * size))
    chunks = F.transform(F.sequence(F.lit(0), n - width, F.lit(CHUNK)), lambda at: cut(body, at, CHUNK + width - 1))
    each = F.transform(chunks, lambda x: F.transform(F.sequence(F.lit(0), half(x) - width), lambda at: F.xxhash64(cut(x, at, width))))
    return F.when(n <= width, F.array(F.xxhash64(body))).otherwise(F.array_distinct(F.flatten(each)))


def _texts(ids: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, body): the bodies of the lines with these ids."""
    return likely(lines, ids, "id").distinct().join(ids, "id").select("id", body_of(F.col("norm")).alias("body"))


def line_classes(df: DataFrame, width: int = WIDTH, threshold: float = 0.8, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(occurrences, classes): every line's (key, tx, pos, id), and (id, class) of the ids in components of several.

    The components are those of all pairs of lines that share a bucket, fit and reach the threshold (see `buckets`).
    """
    lines = line_table(df, text, key)
    # the few normal forms that need a second signature have a column of their own, so that finding them reads no others
    written = materialize(signatures(lines, key, width).withColumn("wide", F.when(F.col("few"), F.col("norm"))))
    # an empty norm, told by its hash
    occurrences = written.where(F.col("id") != F.xxhash64(F.lit("")))
    exploded = lambda rows: rows.select(F.explode("keys").alias("key"), "id", "sketch", "n").where("key is not null")
    wide = materialize(occurrences.where("wide is not null").select("id", F.col("wide").alias("norm")))
    # written, as keyed is read twice and Spark would try the filters of the keys on every line before those of `wide`
    second = materialize(full_signatures(wide, width))
    keyed = exploded(occurrences).unionByName(exploded(second))
    # the normal forms are kept beside the keys: reading the column again costs less than cutting all texts again
    found = bucket_classes(keyed, lambda ids: _texts(ids, occurrences.select("id", "norm")), lambda body: shingles(body, width), threshold, RATIO)
    discard(wide, second)
    seen = occurrences.select(key, "tx", "pos", "id")
    seen._scratch = written._scratch
    return seen, found.select(F.col("node").alias("id"), F.col("component").alias("class"))


def _dropped(seen: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """(key, tx, pos) of every line that is not the first of its class. Only lines whose class has several move twice."""
    place = F.struct(key, "pos", "tx")
    each = materialize(seen.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(classes, "id", "left").where("n > 1 or class is not null").select("id", F.coalesce("class", "id").alias("class"), "first"))
    keepers = each.groupBy("class").agg(F.min("first").alias("keeper"))
    known = materialize(each.select("id", "class").join(keepers, "class").select("id", "keeper"))
    discard(each)
    return likely(seen, known, "id").join(known, "id").where(place != F.col("keeper")).select(key, "tx", "pos")


def dedup_lines(df: DataFrame, width: int = WIDTH, threshold: float = 0.8, text: str = "text", key: str = "doc_id", counts: tuple[str, str] | None = ("n_lines", "n_kept")) -> DataFrame:
    """df with every line dropped that is not the first, by (key, position), of its class; adds the counts of lines.

    Blank lines always stay and are not counted. A null text or key leaves the row as it is (both counts zero). Rows
    with equal key and text keep the same lines, and each counts its own; rows with equal key and other texts are told
    apart by the text. A document may be left with an empty text, but no row goes. Other columns pass unchanged; counts
    names the two columns that are added (None: none); a column of df with such a name is replaced.
    """
    seen, classes = line_classes(df, width, threshold, text, key)
    gone = _dropped(seen, classes, key).groupBy(key, "tx").agg(F.collect_set("pos").alias("__drop"))
    lists = materialize(gone.select(F.col(key).alias("__key"), F.col("tx").alias("__tx"), "__drop"))
    discard(seen)
    marked = df.withColumn("__tx", F.xxhash64(text)).withColumn("__key", F.col(key))
    at = F.xxhash64("__key", "__tx").alias("__at")
    hit = marked.select("*", at)
    # texts that lose no line are not shuffled: the bitmap parts them from those that may
    maybe, sure = likely(hit, lists.select(at), "__at", split=True)
    joined = maybe.drop("__at").join(lists, ["__key", "__tx"], "left").unionByName(sure.drop("__at").withColumn("__drop", F.lit(None).cast("array<int>")))
    cut = joined.withColumn("__parts", F.split(text, "\n", -1))
    stay = F.filter("__parts", lambda line, i: ~F.array_contains("__drop", i))
    rebuilt = F.when(F.size("__drop") > 0, F.array_join(stay, "\n")).otherwise(F.col(text))
    n = F.when(F.col(key).isNotNull() & F.col(text).isNotNull(), F.size(F.filter("__parts", lambda line: line.rlike(r"[^\s\u00a0]")))).otherwise(0).cast("long")
    out = cut.withColumn(text, rebuilt)
    if counts:
        out = out.withColumns({counts[0]: n, counts[1]: n - F.when(F.size("__drop") > 0, F.size("__drop")).otherwise(0)})
    return out.select(*[c for c in df.columns if c not in (counts or ())], *(counts or ()))
