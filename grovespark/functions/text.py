"""Scalar text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column, max_len: int | None = None) -> Column:
    """Lower case, word characters only, blanks and hyphens as one underscore, none at the ends."""
    kept = F.regexp_replace(F.lower(name), r"(?U)[^\w\s-]", "")
    out = F.btrim(F.regexp_replace(kept, r"(?U)[-\s]+", "_"), F.lit("_"))
    return out if max_len is None else F.substring(out, 1, max_len)


def make_id(parent_id: Column, name: Column, max_len: int | None = None) -> Column:
    return F.concat_ws("/", parent_id, slug(name, max_len))


def norm_name(name: Column) -> Column:
    return F.lower(F.btrim(name))


def words_of(name: Column) -> Column:
    """Lower-case words, underscores and hyphens taken as blanks."""
    return F.filter(F.split(F.translate(norm_name(name), "_-", "  "), r"\s+"), lambda w: w != "")


def depth(id_: Column, base: int = 0) -> Column:
    return (F.size(F.split(id_, "/")) - 1 + base).cast("int")


def domain_of(id_: Column) -> Column:
    return F.substring_index(id_, "/", 1)


def parent_path(id_: Column) -> Column:
    parts = F.split(id_, "/")
    return F.nullif(F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/"), F.lit(""))


def first_verb(name: Column) -> Column:
    """First word, letters and underscores only; null unless longer than one character."""
    v = F.regexp_replace(F.split(F.lower(name), r"[\s,.(]")[0], "[^a-z_]", "")
    return F.when(F.length(v) > 1, v)


def stem(verb: Column) -> Column:
    return F.substring_index(verb, "_", 1)


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def title_case(name: Column, suffix: str = "") -> Column:
    """Words of a snake name with capitals, and a suffix in parentheses, if there is one."""
    words = F.initcap(F.translate(name, "_", " "))
    return F.concat(words, F.lit(f" ({suffix})")) if suffix else words


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, total), digits)


def per_minute(count: Column, seconds: Column) -> Column:
    """Null where no time has passed."""
    return F.try_divide(count * 60.0, seconds)


def eta_seconds(done: Column, goal: Column, seconds: Column) -> Column:
    """Seconds until the goal at the pace so far; null before anything is done."""
    return F.try_divide((goal - done) * seconds, done.cast("double"))


def iso_time(text: Column) -> Column:
    """The time of an ISO text; null where it is none."""
    return F.try_to_timestamp(text)


def json_counts(keys: Column, values: Column) -> Column:
    """JSON text of two arrays as an object."""
    return F.to_json(F.map_from_arrays(keys, values))
