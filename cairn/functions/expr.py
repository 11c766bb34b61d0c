"""Scalar expressions over identifiers, templates, tags, JSON text, durations and key prefixes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The highest code point: a prefix followed by it sorts after every key with that prefix.
HIGHEST = "\U0010ffff"


def or_else(first: Column, *rest: Column) -> Column:
    """The first value that is neither null nor empty; else the last one."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in (first, *rest[:-1])), rest[-1])


def id_from_arn(arn: Column) -> Column:
    """The last segment of the resource part, whose separators are ``:`` and ``/``; empty without a ``:``."""
    tail = F.element_at(F.split(arn, ":", 6), -1)
    last = F.element_at(F.split(F.translate(tail, ":", "/"), "/", -1), -1)
    return F.when(F.instr(arn, ":") > 0, last).otherwise("")


def url_segment(url: Column, from_end: int = 1) -> Column:
    """The segment of a path or URL counted from its end, null if there are fewer."""
    return F.try_element_at(F.split(url, "/", -1), F.lit(-from_end))


def bucket_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"(?s)\A[a-z0-9]+://([^/]*)", 1)


def key_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"(?s)\A[a-z0-9]+://[^/]*/(.*)\z", 1)


def strip_prefix(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, "^(?:" + pattern + ")", "")


def render(template: str, columns: dict[str, Column]) -> Column:
    """``{name}`` parts replaced by columns. Null if one is null, unknown, or not a single value."""
    parts = re.split(r"\{(\w+)\}", template)
    made = [F.lit(p) if i % 2 == 0 else columns[p].cast("string") if p in columns else F.lit(None).cast("string") for i, p in enumerate(parts)]
    return F.concat(*made)


def render_or_empty(template: str, columns: dict[str, Column]) -> Column:
    return F.coalesce(render(template, columns), F.lit(""))


def last_wins(entries: Column) -> Column:
    """Entries (key, value) without null keys and, of equal keys, only the last: safe to build a map from."""
    some = F.filter(entries, lambda e: e["key"].isNotNull())
    return F.filter(some, lambda e, i: ~F.exists(F.slice(some, i + 2, F.greatest(F.size(some), F.lit(1))), lambda x: x["key"] == e["key"]))


def tags_to_map(tags: Column, kind: T.DataType) -> Column:
    """A list of tags, of any of the usual spellings of key and value, or a map, as a map; null as an empty map."""
    empty = F.create_map().cast("map<string,string>")
    if isinstance(kind, T.MapType):
        return F.coalesce(tags.cast("map<string,string>"), empty)
    names = kind.elementType.names
    pick = lambda x, spellings: F.coalesce(*(x[n].cast("string") for n in spellings if n in names), F.lit(None).cast("string"))
    entries = F.transform(tags, lambda x: F.struct(pick(x, ("Key", "TagKey", "key")).alias("key"), pick(x, ("Value", "TagValue", "value")).alias("value")))
    return F.coalesce(F.map_from_entries(last_wins(entries)), empty)


def decode_key(c: Column) -> Column:
    """Percent-decoding that leaves ``+`` as it is."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def is_true(c: Column) -> Column:
    return F.lower(c).isin("1", "true", "yes")


def seconds(duration: Column) -> Column:
    """``90``, ``15m``, ``1.5h``, ``7D`` as seconds, a double; null for other text."""
    text = F.lower(F.trim(duration))
    form = r"\A([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)\s*([smhd]?)\z"
    unit = F.regexp_extract(text, form, 2)
    return F.regexp_extract(text, form, 1).try_cast("double") * F.when(unit == "m", 60.0).when(unit == "h", 3600.0).when(unit == "d", 86400.0).otherwise(1.0)


def one_decimal(x: Column) -> Column:
    """A number from 0 to 2^48 as text with one decimal. What lies halfway between two goes to the even one, and only what does: a
    double that looks like 1.85 lies a little above it."""
    n = F.floor(x * 10)
    # 20 x against 2 n + 1, with the rounding error of the sum
    a, b = x * 16, x * 4
    total = a + b
    rest = total - a
    error = (a - (total - rest)) + (b - rest)
    over = (total - (2 * n + 1)) + error
    tenths = n + F.when((over > 0) | ((over == 0) & (n % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def age_text(age: Column) -> Column:
    """Seconds under 90, minutes under 90 of them, hours with a decimal under 36, else days with one."""
    age = age.cast("double")
    whole = lambda c: F.rint(c).cast("long").cast("string")
    return (
        F.when(age < 90, F.concat(whole(age), F.lit("s"))).when(age < 90 * 60, F.concat(whole(age / 60), F.lit("m")))
        .when(age < 36 * 3600, F.concat(one_decimal(age / 3600), F.lit("h"))).otherwise(F.concat(one_decimal(age / 86400), F.lit("d")))
    )


def signature(code: Column, message: Column) -> Column:
    """An error's code, else the first line of its message cut to 60 characters."""
    return F.coalesce(F.nullif(code, F.lit("")), F.substring(F.get(F.split(message, "\n"), F.lit(0)), 1, 60))


def hash_key(*columns: Column) -> Column:
    """32 hex digits over all columns; nulls count."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, 32)


def remap_keys(m: Column, members: list[str]) -> Column:
    """The map with keys in the members' casing; keys that match none, and null values, are dropped."""
    names = F.create_map(*(F.lit(x) for n in members for x in (n.lower(), n))) if members else F.create_map().cast("map<string,string>")
    known = F.map_filter(m, lambda k, v: F.array_contains(F.map_keys(names), F.lower(k)) & v.isNotNull())
    return F.map_from_entries(last_wins(F.transform(F.map_entries(known), lambda e: F.struct(F.try_element_at(names, F.lower(e["key"])).alias("key"), e["value"].alias("value")))))


def branch_end(prefix: Column, n: int = 1) -> Column:
    """A string above every key that begins with ``prefix``."""
    return F.concat(prefix, F.lit(HIGHEST * n))


def is_list(value: Column) -> Column:
    """Whether a variant holds a list."""
    return F.schema_of_variant(value).startswith("ARRAY<")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Null for an empty whole."""
    return F.when(whole != 0, F.round(F.lit(100.0) * part.cast("double") / whole.cast("double"), digits))
