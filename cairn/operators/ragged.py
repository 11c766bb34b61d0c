"""Pages whose items differ from row to row: the walk, the tags and the envelope over variants.

A field that is there but null is a variant that holds null; one that isn't there is a null of SQL. The typed operators in
``shape`` can't tell them apart, and need one schema for all pages.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.expr import id_from_arn, last_wins, or_else, render
from cairn.operators.shape import META, STAMP, Shape

_EMPTY = "map<string,string>"


def member(v: Column, name: str) -> Column:
    """The field of an object, as a variant: null if it isn't there or ``v`` is no object."""
    if "'" in name or "\\" in name:
        raise ValueError(f"not a field name: {name!r}")
    return F.try_variant_get(v, f"$['{name}']", "variant")


def items_of(v: Column) -> Column:
    """A list's items; null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def fields_of(v: Column) -> Column:
    """An object's fields; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def scalar(v: Column) -> Column:
    """A single value as text; null for null, lists and objects."""
    return F.when(items_of(v).isNull() & fields_of(v).isNull(), F.try_variant_get(v, "$", "string"))


def walk(df: DataFrame, page: str, path: tuple[str, ...], out: str = "item") -> DataFrame:
    """``df`` with a row for each node that ``path`` reaches from the variant ``page``: lists are iterated, objects entered,
    each page as its own shape says. A field that isn't there or is null gives no rows; null items of the last list are kept."""
    rows = df.withColumn(out, F.col(page))
    for step in path:
        rows = rows.withColumn(out, member(F.col(out), step)).where(F.col(out).isNotNull() & ~F.is_variant_null(out))
        rows = rows.withColumn(out, F.explode(F.coalesce(items_of(F.col(out)), F.array(out))))
    return rows


def tag_map(tags: Column) -> Column:
    """Tags as a map: of a list by any of the usual spellings, of an object as it is; anything else gives none.

    The spelling that is there counts, even if its value is null: a null key is left out, and of equal keys the last wins. In a list
    what isn't an object is passed over.
    """
    pick = lambda x, names: scalar(F.coalesce(*(member(x, n) for n in names)))
    entry = lambda x: F.struct(pick(x, ("Key", "TagKey", "key")).alias("key"), pick(x, ("Value", "TagValue", "value")).alias("value"))
    listed = F.map_from_entries(last_wins(F.transform(F.filter(items_of(tags), lambda x: fields_of(x).isNotNull()), entry)))
    named = F.transform_values(fields_of(tags), lambda _, v: scalar(v))
    return F.coalesce(listed, named, F.create_map().cast(_EMPTY))


def records(df: DataFrame, page: str, shape: Shape, context: dict[str, Column] | None = None, out: str = "item") -> DataFrame:
    """The items of a page with ``meta``: ``df`` without ``page``, the raw item as a variant, and its envelope.

    An item that is no object becomes one with the field ``shape.scalar_as``. Templates know the item's fields, then the page's
    top-level single values as ``root_<field>``, then the context; an item's field that is there but null, or holds a list
    or an object, counts as missing. A tag field that is a list or an object goes from the item into the envelope.
    """
    rows = walk(df, page, shape.path, "__i")
    rows = rows.withColumn("__f", F.coalesce(fields_of(F.col("__i")), F.create_map(F.lit(shape.scalar_as), F.col("__i"))))
    of = lambda name: F.try_element_at("__f", F.lit(name))
    tags = of(shape.tags)
    tagged = F.coalesce(items_of(tags).isNotNull() | fields_of(tags).isNotNull(), F.lit(False))

    def known(name: str) -> Column:
        outer = scalar(member(F.col(page), name[5:])) if name.startswith("root_") else F.lit(None).cast("string")
        outer = F.coalesce(outer, context[name].cast("string")) if context and name in context else outer
        return F.when(of(name).isNotNull(), scalar(of(name))).otherwise(outer)

    used = {n: known(n) for t in (shape.arn, shape.uri) for n in re.findall(r"\{(\w+)\}", t)}
    empty = F.lit("")
    arn = F.coalesce(render(shape.arn, used), empty) if shape.arn else empty
    text = lambda name: or_else(scalar(of(name)), empty) if name else empty
    rows = rows.withColumn("__arn", arn).withColumn("__tags", F.when(tagged, tag_map(tags)).otherwise(F.create_map().cast(_EMPTY)))
    meta = F.struct(
        F.lit(shape.type).alias("type"), or_else(text(shape.id), id_from_arn(F.col("__arn")), empty).alias("id"), or_else(text(shape.name), F.try_element_at("__tags", F.lit("Name")), empty).alias("name"),
        F.col("__arn").alias("arn"), F.col("__tags").alias("tags"), (F.nullif(render(shape.uri, used), empty) if shape.uri else F.lit(None).cast("string")).alias("uri"), F.lit(None).cast(STAMP).alias("stamp"),
    ).cast(META)
    raw = F.to_variant_object(F.map_filter("__f", lambda k, _: ~((k == shape.tags) & tagged)))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns if c not in (page, out, "meta")), raw.alias(out), meta.alias("meta"))


def normalize(df: DataFrame, page: str, shapes: list[Shape], context: dict[str, Column] | None = None) -> DataFrame:
    """The records of all shapes of the pages, one after the other."""
    made = [records(df, page, s, context) for s in shapes]
    out = made[0]
    for m in made[1:]:
        out = out.union(m)
    return out
