"""From response pages to records with one metadata envelope ``meta``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.expr import id_from_arn, is_list, or_else, render, render_or_empty, tags_to_map, url_segment

STAMP = "struct<profile:string,region:string,account:string,params:map<string,string>>"
META = f"struct<type:string,id:string,name:string,arn:string,tags:map<string,string>,uri:string,stamp:{STAMP}>"


@dataclass(frozen=True)
class Shape:
    """How a page's items become records: where they are, and which fields or templates give their identity.

    ``path``: field names from the page to the items. ``id``, ``name``, ``tags``: field names. ``arn``, ``uri``:
    templates over the item's fields, the context and ``root_<field>``. ``scalar_as``: name of scalar items.
    """

    type: str
    path: tuple[str, ...] = ()
    id: str = ""
    name: str = ""
    arn: str = ""
    uri: str = ""
    tags: str = "Tags"
    scalar_as: str = "Value"


def explode_path(df: DataFrame, path: tuple[str, ...], scalar_as: str = "Value", carry: dict[str, Column] | None = None) -> DataFrame:
    """Items at ``path`` of each page: lists are iterated, structures entered; a missing field gives no rows.

    The page's top-level scalars come along as ``root_<field>``, ``carry`` under its own names.
    """
    roots = {f"root_{f.name}": F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))}
    along = roots | (carry or {})
    whole = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__item"), *(c.alias(n) for n, c in along.items()))
    for step in path:
        kind = whole.schema["__item"].dataType
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return whole.where(F.lit(False)).select(*along)
        whole = whole.withColumn("__item", F.col("__item").getField(step))
        if isinstance(kind[step].dataType, T.ArrayType):
            whole = whole.withColumn("__item", F.explode("__item"))
    whole = whole.where(F.col("__item").isNotNull())
    if isinstance(kind := whole.schema["__item"].dataType, T.StructType):
        return whole.select(*(F.col("__item").getField(n).alias(n) for n in kind.names), *along)
    return whole.select(F.col("__item").alias(scalar_as), *along)


def with_envelope(df: DataFrame, shape: Shape, context: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with ``meta`` last: raw columns stay, but ``root_`` columns and a consumed tag column go.

    A field that is null or absent counts as missing: an ARN template with a missing part is empty, a URI then
    null. The id falls back on the ARN's last segment, the name on the tag Name; both else are empty.
    """
    simple = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))]
    known = {n: F.col(f"`{n}`") for n in simple} | (context or {})
    empty = F.lit("")
    arn = render_or_empty(shape.arn, known) if shape.arn else empty
    id_ = or_else(known[shape.id].cast("string"), empty) if shape.id in known else empty
    tagged = shape.tags in df.columns and isinstance(df.schema[shape.tags].dataType, (T.ArrayType, T.MapType))
    tags = tags_to_map(F.col(shape.tags), df.schema[shape.tags].dataType) if tagged else F.create_map().cast("map<string,string>")
    name = or_else(known[shape.name].cast("string"), empty) if shape.name in known else empty
    meta = F.struct(
        F.lit(shape.type).alias("type"), or_else(id_, id_from_arn(arn), empty).alias("id"), or_else(name, F.try_element_at(tags, F.lit("Name")), empty).alias("name"),
        arn.alias("arn"), tags.alias("tags"), (F.nullif(render(shape.uri, known), empty) if shape.uri else F.lit(None).cast("string")).alias("uri"), F.lit(None).cast(STAMP).alias("stamp"),
    )
    raw = [c for c in df.columns if not c.startswith("root_") and not (tagged and c == shape.tags)]
    return df.withColumn("__meta", meta).select(*(F.col(f"`{c}`") for c in raw if c != "meta"), F.col("__meta").alias("meta"))


def normalize(page: DataFrame, shapes: list[Shape], context: dict[str, Column] | None = None) -> DataFrame:
    """The records of all shapes of a page, by name; each page is read once for each shape."""
    made = [with_envelope(explode_path(page, s.path, s.scalar_as, context), s, {n: F.col(n) for n in context or {}}) for s in shapes]
    made = [m.select(*(c for c in m.columns if c not in (context or {}))) for m in made]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m, allowMissingColumns=True)
    return out.select(*(c for c in out.columns if c != "meta"), "meta")


def unwrap_default(page: DataFrame) -> DataFrame:
    """With exactly one top-level list its items, else the page itself (typed pages)."""
    lists = [f.name for f in page.schema if isinstance(f.dataType, T.ArrayType)]
    if len(lists) != 1:
        return page
    items = explode_path(page, (lists[0],))
    return items.select(*(c for c in items.columns if not c.startswith("root_")))


def unwrap_variant(df: DataFrame, page: str, key: str) -> DataFrame:
    """Ragged pages as variants, each judged by itself: rows (key, item) of its one list, else the page."""
    lists = F.filter(F.map_entries(F.col(page).cast("map<string,variant>")), lambda e: is_list(e["value"]))
    found = df.select(key, page, lists.alias("__lists"))
    many = found.where(F.size("__lists") == 1).select(key, F.explode(F.get("__lists", F.lit(0))["value"].cast("array<variant>")).alias("item"))
    return many.union(found.where(F.size("__lists") != 1).select(key, F.col(page).alias("item")))


def page_items(page: Column) -> Column:
    """Items in all top-level lists of a page given as a variant; null if it has none."""
    lists = F.filter(F.map_values(page.cast("map<string,variant>")), is_list)
    total = F.aggregate(lists, F.lit(0), lambda n, v: n + F.size(v.cast("array<variant>")))
    return F.when(F.size(lists) > 0, total)


def explode_with_parent(df: DataFrame, parents: list[str], child: str, parent_as: str) -> DataFrame:
    """Each item of ``child`` with the parent's columns in a structure of their own."""
    return df.select(F.explode(child).alias("__c"), F.struct(*parents).alias("__p")).select("__c.*", F.col("__p").alias(parent_as))


def explode_map(df: DataFrame, column: str, key_as: str = "key", value_as: str = "value") -> DataFrame:
    """A row for each key of a map column, or of JSON text that holds an object."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = F.from_json(c, "map<string,string>")
    return df.select(*(x for x in df.columns if x != column), F.explode(c).alias(key_as, value_as))


def strip_metadata(df: DataFrame, field_name: str = "ResponseMetadata", inside: str | None = None) -> DataFrame:
    """Without a page's transport metadata, at the top or in the structure ``inside``."""
    return df.withColumn(inside, F.col(inside).dropFields(field_name)) if inside else df.drop(field_name)


def from_url(df: DataFrame, column: str) -> DataFrame:
    """Name and owner from the last two segments of a URL."""
    return df.withColumns({"name": url_segment(F.col(column)), "owner": url_segment(F.col(column), 2)})


def stamp_session(df: DataFrame, profile: Column, region: Column, account: Column, on: bool = True) -> DataFrame:
    """The session under ``meta.stamp``. A record without ``meta`` gets one; stamped params stay."""
    if not on:
        return df
    blank = F.lit(None).cast(META)
    meta = F.col("meta").cast(META) if "meta" in df.columns else blank
    meta = F.coalesce(meta, F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(META))))
    stamp = F.struct(profile.cast("string").alias("profile"), region.cast("string").alias("region"), account.cast("string").alias("account"), meta["stamp"]["params"].alias("params"))
    return df.withColumn("meta", meta.withField("stamp", stamp))


def stamp_params(df: DataFrame, params: dict[str, Column]) -> DataFrame:
    """Request parameters under ``meta.stamp.params``; those that are stamped already win, nulls are left out."""
    have = F.coalesce(F.col("meta.stamp.params"), F.create_map().cast("map<string,string>"))
    fresh = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in params.items())), lambda e: e["value"].isNotNull() & ~F.array_contains(F.map_keys(have), e["key"]))
    stamp = F.coalesce(F.col("meta.stamp"), F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(STAMP))))
    return df.withColumn("meta", F.col("meta").withField("stamp", stamp.withField("params", F.map_concat(have, F.map_from_entries(fresh)))))


def route_session(df: DataFrame) -> DataFrame:
    """Session columns for a piped record: its own fields win over the stamp, if it has one; empty is null; ``meta`` goes."""
    meta = df.schema["meta"].dataType if "meta" in df.columns else None
    stamp = meta["stamp"].dataType if isinstance(meta, T.StructType) and "stamp" in meta.names else None
    stamped = stamp.names if isinstance(stamp, T.StructType) else []
    ways = lambda c: [*([F.col(c)] if c in df.columns else []), *([F.col(f"meta.stamp.{c}")] if c in stamped else [])]
    own = lambda c: F.coalesce(*(F.nullif(x.cast("string"), F.lit("")) for x in ways(c)), F.lit(None).cast("string"))
    return df.withColumns({"profile": own("profile"), "region": own("region")}).drop("meta")


def shape_parameters(df: DataFrame) -> DataFrame:
    """Parameters (Name, Value, Type, Version) as records."""
    meta = F.struct(F.lit("parameter").alias("type"), F.col("Name").alias("id"), F.col("Name").alias("name"), F.lit("").alias("arn"), F.create_map().cast("map<string,string>").alias("tags"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast(STAMP).alias("stamp"))
    return df.select("Name", "Value", "Type", "Version", meta.alias("meta"))


@dataclass
class Registry:
    """How pages of an operation are shaped: a program of the user's, else declared shapes, else the default."""

    programs: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    shapes: dict[str, list[Shape]] = field(default_factory=dict)

    def shape(self, operation: str, page: DataFrame, context: dict[str, Column] | None = None) -> DataFrame:
        if operation in self.programs:
            return self.programs[operation](page)
        return normalize(page, self.shapes[operation], context) if operation in self.shapes else unwrap_default(page)
