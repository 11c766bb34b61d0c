"""Selecting, fitting and capping records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.expr import is_list, is_true


def post(df: DataFrame, where: str | None = None, select: list[str] | None = None, explode: str | None = None, drop: list[str] | None = None) -> DataFrame:
    """A user's program over each record, as SQL expressions: filter, then explode, reshape and drop fields."""
    if where:
        df = df.where(where)
    if explode:
        df = df.withColumn(explode.split(".")[-1], F.explode(F.col(explode)))
    if select:
        df = df.selectExpr(*select)
    for field in drop or []:
        top, _, rest = field.partition(".")
        df = df.withColumn(top, F.col(top).dropFields(rest)) if rest else df.drop(top)
    return df


def fit_to_schema(df: DataFrame, members: list[str]) -> DataFrame:
    """Columns that match a member, whatever their case, under the member's name; others are dropped."""
    own = {c.lower(): c for c in reversed(df.columns)} | {c: c for c in df.columns}
    return df.select(*(F.col(f"`{c}`").alias(m) for m in members if (c := own.get(m) or own.get(m.lower()))))


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as integer, long, float, double, boolean, list, structure, map or untyped (``""``); numbers that can't be
    are null. Lists, structures, maps and untyped text are read as JSON and keep the types of what is in them, see ``coerced``.
    Columns that are lists of text have each item read as JSON."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns({c: F.transform(c, as_json) if c in texts else coerced(F.col(c), kind) for c, kind in types.items()})


def as_json(c: Column) -> Column:
    """Text as a variant: what it holds as JSON, else the text."""
    return F.coalesce(F.try_parse_json(c), c.cast("variant"))


def coerced(c: Column, kind: str) -> Column:
    """A list is an array of variants, and what isn't a JSON list is the one item of one; a structure or map is a variant, of
    the text itself if it isn't JSON; so is untyped text, which is read only if it begins with ``{`` or ``[``."""
    match kind:
        case "integer" | "long":
            return F.trim(c).try_cast("long")
        case "float" | "double":
            return F.trim(c).try_cast("double")
        case "boolean":
            return is_true(F.trim(c))
        case "list":
            return F.when(c.isNotNull(), F.when(is_list(as_json(c)), F.try_variant_get(as_json(c), "$", "array<variant>")).otherwise(F.array(as_json(c))))
        case "structure" | "map":
            return as_json(c)
        case "":
            return F.when(F.substring(c, 1, 1).isin("{", "["), as_json(c)).otherwise(c.cast("variant"))
        case _:
            return c


def under_path(df: DataFrame, column: str, path: str, recursive: bool = True) -> DataFrame:
    """Names below ``path``; without ``recursive`` its direct children only."""
    base = path.rstrip("/") + "/"
    below = F.col(column).startswith(base)
    return df.where(below if recursive else below & (F.instr(F.expr(f"substring({column}, {len(base) + 1})"), "/") == 0))


def own_only(df: DataFrame, owner: str, own: list[str] | DataFrame) -> DataFrame:
    """Rows of the given owners: a list, or a table of them with a column of that name."""
    return df.where(F.col(owner).isin(own)) if isinstance(own, list) else df.join(own.select(owner).distinct(), owner, "left_semi")


def in_window(df: DataFrame, ts: str, low, high) -> DataFrame:
    """Rows from ``low`` to ``high``, both included; a plain comparison, so it reaches the scan."""
    return df.where(F.col(ts).between(F.lit(low), F.lit(high)))


def cap_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows of each key. ``order`` should be total."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def cap(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def in_slice(df: DataFrame, key: str, prefix: str = "", start: str = "", end: str = "") -> DataFrame:
    """Keys with the prefix, after ``start`` and up to ``end``; an empty ``end`` is no bound."""
    k = F.col(key)
    test = k > start
    if end:
        test &= k <= end
    return df.where(test & k.startswith(prefix) if prefix else test)


def struct_paths(schema: T.StructType) -> list[str]:
    """All top-level lists of a page's schema."""
    return [f.name for f in schema if isinstance(f.dataType, T.ArrayType)]
