"""Sealed field values: text encrypted in place by AES, told by a prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "sealed:1:"


def sealed(c: Column, key: Column) -> Column:
    return F.when(c.startswith(PREFIX), c).otherwise(F.concat(F.lit(PREFIX), F.replace(F.replace(F.base64(F.aes_encrypt(c.cast("binary"), key)), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))))


def opened(c: Column, key: Column) -> Column:
    """The text; unsealed text as it is; null where the key doesn't fit."""
    raw = F.try_aes_decrypt(F.unbase64(F.substring(c, F.lit(len(PREFIX) + 1), F.length(c))), key)
    return F.when(c.startswith(PREFIX), raw.cast("string")).otherwise(c)


def seal(df: DataFrame, column: str, key: str | bytes, where: Column | None = None) -> DataFrame:
    """``column`` sealed where the condition holds; sealed values and nulls stay. A key of 16, 24 or 32 bytes is needed."""
    k = key_column(key)
    value = sealed(F.col(column), k)
    return df.withColumn(column, value if where is None else F.when(where, value).otherwise(F.col(column)))


def unseal(df: DataFrame, column: str, key: str | bytes) -> tuple[DataFrame, DataFrame]:
    """The rows with ``column`` opened, and the rows, as they were, that the key doesn't open."""
    k = key_column(key)
    bad = F.col(column).startswith(PREFIX) & opened(F.col(column), k).isNull()
    bad = F.coalesce(bad, F.lit(False))
    return df.where(~bad).withColumn(column, opened(F.col(column), k)), df.where(bad)


def unseal_all(df: DataFrame, key: str | bytes) -> DataFrame:
    """All text, however nested, opened; what the key doesn't open is null."""
    k = key_column(key)
    return df.select(*(_walk(F.col(f"`{f.name}`"), f.dataType, k).alias(f.name) for f in df.schema))


def _walk(c: Column, kind: T.DataType, key: Column) -> Column:
    match kind:
        case T.StringType():
            return opened(c, key)
        case T.ArrayType():
            return F.transform(c, lambda x: _walk(x, kind.elementType, key))
        case T.MapType():
            return F.transform_values(c, lambda _, v: _walk(v, kind.valueType, key))
        case T.StructType():
            return F.when(c.isNotNull(), F.struct(*(_walk(c.getField(f.name), f.dataType, key).alias(f.name) for f in kind)))
        case _:
            return c


def key_column(key: str | bytes) -> Column:
    raw = key.encode() if isinstance(key, str) else key
    if len(raw) not in (16, 24, 32):
        raise ValueError("sealing needs a key of 16, 24 or 32 bytes")
    return F.lit(raw)
