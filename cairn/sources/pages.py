"""Listing pages in XML and operation models in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.expr import decode_key

# fixed values: the fields of a listing's XML
LISTING = (
    "Name string, Prefix string, KeyCount int, IsTruncated boolean, NextContinuationToken string, "
    "Contents array<struct<Key:string,LastModified:string,ETag:string,Size:bigint,StorageClass:string>>, CommonPrefixes array<struct<Prefix:string>>"
)
VERSIONS = (
    "Name string, IsTruncated boolean, NextKeyMarker string, NextVersionIdMarker string, "
    "Version array<struct<Key:string,VersionId:string,IsLatest:boolean,LastModified:string,ETag:string,Size:bigint,StorageClass:string>>, "
    "DeleteMarker array<struct<Key:string,VersionId:string,IsLatest:boolean,LastModified:string>>, CommonPrefixes array<struct<Prefix:string>>"
)


def _items(field: str, names: tuple[str, ...]):
    """A repeated element, with keys decoded; absent elements are an empty list, absent fields null."""
    return F.coalesce(F.transform(f"__x.{field}", lambda o: F.struct(*((decode_key(o[n]) if n == "Key" else o[n]).alias(n) for n in names))), F.array())


def parse_listing_pages(df: DataFrame, body: str) -> DataFrame:
    """``df`` with ``page``: Contents, CommonPrefixes (decoded), IsTruncated and NextContinuationToken; null for bad XML."""
    x = df.withColumn("__x", F.from_xml(F.col(body), LISTING, {"mode": "PERMISSIVE"}))
    page = F.struct(
        F.col("__x.Name").alias("Name"), _items("Contents", ("Key", "LastModified", "ETag", "Size", "StorageClass")).alias("Contents"),
        F.coalesce(F.transform("__x.CommonPrefixes", lambda p: decode_key(p["Prefix"])), F.array().cast("array<string>")).alias("CommonPrefixes"),
        F.coalesce("__x.IsTruncated", F.lit(False)).alias("IsTruncated"), F.col("__x.NextContinuationToken").alias("NextContinuationToken"),
    )
    return x.withColumn("page", F.when(F.col("__x.Name").isNotNull(), page)).drop("__x")


def parse_version_pages(df: DataFrame, body: str) -> DataFrame:
    """``df`` with ``page``: Version, DeleteMarker, CommonPrefixes and the markers of the next page."""
    x = df.withColumn("__x", F.from_xml(F.col(body), VERSIONS, {"mode": "PERMISSIVE"}))
    page = F.struct(
        F.col("__x.Name").alias("Name"), _items("Version", ("Key", "VersionId", "IsLatest", "LastModified", "ETag", "Size", "StorageClass")).alias("Version"),
        _items("DeleteMarker", ("Key", "VersionId", "IsLatest", "LastModified")).alias("DeleteMarker"),
        F.coalesce(F.transform("__x.CommonPrefixes", lambda p: decode_key(p["Prefix"])), F.array().cast("array<string>")).alias("CommonPrefixes"),
        F.coalesce("__x.IsTruncated", F.lit(False)).alias("IsTruncated"), decode_key(F.col("__x.NextKeyMarker")).alias("NextKeyMarker"), F.col("__x.NextVersionIdMarker").alias("NextVersionIdMarker"),
    )
    return x.withColumn("page", F.when(F.col("__x.Name").isNotNull(), page)).drop("__x")


MODEL = "service string, operations map<string,struct<input:string,output:string>>, shapes map<string,struct<type:string,required:array<string>,members:map<string,struct<shape:string>>>>"


def read_models(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Operations (service, operation) and members (service, operation, direction, member, type, required) of model
    files, a JSON object each; a member's type is that of the shape it refers to."""
    models = spark.read.schema(MODEL).json(path, multiLine=True)
    ops = models.select("service", "shapes", F.explode("operations").alias("operation", "op"))
    sides = ops.select("service", "operation", "shapes", F.explode(F.array(F.struct(F.lit("input").alias("direction"), F.col("op.input").alias("shape")), F.struct(F.lit("output").alias("direction"), F.col("op.output").alias("shape")))).alias("s"))
    shape = F.try_element_at("shapes", F.col("s.shape"))
    members = sides.withColumn("shape", shape).select("service", "operation", "s.direction", "shapes", F.col("shape.required").alias("__r"), F.explode("shape.members").alias("member", "m"))
    return ops.select("service", "operation"), members.select("service", "operation", "direction", "member", F.try_element_at("shapes", F.col("m.shape"))["type"].alias("type"), F.coalesce(F.array_contains("__r", F.col("member")), F.lit(False)).alias("required"))
