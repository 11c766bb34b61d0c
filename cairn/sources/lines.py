"""JSON Lines: tables, directories of tables, call logs, parameter lines and names."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALL_LOG = "Ts timestamp, Service string, Operation string, Profile string, Region string, DurationS decimal(12,2), HttpStatus int, Attempts int, Items int, Outcome string, ErrorCode string, Message string"
AUDIT_LOG = "Ts timestamp, Command string, Service string, Operation string, Profile string, Region string, Cache string, ExitCode int, DurationS decimal(12,2), SavedS decimal(12,2)"


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table of JSON lines: the union of all fields, malformed lines skipped."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def table_name(file: str) -> str:
    return file.rsplit("/", 1)[-1].removesuffix(".jsonl").removesuffix(".json").replace("-", "_")


def schema_of_json(found: str) -> T.StructType:
    """What ``schema_of_variant_agg`` says of objects, as the schema to read them by: numbers with a fraction are doubles, fields that hold
    nothing or unlike things are text."""
    out, at = _kind(found, 0)
    if at != len(found) or not isinstance(out, T.StructType):
        raise ValueError(f"not the schema of objects: {found}")
    return out


def _kind(found: str, at: int) -> tuple[T.DataType, int]:
    if found.startswith("OBJECT<", at):
        fields, at = [], at + len("OBJECT<")
        while found[at] != ">":
            name = re.compile(r"(?s)`((?:[^`]|``)*)`: |(\w+): ").match(found, at)
            kind, at = _kind(found, name.end())
            fields.append(T.StructField(name[2] or (name[1] or "").replace("``", "`"), kind))
            at += 2 if found.startswith(", ", at) else 0
        return T.StructType(fields), at + 1
    if found.startswith("ARRAY<", at):
        kind, at = _kind(found, at + len("ARRAY<"))
        return T.ArrayType(kind), at + 1
    name = re.compile(r"\w+(?:\(\d+,\s*\d+\))?").match(found, at)
    known = {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType()}
    return T.DoubleType() if name[0].startswith("DECIMAL") else known.get(name[0], T.StringType()), name.end()


def load_inventory(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """A temp view for each entry of a directory, a file of JSON lines or a folder of such, and a report (table, status, rows, skipped): loaded,
    empty, or failed if it has lines but no JSON object.

    Entries are listed through the path's own file system. One job reads all their lines and finds each entry's
    schema and counts; a view is then read by its schema, malformed lines skipped.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(where).toString().rstrip("/") + "/"
    entries = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(where) if not f.getPath().getName().startswith(("_", "."))}
    found = {}
    if entries:
        # file paths come percent-encoded
        file = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        below = F.regexp_replace(file, r"\A[a-zA-Z0-9]+:/*", "")  # schemes are written with one slash or three
        name = F.get(F.split(below, "/"), F.lit(re.sub(r"\A[a-zA-Z0-9]+:/*", "", base).count("/")))
        lines = spark.read.option("recursiveFileLookup", "true").text(path).select(name.alias("name"), "value").where(F.trim("value") != "")
        v = F.try_parse_json("value")
        lines = lines.select("name", F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), v).alias("v"))
        kinds = lines.groupBy("name").agg(F.schema_of_variant_agg("v").alias("kind"), F.count("v").alias("rows"), F.count("*").alias("lines"))
        found = {r.name: r for r in kinds.collect()}  # a row an entry
    views, report = {}, []
    for name, at in sorted(entries.items()):
        table, r = table_name(name), found.get(name)
        if r is None or not r.rows:
            report.append((table, "empty" if r is None else "failed", 0, r.lines if r else 0))
            continue
        views[table] = spark.read.schema(schema_of_json(r.kind)).option("mode", "DROPMALFORMED").json(at)
        views[table].createOrReplaceTempView(table)
        report.append((table, "loaded", r.rows, r.lines - r.rows))
    return views, spark.createDataFrame(report, "table string, status string, rows long, skipped long")


def read_call_log(spark: SparkSession, path: str, schema: str = CALL_LOG) -> DataFrame:
    """The whole log; an empty one, with a warning, if there is no file yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        warnings.warn(f"no call log at {path}", stacklevel=2)
        return spark.createDataFrame([], schema)
    return read_jsonl(spark, path, schema)


def split_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON objects as variants (``params``), and all other lines that aren't blank, for quarantine."""
    v = lines.where(F.trim(column) != "").withColumn("params", F.try_parse_json(column))
    good = F.coalesce(F.schema_of_variant("params").startswith("OBJECT<"), F.lit(False))
    return v.where(good), v.where(~good).select(*lines.columns)


def read_params(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return split_lines(spark.read.text(path))


def names_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """Names, one a line: trimmed, blank ones dropped."""
    return lines.select(F.trim(F.regexp_replace(column, r"[\r\t]", " ")).alias("name")).where("name <> ''")


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return names_of(spark.read.text(path))


def with_defaults(params: DataFrame, defaults: dict[str, str | None], required: tuple[str, ...] = ("service", "operation")) -> tuple[DataFrame, DataFrame]:
    """Lines may override the defaults; those that then lack a required value go aside."""
    value = lambda c, d: F.coalesce(*([F.nullif(F.col(c), F.lit(""))] if c in params.columns else []), F.lit(d).cast("string"))
    out = params.withColumns({c: value(c, d) for c, d in defaults.items()})
    lacking: Column = F.lit(False)
    for c in required:
        lacking |= F.col(c).isNull()
    return out.where(~lacking), out.where(lacking)
