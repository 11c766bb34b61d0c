"""URL rules by sort-merge range joins: canonical keys make a rule's prefix an interval, a sorted sweep finds the
innermost open one."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import partitions

LAST = b"\xff"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"(?s)\A[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot: a domain's key is a prefix of its subdomains' keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def sweep(rows: DataFrame, intervals: DataFrame, group: str, key: str, value: str, salts: int) -> DataFrame:
    """``rows`` with ``value``, that of the innermost interval of their group that their key is in, else null.

    ``intervals`` (group, lo, value, outer): all keys that begin with the bytes ``lo``, so they nest or are apart;
    ``outer`` is the value of the next one around, else null. Marks at both ends of each interval and the rows are
    sorted together by key; the value at the latest mark is the top of the stack of open intervals. A group's rows
    are dealt to ``salts`` tasks, each of which gets the group's marks.
    """
    names = [c for c in rows.columns if c != value]
    kind = intervals.schema[value].dataType
    dealt = rows.select(*names, F.pmod(F.xxhash64(*names), F.lit(salts)).alias("__salt"), F.col(key).cast("binary").alias("__at"), F.lit(1).alias("__row"), F.lit(None).cast("boolean").alias("__mark"), F.lit(None).cast(kind).alias("__value"))
    ends = F.explode(F.array(F.struct(F.col("lo").alias("at"), F.col(value).alias("v")), F.struct(F.concat("lo", F.lit(LAST)).alias("at"), F.col("outer").alias("v"))))
    marks = intervals.select(F.col(group), ends.alias("__e")).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) if c != group else F.col(group) for c in names]
    marks = marks.select(*nothing, "__salt", F.col("__e.at").alias("__at"), F.lit(0).alias("__row"), F.lit(True).alias("__mark"), F.col("__e.v").alias("__value"))
    w = Window.partitionBy(group, "__salt").orderBy("__at", "__row").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("__mark"), F.struct(F.col("__value").alias("v"))), ignorenulls=True).over(w)
    return dealt.union(marks).withColumn("__top", top).where("__row = 1").select(*names, F.col("__top.v").alias(value))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict)``, one for each row of ``pages``, repeated and null ids included.

    ``rules`` (host, path, verdict): a rule fits its host and all subdomains if the page's path begins with the
    rule's. The longest fitting rule (host and path together; of equal ones that of the longer host) gives the
    verdict; ``rule`` is its host and path. Without one, ``rule`` is null and the verdict ``default``. A null url or
    one without ``://`` has an empty host and path. Rules with a null part are left out; of rules with one host and
    path the least verdict counts. Rules may be many: they are sorted and joined like the pages, never broadcast by
    this code, and only the number of nested rule hosts (a few labels) comes to the driver.
    """
    spark = pages.sparkSession
    salts = salts or max(1, partitions(spark))
    rules = rules.where("host is not null and path is not null and verdict is not null").groupBy(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.withColumn("hk", host_key(F.col("host")))
    # rule hosts, each with the chain of rule hosts around it, outermost first
    hosts = rules.select("hk").distinct()
    labels = F.split(F.expr("left(hk, length(hk) - 1)"), r"\.", -1)
    around = hosts.select("hk", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))).alias("outer_hk"))
    chains = around.join(hosts.select(F.col("hk").alias("outer_hk")), "outer_hk").groupBy("hk").agg(F.sort_array(F.collect_list("outer_hk")).alias("chain"))
    depth = chains.agg(F.max(F.size("chain"))).first()[0] or 0
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not depth:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    top = F.split_part(F.col("hk"), F.lit("."), F.lit(1))
    outer = F.when(F.size("chain") > 1, F.slice("chain", 1, F.size("chain") - 1))
    spans = chains.select(top.alias("tld"), F.col("hk").cast("binary").alias("lo"), "chain", outer.alias("outer"))
    rows = rows.withColumn("hk", host_key(F.col("host"))).withColumn("tld", F.split_part(F.col("hk"), F.lit("."), F.lit(1)))
    rows = sweep(rows, spans, "tld", "hk", "chain", salts).drop("hk", "tld")
    # the rules of each host as nested intervals of paths, each with the rule of the next shorter path around it
    value = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict")
    rules = rules.select("hk", "path", value.alias("best"))
    shorter = rules.select("hk", F.col("path").alias("inner"), F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda i: F.col("path").substr(F.lit(1), i))).alias("path")).where("path <> inner")
    next_out = shorter.join(rules, ["hk", "path"]).groupBy("hk", F.col("inner").alias("path")).agg(F.max("best").alias("outer"))
    paths = rules.join(next_out, ["hk", "path"], "left").select("hk", F.col("path").cast("binary").alias("lo"), "best", "outer")
    found = []
    for i in range(depth):
        rows = rows.withColumn("hk", F.get("chain", F.lit(i)))
        rows = sweep(rows, paths, "hk", "path", "best", salts).drop("hk").withColumnRenamed("best", f"best{i}")
        found.append(F.col(f"best{i}"))
    best = F.greatest(*found) if depth > 1 else found[0]
    return rows.select("page_id", "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))
