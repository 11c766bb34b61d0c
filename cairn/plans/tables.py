"""The given tables, and views that give them the shapes of inventories, keyspaces and logs."""

from __future__ import annotations

from collections.abc import Callable
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Views that read alike in Spark's and DuckDB's SQL; a table is written as {name}.
VIEWS = {
    "LOG": """SELECT ts AS Ts, event_type AS Service, concat('Op', CAST(user_id % 7 AS STRING)) AS Operation, concat('p', CAST(user_id % 5 AS STRING)) AS Profile,
        concat('r', CAST(user_id % 3 AS STRING)) AS Region, CAST(value AS DECIMAL(12, 2)) AS DurationS, CASE WHEN event_type = 'error' THEN NULL ELSE 200 END AS HttpStatus,
        CASE WHEN event_id % 4 = 0 THEN 3 ELSE 1 END AS Attempts, event_id % 50 AS Items, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS Outcome,
        CASE WHEN event_type = 'error' AND event_id % 6 > 0 THEN concat('E', CAST(event_id % 6 AS STRING)) END AS ErrorCode,
        CASE WHEN event_type = 'error' THEN concat('call failed: ', props) END AS Message, event_id FROM {events}""",
    "OBJ": """SELECT concat('b-', event_type) AS Bucket, concat(replace(CAST(CAST(ts AS DATE) AS STRING), '-', '/'), '/', md5(CAST(event_id AS STRING))) AS Key,
        event_id % 5000 AS Size, ts AS LastModified, event_id FROM {events}""",
    "VER": """SELECT 'vb' AS Bucket, concat('u/', CAST(user_id AS STRING)) AS Key, event_id AS VersionId,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS IsLatest,
        CASE WHEN event_type = 'error' THEN 'delete-marker' ELSE 'object-version' END AS kind, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 5000 END AS Size FROM {events}""",
    "RES": """SELECT c_custkey AS Id, c_name AS Name, c_mktsegment AS Segment, n_nationkey AS account, r_name AS region, c_acctbal AS Balance
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "PAR": """SELECT concat('/', replace(p_brand, '#', ''), '/', lower(p_type), '/', CAST(p_partkey AS STRING)) AS Name, p_name AS Value,
        CASE p_size % 3 WHEN 0 THEN 'SecureString' WHEN 1 THEN 'StringList' ELSE 'String' END AS Type, p_size AS Version, p_partkey FROM {part}""",
    "SESS": """SELECT s_name AS profile, s_suppkey AS pos, CASE WHEN s_nationkey = 0 THEN '' ELSE CAST(s_nationkey AS STRING) END AS account FROM {supplier}""",
    "MODEL": """SELECT DISTINCT concat('svc', CAST(user_id AS STRING)) AS service, concat('Op', CAST(event_id % 97 AS STRING)) AS operation,
        CASE WHEN event_id % 3 = 0 THEN 'input' ELSE 'output' END AS direction,
        CASE event_id % 10 WHEN 0 THEN 'Type' WHEN 1 THEN 'type' WHEN 2 THEN 'Id' WHEN 3 THEN 'ID' WHEN 4 THEN 'Name' WHEN 5 THEN 'name' WHEN 6 THEN 'Arn' WHEN 7 THEN 'ARN' WHEN 8 THEN 'Tags' ELSE 'Other' END AS member FROM {events}""",
    "ITEM": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_returnflag = 'R' THEN '0.0.0.0/0' ELSE '10.0.0.0/8' END AS Cidr FROM {lineitem}""",
    "KEYS": "SELECT o_custkey AS key, max(o_orderdate) AS last_used FROM {orders} WHERE o_totalprice > 150000 GROUP BY o_custkey",
}
NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")


class Tables:
    """Tables of one folder, by name; views by theirs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.view(name) if name in VIEWS else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        used = {n: self(n) for n in NAMES if f"{{{n}}}" in VIEWS[name]}
        return self.spark.sql(VIEWS[name], **used)

    def groups(self) -> DataFrame:
        """Security groups, one an order: its lines as permissions with one range each."""
        perm = F.struct(F.col("l_linenumber").alias("line"), F.array(F.struct("Cidr")).alias("Ranges"))
        return self("ITEM").groupBy(F.col("l_orderkey").alias("group")).agg(F.sort_array(F.collect_list(perm)).alias("Perms"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str = ""):
    """Register a function of Tables under its name, with DuckDB SQL in which $VIEW stands for a view."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            views = {k: "(" + v + ")" for k, v in VIEWS.items()}
            for n in NAMES:
                views = {k: v.replace(f"{{{n}}}", n) for k, v in views.items()}
            ORACLE[f.__name__] = Template(sql).substitute(views)
        return f

    return register
