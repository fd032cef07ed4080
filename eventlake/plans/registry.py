"""Registry of queries, their SQL, and the test view of event records that both derive from the tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query by name, with DuckDB SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = (EV_SQL + sql) if " ev" in sql or "(ev" in sql else sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows over all cores, for costly functions of rows from a small file, which is one partition otherwise."""
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: DuckDB form of ev().
EV_SQL = """WITH ev AS (
SELECT o_orderkey AS event_id,
  concat('https://', CASE WHEN n_nationkey % 3 = 0 THEN 'www.' ELSE '' END, 'src', CAST(n_nationkey % 5 AS STRING), '.example.org/e/', CAST(o_orderkey AS STRING)) AS url,
  concat(c_mktsegment, ' ', o_orderpriority) AS name, o_orderdate AS start_ts,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + (o_orderkey % 3) * INTERVAL '1' DAY END AS end_ts,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0.0 ELSE 12.965 + ((o_orderkey % 200) - 100) / 200.0 END AS DOUBLE) AS lat,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0.0 ELSE 77.588 + ((o_custkey % 200) - 100) / 200.0 END AS DOUBLE) AS lng,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE [upper(c_mktsegment), o_orderpriority] END AS keywords,
  c_name AS organizer, n_name AS location_name, 'Event' AS type
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records derived from orders, customers and nations, one per order."""
    joined = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")).join(read(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    return joined.selectExpr(
        "o_orderkey AS event_id",
        "concat('https://', CASE WHEN n_nationkey % 3 = 0 THEN 'www.' ELSE '' END, 'src', CAST(n_nationkey % 5 AS STRING), '.example.org/e/', CAST(o_orderkey AS STRING)) AS url",
        "concat(c_mktsegment, ' ', o_orderpriority) AS name",
        "o_orderdate AS start_ts",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + make_dt_interval(CAST(o_orderkey % 3 AS INT)) END AS end_ts",
        "CASE WHEN o_orderkey % 11 = 0 THEN 0D ELSE CAST(12.965 + ((o_orderkey % 200) - 100) / 200.0 AS DOUBLE) END AS lat",
        "CASE WHEN o_orderkey % 11 = 0 THEN 0D ELSE CAST(77.588 + ((o_custkey % 200) - 100) / 200.0 AS DOUBLE) END AS lng",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE array(upper(c_mktsegment), o_orderpriority) END AS keywords",
        "c_name AS organizer", "n_name AS location_name", "'Event' AS type",
    )


def scratch(spark: SparkSession) -> str:
    """A new path for files that a query writes and reads again, in the folder that driver and executors share.

    Only a local session may go without spark.checkpoint.dir: elsewhere a folder of one machine would lose the files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-eventlake-')}"
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"
