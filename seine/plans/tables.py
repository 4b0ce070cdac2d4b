"""The pipeline's tables made from the test tables, as DataFrames and as the same SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "2024-01-01 00:00:00"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder in ``spark.checkpoint.dir``; without it a temporary folder serves, in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="seine-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    label = F.when((F.col("event_type") == "purchase") & (k % 3 != 0), 1).when((F.col("event_type") == "error") & (k % 5 < 3), 0)
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("d"), F.col("user_id"), F.lit(".example.com")).alias("domain"),
        F.concat(F.lit("https://api"), k % 23, F.lit(".example.com/v1/"), "event_type", F.lit("/jobs?page="), k).alias("url"),
        F.floor(F.col("value") * 100).cast("int").alias("response_size"), label.alias("label"), F.col("ts").alias("captured_at"), "event_type", "props", "value",
    )


CAPTURES = """captures AS (
  SELECT event_id AS id, 'd' || user_id || '.example.com' AS domain,
    'https://api' || (CAST(json_extract_string(props, '$.k') AS INT) % 23) || '.example.com/v1/' || event_type || '/jobs?page=' || CAST(json_extract_string(props, '$.k') AS INT) AS url,
    CAST(floor(value * 100) AS INT) AS response_size,
    CASE WHEN event_type = 'purchase' AND CAST(json_extract_string(props, '$.k') AS INT) % 3 <> 0 THEN 1
         WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INT) % 5 < 3 THEN 0 END AS label,
    ts AS captured_at, event_type, props, value
  FROM events)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))), F.lit(".example.com")).alias("domain"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("created_at"))


COMPANIES = """companies AS (
  SELECT c_custkey AS id, lower(replace(c_name, '#', '-')) || '.example.com' AS domain, c_name AS name, c_acctbal AS created_at FROM customer)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last large order as a discovery record; a third of the customers have none."""
    o = read(spark, sf_dir, "orders").where("o_totalprice > 450000").groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"), F.struct("o_orderdate", "o_orderkey")).alias("o"))
    c = companies(spark, sf_dir).select(F.col("id").alias("o_custkey"), "domain")
    status = F.when(F.col("o.o_orderstatus") == "F", "discovered").when(F.col("o.o_orderstatus") == "O", "pending").otherwise("failed")
    part = (F.col("o.o_orderkey") % 5).cast("string")
    return o.join(c, "o_custkey").select(
        "domain", F.when(F.col("o.o_orderkey") % 4 > 0, F.concat(F.lit("https://api"), part, F.when(F.col("o.o_orderkey") % 7 == 0, ".cookielaw.org/jobs").otherwise(".example.com/jobs"))).alias("api_url"), F.concat(F.lit("tier"), F.col("o.o_orderkey") % 3).alias("tier_used"), status.alias("status"),
        F.round(F.col("o.o_totalprice") / 600000.0, 6).alias("confidence"), F.when(F.col("o.o_orderkey") % 6 > 0, F.col("o.o_orderdate")).alias("next_replay"), (F.col("o.o_orderkey") % 4).cast("int").alias("consecutive_failures"), F.lit(None).cast("string").alias("last_error"),
    )


RECORDS = (
    COMPANIES
    + """,
latest AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders WHERE o_totalprice > 450000),
records AS (
  SELECT domain, CASE WHEN o_orderkey % 4 > 0 THEN 'https://api' || (o_orderkey % 5) || CASE WHEN o_orderkey % 7 = 0 THEN '.cookielaw.org/jobs' ELSE '.example.com/jobs' END END AS api_url,
    'tier' || (o_orderkey % 3) AS tier_used, CASE o_orderstatus WHEN 'F' THEN 'discovered' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
    round(o_totalprice / 600000.0, 6) AS confidence, CASE WHEN o_orderkey % 6 > 0 THEN o_orderdate END AS next_replay, CAST(o_orderkey % 4 AS INT) AS consecutive_failures, CAST(NULL AS VARCHAR) AS last_error
  FROM latest JOIN companies ON o_custkey = id WHERE n = 1)"""
)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("ordinal"), "url", "html")


PAGES = "page_list AS (SELECT page_id AS ordinal, url, html FROM pages)"


def fetch_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"), F.col("l_shipdate").alias("fetched_at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), (F.col("l_returnflag") != "R").alias("success"), F.col("l_quantity").alias("duration"), F.col("l_linenumber").cast("long").alias("jobs_found"))


LOGS = """logs AS (
  SELECT l_suppkey AS source_id, l_shipdate AS fetched_at, l_orderkey * 10 + l_linenumber AS seq, l_returnflag <> 'R' AS success, l_quantity AS duration, CAST(l_linenumber AS BIGINT) AS jobs_found FROM lineitem)"""


def near_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures(spark, sf_dir).where("event_type in ('view', 'error')").select("id", "domain", "url", "label", F.round(F.col("value") / 1000.0, 6).alias("confidence"))


NEAR = CAPTURES + ",\nnear AS (SELECT id, domain, url, label, round(value / 1000.0, 6) AS confidence FROM captures WHERE event_type IN ('view', 'error'))"


def bodies(spark: SparkSession, sf_dir: str, platform: str = "greenhouse") -> DataFrame:
    """An API body for each order: its line items as jobs."""
    items = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type"), "l_partkey")
    job = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("p_name").alias("title"), F.struct(F.concat(F.lit("site "), "l_suppkey").alias("name")).alias("location"), F.array(F.struct(F.col("p_type").alias("name"))).alias("departments"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("first_published"), F.col("l_suppkey").alias("branch_id"), F.concat(F.lit("https://x.example/"), "l_partkey").alias("absolute_url"))
    branches = F.array_distinct(F.collect_list(F.struct(F.col("l_suppkey").alias("id"), F.concat(F.lit("city "), F.col("l_suppkey") % 7).alias("city"), F.lit("XX").alias("country_code"), F.concat(F.lit("place "), "l_suppkey").alias("location"))))
    docs = items.groupBy("l_orderkey").agg(F.to_json(F.struct(F.sort_array(F.collect_list(job)).alias("jobs"), F.filter(branches, lambda b: b["id"] % 2 == 0).alias("branches"))).alias("body"))
    return docs.select(F.col("l_orderkey").alias("source_id"), F.lit(platform).alias("platform"), "body")


ITEMS = """items AS (
  SELECT l_orderkey AS source_id, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS external_id, p_name AS title, p_type, l_suppkey, l_partkey, l_shipdate FROM lineitem JOIN part ON l_partkey = p_partkey)"""
