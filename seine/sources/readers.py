"""Files and topics as DataFrames with declared schemas. Network requests are not made: what they landed is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.urllists import pattern_limit

CAPTURES = "timestamp timestamp, domain string, url string, method string, request_headers map<string,string>, response_status int, response_headers map<string,string>, response_body_preview string, classifier_score double, body_score double, was_hit boolean"
LABELLED = "url string, method string, headers map<string,string>, body string, label int"
URL_MESSAGES = "domain string, raw_url string, company_id string, queued_at timestamp"
RAW_JOBS = "domain string, company_id string, raw_json string, captured_at timestamp"
KERNEL_EVENTS = "pid int, tid int, timestamp_ns long, data_len int, is_write boolean, data binary"


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Capture log, one JSON object a line; empty and malformed lines are left out."""
    return spark.read.schema(CAPTURES).option("mode", "DROPMALFORMED").json(path)


def url_array(spark: SparkSession, path: str) -> DataFrame:
    """A file that is one JSON array of strings: ``ordinal`` and ``url``."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("ordinal", "url"))


def object_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def companies_csv(spark: SparkSession, path: str) -> DataFrame:
    """Columns by header name, letter case and blanks aside; ragged rows are padded; rows without a domain are left out."""
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').csv(path)
    rows = rows.toDF(*(c.strip().lower() for c in rows.columns))
    return rows.where(F.trim("domain") != "")


def ranked_domains(spark: SparkSession, path: str) -> DataFrame:
    """A headed list by position: the third column is the domain, the fourth its ending; public bodies are left out."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*(f"_c{k}" for k in range(len(rows.columns))))
    return rows.select(F.col("_c2").alias("domain"), F.trim("_c3").alias("tld")).where(~F.col("tld").rlike("(gov|edu|mil)$"))


def board_list(spark: SparkSession, path: str, seeds: list[tuple[str, str]] | None = None) -> DataFrame:
    """``company|board`` lines and literal rows, boards distinct letter case aside."""
    rows = spark.read.text(path).where("value like '%|%'").select(F.trim(F.split_part("value", F.lit("|"), F.lit(1))).alias("company"), F.trim(F.split_part("value", F.lit("|"), F.lit(2))).alias("board"))
    if seeds:
        rows = rows.unionByName(spark.createDataFrame(seeds, "company string, board string"))
    return rows.groupBy(F.lower("board").alias("key")).agg(F.min_by("company", F.struct("company", "board")).alias("company"), F.min_by("board", F.struct("company", "board")).alias("board")).drop("key")


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def archive_index(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """Index lines with ``pattern`` and ``url``, at most so many of each pattern."""
    rows = spark.read.schema("pattern string, url string, ordinal long").option("mode", "DROPMALFORMED").json(path)
    return pattern_limit(rows, "pattern", "ordinal", limit)


def certificates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name_value string").option("multiLine", True).json(path)


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options).load()


def topic(spark: SparkSession, servers: str, name: str, schema: str, offsets_per_trigger: int = 10_000) -> DataFrame:
    """A Kafka topic of JSON values from its latest offsets on, as the columns of ``schema`` and the ``key``."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", name).option("startingOffsets", "latest").option("maxOffsetsPerTrigger", offsets_per_trigger).load()
    return raw.select(F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), schema).alias("m")).select("key", "m.*")


def file_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """A folder of JSON lines as a stream: a topic's stand-in."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def labelled_requests(spark: SparkSession, path: str) -> DataFrame:
    """Training rows; bad ones are left out, missing fields have defaults."""
    rows = spark.read.schema(LABELLED).option("mode", "DROPMALFORMED").json(path)
    return rows.select(F.coalesce("url", F.lit("")).alias("url"), F.coalesce("method", F.lit("GET")).alias("method"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), F.coalesce("body", F.lit("")).alias("body"), F.coalesce("label", F.lit(0)).alias("label"))


def kernel_events(spark: SparkSession, path: str) -> DataFrame:
    """Landed kernel captures, payloads of at most 4096 bytes."""
    return spark.read.parquet(path).withColumn("data", F.substring("data", 1, 4096))
