"""Where results go: JSON lines, arrays, CSV, text, partitioned tables, topics, versioned state, metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_json(rows: DataFrame, path: str) -> None:
    """Appends lines; nothing happens where the path is ``none``."""
    if path != "none":
        rows.write.mode("append").json(path)


def stream_json(rows: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Appends what has come every so often, or, without an interval, all there is and then ends."""
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def json_array(rows: DataFrame, path: str, order: list) -> None:
    """One JSON array in one file, rows in order: for lists that people read, which must fit one task."""
    ordered = rows.select(F.struct(*order).alias("_o"), F.struct(*rows.columns).alias("_r"))
    out = ordered.agg(F.transform(F.sort_array(F.collect_list(F.struct("_o", "_r"))), lambda x: x["_r"]).alias("a"))
    out.select(F.to_json("a").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).option("escape", '"').csv(path)


def append_piped(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(F.concat_ws("|", *columns).alias("value")).write.mode("append").text(path)


def to_topic(rows: DataFrame, servers: str, name: str, key: str = "domain") -> None:
    """JSON values under a key, acknowledged by all replicas."""
    keyed_messages(rows, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("topic", name).save()


def keyed_messages(rows: DataFrame, key: str = "domain") -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def partitioned(rows: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    """A table in folders by key, each task's rows in order; a hot key is as many files as tasks."""
    rows.sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).parquet(path)


def new_version(rows: DataFrame, path: str) -> str:
    """Writes state as the next version below a path, complete or not at all; returns its path."""
    spark = rows.sparkSession
    known = versions(spark, path)
    target = f"{path}/v{(known[-1] if known else 0) + 1:08d}"
    rows.write.mode("errorifexists").parquet(target)
    return target


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [x.getPath() for x in fs.listStatus(at)]
    return sorted(int(p.getName()[1:]) for p in names if p.getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def latest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/v{versions(spark, path)[-1]:08d}")


def merge_buckets(path: str, source: DataFrame, keys: list[str], change: Callable[[DataFrame, DataFrame], DataFrame], empty: DataFrame, buckets: int = 64) -> None:
    """Changes state kept in buckets by a hash of its keys; only buckets that the source touches are read and written.

    A version holds new files for those, and a list of which version has each bucket; state without
    a list is ``empty``. Readers see the old list or the new one. ``change`` gets the touched part of
    the state and the source. At most ``buckets`` numbers come to the driver.
    """
    spark = source.sparkSession
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    known = _bucket_list(spark, path)
    touched = {r.b for r in source.select(number.alias("b")).distinct().collect()}
    old = [f"{path}/data/v{known[b]:08d}/bucket={b}" for b in sorted(touched & set(known))]
    part = spark.read.schema(empty.schema).parquet(*old) if old else empty
    version = (versions(spark, f"{path}/lists") or [0])[-1] + 1
    target = f"{path}/data/v{version:08d}"
    change(part, source).withColumn("bucket", number).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    left = {int(x.getPath().getName()[7:]) for x in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at) if x.getPath().getName().startswith("bucket=")}
    listed = {b: v for b, v in known.items() if b not in touched} | dict.fromkeys(left, version)
    spark.createDataFrame(sorted(listed.items()), "bucket int, version int").coalesce(1).write.mode("errorifexists").parquet(f"{path}/lists/v{version:08d}")


def _bucket_list(spark: SparkSession, path: str) -> dict[int, int]:
    return {r.bucket: r.version for r in latest(spark, f"{path}/lists").collect()} if versions(spark, f"{path}/lists") else {}


def read_buckets(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """The state that ``merge_buckets`` has made."""
    known = _bucket_list(spark, path)
    return spark.read.schema(empty.schema).parquet(*(f"{path}/data/v{v:08d}/bucket={b}" for b, v in sorted(known.items()))) if known else empty


def pointers(rows: DataFrame, key: str, location: str, content: str) -> DataFrame:
    """What an archive's table holds of each object: its key, where it lies, its size and digest."""
    return rows.select(key, F.col(location).alias("location"), F.octet_length(content).cast("long").alias("size"), F.sha2(content, 256).alias("digest"))


def observed(rows: DataFrame, name: str, **metrics) -> DataFrame:
    """Rows as they are, with metrics gathered as they pass (read by a query listener)."""
    return rows.observe(name, *(c.alias(k) for k, c in metrics.items()))
