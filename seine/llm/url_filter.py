"""URL rules by hashed expressions.

A URL stands for every pair of a host suffix and a path prefix that some rule could have: the
rules say which numbers of labels and which path lengths occur, so the pairs are few and none
is missed, however long the URL. Pairs meet the rules on the first 32 bits of their SHA-256;
the full digest confirms, and the longest rule wins. No cross join, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the short prefix that the equi-join is on.
SHORT = 8
#: A rule set of at most so many rows (about 100 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_RULES = 500_000
#: host, path, verdict
BASE_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), *LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules=BASE_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (``host`` + ``path`` of the winner, else null), verdict (the rule's, else ``default``).

    A rule fits its host and all subdomains where the path starts with the rule's. The longest
    (host and path together) wins; then the longer host; then block over allow. Null URLs and
    URLs without ``://`` have an empty host and path and meet no rule. Rows with null or
    repeated ids each get a row. Rules with a null are left out; an empty rule set gives
    ``default`` throughout. Distinct URLs are judged once, so a hot URL costs one row.
    """
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull()).select("host", "path", "verdict").distinct()
    shape = rules.agg(F.count("*").alias("n"), F.collect_set(F.size(F.split("host", "\\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()  # one row of small sets
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape.n:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keyed = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict", _digest(F.col("host"), F.col("path")).alias("digest")).withColumn("short", F.substring("digest", 1, SHORT))

    labels, lengths = (F.array(*map(F.lit, sorted(x))) for x in (shape.labels, shape.lengths))
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))
    distinct = rows.where(F.col("host") != "").select("host", "path").distinct()
    expressions = distinct.select("host", "path", F.explode(pairs).alias("x")).select("host", "path", _digest(F.col("x.h"), F.col("x.p")).alias("own")).withColumn("short", F.substring("own", 1, SHORT))
    met = expressions.join(F.broadcast(keyed) if shape.n <= BROADCAST_RULES else keyed, "short").where(F.col("own") == F.col("digest"))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"), (F.col("verdict") == "block").cast("int").alias("b"), F.concat("r_host", "r_path").alias("rule"), "verdict")
    best = met.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
