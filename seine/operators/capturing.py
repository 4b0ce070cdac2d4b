"""Which landed responses become captures, and the rules that labelled captures give for the next run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring, urls
from .reports import accept_hosts, block_hosts

LEAST_BYTES, MOST_BYTES = 200, 10 * 1024 * 1024


def mined_rules(captures: DataFrame) -> DataFrame:
    """Host and ``rule``, block or accept, as a table for the next run in the place of generated code."""
    return block_hosts(captures).select("host", F.lit("block").alias("rule")).unionByName(accept_hosts(captures).select("host", F.lit("accept").alias("rule")))


def _flagged(rows: DataFrame, hosts: DataFrame, name: str) -> DataFrame:
    return rows.join(hosts.select(F.col("host").alias("_host")).distinct().withColumn(name, F.lit(True)), "_host", "left").withColumn(name, F.coalesce(name, F.lit(False)))


def accepted(responses: DataFrame, blocked: DataFrame, trusted: DataFrame, skipped: tuple[str, ...] = ()) -> DataFrame:
    """Responses (url, resource_type, content_type, body) that are kept, with their ``notes``.

    Only script requests count; blocked hosts, junk and skipped URLs go before a body is
    looked at. A trusted host's body is kept as it is; others must be JSON of 200 bytes to
    10 MB and are noted by their shape.
    """
    u = F.col("url")
    rows = responses.where(F.col("resource_type").isin("XHR", "Fetch") & ~urls.is_junk(u) & ~urls.contains_any(u, skipped))
    rows = _flagged(_flagged(rows.withColumn("_host", urls.host_with_port(u)), blocked, "_blocked"), trusted, "_trusted").where(~F.col("_blocked"))
    size = F.octet_length("body")
    rows = rows.where(F.col("_trusted") | (F.lower("content_type").contains("application/json") & size.between(LEAST_BYTES, MOST_BYTES)))
    shape = scoring.body_confidence(u, F.when(~F.col("_trusted"), F.col("body")))["shape"]
    return rows.withColumn("notes", F.when(F.col("_trusted"), "fast_accept").otherwise(shape)).drop("_host", "_blocked", "_trusted")


def run_summary(captures: DataFrame, top: int = 10) -> DataFrame:
    """The domains with most captures, and beside each the mean of all domains."""
    counts = captures.groupBy("domain").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), "domain").limit(top)
    return best.withColumn("mean", F.round(counts.agg(F.avg("n")).scalar(), 2))


def request_url(platform: Column, endpoint: Column) -> Column:
    """Asks greenhouse for full texts, once."""
    return F.when((platform == "greenhouse") & ~endpoint.contains("content=true"), urls.with_content(endpoint)).otherwise(endpoint)


def board_slug(endpoint: Column) -> Column:
    """The last part of a path, or the one before where that is empty or ``jobs``."""
    parts = F.split(urls.path(endpoint), "/")
    last = F.element_at(parts, -1)
    return F.when(last.isin("", "jobs") & (F.size(parts) >= 2), F.get(parts, F.size(parts) - 2)).otherwise(last)
