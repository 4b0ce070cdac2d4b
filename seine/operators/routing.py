"""Which topic a URL or a result goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def route(messages: DataFrame, records: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """``route`` of each message by its domain: replay where discovered, tier1 where unseen; seen ones are dropped.

    Only what goes to tier1 is remembered as seen; a discovered domain passes each time.
    """
    rows = messages.withColumn("domain", F.coalesce(F.nullif(urls.hostname(F.col("raw_url")), F.lit("")), F.col("domain")))
    rows = rows.join(records.select("domain", F.col("status").alias("_status")), "domain", "left").withColumn("route", F.when(F.col("_status") == "discovered", "replay").otherwise("tier1"))
    if seen is not None:
        rows = rows.join(seen.select("domain").distinct().withColumn("_seen", F.lit(True)), "domain", "left").where((F.col("route") == "replay") | F.col("_seen").isNull()).drop("_seen")
    return rows.drop("_status")


def new_domains(routed: DataFrame) -> DataFrame:
    """Domains that a batch sends to tier1: pending records, and the next batch's seen ones."""
    return routed.where("route = 'tier1'").select("domain").distinct()


def settle(results: DataFrame, tier: int, confidence: Column, least: float) -> tuple[DataFrame, DataFrame]:
    """Discovered payloads, and messages for the next tier with the reason."""
    ok = F.coalesce(confidence >= least, F.lit(False))
    return results.where(ok).withColumn("tier_used", F.lit(f"tier{tier}")), results.where(~ok).withColumn(f"tier{tier}_fail_reason", F.coalesce(F.col("error"), F.lit("below threshold")))
