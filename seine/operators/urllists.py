"""URL lists: cleaning with reasons, deduplication, ranking, slugs from several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules, scoring, text, urls


def clean_reason(url: Column) -> Column:
    """Why a URL goes: the first entry that its host holds (or ends with), by kind; null if it stays."""
    host = urls.host_with_port(url)
    out = F.when(host == "", F.lit("invalid"))
    for kind, parts in rules.CLEAN.items():
        for part in parts:
            out = out.when(host.endswith(part) if kind == "government" else host.contains(part), f"{kind} ({part})")
    return out


def clean_urls(pages: DataFrame, url_col: str = "url", order_col: str = "ordinal") -> DataFrame:
    """Every row with ``kept`` and ``reason``: of a host's URLs the shortest stays, the first on a tie.

    Distinct hosts are the groups, so a hot host is one window partition of narrow rows; the
    winner is found by a grouped minimum, which combines before the shuffle.
    """
    rows = pages.withColumn("_reason", clean_reason(F.col(url_col))).withColumn("_host", urls.bare_host(F.col(url_col)))
    best = rows.where("_reason is null").groupBy("_host").agg(F.min_by(F.struct(F.col(url_col).alias("url"), F.col(order_col).alias("at")), F.struct(F.octet_length(url_col), F.col(order_col))).alias("_best"))
    out = rows.join(best, "_host", "left")
    kept = F.col("_reason").isNull() & (F.col(order_col) == F.col("_best.at"))
    return out.select(*pages.columns, kept.alias("kept"), F.when(F.col("_reason").isNotNull(), F.col("_reason")).when(~kept, F.concat(F.lit("duplicate (keeping "), F.col("_best.url"), F.lit(")"))).alias("reason"))


def reason_counts(cleaned: DataFrame) -> DataFrame:
    """Removed URLs by kind of reason, zeros included."""
    kinds = cleaned.sparkSession.createDataFrame([(k,) for k in (*rules.CLEAN, "duplicate", "invalid")], "kind string")
    counts = cleaned.where("not kept").groupBy(F.split_part("reason", F.lit(" "), F.lit(1)).alias("kind")).agg(F.count("*").alias("n"))
    return kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


def canonical_urls(pages: DataFrame, url_col: str = "url", order_col: str = "ordinal") -> DataFrame:
    """Distinct canonical URLs with platform and board, by first appearance."""
    rows = pages.select(urls.canonical(F.col(url_col)).alias("c"), F.col(order_col).alias("first_seen")).where("c is not null")
    return rows.groupBy("c.canonical").agg(F.min("first_seen").alias("first_seen"), F.min_by("c.ats", "first_seen").alias("ats"), F.min_by("c.board", "first_seen").alias("board"))


def ranked_urls(pages: DataFrame, discovered: DataFrame, labelled: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs with score and signals; membership of their bare host in either set (column ``domain``) counts."""
    rows = pages.withColumn("_host", urls.bare_host(F.col(url_col)))
    for name, some in (("_d", discovered), ("_l", labelled)):
        rows = rows.join(some.select(F.col("domain").alias("_host")).distinct().withColumn(name, F.lit(True)), "_host", "left")
    rank = scoring.url_rank(F.col(url_col), F.coalesce("_d", F.lit(False)), F.coalesce("_l", F.lit(False)))
    return rows.withColumn("_r", rank).where("_r is not null").select(*pages.columns, F.col("_r.score").alias("score"), F.col("_r.signals").alias("signals"))


def score_distribution(ranked: DataFrame) -> DataFrame:
    buckets = ranked.sparkSession.createDataFrame([(x,) for x in ("Above 60", "40 to 60", "20 to 39", "Below 20")], "bucket string")
    counts = ranked.groupBy(scoring.score_bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("n"))
    return buckets.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def union_first(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of several sources, the first source that has a key winning."""
    rows = reduce(DataFrame.unionByName, (p.withColumn("_rank", F.lit(k)) for k, p in enumerate(parts)))
    own = [c for c in rows.columns if c not in (key, "_rank")]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*own) if own else F.lit(1), F.struct("_rank", *own)).alias("_row"))
    return best.select(key, *([F.col(f"_row.{c}").alias(c) for c in own]))


def slug_sources(named: DataFrame) -> DataFrame:
    """Valid slugs and variants of company names (``name``, ``source``, ``rank``), each by the first source that gave it."""
    rows = named.select(F.explode(text.slug_variants(text.company_slug(F.col("name")))).alias("slug"), "source", "rank")
    rows = rows.where(text.valid_slug(F.col("slug")) & ~F.col("slug").isin(*rules.SLUG_EXACT))
    return rows.groupBy("slug").agg(F.min_by("source", F.struct("rank", "source")).alias("source"))


def certificate_slugs(certificates: DataFrame, domain: str, first_label: bool = False) -> DataFrame:
    """Distinct slugs of multi-line certificate names."""
    rows = certificates.select(F.explode(F.split("name_value", "\n")).alias("line"))
    slug = (text.first_label if first_label else text.certificate_slug)(F.col("line"), domain)
    valid = text.valid_harvest_slug(F.col("slug")) if first_label else text.blocked_slug(F.col("slug")).isNull()
    return rows.select(slug.alias("slug")).where(valid).distinct()


def pattern_limit(rows: DataFrame, pattern_col: str, order_col: str, limit: int) -> DataFrame:
    """At most so many rows of each pattern, in order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(pattern_col).orderBy(order_col))).where(F.col("_n") <= limit).drop("_n")
