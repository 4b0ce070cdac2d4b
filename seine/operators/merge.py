"""Upserts as new versions of a table: one full outer join on the keys, one expression a column.

Every mutation is a pure function of the target, the source and the moment ``as_of``; the
caller writes the result as the next version. A source may repeat a key: its first row by
``order``, then by all of its columns, counts, so a recomputed task chooses alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text, times, urls


def merge(target: DataFrame, source: DataFrame, keys: list[str], matched: dict[str, Column] | None = None, inserted: dict[str, Column] | None = None, when_matched: Column | None = None, order: list | None = None, insert: bool = True) -> DataFrame:
    """``target`` after the upsert. Expressions see the two sides as ``t.<column>`` and ``s.<column>``.

    ``matched`` columns change where a key is in both and ``when_matched`` holds; a source key
    of its own is inserted with ``inserted``, the source's columns of the same name and nulls.
    Keys are taken to be unique in the target and not null.
    """
    own = [c for c in source.columns if c not in keys]
    simple = {f.name for f in source.schema.fields if f.dataType.typeName() not in ("map", "variant")}
    rank = F.struct(*(order or []), *(F.col(c) if c in simple else F.to_json(c) for c in source.columns))
    best = source.groupBy(*keys).agg(F.min_by(F.struct(*own) if own else F.lit(1), rank).alias("_row"))  # combines before the shuffle
    source = best.select(*keys, *(F.col("_row").getField(c).alias(c) for c in own))
    both = target.withColumn("_t", F.lit(True)).alias("t").join(source.withColumn("_s", F.lit(True)).alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer" if insert else "left_outer")
    in_target, in_both = F.col("t._t").isNotNull(), F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    change = in_both if when_matched is None else in_both & F.coalesce(when_matched, F.lit(False))
    out = []
    for c in target.columns:
        fresh = (inserted or {}).get(c, F.col(f"s.{c}") if c in source.columns else F.lit(None))
        value = F.when(change, matched[c]).when(in_target, F.col(f"t.{c}")) if c in (matched or {}) else F.when(in_target, F.col(f"t.{c}"))
        out.append(value.otherwise(fresh).cast(target.schema[c].dataType).alias(c))
    return both.select(*out)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], inserted: dict[str, Column] | None = None, order: list | None = None) -> DataFrame:
    return merge(target, source, keys, None, inserted, order=order)


def upsert_companies(companies: DataFrame, domains: DataFrame, as_of: Column) -> DataFrame:
    """New domains; known ones keep their id."""
    return insert_ignore(companies, domains, ["domain"], {"created_at": as_of, "updated_at": as_of})


def create_pending(records: DataFrame, domains: DataFrame, as_of: Column) -> DataFrame:
    return insert_ignore(records, domains, ["domain"], {"status": F.lit("pending"), "consecutive_failures": F.lit(0), "updated_at": as_of})


def mark_discovered(records: DataFrame, found: DataFrame, as_of: Column) -> DataFrame:
    """Takes the new endpoint, forgets failures, is due again in an hour."""
    new = {c: F.col(f"s.{c}") for c in ("tier_used", "api_url", "http_method", "request_body", "confidence") if c in found.columns}
    new |= {"status": F.lit("discovered"), "discovered_at": as_of, "next_replay": times.plus_hours(as_of, 1), "consecutive_failures": F.lit(0), "last_error": F.lit(None), "updated_at": as_of}
    return merge(records, found, ["domain"], {k: v for k, v in new.items() if k in records.columns}, {k: v for k, v in new.items() if k in records.columns})


def mark_failed(records: DataFrame, failed: DataFrame, as_of: Column, threshold: int = 3, default_tier: str | None = None) -> DataFrame:
    """One failure more; at the third a record counts as failed, a discovered one too."""
    failures = F.coalesce(F.col("t.consecutive_failures"), F.lit(0)) + 1
    changed = {"consecutive_failures": failures, "last_error": F.col("s.last_error"), "updated_at": as_of, "status": F.when(failures >= threshold, "failed").otherwise(F.col("t.status"))}
    if default_tier:
        changed["tier_used"] = F.coalesce(F.col("t.tier_used"), F.lit(default_tier))
    fresh = {"status": F.lit("pending"), "consecutive_failures": F.lit(1), "last_error": F.col("s.last_error"), "updated_at": as_of}
    keep = lambda d: {k: v for k, v in d.items() if k in records.columns}
    return merge(records, failed, ["domain"], keep(changed), keep(fresh))


def save_probe(records: DataFrame, hits: DataFrame, as_of: Column) -> DataFrame:
    """A confirmed probe; what is discovered already stays."""
    new = {"status": F.lit("discovered"), "api_url": F.col("s.api_url"), "tier_used": F.lit("tier0"), "confidence": F.lit(0.95), "discovered_at": as_of, "updated_at": as_of}
    keep = {k: v for k, v in new.items() if k in records.columns}
    return merge(records, hits, ["domain"], keep, keep, F.col("t.status") != "discovered")


def upsert_sources(sources: DataFrame, found: DataFrame, as_of: Column) -> DataFrame:
    """By endpoint; a known one is active again. Slugs with one endpoint collapse into the first."""
    return merge(sources, found, ["endpoint_url"], {k: v for k, v in {"status": F.lit("active"), "updated_at": as_of}.items() if k in sources.columns}, {k: v for k, v in {"status": F.lit("active"), "created_at": as_of, "updated_at": as_of}.items() if k in sources.columns})


def save_slugs(companies: DataFrame, records: DataFrame, sources: DataFrame, hits: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Company, discovery record and source of each hit, from one input, to be written together."""
    return upsert_companies(companies, hits, as_of), save_probe(records, hits, as_of), upsert_sources(sources, hits, as_of)


JOB_UPDATES = ("title", "location_raw", "city", "country_code", "department", "employment_type", "is_remote", "apply_url", "is_active")


def upsert_jobs(jobs: DataFrame, parsed: DataFrame, as_of: Column) -> DataFrame:
    """Nine fields and three times change; description, posting time and raw JSON stay as first seen."""
    seen = {c: as_of for c in ("last_seen_at", "fetched_at", "updated_at") if c in jobs.columns}
    changed = {c: F.col(f"s.{c}") for c in JOB_UPDATES if c in jobs.columns and c in parsed.columns} | seen
    fresh = seen | {c: as_of for c in ("first_seen_at", "created_at") if c in jobs.columns} | ({"data_quality": F.lit(50)} if "data_quality" in jobs.columns else {})
    return merge(jobs, parsed, ["source_id", "external_id"], changed, fresh)


def source_succeeded(sources: DataFrame, fetched: DataFrame, as_of: Column, hours: int = 6) -> DataFrame:
    changed = {"consecutive_failures": F.lit(0), "status": F.lit("active"), "last_success_at": as_of, "last_fetched_at": as_of, "next_fetch_at": times.plus_hours(as_of, hours), "last_job_count": F.col("s.jobs_found"), "fetch_count": F.coalesce(F.col("t.fetch_count"), F.lit(0)) + 1, "success_count": F.coalesce(F.col("t.success_count"), F.lit(0)) + 1} if set(fetched.columns) >= {"jobs_found"} else {"consecutive_failures": F.lit(0)}
    return merge(sources, fetched, ["source_id"], {k: v for k, v in changed.items() if k in sources.columns}, insert=False)


def source_failed(sources: DataFrame, failed: DataFrame, as_of: Column, threshold: int = 5) -> DataFrame:
    """One failure more; degraded from the fifth; tried again in an hour."""
    failures = F.coalesce(F.col("t.consecutive_failures"), F.lit(0)) + 1
    changed = {"consecutive_failures": failures, "status": F.when(failures >= threshold, "degraded").otherwise(F.col("t.status")), "last_failure_at": as_of, "last_fetched_at": as_of, "next_fetch_at": times.plus_hours(as_of, 1), "fetch_count": F.coalesce(F.col("t.fetch_count"), F.lit(0)) + 1, "failure_count": F.coalesce(F.col("t.failure_count"), F.lit(0)) + 1} if "fetch_count" in sources.columns else {"consecutive_failures": failures, "status": F.when(failures >= threshold, "degraded").otherwise(F.col("t.status"))}
    return merge(sources, failed, ["source_id"], {k: v for k, v in changed.items() if k in sources.columns}, insert=False)


def fetch_log_rows(fetches: DataFrame) -> DataFrame:
    """Rows to append; an error text is cut to 255 characters."""
    return fetches.withColumn("error_message", text.left_chars(F.col("error_message"), 255))


def replay_succeeded(records: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    changed = {"last_replayed": as_of, "next_replay": times.plus_hours(as_of, 1), "consecutive_failures": F.lit(0), "last_error": F.lit(None), "updated_at": as_of}
    return merge(records, done, ["domain"], {k: v for k, v in changed.items() if k in records.columns}, insert=False)


def auth_expired(records: DataFrame, expired: DataFrame, as_of: Column) -> DataFrame:
    """Stale for a day, where the answer was 401 or 403."""
    changed = {"status": F.lit("stale"), "next_replay": times.plus_hours(as_of, 24), "updated_at": as_of}
    return merge(records, expired.where(F.col("http_status").isin(401, 403)), ["domain"], {k: v for k, v in changed.items() if k in records.columns}, insert=False)


def reset_failed(records: DataFrame) -> DataFrame:
    """Failed records that never had an endpoint or a confidence are pending again."""
    again = (F.col("status") == "failed") & (F.col("api_url").isNull() | F.col("confidence").isNull())
    return records.withColumn("status", F.when(again, "pending").otherwise(F.col("status"))).withColumn("consecutive_failures", F.when(again, 0).otherwise(F.col("consecutive_failures")))


def purge_false_positives(records: DataFrame, parts: tuple[str, ...] = rules.FALSE_POSITIVES, least: float = 0.60) -> DataFrame:
    """Without known false positives and low confidences; a null matches neither and stays."""
    return records.where(~F.coalesce(urls.contains_any(F.col("api_url"), parts), F.lit(False)) & ~F.coalesce(F.col("confidence") < least, F.lit(False)))


def apply_labels(captures: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels by ``id``, or by ``domain`` for all of its unlabelled captures (id null)."""
    one = labels.where("id is not null").groupBy("id").agg(F.max("label").alias("_one"))
    all_ = labels.where("id is null").groupBy("domain").agg(F.max("label").alias("_all"))
    return captures.join(one, "id", "left").join(all_, "domain", "left").withColumn("label", F.coalesce("_one", "label", "_all")).select(*captures.columns)


def promote_near_misses(near: DataFrame, captures: DataFrame) -> DataFrame:
    """Captures with the near misses that a review found positive."""
    new = near.where("label = 1").withColumn("notes", F.lit("near_miss_review"))
    return captures.unionByName(new.select(*(F.col(c) if c in new.columns else F.lit(None).cast(captures.schema[c].dataType).alias(c) for c in captures.columns)))


def backfill_sources(records: DataFrame, sources: DataFrame, as_of: Column) -> DataFrame:
    """Sources from discovery records with an endpoint; of several with one endpoint the first."""
    tier, status = F.col("tier_used"), F.col("status")
    rows = records.where("api_url is not null").select(
        "id", text.public_ref(F.col("id")).alias("public_ref"), F.when(tier == "tier0", "ats_probe").when(tier == "tier2", "browser_intercept").otherwise("unknown").alias("discovery_method"), tier.alias("discovery_tier"),
        urls.migrated_platform(F.col("api_url")).alias("ats_platform"), F.coalesce("discovered_at", as_of).alias("discovered_at"), F.col("api_url").alias("endpoint_url"),
        F.when(status == "discovered", "active").when(status == "pending", "unverified").otherwise("retired").alias("status"), "confidence",
    )
    return insert_ignore(sources, rows, ["endpoint_url"], order=["id"])
