"""Scores of URLs, bodies and requests: sums of weights in a fixed order, in double arithmetic."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import rules, urls

D = lambda x: F.lit(float(x))


def _plus(score: Column, condition: Column, weight: float) -> Column:
    return score + F.when(condition, D(weight)).otherwise(D(0))


def static_score(url: Column) -> Column:
    """0 to 0.80, before any request."""
    rest = F.regexp_replace(F.regexp_replace(F.lower(url), "^https://", ""), "^http://", "")
    at = F.instr(rest, "/")
    parts = urls.segments(F.substring(rest, at, F.length(rest)))
    shallow = (at == 0) | ((F.size(parts) <= 2) & (F.get(parts, 0) != ""))
    score = _plus(D(0), urls.contains_any(rest, rules.STATIC_PATHS), 0.25)
    score = _plus(score, urls.starts_with_any(rest, tuple(w + x for x in rules.STATIC_PREFIXES for w in ("", "www."))), 0.20)
    score = _plus(score, shallow, 0.15)
    score = _plus(score, urls.contains_any(rest, tuple(f"{x}/" for x in rules.STATIC_ENDINGS)) | urls.ends_with_any(rest, rules.STATIC_ENDINGS), 0.10)
    return F.least(_plus(score, ~urls.contains_any(rest, rules.STATIC_NOISE), 0.10), D(0.80))


def feedback_boost(hits: Column, misses: Column) -> Column:
    return F.when(hits > 0, F.least(D(0.20), hits / (hits + misses + 1) * D(0.20))).otherwise(D(0))


def frontier_score(url: Column, hits: Column, misses: Column) -> Column:
    return F.least(D(1), static_score(url) + feedback_boost(hits, misses))


def decayed(score: Column, blocks: Column) -> Column:
    """After that many refusals, 0.05 each, not below 0.10."""
    return F.greatest(score - D(0.05) * blocks, D(0.10))


def url_confidence(url: Column, method: Column, content_type: Column, size: Column) -> Column:
    u, kind = F.lower(url), F.lower(content_type)
    score = _plus(D(0), urls.contains_any(u, rules.PATH_WORDS), 0.25)
    score = _plus(score, urls.contains_any(u, rules.PAGING_PARAMS), 0.15)
    score = _plus(score, F.upper(method) == "POST", 0.10)
    score = _plus(score, kind.contains("application/json") | kind.contains("application/graphql-response+json"), 0.15)
    score = _plus(score, urls.depth(urls.path(url)) <= 3, 0.10)
    score = _plus(score, size.between(1024, 2 * 1024 * 1024), 0.10)
    return F.when(urls.is_junk(url), D(0)).otherwise(F.least(_plus(score, urls.is_ats(url), 0.15), D(1)))


def final_confidence(url_score: Column, body_score: Column, url: Column) -> Column:
    blend = url_score * D(0.40) + body_score * D(0.60)
    score = F.greatest(blend, F.greatest(url_score, body_score) * D(0.85))
    floor = F.when(urls.is_ats(url) & (body_score > 0.20), F.greatest(score, D(0.62))).otherwise(score)
    return F.least(floor, D(1))


def near_miss(url_score: Column, body_score: Column, confidence: Column, least: float = 0.60) -> Column:
    return (confidence < least) & ((url_score >= 0.35) | (body_score >= 0.35))


def url_rank(url: Column, discovered: Column, labelled: Column) -> Column:
    """Struct of score 0 to 100 and the signals behind it; null without a host."""
    host, p = urls.host_with_port(url), F.lower(urls.path(url))
    on = lambda names: urls.ends_with_any(host, tuple(f".{x}" for x in names)) | host.isin(*names)
    tests = (
        (on(rules.RANKED_GLOBAL), 40, "Known Global ATS Subdomain (+40)"),
        (host.startswith("careers.") | host.startswith("jobs."), 20, "Dedicated Careers Subdomain (+20)"),
        (p.contains("/careers") | p.contains("/jobs"), 15, "Careers/Jobs contained in path (+15)"),
        (on(rules.RANKED_REGIONAL), 15, "Known Indian ATS (+15)"),
        (discovered, 25, "Previously Discovered API (+25)"),
        (labelled, 20, "Exists in label=1 Captures (+20)"),
    )
    score = F.lit(0)
    for test, points, _ in tests:
        score = score + F.when(test, points).otherwise(0)
    signals = F.array_compact(F.array(*(F.when(test, F.lit(text)) for test, _, text in tests)))
    return F.when(host != "", F.struct(F.least(score, F.lit(100)).alias("score"), signals.alias("signals")))


def score_bucket(score: Column) -> Column:
    return F.when(score >= 60, "Above 60").when(score >= 40, "40 to 60").when(score >= 20, "20 to 39").otherwise("Below 20")


def fallback_confidence(features: Column) -> Column:
    """Of a feature array, where no model is at hand."""
    return F.least(F.aggregate(features, D(0), lambda a, x: a + x) / D(8), D(1))


def _many(keys, vocabulary: tuple[str, ...]) -> int:
    return sum(k in vocabulary for k in keys)


def _jobs(items: list, ats: int, general: int) -> bool:
    """Whether one object of a list has so many keys of either vocabulary."""
    for x in items:
        if isinstance(x, dict):
            keys = [k.lower() for k in x]
            if _many(keys, rules.ATS_VOCABULARY) >= ats or _many(keys, rules.GENERAL_VOCABULARY) >= general:
                return True
    return False


def _full_list(data) -> float:
    """Arrays of job objects near the root, job keys and located titles at any depth."""
    bonus, seen, located = 0.0, set(), False
    stack = [(data, 0)]
    while stack:
        node, depth = stack.pop()
        if isinstance(node, dict):
            keys = {k.lower() for k in node}
            seen |= keys
            located |= bool(keys & set(rules.LOCATION_FIELDS))
            if depth == 0 and "data" in keys and isinstance(node.get("data"), dict) and any(isinstance(x, list) and _jobs(x, 2, 2) for x in node["data"].values()):
                bonus = max(bonus, 0.25)
            for child in node.values():
                if isinstance(child, list) and (depth == 0 or depth == 1 and len(child) >= 3) and _jobs(child, 3, 4):
                    bonus = max(bonus, 0.30 if depth else 0.40)
                stack.append((child, depth + 1))
        elif isinstance(node, list):
            if depth == 0 and _jobs(node, 3, 4):
                bonus = max(bonus, 0.40)
            stack += [(child, depth + 1) for child in node]
    return bonus + 0.20 * bool(seen & set(rules.JOB_KEYS)) + 0.15 * (located and "title" in seen)


def _shapes(data) -> dict[str, float]:
    keys = [k.lower() for k in data] if isinstance(data, dict) else []
    pairs = (("title", "id"), ("title", "url"), ("name", "id"), ("position", "id"), ("role", "id"), ("title", "apply_url"))
    minimal = isinstance(data, list) and bool(data) and all(isinstance(x, dict) and any({a, b} <= {k.lower() for k in x} for a, b in pairs) for x in data)
    lists = [v for v in data.values() if isinstance(v, list) and v] if isinstance(data, dict) else []
    paged = _many(keys, rules.PAGING_FIELDS) > 0 and any(_jobs(x, 3, 4) or (isinstance(x[0], dict) and _many([k.lower() for k in x[0]], rules.SINGLE_JOB_FIELDS) >= 4) for x in lists)
    return {"shape1_full_list": _full_list(data), "shape2_single_job": 0.30 * (_many(keys, rules.SINGLE_JOB_FIELDS) >= 4), "shape3_minimal_list": 0.25 * minimal, "shape4_paginated": 0.35 * paged}


def score_body(body: str | None) -> tuple[float, str]:
    """Of a body whose URL isn't blocked. Any paginated array counts; later shapes win ties."""
    size = len((body or "").encode())
    base = 0.10 * (500 <= size <= 500_000)
    try:
        data = json.loads(body or "", parse_constant=lambda _: (_ for _ in ()).throw(ValueError()))
    except (ValueError, RecursionError):
        return base, "shape_unknown"
    best, name = 0.0, "shape_unknown"
    for shape, score in _shapes(data).items():
        if score > 0 and score >= best:
            best, name = score, shape
    return min(base + 0.15 + best, 1.0), name


def _scored_bodies(bodies: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([score_body(x) for x in bodies], columns=["score", "shape"])


def body_confidence(url: Column, body: Column) -> Column:
    """Struct of score and shape. JSON of any depth is walked in Python, by Arrow batches; blocked URLs get no walk's result."""
    ship_package(SparkSession.active())
    scored = F.pandas_udf(_scored_bodies, "struct<score:double,shape:string>")
    zero = F.struct(D(0).alias("score"), F.lit("shape_unknown").alias("shape"))
    return F.when(urls.is_blocked_response(url), zero).otherwise(scored(F.when(~urls.is_blocked_response(url), body)))
