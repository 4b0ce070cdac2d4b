"""Titles, slugs, salaries, employment types, truncation, links of pages."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import rules, urls


def normal_title(title: Column) -> Column:
    return F.lower(F.regexp_replace(title, r"[^a-zA-Z0-9\s]", ""))


def company_slug(name: Column) -> Column:
    """Legal suffixes go in order, each also before a full stop or comma; blanks become hyphens, other signs go."""
    s = F.lower(F.trim(name))
    for suffix in rules.COMPANY_SUFFIXES:
        for end in ("", r"\.", ","):
            s = F.regexp_replace(s, f"{suffix}{end}$", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"[\s_]+", "-"), r"[^a-z0-9\-]", ""), "^-+|-+$", "")


def slug_variants(slug: Column) -> Column:
    """The slug; with hyphens also without them, and its first part."""
    return F.when(slug.contains("-"), F.array(slug, F.replace(slug, F.lit("-"), F.lit("")), F.split_part(slug, F.lit("-"), F.lit(1)))).otherwise(F.array(slug))


def _digit_count(s: Column) -> Column:
    return F.length(s) - F.length(F.regexp_replace(s, "[0-9]", ""))


def valid_slug(slug: Column) -> Column:
    """3 to 50 of a-z, 0-9 and hyphen, from a letter, at most 60 % digits, not an encoded name."""
    n = F.octet_length(slug)
    return n.between(3, 50) & slug.rlike(r"^[a-z][a-z0-9-]*$") & ~slug.startswith("xn--") & (_digit_count(slug) / n <= 0.6)


def valid_harvest_slug(slug: Column) -> Column:
    return F.octet_length(slug).between(3, 50) & slug.rlike(r"^[a-z][a-z0-9\-]{1,49}$") & ~slug.isin(*rules.SLUG_EXACT) & ~urls.contains_any(slug, rules.SLUG_PARTS) & ~slug.startswith("xn--")


def blocked_slug(slug: Column) -> Column:
    """The first reason against a slug from a certificate; null if there is none."""
    out = F.when(slug.rlike("^[0-9]"), "starts with digit").when(F.length(slug) - F.length(F.replace(slug, F.lit("-"), F.lit(""))) > 3, ">3 hyphens").when(~slug.rlike(r"^[a-z0-9][a-z0-9\-]{1,49}[a-z0-9]$"), "regex mismatch")
    for part in rules.CERTIFICATE_PARTS:
        out = out.when(slug.contains(part), f"contains {part}")
    for name in rules.CERTIFICATE_EXACT:
        out = out.when(slug == name, f"exact {name}")
    return out


def certificate_slug(line: Column, domain: str) -> Column:
    """A certificate's name without wildcard and the platform's domain."""
    s = F.regexp_replace(F.trim(line), r"^\*\.", "")
    return F.regexp_replace(s, "\\Q." + domain + "\\E$", "")


def first_label(line: Column, domain: str) -> Column:
    """The other harvest's form: what precedes the domain, its first label, lower-cased."""
    s = F.regexp_replace(F.trim(line), r"^\*\.", "")
    at = F.instr(s, "." + domain)
    return F.lower(F.split_part(F.when(at > 1, F.substring(s, F.lit(1), at - 1)).otherwise(s), F.lit("."), F.lit(1)))


def salary(raw: Column) -> Column:
    """Struct of currency, min, max; 0 for what is missing."""
    group = lambda k: F.regexp_extract(raw, rules.SALARY, k)
    number = lambda k: F.coalesce(F.try_to_number(F.nullif(F.replace(group(k), F.lit(","), F.lit("")), F.lit("")), F.lit("9" * 18)).cast("double"), F.lit(0.0))
    return F.struct(F.trim(group(1)).alias("currency"), number(2).alias("min"), number(3).alias("max"))


def employment_type(raw: Column, known: dict[str, str] | None = None) -> Column:
    low = F.lower(raw)
    out = F.when(raw == "", F.lit(""))
    for k, v in (known or {}).items():
        out = out.when(raw == k, F.lit(v))
    return out.when(low.contains("full"), "full_time").when(low.contains("part"), "part_time").when(low.contains("contract") | low.contains("freelance"), "contract").when(low.contains("intern"), "internship").otherwise(F.lower(F.replace(raw, F.lit(" "), F.lit("_"))))


def public_ref(identifier: Column) -> Column:
    return F.concat(F.lit("src_"), F.replace(identifier, F.lit("-"), F.lit("")))


def occurrences(s: Column, part: str) -> Column:
    return F.floor((F.length(s) - F.length(F.replace(s, F.lit(part), F.lit("")))) / len(part)).cast("long")


def job_count_guess(body: Column) -> Column:
    """Titles in a body, or ids where there are none."""
    titles = occurrences(body, '"title"')
    return F.when(titles > 0, titles).otherwise(occurrences(body, '"id"'))


def left_chars(s: Column, n: int) -> Column:
    return F.substring(s, 1, n)


def byte_preview(s: Column, n: int = 2048) -> Column:
    """At most so many bytes, cut before a character that would not fit."""
    cuts = [F.substring(s.cast("binary"), 1, n - k).cast("string") for k in range(4)]
    return F.when(F.octet_length(s) <= n, s).otherwise(F.coalesce(*(F.when(F.is_valid_utf8(x), x) for x in cuts)))


def _pretty(values: pd.Series, lengths: pd.Series) -> pd.Series:
    def one(x, n):
        try:
            return json.dumps(json.loads(x), indent=2, ensure_ascii=False)[:n]
        except (TypeError, ValueError):
            return x if x is None else x[:n]

    return pd.Series([one(x, n) for x, n in zip(values, lengths, strict=True)])


def json_preview(body: Column, n: int = 1500) -> Column:
    """Indented JSON, or the text where it isn't JSON, cut to so many characters: for people to read."""
    ship_package(SparkSession.active())
    return F.pandas_udf(_pretty, "string")(body, F.lit(n))


def trigrams(s: Column) -> Column:
    """Distinct trigrams of a lower-cased text with two blanks before it and one behind."""
    padded = F.concat(F.lit("  "), F.lower(s), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all of both."""
    return F.size(F.array_intersect(trigrams(a), trigrams(b))) / F.size(F.array_union(trigrams(a), trigrams(b)))


def links(html: Column) -> Column:
    """Values of href, src and action, then script redirects, in order."""
    return F.concat(F.regexp_extract_all(html, F.lit(rules.LINKS), F.lit(1)), F.regexp_extract_all(html, F.lit(rules.REDIRECTS), F.lit(1)))


def link_platform(html: Column) -> Column:
    """Struct of platform and slug by the first link that a platform's host stands in; null if none does."""

    def one(u: Column) -> Column:
        low = F.lower(u)
        out = F.when(F.lit(False), F.struct(F.lit("").alias("platform"), F.lit("").alias("slug")))
        for name, part, pattern in rules.LINK_PATTERNS:
            slug = F.regexp_extract(u, pattern, 1)
            if name == "workday":
                board = F.regexp_extract(u, pattern, 2)
                slug = F.concat(slug, F.when(board != "", F.concat(F.lit("|"), board)).otherwise(""))
            out = out.when(low.contains(part), F.struct(F.lit(name).alias("platform"), slug.alias("slug")))
        return out

    return F.get(F.filter(F.transform(links(html), one), lambda x: x.isNotNull()), 0)


def _script(html: Column, attribute: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<script[^>]*{attribute}[^>]*>(.*?)</script>"), F.lit(1))


def _payload_url(html: Column) -> Column:
    """The first job API address among the strings of the framework's data script, in document order."""
    strings = F.regexp_extract_all(F.replace(F.concat_ws("\n", _script(html, r"id=[\"']?__NEXT_DATA__[\"']?")), F.lit("\\/"), F.lit("/")), F.lit(r'"(http[^"]*)"'), F.lit(1))
    return F.get(F.filter(strings, lambda x: urls.contains_any(F.lower(x), rules.PAYLOAD_HOSTS + rules.PAYLOAD_PATHS)), 0)


def _policy_host(html: Column) -> Column:
    """The first platform address in the connect-src part of a page's content security policy."""
    tag = F.regexp_extract(html, r"""(?is)<meta[^>]*http-equiv=["']content-security-policy["'][^>]*>""", 0)
    content = F.when(tag.rlike(r'(?is)content="'), F.regexp_extract(tag, r'(?is)content="([^"]*)"', 1)).otherwise(F.regexp_extract(tag, r"(?is)content='([^']*)'", 1))
    tokens = F.split(F.trim(F.regexp_extract(content, r"(?is)connect-src([^;]*)", 1)), r"\s+")
    hit = F.get(F.filter(tokens, lambda t: urls.contains_any(F.lower(t), rules.POLICY_HOSTS)), 0)
    return F.when(hit.startswith("http"), hit).otherwise(F.concat(F.lit("https://"), F.regexp_replace(hit, "^//", "")))


def _posting_url(html: Column, domain: Column) -> Column:
    """The address of the first schema.org job posting, at a script's root or in its graph."""
    address = lambda x: F.coalesce(F.nullif(F.get_json_object(x, "$.url"), F.lit("")), F.nullif(F.get_json_object(x, "$['@id']"), F.lit("")), F.concat(F.lit("https://"), domain))
    kind = lambda x: F.get_json_object(x, "$['@type']")
    graph = lambda s: F.filter(F.coalesce(F.from_json(F.get_json_object(s, "$['@graph']"), "array<string>"), F.array().cast("array<string>")), lambda x: kind(x) == "JobPosting")
    found = F.transform(_script(html, r"type=[\"']application/ld\+json[\"']"), lambda s: F.when(kind(s).isin("JobPosting", "JobPostingList"), address(s)).otherwise(address(F.get(graph(s), 0))))
    found = F.zip_with(_script(html, r"type=[\"']application/ld\+json[\"']"), found, lambda s, a: F.when(kind(s).isin("JobPosting", "JobPostingList") | (F.size(graph(s)) > 0), a))
    return F.get(F.array_compact(found), 0)


def endpoint_matches(html: Column, domain: Column, extra: tuple[tuple[str, str, Callable[[Column, Column], Column]], ...] = ()) -> Column:
    """Array of (pattern, method, url) in declared order; only http(s) addresses count.

    ``extra`` are the caller's own: a name, a method, and a function of page and domain that gives an address or null.
    """
    rows = []
    for name, method, pattern, relative in rules.ENDPOINTS:
        hit = F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
        rows.append((name, method, urls.absolute(hit, domain) if relative else hit))
    preconnect = F.nullif(F.regexp_extract(html, rules.PRECONNECT, 1), F.lit(""))
    rows += [("nextjs_data", "GET", _payload_url(html)), ("preconnect", "GET", urls.origin(preconnect)), ("csp_meta", "GET", _policy_host(html)), ("schema_org_jobs", "GET", _posting_url(html, domain))]
    rows += [(name, method, find(html, domain)) for name, method, find in extra]
    made = [F.when(u.isNotNull() & urls.is_http(u), F.struct(F.lit(n).alias("pattern"), F.lit(m).alias("method"), u.alias("url"))) for n, m, u in rows]
    return F.array_compact(F.array(*made))
