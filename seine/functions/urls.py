"""URL parts by the RFC 3986 regular expression (parse_url fails on blanks and underscores), and tests on them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"


def contains_any(s: Column, parts: tuple[str, ...]) -> Column:
    """Whether one of a fixed list's entries stands in ``s``; false for an empty list."""
    return reduce(or_, (s.contains(x) for x in parts), F.lit(False))


def ends_with_any(s: Column, parts: tuple[str, ...]) -> Column:
    return reduce(or_, (s.endswith(x) for x in parts), F.lit(False))


def starts_with_any(s: Column, parts: tuple[str, ...]) -> Column:
    return reduce(or_, (s.startswith(x) for x in parts), F.lit(False))


def first_part(s: Column, parts: tuple[tuple[str, str], ...], default: str | None) -> Column:
    """The value of the first (part, value) whose part stands in ``s``."""
    out = F.when(F.lit(False), F.lit(""))
    for part, value in parts:
        out = out.when(s.contains(part), F.lit(value))
    return out.otherwise(F.lit(default))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, PARTS, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 4)


def host_with_port(url: Column) -> Column:
    """Lower-cased, without user information."""
    return F.lower(F.regexp_replace(authority(url), r"^[^@]*@", ""))


def hostname(url: Column) -> Column:
    """Without user information and port."""
    return F.regexp_replace(host_with_port(url), r":\d*$", "")


def bare_host(url: Column) -> Column:
    """With port, without a leading ``www.``."""
    return F.regexp_replace(host_with_port(url), r"^www\.", "")


def api_domain(url: Column) -> Column:
    """Between ``://`` and the next slash, a query included where no slash precedes it."""
    return F.split_part(F.split_part(url, F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))


def segments(p: Column) -> Column:
    """Of a path trimmed of slashes; a path without any has one empty segment."""
    return F.split(F.regexp_replace(p, r"^/+|/+$", ""), "/")


def depth(p: Column) -> Column:
    """Segments of a path, none for an empty one."""
    return F.when(F.regexp_replace(p, r"^/+|/+$", "") == "", 0).otherwise(F.size(segments(p)))


def slash_count(p: Column) -> Column:
    return F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))


def query_keys(q: Column) -> Column:
    """Distinct keys of a query, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(q, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1))), lambda k: k != ""))


def is_http(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def absolute(url: Column, domain: Column) -> Column:
    """What starts with ``http`` as it is, else behind https and the domain, with no slash added."""
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), domain, url))


def origin(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), authority(url))


def stripped(domain: Column) -> Column:
    """Without protocol and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(domain, "^http://", ""), "^https://", ""), "/+$", "")


def is_ats(url: Column, domains: tuple[str, ...] = rules.ATS_DOMAINS) -> Column:
    return contains_any(F.lower(url), domains)


def is_junk(url: Column) -> Column:
    u = F.lower(url)
    return contains_any(u, rules.JUNK) | u.endswith(".js") | u.contains(".js?") | u.contains(".js#")


def is_blocked_response(url: Column) -> Column:
    """Exemptions concern the domain rule alone; extensions the path alone."""
    u = F.lower(url)
    return (
        (contains_any(u, rules.RESPONSE_DOMAINS) & ~contains_any(u, rules.RESPONSE_EXEMPT))
        | contains_any(u, rules.RESPONSE_NOISE)
        | (u.contains("_next/data") & ~contains_any(u, rules.RESPONSE_JOB_WORDS))
        | ends_with_any(path(u), rules.RESPONSE_EXTENSIONS)
    )


def is_blocked_request(url: Column) -> Column:
    u = F.lower(url)
    return (
        ends_with_any(u, rules.REQUEST_EXTENSIONS)
        | contains_any(u, tuple(f"{x}?" for x in rules.REQUEST_EXTENSIONS))
        | contains_any(u, rules.REQUEST_DOMAINS)
        | contains_any(u, rules.REQUEST_PARAMS)
        | (~contains_any(u, rules.REQUEST_EXEMPT) & contains_any(u, rules.REQUEST_SEGMENTS))
    )


def is_blocked_content_type(content_type: Column) -> Column:
    return F.lower(content_type).contains("text/html")


def is_json_content_type(content_type: Column) -> Column:
    return content_type.contains("application/json") | content_type.contains("text/javascript")


def is_kept_resource(kind: Column) -> Column:
    return ~kind.isin(*rules.BLOCKED_TYPES) & kind.isin(*rules.KEPT_TYPES)


def is_social(domain: Column) -> Column:
    return contains_any(F.lower(domain), rules.SOCIAL)


def platform(url: Column) -> Column:
    return first_part(url, rules.PLATFORM_PARTS, "custom")


def migrated_platform(url: Column) -> Column:
    return first_part(url, rules.MIGRATED_PARTS, "unknown")


def _by_platform(ats: Column, formats: dict[str, str], slug: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, form in formats.items():
        out = out.when(ats == name, F.format_string(form, slug))
    return out


def platform_domain(ats: Column, slug: Column) -> Column:
    return _by_platform(ats, rules.PLATFORM_DOMAINS, slug).otherwise(slug)


def endpoint(ats: Column, slug: Column) -> Column:
    """The API URL of a slug; every ashby slug shares one; null for an unknown platform."""
    return _by_platform(ats, rules.PLATFORM_ENDPOINTS, slug).when(ats == "ashby", F.lit("https://jobs.ashbyhq.com/api/non-user-graphql?op=ApiJobBoardWithTeams"))


def endpoint_method(ats: Column) -> Column:
    return F.when(ats.isin("ashby", "workable"), "POST").otherwise("GET")


def with_content(url: Column) -> Column:
    """Asks for full job texts."""
    return F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit("content=true"))


def career_candidates(domain: Column) -> Column:
    d = stripped(domain)
    return F.array(*(F.concat(F.lit(a), d, F.lit(b)) for a, b in (("https://", "/careers"), ("https://", "/jobs"), ("https://", "/about/careers"), ("https://", "/company/careers"), ("https://", "/en/careers"), ("https://careers.", ""), ("https://jobs.", ""))))


def career_url(domain: Column) -> Column:
    return F.concat(F.lit("https://"), domain, F.when(domain.contains("career") | domain.contains("job"), "").otherwise("/careers"))


def http_status(code: Column, timed_out: Column) -> Column:
    return F.when(timed_out, "timeout").when(code.between(200, 299), "reachable").when(code.between(300, 399), "redirect").otherwise("dead")


def canonical(url: Column) -> Column:
    """Struct of canonical, ats, board, or null where the URL is to be skipped."""
    host = F.regexp_replace(host_with_port(url), r"^www\.", "")
    parts = segments(path(url))
    first, last = F.get(parts, 0), F.element_at(parts, -1)
    item = last.rlike(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$") | last.rlike(r"^[0-9]+$")
    made = lambda where, ats, board: F.struct(where.alias("canonical"), ats.alias("ats"), board.alias("board"))
    none, empty = F.lit(None).cast("struct<canonical:string,ats:string,board:string>"), F.lit("")
    keep = F.when((F.size(parts) > 1) & first.isin("en", "uk", "us", "corporate"), 2).otherwise(1)
    company = F.when(first == "", made(F.concat(F.lit("https://"), host), empty, empty)).otherwise(made(F.concat(F.lit("https://"), host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), keep), "/")), empty, empty))
    out = F.when(contains_any(host_with_port(url), rules.ARCHIVE_AGGREGATORS) | item, none)
    for ats, domain in rules.ARCHIVE_PLATFORMS:
        sub = F.when(host.endswith("." + domain), F.substring(host, F.lit(1), F.length(host) - len(domain) - 1)).otherwise(host)
        blocked = sub.isin(*rules.OPERATIONAL_HOSTS) | sub.startswith("app") | sub.startswith("api")
        shared = F.when((first == "") | first.isin("jobs", "careers", "careersection"), F.when(first == "", made(F.concat(F.lit("https://"), host, F.lit("/")), F.lit(ats), empty)).otherwise(none)).otherwise(made(F.concat(F.lit("https://"), host, F.lit("/"), first), F.lit(ats), first))
        own = made(F.concat(F.lit("https://"), host), F.lit(ats), sub)
        out = out.when(host.endswith(domain), F.when((sub == host) | blocked, none).when(sub.isin(*rules.SHARED_HOSTS), shared).otherwise(own))
    return out.otherwise(company)
