"""More registered queries: every platform, page patterns, URL tests, mutations, files and streams.

Many take made-up cases, one for each row by its number, whose right answers stand beside them
and are all that the SQL knows: ``@`` in a case stands for the row's number.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsons, rules, scoring, text, times, urls
from ..operators import bloom, capturing, features, merge, parse, probing, reports, routing, schedule, urllists
from ..sources import acquire, readers, writers
from ..streaming import pipelines
from . import catalogue as C
from . import tables as T
from .catalogue import query


def quoted(x) -> str:
    return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"


def picked(key: str, values: list) -> Column:
    """The value whose turn it is for a row's number, with the number in it."""
    one = F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))
    return F.replace(one, F.lit("@"), F.col(key).cast("string")) if isinstance(next(x for x in values if x is not None), str) else one


def picked_sql(key: str, values: list, kind: str = "") -> str:
    one = f"list_element([{', '.join(map(quoted, values))}], CAST({key} % {len(values)} + 1 AS INT))"
    one = f"replace({one}, '@', CAST({key} AS VARCHAR))" if isinstance(next(x for x in values if x is not None), str) else one
    return f"CAST({one} AS {kind})" if kind else one


# URL tests.

HOSTS = (rules.RESPONSE_DOMAINS[0], rules.RESPONSE_EXEMPT[0], rules.REQUEST_DOMAINS[0], rules.REQUEST_DOMAINS[-1], rules.REQUEST_EXEMPT[0], "plain.example", "www.linkedin.com", "Boards.Greenhouse.io")
TAILS = ("/jobs", "/a.css", "/a.PNG?x=1", rules.RESPONSE_NOISE[0], "/_next/data/x", "/_next/data/jobs/x", rules.REQUEST_SEGMENTS[0], "/x?" + rules.REQUEST_PARAMS[0], "/a.woff2", "/api/v1/jobs.js")


@query(f"""WITH u AS (SELECT p_partkey, lower('https://' || list_element([{", ".join(map(quoted, HOSTS))}], CAST(p_partkey % {len(HOSTS)} + 1 AS INT)) || list_element([{", ".join(map(quoted, TAILS))}], CAST((p_partkey // 8) % {len(TAILS)} + 1 AS INT))) u FROM part),
p AS (SELECT *, regexp_extract(u, '^https://[^/?#]*([^?#]*)', 1) path FROM u)
SELECT p_partkey, ({C.contains("u", rules.RESPONSE_DOMAINS)} AND NOT {C.contains("u", rules.RESPONSE_EXEMPT)}) OR {C.contains("u", rules.RESPONSE_NOISE)} OR (contains(u, '_next/data') AND NOT {C.contains("u", rules.RESPONSE_JOB_WORDS)}) OR {C.ends("path", rules.RESPONSE_EXTENSIONS)} response,
{C.ends("u", rules.REQUEST_EXTENSIONS)} OR {C.contains("u", tuple(x + "?" for x in rules.REQUEST_EXTENSIONS))} OR {C.contains("u", rules.REQUEST_DOMAINS)} OR {C.contains("u", rules.REQUEST_PARAMS)} OR (NOT {C.contains("u", rules.REQUEST_EXEMPT)} AND {C.contains("u", rules.REQUEST_SEGMENTS)}) request,
p_partkey % 3 = 0 content_type, {C.contains("u", rules.SOCIAL)} social FROM p""")
def blocked_urls(spark, sf):
    part = lambda values, key: F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))
    number = F.col("p_partkey")
    url = F.concat(F.lit("https://"), part(HOSTS, number), part(TAILS, F.floor(number / 8)))
    kind = F.when(number % 3 == 0, "Text/HTML; charset=utf-8").otherwise("application/json")
    rows = T.read(spark, sf, "part").select("p_partkey", url.alias("u"), kind.alias("k"))
    return rows.select("p_partkey", urls.is_blocked_response(F.col("u")).alias("response"), urls.is_blocked_request(F.col("u")).alias("request"), urls.is_blocked_content_type(F.col("k")).alias("content_type"), urls.is_social(F.col("u")).alias("social"))


ADDRESSES = [
    ("https://a@.example.com/careers", True, "https://a@.example.com", "a@.example.com/careers", "https://a@.example.com/careers"),
    ("http://jobs.example.com:8080/x@/", True, "http://jobs.example.com:8080", "jobs.example.com:8080/x@", "http://jobs.example.com:8080/x@/"),
    ("ftp://files.example.com/@", False, "ftp://files.example.com", "ftp://files.example.com/@", "https://d@.example.comftp://files.example.com/@"),
    ("/api/jobs?x=@", False, "://", "/api/jobs?x=@", "https://d@.example.com/api/jobs?x=@"),
    ("HTTPS://Host.Example.com//", True, "https://Host.Example.com", "HTTPS://Host.Example.com", "https://d@.example.comHTTPS://Host.Example.com//"),
    ("api/x@", False, "://", "api/x@", "https://d@.example.comapi/x@"),
]


@query(f"""SELECT page_id, {picked_sql("page_id", [x[1] for x in ADDRESSES])} http, {picked_sql("page_id", [x[2] for x in ADDRESSES])} origin, {picked_sql("page_id", [x[3] for x in ADDRESSES])} stripped, {picked_sql("page_id", [x[4] for x in ADDRESSES])} absolute,
CASE page_id % 3 WHEN 0 THEN 'https://careers' || page_id || '.example.com' WHEN 1 THEN 'https://jobs' || page_id || '.example.com' ELSE 'https://d' || page_id || '.example.com/careers' END career FROM pages""")
def address_parts(spark, sf):
    u, number = F.col("u"), F.col("page_id").cast("string")
    rows = T.read(spark, sf, "pages").select("page_id", picked("page_id", [x[0] for x in ADDRESSES]).alias("u"), F.concat(picked("page_id", ["careers", "jobs", "d"]), number, F.lit(".example.com")).alias("d"))
    return rows.select("page_id", urls.is_http(u).alias("http"), urls.origin(u).alias("origin"), urls.stripped(u).alias("stripped"), urls.absolute(u, F.concat(F.lit("d"), number, F.lit(".example.com"))).alias("absolute"), urls.career_url(F.col("d")).alias("career"))


ATS = [*rules.PLATFORM_DOMAINS, "other"]


@query(f"""WITH a AS (SELECT c_custkey, 'co' || c_custkey slug, list_element([{", ".join(map(quoted, ATS))}], CAST(c_custkey % {len(ATS)} + 1 AS INT)) ats FROM customer)
SELECT c_custkey, CASE ats {" ".join(f"WHEN '{k}' THEN replace('{v}', '%s', slug)" for k, v in rules.PLATFORM_DOMAINS.items())} ELSE slug END AS "domain",
CASE ats {" ".join(f"WHEN '{k}' THEN replace('{v}', '%s', slug)" for k, v in rules.PLATFORM_ENDPOINTS.items())} WHEN 'ashby' THEN 'https://jobs.ashbyhq.com/api/non-user-graphql?op=ApiJobBoardWithTeams' END api_url, CASE WHEN ats IN ('ashby', 'workable') THEN 'POST' ELSE 'GET' END AS "method",
CASE WHEN ats = 'greenhouse' THEN 'https://boards-api.greenhouse.io/v1/boards/' || slug || '/jobs?content=true' WHEN ats = 'ashby' THEN 'https://jobs.ashbyhq.com/api/non-user-graphql?op=ApiJobBoardWithTeams' {" ".join(f"WHEN ats = '{k}' THEN replace('{v}', '%s', slug)" for k, v in rules.PLATFORM_ENDPOINTS.items() if k != "greenhouse")} END request,
CASE WHEN ats = 'greenhouse' THEN slug END board FROM a""")
def platform_endpoints(spark, sf):
    ats, slug = F.col("ats"), F.col("slug")
    rows = T.read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("co"), "c_custkey").alias("slug"), picked("c_custkey", ATS).alias("ats"))
    rows = rows.withColumn("api_url", urls.endpoint(ats, slug))
    return rows.select("c_custkey", urls.platform_domain(ats, slug).alias("domain"), "api_url", urls.endpoint_method(ats).alias("method"), capturing.request_url(ats, F.col("api_url")).alias("request"), F.when(ats == "greenhouse", capturing.board_slug(F.col("api_url"))).alias("board"))


MIGRATED = [p for p, _ in rules.MIGRATED_PARTS] + ["nowhere.example", "greenhouse.com"]


@query(f"""SELECT c_custkey, {picked_sql("c_custkey", [v for _, v in rules.MIGRATED_PARTS] + ["unknown", "unknown"])} platform FROM customer""")
def migrated_platforms(spark, sf):
    url = F.concat(F.lit("https://x."), picked("c_custkey", MIGRATED), F.lit("/jobs"))
    return T.read(spark, sf, "customer").select("c_custkey", urls.migrated_platform(url).alias("platform"))


RANKED = [
    ("https://acme.greenhouse.io/x", 40, "Known Global ATS Subdomain (+40)"), ("https://careers.acme.example/x", 20, "Dedicated Careers Subdomain (+20)"), ("https://acme.example/about/careers", 15, "Careers/Jobs contained in path (+15)"),
    ("https://acme.keka.com", 15, "Known Indian ATS (+15)"), ("https://found.example/x", 25, "Previously Discovered API (+25)"), ("https://labelled.example/", 20, "Exists in label=1 Captures (+20)"),
    ("https://jobs.lever.co/jobs", 75, "Known Global ATS Subdomain (+40);Dedicated Careers Subdomain (+20);Careers/Jobs contained in path (+15)"), ("https://plain.example", 0, ""),
    ("https://www.both.example/careers", 60, "Careers/Jobs contained in path (+15);Previously Discovered API (+25);Exists in label=1 Captures (+20)"),
]


@query(f"""SELECT page_id, {picked_sql("page_id", [x[1] for x in RANKED], "INT")} score, {picked_sql("page_id", [x[2] for x in RANKED])} signals FROM pages""")
def url_rank_signals(spark, sf):
    pages = T.read(spark, sf, "pages").select("page_id", picked("page_id", [x[0] for x in RANKED]).alias("url"))
    hosts = lambda *some: spark.createDataFrame([(h,) for h in some], "domain string")
    out = urllists.ranked_urls(pages, hosts("found.example", "both.example"), hosts("labelled.example", "both.example"))
    return out.select("page_id", "score", F.array_join("signals", ";").alias("signals"))


@query("""SELECT page_id, 'own POST https://own.example/' || page_id AS found FROM pages""")
def own_page_pattern(spark, sf):
    """A pattern of the caller's own beside the fixed ones."""
    html = F.concat(F.lit("<i own="), F.col("page_id").cast("string"), F.lit(">"))
    own = lambda page, _: F.concat(F.lit("https://own.example/"), F.nullif(F.regexp_extract(page, "own=([0-9]+)", 1), F.lit("")))
    rows = T.read(spark, sf, "pages").select("page_id", text.endpoint_matches(html, F.lit("d.example"), (("own", "POST", own), ("none", "GET", lambda *_: F.lit(None).cast("string")))).alias("m"))
    return rows.select("page_id", F.array_join(F.transform("m", lambda m: F.concat_ws(" ", m["pattern"], m["method"], m["url"])), ",").alias("found"))


@query("""WITH s AS (SELECT CASE WHEN o_totalprice > 490000 THEN 'timeout' WHEN o_orderkey % 600 BETWEEN 200 AND 299 THEN 'reachable' WHEN o_orderkey % 600 BETWEEN 300 AND 399 THEN 'redirect' ELSE 'dead' END AS status FROM orders) SELECT status, count(*) n FROM s GROUP BY 1""")
def validation_statuses(spark, sf):
    status = urls.http_status((F.col("o_orderkey") % 600).cast("int"), F.col("o_totalprice") > 490000)
    return reports.counts_by(T.read(spark, sf, "orders").select(status.alias("status")), "status")


@query("SELECT o_orderpriority AS ats_platform, count(*) n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1")
def sources_per_platform(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "degraded").otherwise("retired")
    rows = T.read(spark, sf, "orders").select(F.col("o_orderpriority").alias("ats_platform"), status.alias("status"))
    return reports.counts_by(rows.where(F.col("status").isin("active", "degraded")), "ats_platform")


@query(f"WITH {T.NEAR}, o AS (SELECT date_trunc('day', captured_at) run, id FROM captures JOIN near USING (id) WHERE near.label IS NULL) SELECT strftime(run, '%Y%m%d_%H%M%S') run, count(*) n FROM o GROUP BY 1")
def near_misses_per_run(spark, sf):
    near = T.near_misses(spark, sf).where("label is null").select("id")
    rows = T.captures(spark, sf).join(near, "id").select(times.run_id(F.date_trunc("day", F.col("captured_at"))).alias("run"))
    return reports.counts_by(rows, "run")


LOOKS = [('{"a": 1}', True), ("  \n [1]", True), ("plain @", False), ("", False), ("<html>", False), ('"{"', False), (None, False)]


@query(f"SELECT page_id, {picked_sql('page_id', [x[1] for x in LOOKS])} json FROM pages")
def looks_like_json(spark, sf):
    return T.read(spark, sf, "pages").select("page_id", jsons.looks_like_json(picked("page_id", [x[0] for x in LOOKS])).alias("json"))


# Pages.

LINKS = [
    ('<a href="https://boards.greenhouse.io/acme@/jobs/1">x</a>', "greenhouse", "acme@"),
    ('<a HREF = "https://jobs.lever.co/acme@/x">', "lever", "acme@"),
    ("<a href='https://acme@.wd5.myworkdayjobs.com/en-US/Board@'>", "workday", "acme@|Board@"),
    ('<a href="https://careers.smartrecruiters.com/Acme@">', "smartrecruiters", "Acme@"),
    ('<iframe src="https://jobs.ashbyhq.com/acme@">', "ashby", "acme@"),
    ('<a href="https://acme@.recruitee.com/">', "recruitee", "acme@"),
    ('<a href="https://acme@.pinpointhq.com/">', "pinpoint", "acme@"),
    ('<a href="https://acme@.freshteam.com/jobs">', "freshteam", "acme@"),
    ('<a href="https://acme@-careers.rippling.com/x">', "rippling", "acme@-careers"),
    ('<a href="https://acme@.teamtailor.com/jobs">', "teamtailor", "acme@"),
    ('<a href="https://jobs.jobvite.com/company/acme@">', "jobvite", "acme@"),
    ('<a href="https://acme@.breezy.hr/p/1">', "breezyhr", "acme@"),
    ('<a href="https://acme@.jobs.personio.de/">', "personio", "acme@"),
    ('<form action="https://apply.workable.com/acme@/">', "workable", "acme@"),
    ('<a href="https://acme@.bamboohr.com/careers">', "bamboohr", "acme@"),
    ('<script>window.location = "https://jobs.lever.co/acme@"</script>', "lever", "acme@"),
    ('<a href="/x"><a href="https://jobs.lever.co/a@"><a href="https://boards.greenhouse.io/b@">', "lever", "a@"),
    ('<a href="/jobs/@">', None, None),
]


@query(f"SELECT page_id, {picked_sql('page_id', [x[1] for x in LINKS])} platform, {picked_sql('page_id', [x[2] for x in LINKS])} slug FROM pages")
def page_platforms(spark, sf):
    rows = T.read(spark, sf, "pages").select("page_id", F.concat("html", picked("page_id", [x[0] for x in LINKS])).alias("h"))
    return rows.select("page_id", text.link_platform(F.col("h")).alias("p")).select("page_id", "p.platform", "p.slug")


PATTERNS = [
    ('<script>fetch("https://boards-api.greenhouse.io/v1/boards/acme@/jobs?x=1")</script>', "greenhouse GET https://boards-api.greenhouse.io/v1/boards/acme@/jobs?x=1"),
    ('<script>fetch("https://api.lever.co/v0/postings/acme@?mode=json")</script>', "lever GET https://api.lever.co/v0/postings/acme@?mode=json"),
    ('<script>u="https://acme@.wd1.myworkdayjobs.com/wday/cxs/acme/jobs"</script>', "workday GET https://acme@.wd1.myworkdayjobs.com/wday/cxs/acme/jobs"),
    ('<script>u="https://api.ashbyhq.com/posting-api/job-board/acme@"</script>', "ashby GET https://api.ashbyhq.com/posting-api/job-board/acme@"),
    ('<script>fetch("/api/v2/jobs?page=@")</script>', "generic_api GET https://d@.example.com/api/v2/jobs?page=@"),
    ("<script>post('/graphql?op=@')</script>", "graphql POST https://d@.example.com/graphql?op=@"),
    ('<script>u="https://api.smartrecruiters.com/v1/companies/acme@/postings?limit=10"</script>', "smartrecruiters GET https://api.smartrecruiters.com/v1/companies/acme@/postings?limit=10"),
    ('<script>u="https://acme@.bamboohr.com/api/gateway.php/acme/v1/applicant_tracking/jobs"</script>', "bamboohr GET https://acme@.bamboohr.com/api/gateway.php/acme/v1/applicant_tracking/jobs"),
    ('<script>u="https://app.jobvite.com/api/website/jobs?c=@"</script>', "jobvite GET https://app.jobvite.com/api/website/jobs?c=@"),
    ('<script>u="https://careers-acme@.icims.com/jobs/search"</script>', "icims GET https://careers-acme@.icims.com/jobs/search"),
    ('<script id="__NEXT_DATA__" type="application/json">{"props": {"a": "http://x.example/none", "u": "https:\\/\\/api.lever.co\\/v0\\/other\\/acme@"}}</script>', "nextjs_data GET https://api.lever.co/v0/other/acme@"),
    ('<link rel="preconnect" href="https://acme@.teamtailor.com/x">', "preconnect GET https://acme@.teamtailor.com"),
    ('<meta http-equiv="Content-Security-Policy" content="default-src self; connect-src self api.Personio.de/acme@ https://x.example">', "csp_meta GET https://api.Personio.de/acme@"),
    ('<script type="application/ld+json">{"@type": "JobPosting", "url": "https://jobs.example/p"}</script>', "schema_org_jobs GET https://jobs.example/p"),
    ('<script type="application/ld+json">{"@graph": [{"@type": "Organization"}, {"@type": "JobPosting", "@id": "https://jobs.example/id"}]}</script>', "schema_org_jobs GET https://jobs.example/id"),
    ('<script type="application/ld+json">{"@type": "JobPosting"}</script>', "schema_org_jobs GET https://d@.example.com"),
    ('<script>fetch("/api/v1/jobs"); u="https://api.lever.co/v0/postings/acme"</script>', "lever GET https://api.lever.co/v0/postings/acme,generic_api GET https://d@.example.com/api/v1/jobs"),
    ("<p>none</p>", ""),
]


def _at_kept(values: list[str]) -> Column:
    """Like ``picked``, but with ``"@type`` and the like left as they are."""
    marked = [x.replace('"@', '"\x01') for x in values]
    return F.replace(picked("page_id", marked), F.lit("\x01"), F.lit("@"))


@query(f"SELECT page_id, {picked_sql('page_id', [x[1] for x in PATTERNS])} found FROM pages")
def page_endpoints(spark, sf):
    domain = F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit(".example.com"))
    rows = T.read(spark, sf, "pages").select("page_id", F.concat("html", _at_kept([x[0] for x in PATTERNS])).alias("h"), domain.alias("d"))
    return rows.select("page_id", F.array_join(F.transform(text.endpoint_matches(F.col("h"), F.col("d")), lambda m: F.concat_ws(" ", m["pattern"], m["method"], m["url"])), ",").alias("found"))


@query("""SELECT doc_id, CASE WHEN octet_length(encode(text)) <= 2048 THEN text END whole, octet_length(encode(text)) > 2048 cut, (SELECT max(octet_length(encode(left(text, k)))) FROM range(0, 2049) r(k) WHERE octet_length(encode(left(text, k))) <= 2048) bytes, left(text, 255) short FROM documents WHERE text IS NOT NULL""")
def body_previews(spark, sf):
    rows = T.read(spark, sf, "documents").where("text is not null").select("doc_id", "text", text.byte_preview(F.col("text")).alias("p"))
    return rows.select("doc_id", F.when(F.octet_length("text") <= 2048, F.col("p")).alias("whole"), (F.col("p") != F.col("text")).alias("cut"), F.octet_length("p").cast("long").alias("bytes"), text.left_chars(F.col("text"), 255).alias("short"))


@query("""SELECT event_id, '{' || chr(10) || '  "k": ' || json_extract_string(props, '$.k') || chr(10) || '}' AS shown, 'a' || props bad FROM events""")
def json_previews(spark, sf):
    return T.read(spark, sf, "events").select("event_id", text.json_preview(F.col("props")).alias("shown"), text.json_preview(F.concat(F.lit("a"), "props")).alias("bad"))


@query("""WITH w AS (SELECT p_partkey, lower(p_name) a, lower(split_part(p_name, ' ', 1)) b FROM part), t AS (SELECT p_partkey, list_distinct(list_transform(range(1, length(a) + 2), lambda i: ('  ' || a || ' ')[i:i + 2])) x, list_distinct(list_transform(range(1, length(b) + 2), lambda i: ('  ' || b || ' ')[i:i + 2])) y FROM w)
SELECT p_partkey, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE, 6) alike FROM t""")
def name_similarity(spark, sf):
    return T.read(spark, sf, "part").select("p_partkey", F.round(text.trigram_similarity(F.col("p_name"), F.split_part("p_name", F.lit(" "), F.lit(1))), 6).alias("alike"))


@query(f"""WITH n AS (SELECT l_orderkey source_id, count(*) n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) SELECT source_id, CAST(n AS BIGINT) guess, least(300, greatest(60, n * 50)) ttl, round(n / 7.0::DOUBLE, 6) per_second, NULL::DOUBLE AS none FROM n""")
def job_count_guesses(spark, sf):
    n = F.col("guess")
    rows = T.bodies(spark, sf).select("source_id", text.job_count_guess(F.col("body")).alias("guess"))
    return rows.select("source_id", "guess", times.clamp_ttl(n * 50).alias("ttl"), F.round(times.rate(n.cast("double"), F.lit(7.0)), 6).alias("per_second"), times.rate(n.cast("double"), F.lit(0.0)).alias("none"))


LAYOUTS = [("2024-03-01T10:00:00Z", "2024-03-01 10:00:00"), ("2024-03-01T12:00:00+02:00", "2024-03-01 10:00:00"), ("2024-03-01T10:00:00", "2024-03-01 10:00:00"), ("2024-03-01", "2024-03-01 00:00:00"), ("March 1, 2024", "2024-03-01 00:00:00"), ("1709287200", None), ("soon", None)]


@query(f"SELECT o_orderkey, {picked_sql('o_orderkey', [x[1] for x in LAYOUTS], 'TIMESTAMP')} AS at FROM orders")
def time_layouts(spark, sf):
    return T.read(spark, sf, "orders").select("o_orderkey", times.any_time(picked("o_orderkey", [x[0] for x in LAYOUTS])).cast("timestamp_ntz").alias("at"))


# Bodies: a body for each platform, and what its one job must become.

POSTED, POSTED_MS = "2024-01-02 03:04:05", "2023-11-14 22:13:20"
BODIES = [
    ("greenhouse", '{"jobs": [{"id": 1@, "title": "T @", "location": {"name": "L @"}, "departments": [{"name": "D"}], "absolute_url": "https://u/@", "first_published": "2024-01-02T03:04:05Z"}, {"id": 0, "title": "no id"}, {"id": 5}]}', {"external_id": "1@", "location_raw": "L @", "department": "D", "apply_url": "https://u/@", "posted_at": POSTED}),
    ("lever", '[{"id": "x@", "text": "T @", "categories": {"location": "L @", "team": "D", "commitment": "Full Time"}, "applyUrl": "https://u/@", "createdAt": 1700000000000}]', {"location_raw": "L @", "department": "D", "employment_type": "full_time", "apply_url": "https://u/@", "posted_at": POSTED_MS, "raw_json": '{"applyUrl":"https://u/@","categories":{"commitment":"Full Time","location":"L @","team":"D"},"createdAt":1700000000000,"id":"x@","text":"T @"}'}),
    ("ashby", '{"data": {"jobBoardWithTeams": {"jobPostings": [{"id": "x@", "title": "T @", "locationName": "L @", "teamName": "D", "employmentType": "Intern", "isRemote": true, "jobUrl": "https://u/@"}]}}}', {"location_raw": "L @", "department": "D", "employment_type": "internship", "is_remote": True, "apply_url": "https://u/@"}),
    ("ashbyhq", '{"data": {"jobBoardWithTeams": {"jobPostings": [{"id": "x@", "title": "T @", "isRemote": false}]}}}', {}),
    ("recruitee", '{"offers": [{"id": 1@, "title": "T @", "location": "L @", "department": "D", "remote": true, "url": "https://u/@"}]}', {"external_id": "1@", "location_raw": "L @", "department": "D", "is_remote": True, "apply_url": "https://u/@"}),
    ("freshteam", '{"jobs": [{"id": 1@, "title": "T @", "branch_id": 2, "job_role_id": 3, "remote": false, "url": "https://u/@", "created_at": "2024-01-02T03:04:05Z"}], "branches": [{"id": 2, "city": "old"}, {"id": 2, "city": "C @", "country_code": "XX", "location": "L @"}], "job_roles": [{"id": 3, "name": "D"}]}', {"external_id": "1@", "location_raw": "L @", "city": "C @", "country_code": "XX", "department": "D", "apply_url": "https://u/@", "posted_at": POSTED}),
    ("pinpointhq", '{"data": [{"id": "x@", "title": "T @", "location": {"name": "L @", "city": "C @", "country_code": "XX"}, "job": {"department": {"name": "D"}}, "employment_type": "full time", "workplace_type": "fully_remote", "url": "https://u/@"}]}', {"location_raw": "L @", "city": "C @", "country_code": "XX", "department": "D", "employment_type": "full_time", "is_remote": True, "apply_url": "https://u/@"}),
    ("pinpoint", '{"data": [{"id": 7@, "title": "T @", "workplace_type": "onsite"}]}', {"external_id": "7@"}),
    ("rippling", '[{"uuid": "x@", "name": "T @", "workLocation": {"label": "L @"}, "department": {"label": "D"}, "url": "https://u/@", "employmentType": "PART_TIME"}]', {"location_raw": "L @", "department": "D", "employment_type": "part_time", "apply_url": "https://u/@"}),
    ("teamtailor", '{"data": [{"id": "x@", "attributes": {"title": "T @", "remote-status": "Fully-Remote", "pitch": "P @"}, "links": {"careersite-job-url": "https://u/@"}}]}', {"is_remote": True, "description": "P @", "apply_url": "https://u/@"}),
    ("workable", '{"results": [{"id": 1@, "title": "T @", "location": {"city": "C @", "countryCode": "XX"}, "department": ["D"], "remote": false, "published": "2024-01-02T03:04:05Z", "url": "https://u/@", "employment_type": "Contract"}]}', {"external_id": "1@", "city": "C @", "country_code": "XX", "department": "D", "employment_type": "contract", "apply_url": "https://u/@", "posted_at": POSTED}),
    ("smartrecruiters", '{"content": [{"id": "x@", "name": "T @", "location": {"city": "C @", "country": {"code": "xx"}}, "department": {"label": "D"}, "typeOfEmployment": {"label": "Temporary"}}]}', {"city": "C @", "country_code": "xx", "department": "D", "employment_type": "contract"}),
    ("jobvite", '{"reqList": [{"id": "x@", "title": "T @", "jobRegion": "L @", "jobCategory": "D", "jobType": "Intern", "applyLink": "https://u/@", "publishedDate": 1700000000000}]}', {"location_raw": "L @", "city": "L @", "department": "D", "employment_type": "internship", "apply_url": "https://u/@", "posted_at": POSTED_MS}),
    ("breezyhr", '[{"_id": "x@", "name": "T @", "location": {"name": "L @", "city": "C @", "country": {"id": "XX"}, "is_remote": true}, "department": {"name": "D"}, "type": {"id": "temporary"}, "url": "https://u/@"}]', {"location_raw": "L @", "city": "C @", "country_code": "XX", "department": "D", "employment_type": "contract", "is_remote": True, "apply_url": "https://u/@"}),
    ("personio", '[{"id": 1@, "name": "T @", "office": "L @", "department": "D", "employment_type": "freelance", "url": "https://u/@"}, 5, {"id": 2}]', {"external_id": "1@", "location_raw": "L @", "department": "D", "employment_type": "contract", "apply_url": "https://u/@"}),
    ("own", '{"a": {"list": [{"key": "x@", "head": "T @", "where": "L @", "far": "YES"}]}}', {"location_raw": "L @", "is_remote": True}),
    ("unknown", '[{"id": "x@", "title": "T @"}]', None),
    ("greenhouse", '{"jobs": [{"id": 1@', None),
    ("lever", '{"a": 1}', None),
]
OWN = {"own": {"jobs_path": "a.list", "external_id": "key", "title": "head", "location_raw": "where", "is_remote": "far", "remote_values": ("yes",)}}


def _wanted(field: str) -> list:
    other = {"external_id": "x@", "title": "T @", "is_remote": False, "posted_at": None, "raw_json": None}
    return [(x or {}).get(field, other.get(field, "")) for _, _, x in BODIES]


@query(f"""SELECT p_partkey, {picked_sql("p_partkey", [x[0] for x in BODIES])} platform, {", ".join(f"{picked_sql('p_partkey', _wanted(k), 'TIMESTAMP' if k == 'posted_at' else '')} {k}" for k in parse.FIELDS)}
FROM part WHERE {picked_sql("p_partkey", [x is not None for _, _, x in BODIES])}""")
def parse_every_platform(spark, sf):
    rows = T.read(spark, sf, "part").select("p_partkey", picked("p_partkey", [x[0] for x in BODIES]).alias("platform"), picked("p_partkey", [x[1] for x in BODIES]).alias("body"))
    out = parse.parse_known(rows, ["p_partkey"], OWN)
    return out.select("p_partkey", "platform", *(F.when(F.col("platform") == "lever", F.col(k)).alias(k) if k == "raw_json" else F.col(k).cast("timestamp_ntz").alias(k) if k == "posted_at" else k for k in parse.FIELDS))


@query(f"""WITH {T.ITEMS}, n AS (SELECT count(*) n FROM items) SELECT field, alias, n jobs, 1.0::DOUBLE AS share FROM n, (VALUES ('external_job_id', 'id'), ('title', 'title'), ('location', 'location')) f(field, alias)""")
def inferred_schema(spark, sf):
    return parse.infer_schema(T.bodies(spark, sf).select(F.col("body").alias("raw_json")))


@query("""SELECT DISTINCT url, CASE WHEN contains(url, '/fr/') OR contains(url, '/de/') THEN NULL ELSE 200 END AS status, CASE WHEN contains(url, '/fr/') OR contains(url, '/de/') THEN NULL ELSE url || ' body' END AS body, contains(url, '/fr/') AS timed_out,
CASE WHEN contains(url, '/fr/') THEN 'slow' WHEN contains(url, '/de/') THEN 'ValueError: bad' END AS error FROM pages WHERE url IS NOT NULL""")
def acquired_responses(spark, sf):
    """Responses of a client that has no network."""
    return acquire.acquire(T.read(spark, sf, "pages"), _client).select("url", "status", "body", "timed_out", "error")


def _client(url: str) -> tuple[int, str, str]:
    if "/fr/" in url:
        raise TimeoutError("slow")
    if "/de/" in url:
        raise ValueError("bad")
    return 200, "text/html", f"{url} body"


PAD = "." * 600
PROBES = [
    ("greenhouse", 200, "application/json", json.dumps({"jobs": [{"id": 1}, {"id": 2}], "pad": PAD[:100]}), True, 2), ("greenhouse", 200, "application/json", '{"jobs": []}', False, 0), ("greenhouse", 404, "application/json", json.dumps({"jobs": [{}], "pad": PAD}), False, 0),
    ("lever", 200, "application/json; charset=utf-8", '[{"text": "T"}]', True, 1), ("lever", 200, "text/html", '[{"text": "T"}]', False, 0), ("lever", 200, "application/json", "[]", False, 0),
    ("ashby", 200, "", '{"data": {"jobBoardWithTeams": {"jobPostings": [1, 2, 3]}}}', True, 3), ("ashby", 200, "", '{"data": {"jobBoardWithTeams": null}}', False, 0),
    ("workable", 200, "application/json", '{"total": 7}', True, 7), ("workable", 200, "application/json", '{"total": 0}', False, 0),
    ("bamboohr", 200, "text/html", 'x "jobOpenings" ' + PAD, True, 0), ("bamboohr", 200, "text/html", '"jobOpenings"', False, 0),
    ("recruitee", 200, "application/json", json.dumps({"offers": [{"title": "T", "slug": "s"}], "pad": PAD}), True, 1), ("recruitee", 200, "application/json", json.dumps({"offers": [{"title": "T"}], "pad": PAD}), False, 0),
    ("teamtailor", 200, "application/json", json.dumps({"data": [{"id": 1}], "pad": PAD}), True, 1), ("teamtailor", 200, "application/json", json.dumps({"data": [], "pad": PAD}), False, 0),
    ("rippling", 200, "application/json", json.dumps([{"id": 1, "name": "n", "department": PAD}]), True, 0), ("rippling", 200, "application/json", json.dumps([{"id": 1, "name": PAD}]), False, 0),
    ("pinpoint", 200, "application/json", json.dumps({"data": [{"title": "T", "location": "L", "employment_type": PAD}]}), True, 1), ("pinpoint", 200, "application/json", "<html>" + json.dumps({"data": [{"title": "T", "location": "L", "employment_type": PAD}]}), False, 0),
    ("freshteam", 200, "application/json", json.dumps([{"title": "T", "id": 1, "remote": PAD}]), True, 0), ("freshteam", 200, "application/json", '[{"title": "T", "id": 1, "remote": true}]', False, 0),
    ("smartrecruiters", 200, "application/json", json.dumps({"content": [{"name": "x"}, {"name": "y"}], "pad": PAD}), True, 2), ("smartrecruiters", 200, "application/json", json.dumps({"content": [{}], "pad": PAD}), False, 0),
    ("jobvite", 200, "application/json", '{"totalCount": 5, "reqList": [1, 2]}', True, 2), ("jobvite", 200, "application/json", '{"totalCount": 0, "reqList": []}', False, 0),
    ("breezyhr", 200, "application/json", '[{"a": 1}]', True, 1), ("breezyhr", 200, "application/json", "{}", False, 0),
    ("personio", 200, "application/json", json.dumps([{"a": 1}, {"pad": PAD}]), True, 2), ("personio", 200, "application/json", "[1]", False, 0),
    ("workday", 200, "", '{"total": 4, "jobPostings": [1, 2]}', True, 4), ("workday", 200, "", '{"jobPostings": [1, 2, 3]}', True, 3), ("workday", 200, "", '{"total": 0, "jobPostings": []}', False, 0), ("workday", 500, "", '{"total": 4}', False, 0),
    ("other", 200, "application/json", '[{"text": "T"}]', False, 0),
]


@query(f"SELECT p_partkey, {picked_sql('p_partkey', [x[4] for x in PROBES])} confirmed, {picked_sql('p_partkey', [x[5] for x in PROBES], 'INT')} job_count FROM part")
def probe_every_platform(spark, sf):
    c = probing.confirmation(*(picked("p_partkey", [x[k] for x in PROBES]) for k in range(4)))
    return T.read(spark, sf, "part").select("p_partkey", c.alias("c")).select("p_partkey", "c.confirmed", "c.job_count")


# Bodies of each shape, with the score that the rules add up to.
SHAPES = [  # size 0.10 (500 bytes or more), JSON 0.15, then the best shape
    ("https://a/jobs", "not json", 0.0, "shape_unknown"), ("https://a/jobs", "{}", 0.15, "shape_unknown"), ("https://a/jobs", '{"pad": "' + PAD + '"}', 0.25, "shape_unknown"),
    ("https://a/jobs", json.dumps({"pad": PAD, "x": {"y": [{"title": "T", "location": "L", "department": "D"}] * 3}}), 0.25 + 0.30, "shape1_full_list"),
    ("https://a/jobs", json.dumps([{"title": "T", "location": "L", "description": "D"}]), 0.15 + 0.40, "shape1_full_list"),
    ("https://a/jobs", json.dumps({"jobs": [{"title": "T", "location": {"city": "C"}, "department": "D"}]}), 0.15 + 0.40 + 0.20 + 0.15, "shape1_full_list"),
    ("https://a/graphql", json.dumps({"data": {"jobs": [{"title": "T", "location": "L"}]}}), 0.15 + 0.25 + 0.20, "shape1_full_list"),
    ("https://a/jobs", json.dumps({"title": "T", "description": "D", "location": "L", "department": "X", "apply_url": "U"}), 0.15 + 0.30, "shape2_single_job"),
    ("https://a/jobs", json.dumps([{"name": "N", "id": 1}, {"role": "R", "id": 2}]), 0.15 + 0.25, "shape3_minimal_list"),
    ("https://a/jobs", json.dumps({"total": 1, "page": 1, "rows": [{"title": "T", "location": "L", "salary": 1, "deadline": 2}]}), 0.15 + 0.35, "shape4_paginated"),
    ("https://a/x.css", json.dumps([{"title": "T", "location": "L", "description": "D"}]), 0.0, "shape_unknown"),
    ("https://a/jobs", "[1, 2", 0.0, "shape_unknown"), ("https://a/jobs", "", 0.0, "shape_unknown"),
]


@query(f"SELECT page_id, {picked_sql('page_id', [round(x[2], 6) for x in SHAPES], 'DOUBLE')} score, {picked_sql('page_id', [x[3] for x in SHAPES])} shape FROM pages")
def body_shapes(spark, sf):
    b = scoring.body_confidence(picked("page_id", [x[0] for x in SHAPES]), picked("page_id", [x[1] for x in SHAPES]))
    return T.read(spark, sf, "pages").select("page_id", b.alias("b")).select("page_id", F.round("b.score", 6).alias("score"), "b.shape")


@query("""WITH n AS (SELECT count(DISTINCT l_orderkey) n FROM lineitem JOIN part ON l_partkey = p_partkey), b AS (SELECT count(DISTINCT l_orderkey) n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 2 = 0)
SELECT field, n.n FROM n, (VALUES ('jobs'), ('branches'), ('jobs[].id'), ('jobs[].title'), ('jobs[].location'), ('jobs[].departments'), ('jobs[].first_published'), ('jobs[].branch_id'), ('jobs[].absolute_url')) f(field)
UNION ALL SELECT field, b.n FROM b, (VALUES ('branches[].id'), ('branches[].city'), ('branches[].country_code'), ('branches[].location')) f(field)""")
def body_field_census(spark, sf):
    return reports.field_census(T.bodies(spark, sf), "body", None)


# Probing, routing, scores.


@query(f"""WITH s AS (SELECT DISTINCT lower(p_brand) slug FROM part), p(priority, ats) AS (VALUES (0, 'lever'), (1, 'workable'), (2, 'greenhouse')) SELECT slug, CAST(priority AS INT) priority, ats,
CASE ats {" ".join(f"WHEN '{k}' THEN replace('{rules.PLATFORM_ENDPOINTS[k]}', '%s', slug)" for k in ("lever", "workable", "greenhouse"))} END api_url, CASE ats WHEN 'workable' THEN 'POST' ELSE 'GET' END AS "method" FROM s, p""")
def slug_probes(spark, sf):
    slugs = T.read(spark, sf, "part").select(F.lower("p_brand").alias("slug")).distinct()
    return probing.probes(slugs, ("lever", "workable", "greenhouse"))


@query("""WITH b AS (SELECT lower(p_brand) k, min(p_brand) board FROM part GROUP BY 1), e(priority, environment) AS (VALUES (0, 'wd1'), (1, 'wd5'), (2, 'wd103')) SELECT board, CAST(priority AS INT) priority, environment FROM b, e""")
def board_probes(spark, sf):
    names = T.read(spark, sf, "part").select(F.col("p_brand").alias("board"))
    return probing.boards(("wd1", "wd5", "wd103"), names.union(names.select(F.lower("board")).where("false")))


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_acctbal > 6000 THEN 'lever' WHEN c_acctbal > 3000 THEN 'breezyhr' END ats FROM customer) SELECT 'co' || c_custkey slug, ats, CASE ats WHEN 'lever' THEN 'https://l/' ELSE 'https://b/' END || c_custkey api_url, CAST(CASE ats WHEN 'lever' THEN 1 ELSE 2 END AS INT) job_count,
CASE ats WHEN 'lever' THEN 'jobs.lever.co/co' || c_custkey ELSE 'co' || c_custkey || '.breezy.hr' END AS "domain" FROM r WHERE ats IS NOT NULL""")
def first_probe_hit(spark, sf):
    answers = lambda ats, k, prefix, body, least: T.read(spark, sf, "customer").select(F.concat(F.lit("co"), "c_custkey").alias("slug"), F.lit(k).alias("priority"), F.lit(ats).alias("ats"), F.concat(F.lit(prefix), "c_custkey").alias("api_url"), F.lit(200).alias("status"), F.lit("application/json").alias("content_type"), F.when(F.col("c_acctbal") > least, body).otherwise("[]").alias("body"))
    return probing.first_hit(answers("breezyhr", 1, "https://b/", '[{"a": 1}, {"a": 2}]', 3000).union(answers("lever", 0, "https://l/", '[{"text": "T"}]', 6000)))


@query("""SELECT o_orderkey, o_totalprice >= 250000 AS found, CASE WHEN o_totalprice >= 250000 THEN 'tier1' END tier_used, CASE WHEN o_totalprice >= 250000 THEN NULL WHEN o_orderstatus = 'F' THEN 'no match' ELSE 'below threshold' END reason FROM orders""")
def tier_results(spark, sf):
    rows = T.read(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "F", "no match").alias("error"))
    good, bad = routing.settle(rows, 1, F.col("o_totalprice") / 500000.0, 0.5)
    none = F.lit(None).cast("string")
    return good.select("o_orderkey", F.lit(True).alias("found"), "tier_used", none.alias("reason")).union(bad.select("o_orderkey", F.lit(False), none, "tier1_fail_reason"))


@query("""WITH s AS (SELECT page_id, page_id % 4 hits, page_id % 3 misses, page_id % 20 blocks FROM pages), b AS (SELECT *, CASE WHEN hits > 0 THEN least(0.2, hits / (hits + misses + 1)::DOUBLE * 0.2) ELSE 0.0 END::DOUBLE boost FROM s)
SELECT page_id, round(boost, 6) boost, round(greatest(0.8::DOUBLE - 0.05::DOUBLE * blocks, 0.1), 6) decayed FROM b""")
def frontier_scores(spark, sf):
    n = F.col("page_id")
    rows = T.read(spark, sf, "pages").select("page_id", scoring.static_score(F.col("url")).alias("static"), scoring.frontier_score(F.col("url"), n % 4, n % 3).alias("whole"), scoring.decayed(F.lit(0.8), n % 20).alias("decayed"))
    return rows.select("page_id", F.round(F.col("whole") - F.col("static"), 6).alias("boost"), F.round("decayed", 6).alias("decayed"))


@query(f"""WITH {T.COMPANIES}, f AS (SELECT page_id, 'https://' || c.domain || '/careers' url, c.id, c.domain FROM pages JOIN companies c ON c.id = page_id) SELECT page_id, url, id company_id, 'Customer#' || lpad(CAST(page_id AS VARCHAR), 9, '0') AS "name" FROM f""")
def frontier_companies(spark, sf):
    """Each queued URL with the company that it was queued for."""
    c = T.companies(spark, sf)
    queue = T.read(spark, sf, "pages").select("page_id").join(c.select(F.col("id").alias("page_id"), "domain"), "page_id").select("page_id", urls.career_url(F.col("domain")).alias("url"))
    known = c.select(urls.career_url(F.col("domain")).alias("url"), F.col("id").alias("company_id"), F.coalesce("name", "domain").alias("name"))
    return schedule.with_company(queue, known)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 5000)")
def orphaned_rows(spark, sf):
    parents = T.read(spark, sf, "orders").where("o_totalprice > 5000").select(F.col("o_orderkey").alias("l_orderkey"))
    return reports.orphans(T.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), parents, ["l_orderkey"])


@query(f"WITH {T.NEAR} SELECT id, domain, confidence FROM near WHERE label IS NULL ORDER BY confidence DESC, id LIMIT 60")
def near_miss_queue(spark, sf):
    return schedule.near_miss_queue(T.near_misses(spark, sf), 60).select("id", "domain", "confidence")


@query(f"WITH {T.CAPTURES} SELECT id, domain, captured_at FROM captures WHERE label IS NULL ORDER BY domain, captured_at, id LIMIT 60")
def label_queue(spark, sf):
    return schedule.label_queue(T.captures(spark, sf), 60).select("id", "domain", "captured_at")


@query(C.SQL["seen_anti_join"])
def bloom_unseen(spark, sf):
    """Companies without a record, by a Bloom filter of the records with so few false hits that none is likely."""
    size = bloom.size_for(2_000_000, 1e-9)
    records = T.records(spark, sf)
    held = bloom.united(bloom.build(records.where("confidence > 0.8"), "domain", size), bloom.build(records.where("confidence <= 0.8"), "domain", size))
    return bloom.without_held(T.companies(spark, sf), "domain", held, size).select("id", "domain")


@query()
def frontier_pops(spark, sf):
    """Events push URLs into a queue for each day, and errors pop one, which is refused where the value is small."""
    pop = F.col("event_type") == "error"
    rows = T.read(spark, sf, "events").select(F.to_date("ts").cast("string").alias("queue"), F.col("event_id").alias("seq"), F.when(pop, "pop").otherwise("push").alias("op"), F.concat(F.lit("u"), "event_id").alias("url"), (F.col("value") / 100).alias("score"), (F.col("value") < 10).alias("refused"))
    return schedule.frontier_run(rows, 25)


# Slugs.


@query("""WITH n AS (SELECT lower(p_brand) || '-' || p_size slug, min(p_partkey) first FROM part GROUP BY 1), o AS (SELECT DISTINCT lower(p_brand) || '-' || p_size slug FROM part WHERE p_retailprice > 950)
SELECT n.slug, CASE WHEN o.slug IS NOT NULL THEN 'old' ELSE 'new' END origin FROM n LEFT JOIN o USING (slug)""")
def slug_union(spark, sf):
    slug = F.concat(F.lower("p_brand"), F.lit("-"), "p_size").alias("slug")
    old = T.read(spark, sf, "part").where("p_retailprice > 950").select(slug, F.lit("old").alias("origin"))
    new = T.read(spark, sf, "part").select(slug, F.lit("new").alias("origin"))
    return urllists.union_first([old, new], "slug")


@query("""WITH s AS (SELECT replace(replace(lower(p_name), ' ', '-'), '#', '') slug, CASE WHEN p_size > 25 THEN 0 ELSE 1 END r FROM part), v AS (SELECT unnest([slug, replace(slug, '-', ''), split_part(slug, '-', 1)]) slug, r FROM s WHERE contains(slug, '-') UNION ALL SELECT slug, r FROM s WHERE NOT contains(slug, '-'))
SELECT slug, CASE min(r) WHEN 0 THEN 'list' ELSE 'table' END AS source FROM v WHERE strlen(slug) BETWEEN 3 AND 50 AND regexp_matches(slug, '^[a-z][a-z0-9-]*$') GROUP BY slug""")
def slug_variant_sources(spark, sf):
    rows = T.read(spark, sf, "part").select(F.col("p_name").alias("name"), F.when(F.col("p_size") > 25, "list").otherwise("table").alias("source"), F.when(F.col("p_size") > 25, 0).otherwise(1).alias("rank"))
    return urllists.slug_sources(rows)


NAMES = ["*.acme@.lever.co\nwww.lever.co\nacme@.lever.co", "a@.b.lever.co\nlever.co", "dev-x@.lever.co\nuuid@.lever.co", "Beta@.lever.co\n9x.lever.co", "x.lever.co\nabc@-jobs.lever.co"]


@query(f"""WITH l AS (SELECT DISTINCT trim(unnest(string_split({picked_sql("c_custkey", NAMES)}, chr(10)))) line FROM customer), s AS (SELECT regexp_replace(regexp_replace(line, '^\\*\\.', ''), '\\.lever\\.co$', '') slug FROM l)
SELECT DISTINCT slug, 'whole' AS form FROM s WHERE regexp_matches(slug, '^(acme|abc)[0-9]+(-jobs)?$')
UNION ALL SELECT DISTINCT split_part(lower(slug), '.', 1), 'label' FROM s WHERE regexp_matches(lower(slug), '^(acme|abc|beta)[0-9]+(-jobs)?$') OR regexp_matches(lower(slug), '^a[0-9]{{2,}}\\.b$') OR lower(slug) = 'lever.co'""")
def certificate_slugs(spark, sf):
    rows = T.read(spark, sf, "customer").select(picked("c_custkey", NAMES).alias("name_value"))
    return urllists.certificate_slugs(rows, "lever.co").withColumn("form", F.lit("whole")).union(urllists.certificate_slugs(rows, "lever.co", True).withColumn("form", F.lit("label")))


# Mutations.

STAMP = "TIMESTAMP '1990-01-01 00:00:00'"


def stamp(name: str) -> Column:
    return F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias(name)


@query(f"""WITH {T.COMPANIES} SELECT domain, CASE WHEN created_at > 5000 THEN id ELSE id + 100000 END id, CASE WHEN created_at > 5000 THEN "name" ELSE 'new' END AS "name", CASE WHEN created_at > 5000 THEN {STAMP} ELSE {C.AS_OF_SQL} END created_at FROM companies""")
def merge_companies(spark, sf):
    rows = T.companies(spark, sf)
    known = rows.where("created_at > 5000").select("id", "domain", "name", stamp("created_at"), stamp("updated_at"))
    found = rows.select((F.col("id") + 100000).alias("id"), "domain", F.lit("new").alias("name"))
    return merge.upsert_companies(known, found.union(found), C.as_of()).select("domain", "id", "name", "created_at")


SOURCES_SQL = "s AS (SELECT s_suppkey source_id, 'https://s/' || s_suppkey endpoint_url, s_acctbal balance FROM supplier), n AS (SELECT l_suppkey source_id, count(*) jobs FROM lineitem GROUP BY 1)"


def _sources(spark, sf) -> DataFrame:
    count = lambda name, n: F.lit(n).alias(name)
    return T.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("source_id"), F.concat(F.lit("https://s/"), "s_suppkey").alias("endpoint_url"), F.lit("degraded").alias("status"), count("consecutive_failures", 4), count("fetch_count", 10), count("success_count", 6), count("failure_count", 4), F.lit(7).cast("long").alias("last_job_count"), stamp("next_fetch_at"), stamp("last_success_at"), stamp("last_failure_at"), stamp("last_fetched_at"), stamp("created_at"), stamp("updated_at"), F.col("s_acctbal").alias("balance"))


@query(f"""WITH {SOURCES_SQL} SELECT endpoint_url, CASE WHEN balance <= 4000 THEN 'active' ELSE 'degraded' END AS status, balance <= 4000 AND balance > 2000 AS known_again, CASE WHEN balance > 2000 THEN {STAMP} ELSE {C.AS_OF_SQL} END created_at, CASE WHEN balance <= 4000 THEN {C.AS_OF_SQL} ELSE {STAMP} END updated_at FROM s""")
def merge_sources(spark, sf):
    rows = _sources(spark, sf)
    old = rows.where("balance > 2000").drop("balance")
    found = rows.where("balance <= 4000").select("endpoint_url", "source_id")
    again = old.select("endpoint_url", F.lit(True).alias("known_again"))
    out = merge.upsert_sources(old, found.union(found), C.as_of()).select("endpoint_url", "status", "created_at", "updated_at")
    return out.join(again, "endpoint_url", "left").select("endpoint_url", "status", (F.coalesce("known_again", F.lit(False)) & (F.col("status") == "active")).alias("known_again"), "created_at", "updated_at")


@query(f"""WITH {SOURCES_SQL} SELECT s.source_id, CASE WHEN jobs IS NOT NULL THEN 'active' ELSE 'degraded' END AS status, CASE WHEN jobs IS NOT NULL THEN 0 ELSE 4 END consecutive_failures, CASE WHEN jobs IS NOT NULL THEN 11 ELSE 10 END fetch_count, CASE WHEN jobs IS NOT NULL THEN 7 ELSE 6 END success_count,
CASE WHEN jobs IS NOT NULL THEN jobs ELSE 7 END last_job_count, CASE WHEN jobs IS NOT NULL THEN {C.AS_OF_SQL} + INTERVAL 6 HOUR ELSE {STAMP} END next_fetch_at, CASE WHEN jobs IS NOT NULL THEN {C.AS_OF_SQL} ELSE {STAMP} END last_success_at FROM s LEFT JOIN (SELECT * FROM n WHERE jobs > 55) n USING (source_id)""")
def merge_source_success(spark, sf):
    fetched = T.read(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("source_id")).agg(F.count("*").alias("jobs_found")).where("jobs_found > 55")
    return merge.source_succeeded(_sources(spark, sf), fetched, C.as_of()).select("source_id", "status", "consecutive_failures", "fetch_count", "success_count", "last_job_count", "next_fetch_at", "last_success_at")


@query(f"""WITH {SOURCES_SQL} SELECT source_id, CASE WHEN balance < 5000 THEN 5 ELSE 4 END consecutive_failures, CASE WHEN balance < 5000 THEN 11 ELSE 10 END fetch_count, CASE WHEN balance < 5000 THEN 5 ELSE 4 END failure_count, 'degraded' AS status, CASE WHEN balance < 5000 THEN {C.AS_OF_SQL} + INTERVAL 1 HOUR ELSE {STAMP} END next_fetch_at FROM s""")
def merge_source_failure(spark, sf):
    rows = _sources(spark, sf)
    return merge.source_failed(rows, rows.where("balance < 5000").select("source_id"), C.as_of()).select("source_id", "consecutive_failures", "fetch_count", "failure_count", "status", "next_fetch_at")


@query("SELECT doc_id, left(text, 255) error_message FROM documents")
def fetch_log_append(spark, sf):
    path = T.scratch(spark, "fetch-log")
    merge.fetch_log_rows(T.read(spark, sf, "documents").select("doc_id", F.col("text").alias("error_message"))).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query(f"""WITH {T.RECORDS} SELECT domain, CASE WHEN confidence > 0.8 THEN 0 ELSE consecutive_failures END consecutive_failures, CASE WHEN confidence > 0.8 THEN {C.AS_OF_SQL} + INTERVAL 1 HOUR ELSE next_replay END next_replay, CASE WHEN confidence > 0.8 THEN {C.AS_OF_SQL} ELSE {STAMP} END updated_at FROM records""")
def merge_replay_success(spark, sf):
    rows = T.records(spark, sf).withColumn("updated_at", stamp("x"))
    return merge.replay_succeeded(rows, rows.where("confidence > 0.8").select("domain"), C.as_of()).select("domain", "consecutive_failures", "next_replay", "updated_at")


@query(f"""WITH {T.RECORDS} SELECT domain, CASE WHEN tier_used <> 'tier2' THEN 'stale' ELSE status END AS status, CASE WHEN tier_used <> 'tier2' THEN {C.AS_OF_SQL} + INTERVAL 24 HOUR ELSE next_replay END next_replay FROM records""")
def merge_auth_expired(spark, sf):
    rows = T.records(spark, sf)
    answers = rows.select("domain", F.when(F.col("tier_used") == "tier0", 401).when(F.col("tier_used") == "tier1", 403).otherwise(500).alias("http_status"))
    return merge.auth_expired(rows, answers, C.as_of()).select("domain", "status", "next_replay")


@query(f"""WITH {T.CAPTURES} SELECT id, domain, label, CAST(NULL AS VARCHAR) notes FROM captures WHERE label IS NOT NULL UNION ALL SELECT id, domain, 1, 'near_miss_review' FROM captures WHERE label IS NULL AND value > 90""")
def promoted_near_misses(spark, sf):
    rows = T.captures(spark, sf)
    known = rows.where("label is not null").select("id", "domain", "label", F.lit(None).cast("string").alias("notes"))
    near = rows.where("label is null").select("id", "domain", F.when(F.col("value") > 90, 1).otherwise(0).alias("label"))
    return merge.promote_near_misses(near, known)


@query(f"""WITH {T.RECORDS}, {C.FOUND_SQL} SELECT coalesce(r.domain, f.domain) AS domain, CASE WHEN f.domain IS NOT NULL THEN {C.AS_OF_SQL} ELSE {STAMP} END updated_at FROM records r FULL JOIN found f ON r.domain = f.domain""")
def updated_at_of_merges(spark, sf):
    rows = T.records(spark, sf).withColumn("updated_at", stamp("x"))
    return merge.mark_discovered(rows, C._found(spark, sf), C.as_of()).select("domain", "updated_at")


@query(f"""WITH {T.RECORDS}, {C.FOUND_SQL}
SELECT 'company' kind, domain AS key, '' AS status FROM companies UNION ALL SELECT 'record', coalesce(r.domain, f.domain), CASE WHEN r.domain IS NULL OR f.domain IS NOT NULL THEN 'discovered' ELSE r.status END FROM records r FULL JOIN found f ON r.domain = f.domain
UNION ALL SELECT 'source', api_url, 'active' FROM found""")
def save_probe_hits(spark, sf):
    """Company, record and source of each hit, of one input."""
    hits = C._found(spark, sf).withColumn("endpoint_url", F.col("api_url"))
    known = T.companies(spark, sf).where("created_at <= 5000").select("domain", stamp("created_at"), stamp("updated_at"))
    sources = spark.createDataFrame([], "endpoint_url string, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    a, b, c = merge.save_slugs(known, T.records(spark, sf), sources, hits, C.as_of())
    return a.select(F.lit("company").alias("kind"), F.col("domain").alias("key"), F.lit("").alias("status")).union(b.select(F.lit("record"), "domain", "status")).union(c.select(F.lit("source"), "endpoint_url", "status"))


# Alerts and features.

TICKS_SQL = "ticks AS (SELECT date_trunc('minute', ts) AS m, event_type = 'purchase' s, event_type = 'error' f, value FROM events)"


@query(f"""WITH {TICKS_SQL}, b AS (SELECT min(m) lo, max(m) hi FROM ticks), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) m FROM b),
c AS (SELECT d.m, count_if(s) s, count_if(f) f, count(value) p, max(value * 60) lag, max(value / 80000) cost FROM d LEFT JOIN ticks USING (m) GROUP BY 1),
w AS (SELECT m, sum(s) OVER five s5, sum(f) OVER five f5, sum(p) OVER fifteen p15, lag, cost FROM c WINDOW five AS (ORDER BY m ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), fifteen AS (ORDER BY m ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)),
a AS (SELECT m, 'success_rate' AS alert, coalesce(s5 / nullif(s5 + f5, 0)::DOUBLE < 0.8, false) low, 5 hold FROM w UNION ALL SELECT m, 'replay_lag', coalesce(lag > 3600, false), 5 FROM w UNION ALL SELECT m, 'replay_errors', f5 / 300.0 > 10, 5 FROM w UNION ALL SELECT m, 'stalled', p15 = 0, 10 FROM w UNION ALL SELECT m, 'cost', coalesce(cost > 0.001, false), 30 FROM w),
i AS (SELECT *, epoch(m) // 60 - row_number() OVER (PARTITION BY alert ORDER BY m) g FROM a WHERE low)
SELECT alert, min(m) AS first, max(m) AS last, count(*) AS minutes FROM i GROUP BY alert, g HAVING count(*) >= max(hold)""")
def alerts_held(spark, sf):
    kind = F.col("event_type")
    ticks = T.read(spark, sf, "events").select(F.col("ts").alias("at"), (kind == "purchase").alias("success"), (kind == "error").alias("failure"), (kind == "error").alias("replay_error"), F.lit(True).alias("processed"), (F.col("value") * 60).alias("lag"), (F.col("value") / 80000).alias("cost"), F.lit(None).cast("int").alias("up"))
    return reports.held_rules(reports.alert_minutes(ticks))


REQUESTS = [
    ("https://boards.greenhouse.io/v1/jobs?page=1", "post", {"Authorization": "Bearer x", "X-API-Key": "k", "Content-Type": "application/JSON", "ACCEPT": "application/json"}, '{"limit": 1}', (1, 1, 1, 2, 0, 1, 0, 1, 1, 1, 1, 4, 1, 1, 1, 0)),
    ("https://a.com/graphql", "GET", {}, "", (1, 0, 0, 1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0)),
    ("https://a.com", "PUT", {"Accept": "text/html", "authorization": "Basic x"}, "x" * 150, (0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 2, 0, 2, 0, 0)),
    ("https://a.com/x/y/z/?offset=2&q=page", "GET", {"api-key": "", **{f"h{k}": "" for k in range(40)}}, "[" + "1," * 600 + "1]", (0, 0, 1, 4, 0, 0, 1, 0, 1, 0, 0, 30, 0, 3, 1, 0)),
]


@query(f"""SELECT event_id, {", ".join(picked_sql("event_id", [r[4][k] for r in REQUESTS], "INT") + " " + name for k, name in enumerate(features.NAMES))}, {picked_sql("event_id", [round(min(sum(r[4]) / 8, 1), 6) for r in REQUESTS], "DOUBLE")} confidence, {picked_sql("event_id", [min(sum(r[4]) / 8, 1) >= 0.4 for r in REQUESTS])} positive FROM events""")
def request_features_all(spark, sf):
    headers = F.element_at(F.array(*(F.create_map(*(F.lit(x) for kv in r[2].items() for x in kv)) if r[2] else F.create_map().cast("map<string,string>") for r in REQUESTS)), (F.col("event_id") % len(REQUESTS) + 1).cast("int"))
    cases = [picked("event_id", [r[k] for r in REQUESTS]) for k in (0, 1, 3)]
    rows = T.read(spark, sf, "events").select("event_id", *features.request_features(cases[0], cases[1], headers, cases[2]))
    return features.fallback(rows).select("event_id", *features.NAMES, F.round("confidence", 6).alias("confidence"), "positive")


@query("SELECT event_id, value > 50 AS positive FROM events")
def trained_predictions(spark, sf):
    """Boosted trees learn which requests are positive from the features of a split, and are asked about all."""
    url = F.when(F.col("value") > 50, "https://a.com/jobs?page=1").otherwise("https://a.com/x")
    rows = T.read(spark, sf, "events").select("event_id", (F.col("value") > 50).cast("int").alias("label"), *features.request_features(url, F.lit("GET"), F.create_map().cast("map<string,string>"), F.lit("")))
    learnt, _ = features.split(rows)
    return features.predict(features.train(learnt, trees=3), rows).select("event_id", (F.col("confidence") >= 0.5).alias("positive"))


# Files: written by a sink, read again by a source.


@query(f"WITH {T.CAPTURES} SELECT domain, url, CAST(response_size AS INT) AS response_status, label = 1 AS was_hit, count(*) n FROM captures GROUP BY ALL")
def captures_as_lines(spark, sf):
    path = T.scratch(spark, "captures")
    rows = T.captures(spark, sf).select("domain", "url", F.col("response_size").alias("response_status"), (F.col("label") == 1).alias("was_hit"))
    writers.append_json(rows, path)
    writers.append_json(rows, "none")
    spark.createDataFrame([("",), ("{broken",)], "value string").write.mode("append").text(path)
    return readers.captures(spark, path).groupBy("domain", "url", "response_status", "was_hit").agg(F.count("*").alias("n"))


@query("SELECT CAST(row_number() OVER (ORDER BY page_id) - 1 AS INT) AS ordinal, url FROM pages")
def urls_as_array(spark, sf):
    path = T.scratch(spark, "urls")
    rows = T.read(spark, sf, "pages").select("page_id", "url")
    listed = rows.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "url"))), lambda x: x["url"])).alias("value"))
    listed.coalesce(1).write.text(path)
    return readers.url_array(spark, path)


@query("SELECT page_id, url FROM pages")
def pages_as_objects(spark, sf):
    path = T.scratch(spark, "objects")
    writers.json_array(T.read(spark, sf, "pages").select("page_id", "url"), path, ["page_id"])
    return readers.object_array(spark, path, "page_id long, url string")


@query(f"""WITH {T.COMPANIES} SELECT domain, '"' || "name" || '", Inc' AS "name" FROM companies""")
def companies_as_csv(spark, sf):
    path = T.scratch(spark, "csv")
    rows = T.companies(spark, sf).select(F.concat(F.lit('"'), "name", F.lit('", Inc')).alias(" Name "), F.col("domain").alias("Domain"))
    writers.append_csv(rows, path)
    writers.append_csv(rows.limit(1).select(F.lit("nobody").alias(" Name "), F.lit(" ").alias("Domain")), path)
    return readers.companies_csv(spark, path).select("domain", "name")


@query("SELECT 'd' || c_custkey AS domain, CASE WHEN c_acctbal > 5000 THEN 'com' ELSE 'io' END tld FROM customer WHERE c_acctbal > 3000")
def ranked_list(spark, sf):
    path = T.scratch(spark, "ranked")
    rows = T.read(spark, sf, "customer").select("c_custkey", "c_name", F.concat(F.lit("d"), "c_custkey").alias("d"), F.when(F.col("c_acctbal") > 5000, "com").when(F.col("c_acctbal") > 3000, "io").when(F.col("c_acctbal") > 2000, "gov").when(F.col("c_acctbal") > 1000, "edu").otherwise("mil").alias("t"))
    writers.append_csv(rows, path)
    return readers.ranked_domains(spark, path)


@query("""WITH b AS (SELECT p_type company, p_brand board FROM part UNION ALL SELECT 'seed', 'BRAND#1' UNION ALL SELECT 'seed', 'Extra') SELECT arg_min(company, (company, board)) company, arg_min(board, (company, board)) board FROM b GROUP BY lower(board)""")
def boards_as_text(spark, sf):
    path = T.scratch(spark, "boards")
    writers.append_piped(T.read(spark, sf, "part").select("p_type", "p_brand"), path, ["p_type", "p_brand"])
    spark.createDataFrame([("no board",)], "value string").write.mode("append").text(path)
    return readers.board_list(spark, path, [("seed", "BRAND#1"), ("seed", "Extra")])


@query("SELECT trim(p_name) line, count(*) n FROM part GROUP BY 1")
def lines_of_text(spark, sf):
    path = T.scratch(spark, "lines")
    T.read(spark, sf, "part").select(F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("value")).write.text(path)
    spark.createDataFrame([("",), ("   ",)], "value string").write.mode("append").text(path)
    return reports.counts_by(readers.lines(spark, path), "line")


@query("WITH r AS (SELECT p_brand pattern, 'https://x/' || p_partkey url, p_partkey ordinal, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) n FROM part) SELECT pattern, url FROM r WHERE n <= 3")
def archive_index_limited(spark, sf):
    path = T.scratch(spark, "index")
    writers.append_json(T.read(spark, sf, "part").select(F.col("p_brand").alias("pattern"), F.concat(F.lit("https://x/"), "p_partkey").alias("url"), F.col("p_partkey").cast("long").alias("ordinal")), path)
    return readers.archive_index(spark, path, 3).select("pattern", "url")


@query("SELECT 'a' || c_custkey slug FROM customer WHERE c_custkey > 9")
def certificates_as_json(spark, sf):
    path = T.scratch(spark, "certificates")
    rows = T.read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("*.a"), "c_custkey", F.lit(".lever.co\nwww.lever.co")).alias("name_value"))
    writers.json_array(rows, path, ["c_custkey"])
    return urllists.certificate_slugs(readers.certificates(spark, path), "lever.co")


@query("SELECT event_type AS url, 'GET' AS method, 0 AS n_headers, '' AS body, 0 AS label, count(*) n FROM events GROUP BY ALL")
def requests_as_lines(spark, sf):
    path = T.scratch(spark, "requests")
    T.read(spark, sf, "events").select(F.col("event_type").alias("url")).write.json(path)
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(path)
    rows = readers.labelled_requests(spark, path).select("url", "method", F.size("headers").alias("n_headers"), "body", "label")
    return rows.groupBy("url", "method", "n_headers", "body", "label").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS pid, least(4096, octet_length(encode(coalesce(text, '')))) n, octet_length(encode(coalesce(text, ''))) data_len FROM documents")
def kernel_payloads(spark, sf):
    path = T.scratch(spark, "kernel")
    data = F.coalesce("text", F.lit("")).cast("binary")
    T.read(spark, sf, "documents").select(F.col("doc_id").alias("pid"), F.octet_length(data).cast("long").alias("data_len"), data.alias("data")).write.parquet(path)
    return readers.kernel_events(spark, path).select("pid", F.octet_length("data").cast("long").alias("n"), "data_len")


@query("SELECT c_custkey, c_acctbal FROM customer")
def versioned_state(spark, sf):
    """The second version of a table is what is read."""
    path = T.scratch(spark, "state")
    rows = T.read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    writers.new_version(rows.select("c_custkey", F.lit(0.0).alias("c_acctbal")), path)
    writers.new_version(rows, path)
    return writers.latest(spark, path)


@query(C.SQL["merge_discovered"].split("CASE WHEN f.domain IS NOT NULL THEN CAST(0.75")[0].rstrip().rstrip(",") + " FROM records r FULL JOIN found f ON r.domain = f.domain")
def merge_touched_buckets(spark, sf):
    """The same upsert over state in buckets: written once whole, then changed where the source has keys."""
    path, rows = T.scratch(spark, "buckets"), T.records(spark, sf)
    empty = rows.where("false")
    writers.merge_buckets(path, rows, ["domain"], lambda _, source: source, empty, 16)
    writers.merge_buckets(path, C._found(spark, sf), ["domain"], lambda part, source: merge.mark_discovered(part, source, C.as_of()), empty, 16)
    return writers.read_buckets(spark, path, empty).select("domain", "api_url", "status")


@query(f"WITH {T.RECORDS} SELECT domain, next_replay FROM records WHERE status = 'discovered' AND next_replay <= {C.AS_OF_SQL}")
def due_from_partitions(spark, sf):
    """Due records out of state in folders by status, sorted by time: other folders and later row groups aren't read."""
    path = T.scratch(spark, "due")
    writers.partitioned(T.records(spark, sf).select("domain", "status", "next_replay"), path, ["status"], ["next_replay"])
    return readers.table(spark, path).where((F.col("status") == "discovered") & (F.col("next_replay") <= C.as_of())).select("domain", "next_replay")


@query("""SELECT 'd' || c_custkey AS key, '{"domain":"d' || c_custkey || '","n":' || c_nationkey || '}' AS value FROM customer""")
def topic_messages(spark, sf):
    return writers.keyed_messages(T.read(spark, sf, "customer").select(F.concat(F.lit("d"), "c_custkey").alias("domain"), F.col("c_nationkey").alias("n")))


@query("SELECT doc_id, 's3://archive/' || source || '/' || doc_id AS location, octet_length(encode(coalesce(text, ''))) size, sha256(coalesce(text, '')) digest FROM documents")
def archive_pointers(spark, sf):
    rows = T.read(spark, sf, "documents").select("doc_id", F.concat_ws("/", F.lit("s3://archive"), "source", "doc_id").alias("location"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return writers.pointers(rows, "doc_id", "location", "content")


@query("SELECT event_type, count(*) n FROM events GROUP BY 1")
def observed_counts(spark, sf):
    rows = writers.observed(T.read(spark, sf, "events"), "events", n=F.count("*"), errors=F.count_if(F.col("event_type") == "error"))
    return reports.counts_by(rows, "event_type")


# Streams: the whole table as one, until all of it is read.


def _stream(spark, sf) -> DataFrame:
    events = T.read(spark, sf, "events")
    rows = spark.readStream.schema(events.schema).parquet(f"{sf}/events.parquet*")
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("at"), F.concat(F.lit("d"), "user_id").alias("domain"), "event_type", "value")


def _gathered(rows: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives: its rows, or in complete mode the table after the last batch."""
    spark, path = rows.sparkSession, T.scratch(rows.sparkSession, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out" if mode == "complete" else f"{path}/out/batch={number}")

    rows.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/out" if mode == "complete" else f"{path}/out/batch=*")


@query("SELECT DISTINCT 'd' || user_id AS domain FROM events")
def stream_first_of_domain(spark, sf):
    return _gathered(pipelines.first_of_domain(_stream(spark, sf).select("domain", "at"), "at")).select("domain")


@query(C.SQL["cooldown_allowed"].split("SELECT e.event_id")[0] + "SELECT event_id FROM a")
def stream_allowed(spark, sf):
    return _gathered(pipelines.allowed(_stream(spark, sf).select("event_id", "domain", "at"), "domain", "at", 4 * 3600.0, "event_id")).select("event_id")


@query("SELECT 'd' || user_id AS domain, CAST(count_if(event_type = 'purchase') AS DOUBLE) hits, CAST(count_if(event_type <> 'purchase') AS BIGINT) misses FROM events GROUP BY 1")
def stream_feedback(spark, sf):
    rows = _stream(spark, sf).select("domain", (F.col("event_type") == "purchase").alias("hit"), F.lit(1.0).alias("weight"), "at")
    return _gathered(pipelines.feedback(rows), "complete").select("domain", "hits", "misses")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) n FROM events GROUP BY 1, 2")
def stream_windows(spark, sf):
    out = _gathered(pipelines.windowed(_stream(spark, sf), "at", ["event_type"], "1 day", "1 hour"), "complete")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(C.SQL["session_counts"].replace("SELECT user_id, min(ts)", "SELECT 'd' || user_id AS domain, min(ts)"))
def stream_sessions(spark, sf):
    out = _gathered(pipelines.sessions(_stream(spark, sf), "at", ["domain"], "1 day", "30 minutes"), "complete")
    return out.select("domain", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


@query("""WITH r AS (SELECT event_type AS queue, 'u' || event_id AS url, value score, event_id seq, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) n FROM events) SELECT queue, url, score, seq FROM r WHERE n <= 20""")
def stream_frontier(spark, sf):
    rows = _stream(spark, sf).select(F.col("event_type").alias("queue"), F.concat(F.lit("u"), "event_id").alias("url"), F.col("value").alias("score"), F.col("event_id").alias("seq"))
    out = _gathered_last(pipelines.frontier_state(rows, 20), "queue")
    return out.select("queue", "url", "score", "seq")


def _gathered_last(rows: DataFrame, key: str) -> DataFrame:
    """Of an update stream, what the last batch that has a key says of it."""
    spark, path = rows.sparkSession, T.scratch(rows.sparkSession, "stream")
    rows.writeStream.outputMode("update").foreachBatch(lambda batch, number: batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/out/{number}")).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    all_ = spark.read.schema(rows.schema.add("_batch", "long")).parquet(f"{path}/out/*")
    return all_.join(all_.groupBy(key).agg(F.max("_batch").alias("_batch")), [key, "_batch"])


@query(f"""WITH {T.RECORDS}, e AS (SELECT event_id, 'customer-' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '.example.com' AS domain FROM events) SELECT event_id, e.domain, CASE WHEN r.status = 'discovered' THEN 'replay' ELSE 'tier1' END AS route FROM e LEFT JOIN records r USING (domain)""")
def stream_intake(spark, sf):
    """URLs routed batch by batch, and each route's messages into a folder of its own, read together."""
    path = T.scratch(spark, "intake")
    number = F.lpad(F.regexp_extract("domain", "[0-9]+", 0), 9, "0")
    messages = _stream(spark, sf).select("event_id", F.concat(F.lit("customer-"), number, F.lit(".example.com")).alias("domain")).withColumn("raw_url", F.concat(F.lit("https://"), "domain", F.lit("/x")))
    sink = lambda batch, k: batch.select("event_id", "domain", "route").write.mode("overwrite").partitionBy("route").parquet(f"{path}/out/{k}")
    pipelines.intake(messages, lambda: T.records(spark, sf), sink, f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.option("basePath", f"{path}/out").parquet(*[f"{path}/out/*/route={r}" for r in ("replay", "tier1")]).select("event_id", "domain", F.regexp_extract(F.input_file_name(), "route=([a-z0-9]+)", 1).alias("route"))


@query("""SELECT event_id, value > 50 AS found, CASE WHEN value > 50 THEN 'tier1' END AS tier_used, CASE WHEN value <= 50 THEN 'below threshold' END AS reason FROM events""")
def stream_tier(spark, sf):
    """A tier's results, split batch by batch into discoveries and messages for the next tier."""
    path = T.scratch(spark, "tier")
    found = lambda batch, k: batch.select("event_id", "tier_used").write.mode("overwrite").parquet(f"{path}/found/{k}")
    missed = lambda batch, k: batch.select("event_id", F.col("tier1_fail_reason").alias("reason")).write.mode("overwrite").parquet(f"{path}/next/{k}")
    rows = _stream(spark, sf).select("event_id", "value", F.lit(None).cast("string").alias("error"))
    pipelines.tiered(rows, 1, F.col("value") / 100, 0.500000001, found, missed, f"{path}/checkpoint", once=True).awaitTermination()
    none = F.lit(None).cast("string")
    return spark.read.parquet(f"{path}/found/*").select("event_id", F.lit(True).alias("found"), "tier_used", none.alias("reason")).union(spark.read.parquet(f"{path}/next/*").select("event_id", F.lit(False), none, "reason"))


@query("SELECT CAST(event_id AS VARCHAR) external_job_id, event_type AS title FROM events WHERE value > 20")
def stream_normalise(spark, sf):
    path = T.scratch(spark, "normalise")
    body = F.to_json(F.struct(F.array(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title"))).alias("jobs")))
    rows = _stream(spark, sf).select("domain", F.lit("c").alias("company_id"), F.when(F.col("value") > 20, body).otherwise("broken").alias("raw_json"))
    write = lambda kind: lambda batch, k: batch.write.mode("overwrite").parquet(f"{path}/{kind}/{k}")
    pipelines.normalise(rows, write("jobs"), write("dead"), f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/jobs/*").select("external_job_id", "title")


@query("""SELECT event_id, CASE WHEN value > 50 THEN 'shape1_full_list' ELSE 'shape_unknown' END AS shape, CASE WHEN value > 50 THEN 0.55 ELSE 0.0 END::DOUBLE body_score FROM events""")
def stream_scored(spark, sf):
    body = F.when(F.col("value") > 50, json.dumps([{"title": "T", "location": "L", "description": "D"}])).otherwise("none")
    rows = _stream(spark, sf).select("event_id", F.lit("https://a/jobs").alias("url"), F.lit("GET").alias("method"), F.lit("application/json").alias("content_type"), body.alias("body"))
    return _gathered(pipelines.scored(rows)).select("event_id", "shape", F.round("body_score", 6).alias("body_score"))


@query(f"WITH {T.RECORDS} SELECT domain, next_replay FROM records WHERE status = 'discovered' AND (next_replay IS NULL OR next_replay <= {C.AS_OF_SQL}) ORDER BY next_replay NULLS FIRST, domain LIMIT 50")
def stream_replayed(spark, sf):
    """What one tick of the scheduler takes up."""
    path = T.scratch(spark, "replayed")
    due: Callable[[], DataFrame] = lambda: schedule.due(T.records(spark, sf), C.as_of())
    work = lambda batch, k: batch.select("domain", "next_replay").write.mode("overwrite").parquet(f"{path}/out/{k}")
    pipelines.replayed(due, work, _stream(spark, sf), f"{path}/checkpoint", most=50, once=True).awaitTermination()
    return spark.read.parquet(f"{path}/out/*").distinct()


@query("SELECT event_id, 'd' || user_id AS domain FROM events")
def stream_to_lines(spark, sf):
    path = T.scratch(spark, "lines-out")
    writers.stream_json(_stream(spark, sf).select("event_id", "domain"), f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return spark.read.schema("event_id long, domain string").json(f"{path}/out")
