"""Values asserted exactly: scores, shapes, blockers, page analysis, slugs, salaries, times."""

import json

import pytest
from pyspark.sql import functions as F

from seine.functions import jsons, scoring, text, times, urls
from seine.operators import parse

# The inputs of this file and the scores and fields that each must give.
PAD = "x" * 500


def values(spark, rows, schema, *columns):
    """One column's values, or tuples of several, in the order of the rows."""
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"_k int, {schema}")
    out = df.select("_k", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).orderBy("_k").collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in out]


def near(x):
    return pytest.approx(x, abs=1e-3)


def test_static_score(spark):
    cases = {"https://acme.io/jobs": 0.60, "https://acme.io/about/jobs": 0.50, "https://jobs.lever.co/acme": 0.55, "acme.com": 0.25, "acme.com/": 0.10, "http://www.jobs.acme.ai/a/b/c": 0.40, "https://acme.io/jobs/blog": 0.50}
    assert values(spark, [(u,) for u in cases], "u string", scoring.static_score(F.col("u"))) == [near(x) for x in cases.values()]


def test_feedback_and_decay(spark):
    assert values(spark, [(50, 5), (0, 3), (0, 0)], "h int, m int", scoring.feedback_boost(F.col("h"), F.col("m"))) == [near(0.178571), 0, 0]
    assert values(spark, [(1,), (2,), (9,)], "n int", scoring.decayed(F.lit(0.20), F.col("n"))) == [near(0.15), near(0.10), near(0.10)]


URLS = [
    ("https://boards-api.greenhouse.io/v1/boards/stripe/jobs", "GET", "application/json", 0, 0.55), ("https://api.lever.co/v0/postings/acmecorp?mode=json", "GET", "", 0, 0.50), ("https://example.com/graphql", "POST", "application/json", 63, 0.35),
    ("https://api.techcorp.com/careers/v2?page=1&size=20", "GET", "", 0, 0.50), ("https://www.google-analytics.com/collect", "POST", "", 0, 0), ("https://cdn.techcorp.com/images/hero-banner.jpg", "GET", "", 0, 0),
    ("https://api.greenhouse.io/v1/boards/test/jobs?page=1&size=20", "POST", "application/json", 60, 0.80), ("https://jobs.acme.com/positions", "GET", "", 0, 0.35), ("https://coforma.pinpointhq.com/postings.json", "GET", "application/json", 8192, 0.75),
    ("https://capmo.jobs.personio.de/search.json", "GET", "application/json", 4096, 0.50), ("https://api.greenhouse.io/v1/boards/customerio/embed/departments", "GET", "application/json", 16384, 0.65),
    ("https://impactanalytics.keka.com/careers/api/embedjobs", "GET", "application/json", 8192, 0.75), ("https://example.com/api/jobs?page=1", "GET", "application/json", 500, 0.65),
]


def test_url_confidence(spark):
    got = values(spark, [r[:4] for r in URLS], "u string, m string, c string, s int", scoring.url_confidence(F.col("u"), F.col("m"), F.col("c"), F.col("s")))
    assert got == [near(r[4]) for r in URLS]


def padded(x):
    return json.dumps(x) + " " * max(0, 500 - len(json.dumps(x)))


def keys(*names):
    return dict.fromkeys(names, "v")


BODIES = [
    (json.dumps([keys("title", "location", "description")]), "https://example.com/jobs", 0.55, "shape1_full_list"), (json.dumps([keys("title", "location")]), "https://example.com/jobs", 0.15, "shape_unknown"), ("[]", "https://example.com/api/jobs", 0.15, "shape_unknown"),
    (json.dumps(keys("user", "age")), "https://example.com/api/jobs", 0.15, "shape_unknown"), (padded({"jobs": [{**keys("title", "department"), "location": keys("city", "country")}]}), "https://example.com/api/jobs", 1.00, "shape1_full_list"),
    (padded([keys("name", "city", "team", "url")]), "https://example.com/api/jobs?page=1", 0.65, "shape1_full_list"), (json.dumps([keys("name", "city", "team")]), "https://example.com/api/jobs", 0.15, "shape_unknown"),
    (json.dumps({"requisitionList": [keys("title", "location", "department", "employment_type")] * 3}), "https://myworkdayjobs.com/api", 0.55, "shape1_full_list"), (json.dumps({"data": {"jobs": [keys("title", "location")]}}), "https://example.com/graphql", 0.60, "shape1_full_list"),
    (json.dumps(keys("title", "description", "location", "department", "apply_url")), "https://example.com/api/job/123", 0.45, "shape2_single_job"), (json.dumps([keys("title", "id")] * 2), "https://example.com/api/jobs", 0.40, "shape3_minimal_list"),
    (json.dumps([keys("title")] * 2), "https://example.com/api/jobs", 0.15, "shape_unknown"), (json.dumps({"total": 1, "page": 1, "noise": [keys("foo", "baz")]}), "https://example.com/api/jobs", 0.15, "shape_unknown"),
    (json.dumps({"jobs": [keys("title", "location", "description")]}), "https://cdn.cookielaw.org/x", 0, "shape_unknown"), ("{}", "https://a.com/_next/data/x/blog.json", 0, "shape_unknown"),
    (json.dumps({"pageProps": {"jobs": [keys("title", "location")]}}), "https://a.com/_next/data/x/careers.json", 0.35, "shape1_full_list"), ("not json", "https://a.com/x", 0, "shape_unknown"), (None, "https://a.com/x", 0, "shape_unknown"),
]


def test_body_confidence(spark):
    got = values(spark, [(b, u) for b, u, _, _ in BODIES], "b string, u string", scoring.body_confidence(F.col("u"), F.col("b")))
    assert [(r.score, r.shape) for r in got] == [(near(s), shape) for _, _, s, shape in BODIES]


def test_paginated_shape():
    assert scoring.score_body(json.dumps({"total": 1, "page": 1, "rows": [keys("title", "location", "salary", "deadline")]})) == (near(0.50), "shape4_paginated")


def test_final_confidence(spark):
    rows = [(0.20, 0.25, "https://x.lever.co"), (0.20, 0.25, "https://x.com"), (0.20, 0.15, "https://x.lever.co")]
    assert values(spark, rows, "a double, b double, u string", scoring.final_confidence(F.col("a"), F.col("b"), F.col("u"))) == [near(0.62), near(0.23), near(0.17)]


def test_blockers(spark):
    blocked = ["google-analytics.com/collect?v=1", "cdn.segment.com/analytics.js", "mixpanel.com/track", "hotjar.com/api/metrics", "intercom.io/api/users", "a.com/api/v1/analytics/pageview", "a.com/telemetry/event", "a.com/tracking/pixel.gif", "a.com/beacon/collect", "a.com/healthcheck", "a.com/auth/token/refresh", "a.com/feature-flag/check", "a.com/killswitch/status", "a.com/api/initialize?app=web"]
    free = ["https://boards-api.greenhouse.io/v1/config", "https://api.lever.co/v0/initialize"]
    assert values(spark, [(u,) for u in blocked + free], "u string", urls.is_blocked_request(F.col("u"))) == [True] * len(blocked) + [False] * 2
    assert values(spark, [("text/html; charset=utf-8",), ("TEXT/HTML",), ("application/json",)], "c string", urls.is_blocked_content_type(F.col("c"))) == [True, True, False]


PAGES = [
    ('fetch("https://boards-api.greenhouse.io/v1/boards/acmecorp/jobs?content=true")', "acmecorp.com", "greenhouse", "GET", "https://boards-api.greenhouse.io/v1/boards/acmecorp/jobs?content=true"),
    ('"https://api.lever.co/v0/postings/my-company?mode=json"', "my-company.com", "lever", "GET", "https://api.lever.co/v0/postings/my-company?mode=json"),
    ('"https://api.ashbyhq.com/posting-api/job-board/stripe"', "stripe.com", "ashby", "GET", "https://api.ashbyhq.com/posting-api/job-board/stripe"),
    ("axios.get('/api/v2/jobs?limit=20&offset=0')", "techcorp.com", "generic_api", "GET", "https://techcorp.com/api/v2/jobs?limit=20&offset=0"),
    ("fetch('/graphql', {})", "graphqlco.com", "graphql", "POST", "https://graphqlco.com/graphql"),
    ('<script id="__NEXT_DATA__" type="application/json">{"a":{"b":["https://cdn.x.com/y","https:\\/\\/api.lever.co\\/v0\\/postings\\/nested-corp?mode=json"]}}</script>', "nested-corp.com", "nextjs_data", "GET", "https://api.lever.co/v0/postings/nested-corp?mode=json"),
    ('<link rel="preconnect" href="https://boards-api.greenhouse.io">', "someco.com", "preconnect", "GET", "https://boards-api.greenhouse.io"),
    ("""<meta http-equiv="Content-Security-Policy" content="default-src 'self'; connect-src 'self' https://api.lever.co https://x.y; img-src *">""", "csp-corp.com", "csp_meta", "GET", "https://api.lever.co"),
    ('<script type="application/ld+json">{"@type":"JobPosting","url":"https://example.com/jobs/123"}</script>', "example.com", "schema_org_jobs", "GET", "https://example.com/jobs/123"),
    ('<script type="application/ld+json">{"@graph":[{"@type":"X"},{"@type":"JobPosting","@id":"https://example.com/jobs/456"}]}</script>', "example.com", "schema_org_jobs", "GET", "https://example.com/jobs/456"),
]


def test_page_analysis(spark):
    rows = [(h, d) for h, d, *_ in PAGES] + [("<p>nothing</p>", "acme.com")]
    got = values(spark, rows, "h string, d string", text.endpoint_matches(F.col("h"), F.col("d")))
    assert got[-1] == []
    for (_, _, *want), matches in zip(PAGES, got, strict=False):
        assert tuple(want) in [tuple(m) for m in matches], want
    two = values(spark, [(PAGES[0][0] + PAGES[1][0], "multi.com")], "h string, d string", text.endpoint_matches(F.col("h"), F.col("d")))[0]
    assert [m.pattern for m in two] == ["greenhouse", "lever"]


def test_link_platform(spark):
    rows = [('<a href="/x"><a href="https://boards.greenhouse.io/acme/jobs">',), ('<a href="https://co.wd5.myworkdayjobs.com/en-US/Careers/x">',), ("<script>window.location = 'https://jobs.lever.co/zed'</script>",), ("none",)]
    assert [r and tuple(r) for r in values(spark, rows, "h string", text.link_platform(F.col("h")))] == [("greenhouse", "acme"), ("workday", "co|Careers"), ("lever", "zed"), None]


def test_slugs(spark):
    assert values(spark, [("Acme Widgets Inc.",), ("A_B  Corp",), ("X Holdings Group",)], "n string", text.company_slug(F.col("n"))) == ["acme-widgets", "a-b", "x"]
    assert values(spark, [("acme",), ("a1234",), ("ab",), ("xn--ab",), ("9abc",), ("a-b-c",)], "s string", text.valid_slug(F.col("s"))) == [True, False, False, False, False, True]
    assert values(spark, [("9a",), ("a-b-c-d-e",), ("a",), ("my-staging",), ("careers",), ("acme",)], "s string", text.blocked_slug(F.col("s"))) == ["starts with digit", ">3 hyphens", "regex mismatch", "contains staging", "exact careers", None]
    assert values(spark, [("*.acme.lever.co",)], "s string", text.certificate_slug(F.col("s"), "lever.co"), text.first_label(F.col("s"), "lever.co")) == [("acme", "acme")]


def test_salary(spark):
    cases = {"USD 80,000 - 100,000": ("USD", 80000, 100000), "$80,000 - $100,000": ("$", 80000, 0), "80k - 100k": ("", 80, 0), "£45000": ("£", 45000, 0), "Competitive": ("", 0, 0)}
    assert [tuple(r) for r in values(spark, [(s,) for s in cases], "s string", text.salary(F.col("s")))] == list(cases.values())


def test_employment_types(spark):
    known = {"Full-time": "full_time"}
    assert values(spark, [("Full-time",), ("Fulltime contract",), ("Freelance",), ("Working Student",), ("",)], "s string", text.employment_type(F.col("s"), known)) == ["full_time", "full_time", "contract", "working_student", ""]


def test_json_reads(spark):
    doc = json.dumps({"departments": [{"name": "Eng"}], "id": 4001.0, "b": True, "a-b": "x", "s": " t ", "n": 2.5})
    assert values(spark, [(doc,)], "d string", *(jsons.string_at(F.col("d"), p) for p in ("departments[0].name", "departments[1].name", "id", "b", "a-b"))) == [("Eng", "", "4001", "true", "x")]
    assert values(spark, [(doc,)], "d string", jsons.rounded_string(F.col("d"), "n"), jsons.rounded_string(F.col("d"), "s"), jsons.number_at(F.col("d"), "zz")) == [("2", "t", 0.0)]


def test_times(spark):
    rows = [("2024-03-01T10:00:00Z",), ("2024-03-01T10:00:00",), ("2024-03-01",), ("March 1, 2024",), ("nonsense",)]
    got = values(spark, rows, "s string", times.any_time(F.col("s")).cast("string"))
    assert got == ["2024-03-01 10:00:00", "2024-03-01 10:00:00", "2024-03-01 00:00:00", "2024-03-01 00:00:00", None]
    assert values(spark, [(5,), (120,), (900,)], "t int", times.clamp_ttl(F.col("t"))) == [60, 120, 300]


def test_canonical(spark):
    cases = {"https://boards.greenhouse.io/stripe/x": ("https://boards.greenhouse.io/stripe", "greenhouse", "stripe"), "https://acme.lever.co/": ("https://acme.lever.co", "lever", "acme"), "https://www.a.com/en/jobs/x": ("https://a.com/en/jobs", "", ""), "https://a.com": ("https://a.com", "", ""), "https://linkedin.com/x": None, "https://a.com/jobs/123": None, "https://api.lever.co/x": None, "https://lever.co/x": None}
    assert [r and tuple(r) for r in values(spark, [(u,) for u in cases], "u string", urls.canonical(F.col("u")))] == list(cases.values())


PLATFORMS = {
    "greenhouse": ({"jobs": [{"id": 4001.0, "title": "T", "location": {"name": "L"}, "departments": [{"name": "D"}], "absolute_url": "u", "first_published": "2024-01-02T03:04:05Z"}, {"id": 0, "title": "no id"}, {"id": 5}]}, ("4001", "T", "L", "D", "", False)),
    "lever": ([{"id": "x", "text": "T", "categories": {"location": "L", "team": "D", "commitment": "Full Time"}, "createdAt": 1700000000000}], ("x", "T", "L", "D", "full_time", False)),
    "ashby": ({"data": {"jobBoardWithTeams": {"jobPostings": [{"id": "x", "title": "T", "locationName": "L", "teamName": "D", "employmentType": "Intern", "isRemote": True}]}}}, ("x", "T", "L", "D", "internship", True)),
    "pinpoint": ({"data": [{"id": 7, "title": "T", "location": {"name": "L"}, "job": {"department": {"name": "D"}}, "employment_type": "contract", "workplace_type": "Fully_Remote"}]}, ("7", "T", "L", "D", "contract", True)),
    "teamtailor": ({"data": [{"id": "x", "attributes": {"title": "T", "remote-status": "none"}}]}, ("x", "T", "", "", "", False)),
    "freshteam": ({"jobs": [{"id": 1, "title": "T", "branch_id": 2, "job_role_id": 9, "remote": False}], "branches": [{"id": 2, "city": "old"}, {"id": 2, "city": "C", "location": "L"}], "job_roles": [{"id": 3, "name": "D"}]}, ("1", "T", "L", "", "", False)),
    "personio": ([{"id": 3, "name": "T", "office": "L", "department": "D", "employment_type": "freelance"}], ("3", "T", "L", "D", "contract", False)),
    "unknown": ([{"id": 3}], None),
}


def test_parse_known(spark):
    bodies = spark.createDataFrame([(p, json.dumps(b)) for p, (b, _) in PLATFORMS.items()] + [("greenhouse", "broken{"), ("lever", '{"a":1}')], "platform string, body string")
    got = {r.platform: (r.external_id, r.title, r.location_raw, r.department, r.employment_type, r.is_remote) for r in parse.parse_known(bodies, []).collect()}
    assert got == {p: want for p, (_, want) in PLATFORMS.items() if want}


def test_parse_heuristic(spark):
    job = {"req_id": 12, "job_title": " T ", "office": {"text": "L"}, "compensation": "USD 1,000 - 2,000", "postedAt": "2024-01-02"}
    bodies = [[job], {"jobs": [job]}, {"data": {"jobs": [job]}}, {"foo": [job]}, {"jobs": 5, "items": [job]}, {"data": {"x": 1}, "jobs": []}, [1, {"title": "no id"}]]
    rows = [(k, json.dumps(b)) for k, b in enumerate(bodies)] + [(7, json.dumps(json.dumps([job]))), (8, "oops")]
    got = parse.parse_heuristic(spark.createDataFrame(rows, "k int, raw_json string"), ["k"]).collect()
    assert sorted(r.k for r in got) == [0, 1, 2, 4, 7]
    assert {(r.external_job_id, r.title, r.location, r.salary_min, r.salary_max, str(r.posted_at)) for r in got} == {("12", "T", "L", 1000.0, 2000.0, "2024-01-02 00:00:00")}


def test_jobs_are_found_at_any_depth(spark):
    """The first alias that is present with an array or an object decides, however deep it leads."""
    jobs = '[{"id": 1}, 5, {"id": "b"}]'
    nested = lambda n: '{"a": 1, "data": ' * n + f'{{"postings": {jobs}}}' + "}" * n
    rows = [(n, nested(n)) for n in (0, 1, 3, 5, 40)] + [(100, jobs), (101, '{"jobs": "none", "results": []}'), (102, '{"jobs": {"x": 1}, "results": [{"id": 9}]}'), (103, '{"jobs": 7, "items": [{"id": 9}]}'), (104, "{"), (105, '{"other": [{"id": 1}]}'), (106, None), (107, '{"data" : \n {"jobs":[{"id":3}]}}')]
    got = parse.parse_heuristic(spark.createDataFrame(rows, "k int, raw_json string"), ["k"]).collect()
    assert sorted((r.k, r.external_job_id) for r in got) == sorted([(n, i) for n in (0, 1, 3, 5, 40, 100) for i in ("1", "b")] + [(103, "9"), (107, "3")])


def test_schemas_can_be_added_and_lookups_take_the_last_of_an_id(spark):
    extra = {"own": {"jobs_path": "a.b", "external_id": "no", "title": "t", "lookups": (("place", "places", {"city": "c", "department": "d"}),)}}
    body = '{"a": {"b": [{"no": 1.9, "t": "x", "place": 7}, {"no": true, "t": "y", "place": "8"}, {"no": "z", "t": 5, "place": 0}, {"no": "q", "t": "w", "place": 99}]}, "places": [{"id": 7, "c": "old"}, {"id": 8, "c": 1}, {"id": 7, "c": "new", "d": "dep"}, {"id": "9"}, 3]}'
    rows = spark.createDataFrame([("own", body), ("greenhouse", '{"jobs": [{"id": 1, "title": "g", "place": 7}]}'), ("none", "[]"), ("own", "[1"), (None, body)], "platform string, body string")
    got = parse.parse_known(rows, [], extra).collect()
    assert sorted((r.platform, r.position, r.external_id, r.title, r.city, r.department) for r in got) == [("greenhouse", 0, "1", "g", "", ""), ("own", 0, "1", "x", "new", "dep"), ("own", 1, "true", "y", "", ""), ("own", 2, "z", "5", "", ""), ("own", 3, "q", "w", "", "")]
    assert parse.parse_known(rows, [], extra, ["greenhouse"]).count() == 1
