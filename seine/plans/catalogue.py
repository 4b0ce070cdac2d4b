"""Every registered query over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, scoring, text, times, urls
from ..operators import capturing, features, merge, parse, probing, reports, routing, schedule, urllists
from . import tables as T  # noqa: I001

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF_SQL = "TIMESTAMP '1998-06-01 00:00:00'"


def as_of():
    return F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")


def plain_counts(sql: str) -> str:
    """``count_if`` as BIGINT, which DuckDB makes 128 bits wide."""
    out, at = "", 0
    while (k := sql.find("count_if(", at)) >= 0:
        end, depth = k + 9, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += sql[at:k] + f"CAST({sql[k:end]} AS BIGINT)"
        at = end
    return out + sql[at:]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = plain_counts(sql)
        return f

    return add


def contains(column: str, parts: tuple[str, ...]) -> str:
    """The list of substrings as SQL."""
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


def ends(column: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"ends_with({column}, '{p}')" for p in parts) + ")"


HOST = "lower(regexp_replace(regexp_extract({0}, '^(?:[^:/?#]+:)?(?://([^/?#]*))?', 1), '^[^@]*@', ''))"
BARE = "regexp_replace(" + HOST + ", '^www\\.', '')"
PATH = "regexp_extract({0}, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1)"
QUERY = "regexp_extract({0}, '^(?:[^:/?#]+:)?(?://[^/?#]*)?[^?#]*\\?([^#]*)', 1)"
SEGMENTS = "string_split(regexp_replace({0}, '^/+|/+$', '', 'g'), '/')"
API = "split_part(split_part({0}, '://', 2), '/', 1)"


# Captures.


@query(f"""WITH {T.CAPTURES},
by_url AS (SELECT domain, url, count(*) n, count(label) l, count_if(label = 1) p FROM captures GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY n DESC, url) r FROM by_url)
SELECT domain, CAST(sum(n) AS BIGINT) total, CAST(sum(l) AS BIGINT) labelled, CAST(sum(p) AS BIGINT) positive, max(CASE WHEN r = 1 THEN url END) top_url
FROM ranked GROUP BY domain ORDER BY total DESC, domain LIMIT 30""")
def capture_domain_report(spark, sf):
    return reports.domain_report(T.captures(spark, sf))


@query(f"""WITH {T.CAPTURES} SELECT count(*) total, count(label) labelled, count_if(label = 1) positive, count_if(label = 0) negative, count_if(label IS NULL) unlabelled,
count(DISTINCT domain) domains, count(DISTINCT CASE WHEN label = 1 THEN domain END) positive_domains FROM captures""")
def capture_overall_stats(spark, sf):
    return reports.capture_totals(T.captures(spark, sf))


@query(f"""WITH s AS (SELECT unnest({SEGMENTS.format(PATH.format("url"))}) segment FROM pages) SELECT segment, count(*) n FROM s WHERE segment <> '' GROUP BY 1 ORDER BY n DESC, segment LIMIT 20""")
def path_segment_topk(spark, sf):
    return reports.path_segments(T.pages(spark, sf), "url")


@query(f"""WITH {T.CAPTURES}, s AS (SELECT unnest({SEGMENTS.format(PATH.format("url"))}) segment FROM captures) SELECT segment, count(*) n FROM s WHERE regexp_matches(segment, '^[A-Za-z_-]+$') AND strlen(segment) > 2 GROUP BY 1 HAVING count(*) >= 2""")
def word_segment_counts(spark, sf):
    return reports.word_segments(T.captures(spark, sf), "url")


@query(f"""WITH s AS (SELECT unnest(list_distinct(list_transform(string_split({QUERY.format("url")}, '&'), lambda x: split_part(x, '=', 1)))) param FROM pages) SELECT param, count(*) n FROM s WHERE param <> '' GROUP BY 1 ORDER BY n DESC, param LIMIT 20""")
def query_param_topk(spark, sf):
    return reports.query_params(T.pages(spark, sf), "url")


@query("WITH k AS (SELECT unnest(json_keys(props)) field FROM events) SELECT field, count(*) n FROM k GROUP BY 1 ORDER BY n DESC, field LIMIT 30")
def json_field_census(spark, sf):
    return reports.field_census(T.read(spark, sf, "events"), "props")


@query(f"""WITH {T.CAPTURES} SELECT {API.format("url")} host, count(*) n FROM captures WHERE label = 0 AND url NOT IN (SELECT url FROM captures WHERE label = 1) GROUP BY 1 HAVING count(*) >= 3""")
def mined_block_hosts(spark, sf):
    return reports.block_hosts(T.captures(spark, sf))


@query(f"""WITH {T.CAPTURES} SELECT {API.format("url")} host, count(DISTINCT domain) domains FROM captures WHERE label = 1 GROUP BY 1 HAVING count(DISTINCT domain) >= 2""")
def mined_accept_hosts(spark, sf):
    return reports.accept_hosts(T.captures(spark, sf))


@query(f"""WITH {T.CAPTURES}, b AS (SELECT {API.format("url")} host FROM captures WHERE label = 0 AND url NOT IN (SELECT url FROM captures WHERE label = 1) GROUP BY 1 HAVING count(*) >= 3),
a AS (SELECT {API.format("url")} host FROM captures WHERE label = 1 GROUP BY 1 HAVING count(DISTINCT domain) >= 2) SELECT host, 'block' AS "rule" FROM b UNION ALL SELECT host, 'accept' FROM a""")
def mined_rules(spark, sf):
    return capturing.mined_rules(T.captures(spark, sf))


@query(f"WITH {T.CAPTURES}, n AS (SELECT domain, count(*) n FROM captures GROUP BY 1) SELECT domain, n, round((SELECT avg(n) FROM n), 2) mean FROM n ORDER BY n DESC, domain LIMIT 10")
def capture_run_summary(spark, sf):
    return capturing.run_summary(T.captures(spark, sf))


@query(f"""WITH {T.CAPTURES}, r AS (SELECT id, {HOST.format("url")} h, CASE id % 3 WHEN 0 THEN 'Image' WHEN 1 THEN 'XHR' ELSE 'Fetch' END t, CASE WHEN id % 5 < 3 THEN 'application/json' ELSE 'text/html' END c, props || repeat(' ', CAST(id % 4 AS INT) * 100) body FROM captures WHERE event_type <> 'error')
SELECT id, CASE WHEN h = 'api1.example.com' THEN 'fast_accept' ELSE 'shape_unknown' END notes FROM r WHERE t <> 'Image' AND h <> 'api2.example.com' AND (h = 'api1.example.com' OR (c = 'application/json' AND strlen(body) BETWEEN 200 AND 10485760))""")
def accepted_captures(spark, sf):
    rows = T.captures(spark, sf).select("id", "url", F.element_at(F.array(F.lit("Image"), F.lit("XHR"), F.lit("Fetch")), (F.col("id") % 3 + 1).cast("int")).alias("resource_type"), F.when(F.col("id") % 5 < 3, "application/json").otherwise("text/html").alias("content_type"), F.concat("props", F.repeat(F.lit(" "), (F.col("id") % 4 * 100).cast("int"))).alias("body"))
    hosts = lambda h: spark.createDataFrame([(h,)], "host string")
    return capturing.accepted(rows, hosts("api2.example.com"), hosts("api1.example.com")).select("id", "notes")


@query(f"""WITH s AS (SELECT o_orderkey source_id, CASE WHEN o_orderkey % 6 > 0 THEN o_orderdate END next_fetch_at, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'degraded' ELSE 'retired' END status, o_orderpriority ats_platform FROM orders)
SELECT source_id, next_fetch_at FROM s WHERE status IN ('active', 'degraded') AND (next_fetch_at IS NULL OR next_fetch_at <= {AS_OF_SQL}) ORDER BY next_fetch_at NULLS LAST, source_id LIMIT 200""")
def due_source_queue(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "degraded").otherwise("retired")
    rows = T.read(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"), F.when(F.col("o_orderkey") % 6 > 0, F.col("o_orderdate")).alias("next_fetch_at"), status.alias("status"), F.col("o_orderpriority").alias("ats_platform"))
    return schedule.due_sources(rows, as_of(), limit=200).select("source_id", "next_fetch_at")


@query(f"WITH {T.CAPTURES} SELECT DISTINCT {BARE.format('url')} host FROM captures WHERE label = 1")
def discovered_host_set(spark, sf):
    return reports.discovered_hosts(T.captures(spark, sf).where("label = 1"))


@query(f"""WITH {T.CAPTURES}, f AS (SELECT domain, CAST(count_if(event_type = 'purchase') AS DOUBLE) hits, count_if(event_type <> 'purchase') misses, max(CASE WHEN event_type = 'purchase' THEN captured_at END) last_hit FROM captures GROUP BY 1)
SELECT domain, hits, misses, last_hit, CASE WHEN hits > 0 THEN round(least(0.2, hits / (hits + misses + 1) * 0.2), 6) ELSE 0.0 END boost FROM f""")
def domain_feedback_boost(spark, sf):
    entries = T.captures(spark, sf).select("domain", (F.col("event_type") == "purchase").alias("hit"), F.lit(1.0).alias("weight"), F.col("captured_at").alias("at"))
    return reports.feedback(entries).select("*", F.round(scoring.feedback_boost(F.col("hits"), F.col("misses")), 6).alias("boost"))


@query(f"WITH {T.CAPTURES} SELECT CAST(count_if(event_type = 'purchase') AS DOUBLE) / count(*) hit_rate FROM captures")
def global_hit_rate(spark, sf):
    entries = T.captures(spark, sf).select("domain", (F.col("event_type") == "purchase").alias("hit"), F.lit(1.0).alias("weight"), F.col("captured_at").alias("at"))
    return reports.hit_rate(reports.feedback(entries))


@query(f"""WITH {T.CAPTURES} SELECT domain, count_if(event_type = 'purchase') hits, count_if(event_type <> 'purchase') misses, count(*) total, count_if(event_type <> 'purchase' AND value / 100 > 0.25) near_misses FROM captures GROUP BY 1""")
def capture_entry_summary(spark, sf):
    return reports.entry_summary(T.captures(spark, sf).select("domain", (F.col("event_type") == "purchase").alias("hit"), (F.col("value") / 100).alias("body_score")))


@query(f"""WITH {T.CAPTURES}, s AS (SELECT id, least(value / 200, 1.0) u, least(value / 300, 1.0) b FROM captures), c AS (SELECT id, u, b, greatest(u * 0.4::DOUBLE + b * 0.6::DOUBLE, greatest(u, b) * 0.85::DOUBLE) f FROM s)
SELECT id, floor(f * 1e6 + 0.2371) / 1e6 confidence FROM c WHERE f < 0.6 AND (u >= 0.35 OR b >= 0.35)""")
def near_miss_candidates(spark, sf):
    rows = T.captures(spark, sf).select("id", "url", F.least(F.col("value") / 200, F.lit(1.0)).alias("u"), F.least(F.col("value") / 300, F.lit(1.0)).alias("b"))
    rows = rows.withColumn("f", scoring.final_confidence(F.col("u"), F.col("b"), F.col("url")))
    return rows.where(scoring.near_miss(F.col("u"), F.col("b"), F.col("f"))).select("id", (F.floor(F.col("f") * 1e6 + 0.2371) / 1e6).alias("confidence"))


@query(f"""WITH {T.CAPTURES}, n AS (SELECT domain, count(*) n, count_if(label = 1) p, count_if(label = 0) q FROM captures GROUP BY 1)
SELECT c.id, n.n - 1 others, p - (CASE WHEN label = 1 THEN 1 ELSE 0 END) others_positive, q - (CASE WHEN label = 0 THEN 1 ELSE 0 END) others_negative FROM captures c JOIN n USING (domain)""")
def capture_context(spark, sf):
    return reports.capture_context(T.captures(spark, sf)).select("id", "others", "others_positive", "others_negative")


@query(f"""WITH {T.NEAR}, o AS (SELECT * FROM near WHERE label IS NULL), t AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY confidence DESC, id) r FROM o)
SELECT o.id, (SELECT count(*) FROM o x WHERE x.domain = o.domain) - 1 others,
  round(coalesce((SELECT sum(confidence) FROM (SELECT confidence FROM t WHERE t.domain = o.domain AND t.r <= 4 AND t.id <> o.id ORDER BY confidence DESC, id LIMIT 3)), 0), 6) best_sum FROM o""")
def near_miss_context(spark, sf):
    out = reports.near_miss_context(T.near_misses(spark, sf))
    return out.select("id", "others", F.round(F.aggregate("best_others", F.lit(0.0), lambda a, x: a + x), 6).alias("best_sum"))


@query(f"""WITH {T.CAPTURES}, r AS (SELECT domain, id, url, response_size, row_number() OVER (PARTITION BY domain ORDER BY response_size DESC, id) n FROM captures) SELECT domain, id, url, response_size FROM r WHERE n = 1""")
def best_hit(spark, sf):
    return reports.best_hits(T.captures(spark, sf).select("domain", "id", "url", "response_size"), "domain", "response_size", "id")


@query(f"""WITH {T.CAPTURES} SELECT id, url, response_size FROM captures WHERE label IS NULL AND url ILIKE '%/VIEW/%' ORDER BY CASE WHEN response_size > 5000 THEN 0 ELSE 1 END, response_size DESC, id LIMIT 50""")
def review_queue_order(spark, sf):
    rows = T.captures(spark, sf).where(F.col("label").isNull() & F.col("url").ilike("%/VIEW/%"))
    return rows.orderBy(F.when(F.col("response_size") > 5000, 0).otherwise(1), F.desc("response_size"), "id").limit(50).select("id", "url", "response_size")


@query(f"""WITH {T.CAPTURES}, u AS (SELECT lower(url) u, url, id, event_type, response_size FROM captures),
s AS (SELECT id, CASE WHEN {contains("u", rules.JUNK)} OR ends_with(u, '.js') OR contains(u, '.js?') OR contains(u, '.js#') THEN 0.0 ELSE
 (CASE WHEN {contains("u", rules.PATH_WORDS)} THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN {contains("u", rules.PAGING_PARAMS)} THEN 0.15::DOUBLE ELSE 0 END) + (CASE WHEN event_type = 'click' THEN 0.10::DOUBLE ELSE 0 END)
 + (CASE WHEN id % 2 = 0 THEN 0.15::DOUBLE ELSE 0 END) + 0.10::DOUBLE + (CASE WHEN response_size BETWEEN 1024 AND 2097152 THEN 0.10::DOUBLE ELSE 0 END) + (CASE WHEN {contains("u", rules.ATS_DOMAINS)} THEN 0.15::DOUBLE ELSE 0 END) END s FROM u)
SELECT id, round(least(s, 1.0), 6) score FROM s""")
def url_path_confidence(spark, sf):
    method, kind = F.when(F.col("event_type") == "click", "post").otherwise("GET"), F.when(F.col("id") % 2 == 0, "application/json; charset=utf-8").otherwise("text/plain")
    return T.captures(spark, sf).select("id", F.round(scoring.url_confidence(F.col("url"), method, kind, F.col("response_size")), 6).alias("score"))


@query(f"""WITH {T.CAPTURES}, x AS (SELECT id, CASE WHEN value > 75 THEN 1 ELSE label END label FROM captures) SELECT id, CAST(label AS INT) label FROM x""")
def label_merge(spark, sf):
    rows = T.captures(spark, sf)
    labels = rows.where("value > 75").select("id", F.lit(None).cast("string").alias("domain"), F.lit(1).alias("label"))
    return merge.apply_labels(rows, labels).select("id", "label")


# URL lists.


@query(f"""WITH h AS (SELECT page_id, regexp_replace(regexp_replace(lower(url), '^https://', ''), '^http://', '') r FROM pages),
p AS (SELECT *, instr(r, '/') a, {SEGMENTS.format("substr(r, instr(r, '/'))")} s FROM h)
SELECT page_id, round(least(0.8, (CASE WHEN {contains("r", rules.STATIC_PATHS)} THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN regexp_matches(r, '^(www\\.)?(jobs|careers|work|apply)\\.') THEN 0.2::DOUBLE ELSE 0 END)
 + (CASE WHEN a = 0 OR (len(s) <= 2 AND s[1] <> '') THEN 0.15::DOUBLE ELSE 0 END) + (CASE WHEN regexp_matches(r, '\\.(io|ai|co)(/|$)') THEN 0.1::DOUBLE ELSE 0 END) + (CASE WHEN {contains("r", rules.STATIC_NOISE)} THEN 0 ELSE 0.1::DOUBLE END)), 6) score FROM p""")
def url_static_score(spark, sf):
    return T.read(spark, sf, "pages").select("page_id", F.round(scoring.static_score(F.col("url")), 6).alias("score"))


RANKED_SQL = f"""h AS (SELECT page_id, url, {HOST.format("url")} h, {BARE.format("url")} b, lower({PATH.format("url")}) p FROM pages), d AS (SELECT DISTINCT b FROM h WHERE contains(url, '/en/')), l AS (SELECT DISTINCT b FROM h WHERE contains(url, '/fr/')),
ranked AS (SELECT page_id, least(100, (CASE WHEN {ends("h", tuple("." + x for x in rules.RANKED_GLOBAL))} THEN 40 ELSE 0 END) + (CASE WHEN starts_with(h, 'careers.') OR starts_with(h, 'jobs.') THEN 20 ELSE 0 END) + (CASE WHEN contains(p, '/careers') OR contains(p, '/jobs') THEN 15 ELSE 0 END)
 + (CASE WHEN {ends("h", tuple("." + x for x in rules.RANKED_REGIONAL))} THEN 15 ELSE 0 END) + (CASE WHEN b IN (FROM d) THEN 25 ELSE 0 END) + (CASE WHEN b IN (FROM l) THEN 20 ELSE 0 END)) score FROM h WHERE h <> '')"""


def _ranked(spark, sf):
    pages = T.read(spark, sf, "pages").select("page_id", "url")
    some = lambda part: pages.where(F.col("url").contains(part)).select(urls.bare_host(F.col("url")).alias("domain"))
    return urllists.ranked_urls(pages, some("/en/"), some("/fr/"))


@query(f"WITH {RANKED_SQL} SELECT page_id, CAST(score AS INT) score FROM ranked")
def url_priority_score(spark, sf):
    return _ranked(spark, sf).select("page_id", "score")


@query(f"""WITH {RANKED_SQL}, b(bucket) AS (VALUES ('Above 60'), ('40 to 60'), ('20 to 39'), ('Below 20'))
SELECT bucket, count(score) n FROM b LEFT JOIN ranked ON bucket = CASE WHEN score >= 60 THEN 'Above 60' WHEN score >= 40 THEN '40 to 60' WHEN score >= 20 THEN '20 to 39' ELSE 'Below 20' END GROUP BY 1""")
def url_score_buckets(spark, sf):
    return urllists.score_distribution(_ranked(spark, sf))


CLEAN_CASE = " ".join(f"WHEN {'ends_with' if k == 'government' else 'contains'}(h, '{p}') THEN '{k} ({p})'" for k, parts in rules.CLEAN.items() for p in parts)
CLEAN_SQL = f"""h AS (SELECT page_id ordinal, url, {HOST.format("url")} h, {BARE.format("url")} b FROM pages),
r AS (SELECT *, CASE WHEN h = '' THEN 'invalid' {CLEAN_CASE} END reason FROM h),
k AS (SELECT *, first_value(url) OVER w best, row_number() OVER w n FROM r WHERE reason IS NULL WINDOW w AS (PARTITION BY b ORDER BY strlen(url), ordinal)),
cleaned AS (SELECT ordinal, url, n = 1 kept, CASE WHEN n > 1 THEN 'duplicate (keeping ' || best || ')' END reason FROM k UNION ALL SELECT ordinal, url, false, reason FROM r WHERE reason IS NOT NULL)"""


@query(f"WITH {CLEAN_SQL} SELECT ordinal, url FROM cleaned WHERE kept")
def url_clean_kept(spark, sf):
    return urllists.clean_urls(T.pages(spark, sf).drop("html")).where("kept").select("ordinal", "url")


@query(f"WITH {CLEAN_SQL} SELECT ordinal, url, reason FROM cleaned WHERE NOT kept")
def url_clean_removed(spark, sf):
    return urllists.clean_urls(T.pages(spark, sf).drop("html")).where("not kept").select("ordinal", "url", "reason")


@query(f"""WITH {CLEAN_SQL}, k2(kind) AS (VALUES ('aggregator'), ('social'), ('government'), ('redirect'), ('duplicate'), ('invalid')) SELECT kind, count(ordinal) n FROM k2 LEFT JOIN (SELECT * FROM cleaned WHERE NOT kept) c ON split_part(c.reason, ' ', 1) = kind GROUP BY 1""")
def url_reason_counts(spark, sf):
    return urllists.reason_counts(urllists.clean_urls(T.pages(spark, sf).drop("html")))


@query(f"""WITH h AS (SELECT page_id, {BARE.format("url")} h, {SEGMENTS.format(PATH.format("url"))} s FROM pages),
c AS (SELECT page_id, CASE WHEN s[1] = '' THEN 'https://' || h WHEN len(s) > 1 AND s[1] IN ('en', 'uk', 'us', 'corporate') THEN 'https://' || h || '/' || s[1] || '/' || s[2] ELSE 'https://' || h || '/' || s[1] END canonical
 FROM h WHERE NOT regexp_matches(s[-1], '^[0-9]+$') AND NOT regexp_matches(s[-1], '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$'))
SELECT canonical, min(page_id) first_seen, '' ats, '' board FROM c GROUP BY 1""")
def url_canonical(spark, sf):
    return urllists.canonical_urls(T.pages(spark, sf))


PLATFORM_CASE = "CASE " + " ".join(f"WHEN contains(u, '{p}') THEN '{v}'" for p, v in rules.PLATFORM_PARTS) + " ELSE 'custom' END"
HOSTS = tuple(p for p, _ in rules.PLATFORM_PARTS)


@query(f"""WITH u AS (SELECT c_custkey, 'https://x.' || list_element([{", ".join(f"'{p}'" for p in (*HOSTS, "other"))}], CAST(c_custkey % 15 + 1 AS INT)) || '/jobs' u FROM customer) SELECT c_custkey, u AS url, {PLATFORM_CASE} platform FROM u""")
def platform_from_url(spark, sf):
    rows = T.read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("https://x."), F.element_at(F.array(*map(F.lit, (*HOSTS, "other"))), (F.col("c_custkey") % 15 + 1).cast("int")), F.lit("/jobs")).alias("url"))
    return rows.select("c_custkey", "url", urls.platform(F.col("url")).alias("platform"))


@query(f"""WITH {T.COMPANIES} SELECT id, unnest(['https://' || domain || '/careers', 'https://' || domain || '/jobs', 'https://' || domain || '/about/careers', 'https://' || domain || '/company/careers', 'https://' || domain || '/en/careers', 'https://careers.' || domain, 'https://jobs.' || domain]) candidate FROM companies""")
def career_candidates(spark, sf):
    return T.companies(spark, sf).select("id", F.explode(urls.career_candidates(F.col("domain"))).alias("candidate"))


@query(f"WITH {T.RECORDS} SELECT id, domain FROM companies WHERE domain NOT IN (SELECT domain FROM records WHERE domain IS NOT NULL)")
def seen_anti_join(spark, sf):
    return T.companies(spark, sf).join(T.records(spark, sf), "domain", "left_anti").select("id", "domain")


@query(f"""WITH {RANKED_SQL} SELECT page_id, CAST(score AS INT) score FROM ranked ORDER BY score DESC, page_id LIMIT 40""")
def frontier_topk(spark, sf):
    return schedule.frontier(_ranked(spark, sf).select("page_id", "score"), 40, "score", "page_id")


@query("""SELECT page_id, list_transform(regexp_extract_all(html, '(?i)(?:href|src|action)\\s*=\\s*["'']([^"'']+)["'']', 1), lambda x: x) links FROM pages""".replace("list_transform(", "array_to_string(list_transform(").replace("lambda x: x) links", "lambda x: x), ' ') links"))
def html_link_extract(spark, sf):
    return T.read(spark, sf, "pages").select("page_id", F.array_join(text.links(F.col("html")), " ").alias("links"))


@query(f"""WITH l AS (SELECT unnest(regexp_extract_all(html, '(?i)(?:href|src|action)\\s*=\\s*["'']([^"'']+)["'']', 1)) u FROM pages), h AS (SELECT {BARE.format("u")} host FROM l) SELECT host, count(*) n FROM h GROUP BY 1""")
def html_link_hosts(spark, sf):
    return T.read(spark, sf, "pages").select(F.explode(text.links(F.col("html"))).alias("u")).groupBy(urls.bare_host(F.col("u")).alias("host")).agg(F.count("*").alias("n"))


# Texts.


@query("SELECT doc_id, lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g')) title FROM documents")
def title_normalize(spark, sf):
    return T.read(spark, sf, "documents").select("doc_id", text.normal_title(F.col("text")).alias("title"))


SLUG = "trim(p_name || CASE p_partkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' Holdings' WHEN 2 THEN ' Group Ltd' ELSE '' END)"
for _suffix in rules.COMPANY_SUFFIXES:
    for _end in ("", "\\.", ","):
        SLUG = f"regexp_replace({SLUG if _suffix != ' inc' or _end else 'lower(' + SLUG + ')'}, '{_suffix}{_end}$', '')"
SLUG = f"regexp_replace(regexp_replace(regexp_replace({SLUG}, '[\\s_]+', '-', 'g'), '[^a-z0-9\\-]', '', 'g'), '^-+|-+$', '', 'g')"


def _slugs(spark, sf):
    name = F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, " Inc.").when(F.col("p_partkey") % 4 == 1, " Holdings").when(F.col("p_partkey") % 4 == 2, " Group Ltd").otherwise(""))
    return T.read(spark, sf, "part").select("p_partkey", text.company_slug(name).alias("slug"))


@query(f"SELECT p_partkey, {SLUG} slug FROM part")
def company_slugify(spark, sf):
    return _slugs(spark, sf)


@query(f"""WITH s AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {SLUG} WHEN 1 THEN CAST(p_partkey AS VARCHAR) || 'x' ELSE 'dev-' || {SLUG} END slug FROM part)
SELECT p_partkey, slug, strlen(slug) BETWEEN 3 AND 50 AND regexp_matches(slug, '^[a-z][a-z0-9-]*$') AND NOT starts_with(slug, 'xn--') AND (length(slug) - length(regexp_replace(slug, '[0-9]', '', 'g')))::DOUBLE / strlen(slug) <= 0.6 valid,
 strlen(slug) BETWEEN 3 AND 50 AND regexp_matches(slug, '^[a-z][a-z0-9\\-]{{1,49}}$') AND slug NOT IN ({", ".join(f"'{x}'" for x in rules.SLUG_EXACT)}) AND NOT {contains("slug", rules.SLUG_PARTS)} AND NOT starts_with(slug, 'xn--') valid_harvest,
 CASE WHEN regexp_matches(slug, '^[0-9]') THEN 'starts with digit' WHEN length(slug) - length(replace(slug, '-', '')) > 3 THEN '>3 hyphens' WHEN NOT regexp_matches(slug, '^[a-z0-9][a-z0-9\\-]{{1,49}}[a-z0-9]$') THEN 'regex mismatch'
 {" ".join(f"WHEN contains(slug, '{x}') THEN 'contains {x}'" for x in rules.CERTIFICATE_PARTS)} {" ".join(f"WHEN slug = '{x}' THEN 'exact {x}'" for x in rules.CERTIFICATE_EXACT)} END blocked FROM s""")
def slug_validity(spark, sf):
    slug = F.when(F.col("p_partkey") % 3 == 0, F.col("slug")).when(F.col("p_partkey") % 3 == 1, F.concat(F.col("p_partkey").cast("string"), F.lit("x"))).otherwise(F.concat(F.lit("dev-"), "slug"))
    rows = _slugs(spark, sf).select("p_partkey", slug.alias("slug"))
    return rows.select("*", text.valid_slug(F.col("slug")).alias("valid"), text.valid_harvest_slug(F.col("slug")).alias("valid_harvest"), text.blocked_slug(F.col("slug")).alias("blocked"))


@query("""WITH r AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'USD ' || CAST(floor(p_retailprice) AS BIGINT) || ' - ' || CAST(floor(p_retailprice * 2) AS BIGINT) WHEN 1 THEN '$' || CAST(floor(p_retailprice) AS BIGINT) || ',000 - $9' WHEN 2 THEN CAST(p_size AS VARCHAR) || 'k - 100k' ELSE 'Competitive' END raw FROM part),
m AS (SELECT p_partkey, raw, regexp_extract(raw, '([\\$£€¥]|USD|EUR|GBP|INR)?[\\s]*([\\d,]+)[\\s]*(?:-|to)?[\\s]*([\\d,]+)?', ['c', 'a', 'b']) g FROM r)
SELECT p_partkey, trim(g.c) currency, coalesce(try_cast(replace(g.a, ',', '') AS DOUBLE), 0.0) min, coalesce(try_cast(replace(g.b, ',', '') AS DOUBLE), 0.0) max FROM m""")
def salary_parse(spark, sf):
    price = lambda k: F.floor(F.col("p_retailprice") * k).cast("string")
    raw = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("USD "), price(1), F.lit(" - "), price(2))).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("$"), price(1), F.lit(",000 - $9"))).when(F.col("p_partkey") % 4 == 2, F.concat("p_size", F.lit("k - 100k"))).otherwise("Competitive")
    return T.read(spark, sf, "part").select("p_partkey", text.salary(raw).alias("s")).select("p_partkey", "s.currency", "s.min", "s.max")


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_type), 'full') THEN 'full_time' WHEN contains(lower(p_type), 'part') THEN 'part_time' WHEN contains(lower(p_type), 'contract') OR contains(lower(p_type), 'freelance') THEN 'contract' WHEN contains(lower(p_type), 'intern') THEN 'internship' ELSE lower(replace(p_type, ' ', '_')) END kind FROM part""")
def employment_type_map(spark, sf):
    return T.read(spark, sf, "part").select("p_partkey", text.employment_type(F.col("p_type")).alias("kind"))


@query("""SELECT o_orderkey, o_orderdate AS from_ms, o_orderdate AS from_text, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS from_date FROM orders""")
def time_parse(spark, sf):
    at = F.col("o_orderdate").cast("timestamp")
    rows = T.read(spark, sf, "orders").select("o_orderkey", F.unix_millis(at).cast("string").alias("ms"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.date_format(at, "MMMM d, yyyy").alias("long"))
    return rows.select("o_orderkey", times.typed_time(F.col("ms"), F.lit("number"), "unix_ms").cast("timestamp_ntz").alias("from_ms"), times.typed_time(F.col("iso"), F.lit("string"), "rfc3339").cast("timestamp_ntz").alias("from_text"), times.any_time(F.col("long")).cast("timestamp_ntz").alias("from_date"))


# Records and mutations.


@query("SELECT o_orderstatus AS status, count(*) n FROM orders GROUP BY 1")
def status_histogram(spark, sf):
    return T.read(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query(f"WITH {T.RECORDS} SELECT c.id, c.domain, r.status FROM companies c LEFT JOIN records r USING (domain) WHERE r.domain IS NULL OR r.status <> 'discovered'")
def pending_companies(spark, sf):
    return schedule.pending(T.companies(spark, sf), T.records(spark, sf)).select("id", "domain", "status")


@query(f"WITH {T.RECORDS} SELECT count(*) n FROM companies c LEFT JOIN records r USING (domain) WHERE r.domain IS NULL OR r.status = 'pending'")
def pending_company_count(spark, sf):
    return T.companies(spark, sf).join(T.records(spark, sf).select("domain", "status"), "domain", "left").where("status is null or status = 'pending'").agg(F.count("*").alias("n"))


@query(f"WITH {T.RECORDS} SELECT domain, next_replay FROM records WHERE status = 'discovered' AND (next_replay IS NULL OR next_replay <= {AS_OF_SQL}) ORDER BY next_replay NULLS FIRST, domain LIMIT 100")
def due_replay_queue(spark, sf):
    return schedule.due(T.records(spark, sf), as_of(), 100).select("domain", "next_replay")


@query(f"WITH {T.RECORDS} SELECT c.domain, CASE WHEN r.status = 'discovered' THEN 'replay' ELSE 'tier1' END route FROM companies c LEFT JOIN records r USING (domain)")
def route_tiers(spark, sf):
    messages = T.companies(spark, sf).select("domain", F.concat(F.lit("https://"), "domain", F.lit(":443/x")).alias("raw_url"))
    return routing.route(messages, T.records(spark, sf)).select("domain", "route")


FOUND_SQL = "found AS (SELECT domain, 'https://new.example/' || id api_url, 'tier2' tier_used, 0.75 confidence FROM companies WHERE created_at > 5000)"


def _found(spark, sf):
    return T.companies(spark, sf).where("created_at > 5000").select("domain", F.concat(F.lit("https://new.example/"), "id").alias("api_url"), F.lit("tier2").alias("tier_used"), F.lit(0.75).alias("confidence"))


@query(f"""WITH {T.RECORDS}, {FOUND_SQL} SELECT coalesce(r.domain, f.domain) domain, CASE WHEN f.domain IS NOT NULL THEN f.api_url ELSE r.api_url END api_url, CASE WHEN f.domain IS NOT NULL THEN 'discovered' ELSE r.status END status,
CASE WHEN f.domain IS NOT NULL THEN CAST(0.75 AS DOUBLE) ELSE r.confidence END confidence, CASE WHEN f.domain IS NOT NULL THEN {AS_OF_SQL} + INTERVAL 1 HOUR ELSE r.next_replay END next_replay, CASE WHEN f.domain IS NOT NULL THEN 0 ELSE r.consecutive_failures END consecutive_failures FROM records r FULL JOIN found f ON r.domain = f.domain""")
def merge_discovered(spark, sf):
    return merge.mark_discovered(T.records(spark, sf), _found(spark, sf), as_of()).select("domain", "api_url", "status", "confidence", "next_replay", "consecutive_failures")


@query(f"""WITH {T.RECORDS}, f AS (SELECT domain FROM companies WHERE created_at <= 5000) SELECT coalesce(r.domain, f.domain) domain, CASE WHEN r.domain IS NULL THEN 'pending' WHEN f.domain IS NOT NULL AND r.consecutive_failures + 1 >= 3 THEN 'failed' ELSE r.status END status,
CASE WHEN r.domain IS NULL THEN 1 WHEN f.domain IS NOT NULL THEN r.consecutive_failures + 1 ELSE r.consecutive_failures END consecutive_failures, CASE WHEN f.domain IS NOT NULL THEN 'timeout' ELSE r.last_error END last_error FROM records r FULL JOIN f ON r.domain = f.domain""")
def merge_failed(spark, sf):
    failed = T.companies(spark, sf).where("created_at <= 5000").select("domain", F.lit("timeout").alias("last_error"))
    return merge.mark_failed(T.records(spark, sf), failed, as_of()).select("domain", "status", "consecutive_failures", "last_error")


@query(f"WITH {T.RECORDS} SELECT domain, status FROM records UNION ALL SELECT domain, 'pending' FROM companies WHERE created_at > 8000 AND domain NOT IN (SELECT domain FROM records)")
def insert_ignore(spark, sf):
    return merge.create_pending(T.records(spark, sf), T.companies(spark, sf).where("created_at > 8000").select("domain"), as_of()).select("domain", "status")


@query(f"""WITH {T.RECORDS}, {FOUND_SQL} SELECT coalesce(r.domain, f.domain) domain, CASE WHEN r.domain IS NULL OR (f.domain IS NOT NULL AND r.status <> 'discovered') THEN f.api_url ELSE r.api_url END api_url,
CASE WHEN r.domain IS NULL OR f.domain IS NOT NULL THEN 'discovered' ELSE r.status END status FROM records r FULL JOIN found f ON r.domain = f.domain""")
def conditional_upsert(spark, sf):
    return merge.save_probe(T.records(spark, sf), _found(spark, sf), as_of()).select("domain", "api_url", "status")


@query(f"""WITH {T.RECORDS} SELECT domain, api_url, confidence FROM records WHERE NOT coalesce({contains("api_url", rules.FALSE_POSITIVES)}, false) AND NOT coalesce(confidence < 0.1, false)""")
def purge_false_positives(spark, sf):
    return merge.purge_false_positives(T.records(spark, sf), least=0.1).select("domain", "api_url", "confidence")


@query(f"""WITH {T.RECORDS} SELECT domain, CASE WHEN status = 'failed' AND api_url IS NULL THEN 'pending' ELSE status END status, CASE WHEN status = 'failed' AND api_url IS NULL THEN 0 ELSE consecutive_failures END consecutive_failures FROM records""")
def reset_failed(spark, sf):
    return merge.reset_failed(T.records(spark, sf)).select("domain", "status", "consecutive_failures")


@query(f"""WITH {T.RECORDS}, n AS (SELECT *, row_number() OVER (PARTITION BY api_url ORDER BY domain) k FROM records WHERE api_url IS NOT NULL)
SELECT api_url endpoint_url, 'src_' || replace(domain, '-', '') public_ref, CASE tier_used WHEN 'tier0' THEN 'ats_probe' WHEN 'tier2' THEN 'browser_intercept' ELSE 'unknown' END discovery_method, 'unknown' ats_platform, CASE status WHEN 'discovered' THEN 'active' WHEN 'pending' THEN 'unverified' ELSE 'retired' END status FROM n WHERE k = 1""")
def backfill_sources(spark, sf):
    empty = spark.createDataFrame([], "id string, public_ref string, discovery_method string, discovery_tier string, ats_platform string, discovered_at timestamp_ntz, endpoint_url string, status string, confidence double")
    rows = T.records(spark, sf).withColumn("id", F.col("domain")).withColumn("discovered_at", F.col("next_replay"))
    return merge.backfill_sources(rows, empty, as_of()).select("endpoint_url", "public_ref", "discovery_method", "ats_platform", "status")


@query(f"""WITH {T.ITEMS}, one AS (SELECT source_id, external_id, min(title) title, min(l_shipdate) shipped FROM items GROUP BY 1, 2), old AS (SELECT source_id, external_id, 'old' title, TIMESTAMP '1990-01-01 00:00:00' last_seen_at FROM one WHERE shipped < TIMESTAMP '1999-01-01 00:00:00'), new AS (SELECT source_id, external_id, title FROM one WHERE shipped >= TIMESTAMP '1997-01-01 00:00:00')
SELECT coalesce(o.source_id, n.source_id) source_id, coalesce(o.external_id, n.external_id) external_id, CASE WHEN n.external_id IS NOT NULL THEN n.title ELSE o.title END title, CASE WHEN n.external_id IS NOT NULL THEN {AS_OF_SQL} ELSE o.last_seen_at END last_seen_at
FROM old o FULL JOIN new n ON o.source_id = n.source_id AND o.external_id = n.external_id""")
def merge_jobs(spark, sf):
    items = T.read(spark, sf, "lineitem").join(T.read(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("title")), "l_partkey").select(F.col("l_orderkey").alias("source_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("external_id"), "title", "l_shipdate").groupBy("source_id", "external_id").agg(F.min("title").alias("title"), F.min("l_shipdate").alias("shipped"))
    at = lambda year: F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    old = items.where(F.col("shipped") < at(1999)).select("source_id", "external_id", F.lit("old").alias("title"), F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("last_seen_at"))
    return merge.upsert_jobs(old, items.where(F.col("shipped") >= at(1997)).drop("shipped"), as_of())


# Fetch logs.


@query(f"""WITH {T.LOGS}, i AS (SELECT *, sum(CAST(success AS INT)) OVER (PARTITION BY source_id ORDER BY fetched_at, seq) g FROM logs)
SELECT seq, CAST(sum(CAST(NOT success AS INT)) OVER (PARTITION BY source_id, g ORDER BY fetched_at, seq) AS BIGINT) streak FROM i""")
def failure_streaks(spark, sf):
    return schedule.failure_streaks(T.fetch_logs(spark, sf), "source_id", ["fetched_at", "seq"]).select("seq", "streak")


@query(f"""WITH {T.LOGS} SELECT source_id, count(*) fetches, count_if(success) successes, count_if(NOT success) failures, CAST(sum(jobs_found) AS BIGINT) jobs, arg_max(jobs_found, (fetched_at, seq)) last_jobs, round(avg(duration), 6) avg_duration FROM logs GROUP BY 1""")
def source_health(spark, sf):
    return reports.source_health(T.fetch_logs(spark, sf))


@query(f"""WITH {T.LOGS}, b(le) AS (VALUES (0.5::DOUBLE), (1.0), (2.0), (5.0), (10.0), (20.0), (45.0), (NULL)) SELECT source_id, le, count_if(le IS NULL OR duration <= le) n FROM logs, b GROUP BY 1, 2""")
def duration_histogram(spark, sf):
    return reports.histogram(T.fetch_logs(spark, sf), "source_id", "duration")


@query("""WITH m AS (SELECT event_id, event_type <> 'error' ok, unnest(range(0, 5)) k, date_trunc('minute', ts) base FROM events), w AS (SELECT base - k * INTERVAL 1 MINUTE AS start, ok FROM m)
SELECT start, count_if(ok) ok, count(*) n, round(count_if(ok) / count(*)::DOUBLE, 6) ratio, count_if(ok) / count(*)::DOUBLE < 0.8 low FROM w GROUP BY 1""")
def alert_success_ratio(spark, sf):
    return reports.alert_success(T.read(spark, sf, "events").select(F.col("ts").alias("at"), (F.col("event_type") != "error").alias("ok")))


@query("""WITH x AS (SELECT event_id, ts, user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) b FROM events) SELECT event_id, CASE WHEN b IS NOT NULL THEN (epoch_us(ts) - epoch_us(b)) / 1e6 END gap FROM x""")
def cooldown_gap(spark, sf):
    return schedule.gaps(T.read(spark, sf, "events"), "user_id", "ts", "event_id").select("event_id", "gap")


@query("""WITH RECURSIVE firsts AS (SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
a(user_id, event_id, ts) AS (SELECT * FROM firsts UNION ALL SELECT user_id, event_id, ts FROM (
  SELECT e.user_id, e.event_id, e.ts, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) n FROM a JOIN events e ON e.user_id = a.user_id AND e.ts >= a.ts + INTERVAL 4 HOUR) WHERE n = 1)
SELECT e.event_id, e.user_id, e.ts, a.event_id IS NOT NULL allowed FROM events e LEFT JOIN a ON e.event_id = a.event_id""")
def cooldown_allowed(spark, sf):
    """Which requests a four-hour cooldown lets through depends on the ones that it did."""
    return schedule.allowed_requests(T.read(spark, sf, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", 4 * 3600)


@query("SELECT event_id, floor(avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) * 1e6 + 0.2371) / 1e6 rolling_mean FROM events")
def rolling_score_mean(spark, sf):
    return schedule.rolling_mean(T.read(spark, sf, "events"), "event_type", "event_id", "value").select("event_id", (F.floor(F.col("rolling_mean") * 1e6 + 0.2371) / 1e6).alias("rolling_mean"))


@query("""WITH f AS (SELECT p_brand ats, p_size > 10 valid, p_retailprice > 1200 confirmed FROM part), g AS (SELECT coalesce(ats, 'TOTAL') ats, count(*) raw, count_if(valid) valid, count_if(valid AND confirmed) confirmed FROM f GROUP BY ROLLUP (ats))
SELECT ats, raw, valid, confirmed, round(confirmed / nullif(valid, 0)::DOUBLE, 6) rate FROM g""")
def harvest_funnel_rollup(spark, sf):
    return reports.harvest_funnel(T.read(spark, sf, "part").select(F.col("p_brand").alias("ats"), (F.col("p_size") > 10).alias("valid"), (F.col("p_retailprice") > 1200).alias("confirmed")))


@query("SELECT coalesce(event_type, 'TOTAL') ats, count_if(value > 80) active, count_if(value BETWEEN 20 AND 80) inactive, count_if(value < 20) error, count(*) total FROM (SELECT event_type, CAST(value AS DOUBLE) value FROM events) GROUP BY ROLLUP (event_type)".replace("value BETWEEN 20 AND 80", "value >= 20 AND value <= 80"))
def platform_status_totals(spark, sf):
    status = F.when(F.col("value") > 80, "active").when(F.col("value") >= 20, "inactive").otherwise("error")
    return reports.status_pivot(T.read(spark, sf, "events").select(F.col("event_type").alias("ats"), status.alias("status")), "ats", "status", ["active", "inactive", "error"])


# Bodies.


@query(f"""WITH {T.ITEMS} SELECT source_id, external_id, title, 'site ' || l_suppkey location_raw, p_type department, 'https://x.example/' || l_partkey apply_url, l_shipdate posted_at FROM items""")
def job_parse_known(spark, sf):
    return parse.parse_known(T.bodies(spark, sf), ["source_id"], platforms=["greenhouse"]).select("source_id", "external_id", "title", "location_raw", "department", "apply_url", F.col("posted_at").cast("timestamp_ntz").alias("posted_at"))


@query(f"""WITH {T.ITEMS} SELECT source_id, external_id, title, CASE WHEN l_suppkey % 2 = 0 AND l_suppkey > 0 THEN 'city ' || (l_suppkey % 7) ELSE '' END city, CASE WHEN l_suppkey % 2 = 0 AND l_suppkey > 0 THEN 'place ' || l_suppkey ELSE '' END location_raw FROM items""")
def lookup_join_parse(spark, sf):
    return parse.parse_known(T.bodies(spark, sf, "freshteam"), ["source_id"], platforms=["freshteam"]).select("source_id", "external_id", "title", "city", "location_raw")


@query(f"""WITH {T.ITEMS} SELECT source_id, external_id external_job_id, title, 'site ' || l_suppkey AS location FROM items""")
def job_parse_heuristic(spark, sf):
    return parse.parse_heuristic(T.bodies(spark, sf).withColumnRenamed("body", "raw_json"), ["source_id"]).select("source_id", "external_job_id", "title", "location")


@query(f"""WITH {T.ITEMS}, j AS (SELECT source_id, sum(octet_length(encode('{{"id":' || external_id || ',"title":"' || title || '","location":{{"name":"site ' || l_suppkey || '"}},"departments":[{{"name":"' || p_type || '"}}],"first_published":"2000-01-01T00:00:00Z","branch_id":' || l_suppkey || ',"absolute_url":"https://x.example/' || l_partkey || '"}}'))) + count(*) - 1 size FROM items GROUP BY 1),
b AS (SELECT source_id, sum(octet_length(encode('{{"id":' || l_suppkey || ',"city":"city ' || (l_suppkey % 7) || '","country_code":"XX","location":"place ' || l_suppkey || '"}}'))) + count(*) - 1 size FROM (SELECT DISTINCT source_id, l_suppkey FROM items WHERE l_suppkey % 2 = 0) GROUP BY 1)
SELECT source_id, round(0.15 + 0.40 + 0.20 + CASE WHEN b.size > 0 THEN 0.15 ELSE 0 END + CASE WHEN 25 + j.size + coalesce(b.size, 0) >= 500 THEN 0.10 ELSE 0 END, 6)::DOUBLE score, 'shape1_full_list' shape FROM j LEFT JOIN b USING (source_id)""")
def body_shape_score(spark, sf):
    """JSON of any depth is walked in Python."""
    url = F.concat(F.lit("https://api.example.com/jobs/"), "source_id")
    return T.bodies(spark, sf).select("source_id", scoring.body_confidence(url, F.col("body")).alias("b")).select("source_id", F.round("b.score", 6).alias("score"), "b.shape")


@query(f"""WITH {T.ITEMS}, n AS (SELECT source_id, count(*) n FROM items GROUP BY 1) SELECT source_id, true AS confirmed, CAST(n AS INT) job_count FROM n""")
def probe_confirmation(spark, sf):
    c = probing.confirmation(F.col("platform"), F.lit(200), F.lit("application/json"), F.col("body"))
    return T.bodies(spark, sf).select("source_id", c.alias("c")).select("source_id", "c.confirmed", "c.job_count")


@query(f"""WITH {T.CAPTURES}, f AS (SELECT id, CAST({contains("lower(" + PATH.format("url") + ")", features.JOB_SEGMENTS)} AS INT) has_job_path_segment, CAST({contains("lower(" + QUERY.format("url") + ")", features.PARAMS)} AS INT) has_pagination_param,
CAST(length({PATH.format("url")}) - length(replace({PATH.format("url")}, '/', '')) AS INT) url_path_depth, CAST(event_type = 'click' AS INT) is_post, CAST(event_type <> 'click' AS INT) is_get, CAST({contains("lower(props)", tuple('"' + k + '"' for k in features.BODY_KEYS))} AS INT) has_job_body_key,
CASE WHEN length(props) = 0 THEN 0 WHEN length(props) < 100 THEN 1 WHEN length(props) < 1000 THEN 2 ELSE 3 END body_length_bucket FROM captures)
SELECT *, 1 is_json_body, round(least((has_job_path_segment + has_pagination_param + url_path_depth + is_post + is_get + 1 + 1 + has_job_body_key + body_length_bucket + 1) / 8.0, 1.0), 6)::DOUBLE confidence FROM f""")
def ml_features(spark, sf):
    headers = F.create_map(F.lit("Accept"), F.lit("application/JSON"))
    method = F.when(F.col("event_type") == "click", "POST").otherwise("GET")
    rows = features.fallback(T.captures(spark, sf).select("id", *features.request_features(F.col("url"), method, headers, F.col("props"))))
    return rows.select("id", "has_job_path_segment", "has_pagination_param", "url_path_depth", "is_post", "is_get", "has_job_body_key", "body_length_bucket", "is_json_body", F.round("confidence", 6).alias("confidence"))


@query("""WITH s AS (SELECT least(n_chars / 5000.0::DOUBLE, 1.0) s, quality q FROM labels JOIN documents USING (doc_id)), p AS (SELECT count_if(q = 1) pos, count_if(q = 0) neg, count_if(q = 1 AND s >= 0.5) tp, count_if(q = 0 AND s >= 0.5) fp FROM s),
w AS (SELECT sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END)::DOUBLE wins FROM s a, s b WHERE a.q = 1 AND b.q = 0)
SELECT pos, neg, round(tp / (tp + fp)::DOUBLE, 6) "precision", round(tp / pos::DOUBLE, 6) recall, round(2 * (tp / (tp + fp)::DOUBLE) * (tp / pos::DOUBLE) / (tp / (tp + fp)::DOUBLE + tp / pos::DOUBLE), 6) f1, round(neg / pos::DOUBLE, 6) class_weight, round(wins / (pos * neg), 6) auc FROM p, w""")
def auc_rank(spark, sf):
    rows = T.read(spark, sf, "labels").join(T.read(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").select(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("score"), F.col("quality").alias("label"))
    return reports.evaluation(rows)


# Event time (an addition: the pipeline itself goes by arrival).


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) n FROM events GROUP BY 1, 2")
def tumbling_counts(spark, sf):
    return T.read(spark, sf, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) k FROM g)
SELECT user_id, min(ts) AS start, count(*) n FROM s GROUP BY user_id, k""")
def session_counts(spark, sf):
    return T.read(spark, sf, "events").groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


from . import inventory  # noqa: E402, F401  registers more
