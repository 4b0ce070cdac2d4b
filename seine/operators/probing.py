"""Whether a landed response confirms a platform's board, and which of several probes wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsons, urls


def _has(body: Column, *names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & body.contains(f'"{name}"')
    return out


def _length(body: Column, path: str) -> Column:
    return F.coalesce(F.json_array_length(jsons.at(body, path) if path else body), F.lit(0))


def confirmation(ats: Column, status: Column, content_type: Column, body: Column) -> Column:
    """Struct of confirmed and job_count for a landed response, by the platform's own test; false for unknown platforms."""
    ok, json, size = status == 200, urls.is_json_content_type(content_type), F.octet_length(body)
    first = lambda path, key: jsons.at(body, f"{path}[0].{key}" if path else key)
    html = body.contains("<html") | body.contains("<!DOCTYPE")
    none = F.lit(0)
    postings = F.when(jsons.kind(body, "data.jobBoardWithTeams") == "object", _length(body, "data.jobBoardWithTeams.jobPostings"))
    tests = {
        "greenhouse": (ok & (size > 100) & json & jsons.is_json(body) & _has(body, "jobs"), _length(body, "jobs")),
        "lever": (ok & (size > 2) & json & F.get_json_object(body, "$[0].text").isNotNull(), _length(body, "")),
        "ashby": (ok & postings.isNotNull(), F.coalesce(postings, none)),
        "workable": (ok & json & (jsons.number_at(body, "total") > 0), jsons.number_at(body, "total").cast("int")),
        "bamboohr": (ok & (size > 50) & _has(body, "jobOpenings"), none),
        "recruitee": (ok & json & (size > 100) & (F.coalesce(first("offers", "title"), F.lit("")) != "") & (F.coalesce(first("offers", "slug"), F.lit("")) != ""), _length(body, "offers")),
        "teamtailor": (ok & json & _has(body, "data") & (size > 50) & (_length(body, "data") > 0), _length(body, "data")),
        "rippling": (ok & json & _has(body, "id", "name", "department") & (size > 200), none),
        "pinpoint": (~html & ok & json & (size > 300) & _has(body, "data", "title", "location", "employment_type") & (_length(body, "data") > 0), _length(body, "data")),
        "freshteam": (ok & json & (size > 500) & _has(body, "title", "id", "remote"), none),
        "smartrecruiters": (ok & json & (size > 50) & first("content", "name").isNotNull(), _length(body, "content")),
        "jobvite": (ok & json & ((jsons.number_at(body, "totalCount") > 0) | (_length(body, "reqList") > 0)), _length(body, "reqList")),
        "breezyhr": (ok & json & (_length(body, "") > 0), _length(body, "")),
        "personio": (ok & json & (size > 50) & (_length(body, "") > 0), _length(body, "")),
        "workday": (ok & ((_length(body, "jobPostings") > 0) | (jsons.number_at(body, "total") > 0)), F.greatest(_length(body, "jobPostings"), jsons.number_at(body, "total").cast("int"))),
    }
    out = F.when(F.lit(False), F.struct(F.lit(False).alias("confirmed"), none.alias("job_count")))
    for name, (test, count) in tests.items():
        test = F.coalesce(test, F.lit(False))
        out = out.when(ats == name, F.struct(test.alias("confirmed"), F.when(test, count).otherwise(0).cast("int").alias("job_count")))
    return out.otherwise(F.struct(F.lit(False).alias("confirmed"), none.alias("job_count")))


def probes(slugs: DataFrame, platforms: tuple[str, ...]) -> DataFrame:
    """Every slug on every platform, in platform order (``priority``), with endpoint and method."""
    listed = F.explode(F.array(*(F.struct(F.lit(k).alias("priority"), F.lit(p).alias("ats")) for k, p in enumerate(platforms))))
    out = slugs.select("slug", listed.alias("p")).select("slug", "p.*")
    return out.select("*", urls.endpoint(F.col("ats"), F.col("slug")).alias("api_url"), urls.endpoint_method(F.col("ats")).alias("method"))


def boards(environments: tuple[str, ...], names: DataFrame) -> DataFrame:
    """Every environment with every distinct board, letter case aside."""
    return names.groupBy(F.lower("board").alias("key")).agg(F.min("board").alias("board")).select("board", F.posexplode(F.array(*map(F.lit, environments))).alias("priority", "environment"))


def first_hit(responses: DataFrame, key: str = "slug") -> DataFrame:
    """The confirmed response of least priority for each key."""
    judged = responses.withColumn("_c", confirmation(F.col("ats"), F.col("status"), F.col("content_type"), F.col("body"))).where("_c.confirmed")
    return judged.groupBy(key).agg(F.min_by(F.struct("ats", "api_url", F.col("_c.job_count").alias("job_count")), "priority").alias("hit")).select(key, "hit.*", urls.platform_domain(F.col("hit.ats"), F.col(key)).alias("domain"))
