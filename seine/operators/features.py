"""Sixteen features of a request, in a fixed order, and a classifier over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsons, urls

# What the features look for.
JOB_SEGMENTS = ("/jobs", "/careers", "/positions", "/openings", "/postings", "/vacancies", "/roles", "/graphql", "/api/v")
ATS = ("greenhouse.io", "lever.co", "ashbyhq.com", "workday.com", "myworkdayjobs.com", "smartrecruiters.com", "bamboohr.com", "jobvite.com", "icims.com", "breezy.hr", "recruitee.com", "teamtailor.com", "personio.com")
PARAMS = ("page=", "from=", "size=", "offset=", "start=", "limit=")
BODY_KEYS = ("limit", "offset", "departments", "jobtype", "locationid", "operationname", "page", "size", "category", "team")
NAMES = (
    "has_job_path_segment", "has_ats_domain", "has_pagination_param", "url_path_depth", "is_graphql", "is_post", "is_get", "has_auth_bearer", "has_api_key_header",
    "has_json_content_type", "has_accept_json", "header_count", "has_job_body_key", "body_length_bucket", "is_json_body", "response_is_json",
)


def request_features(url: Column, method: Column, headers: Column, body: Column) -> list[Column]:
    """Sixteen integer columns; header names count in lower case, at most 30; the last is always 0."""
    u, p, q = F.lower(url), F.lower(urls.path(url)), F.lower(urls.query(url))
    names = F.transform(F.map_keys(headers), lambda k: F.lower(k))
    value = lambda name: F.get(F.transform(F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name), lambda e: F.lower(e["value"])), 0)
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    n = F.length(body)
    out = (
        yes(urls.contains_any(p, JOB_SEGMENTS)), yes(urls.contains_any(u, ATS)), yes(urls.contains_any(q, PARAMS)), urls.slash_count(p), yes(u.contains("graphql")), yes(F.upper(method) == "POST"), yes(F.upper(method) == "GET"),
        yes(value("authorization").startswith("bearer ")), yes(F.arrays_overlap(names, F.array(*map(F.lit, ("x-api-key", "x-auth-token", "api-key"))))), yes(value("content-type").contains("json")), yes(value("accept").contains("json")),
        F.least(F.size(F.array_distinct(names)), F.lit(30)), yes(urls.contains_any(F.lower(body), tuple(f'"{k}"' for k in BODY_KEYS))), F.when(n == 0, 0).when(n < 100, 1).when(n < 1000, 2).otherwise(3), yes(jsons.is_json(body)), F.lit(0),
    )
    return [c.cast("int").alias(name) for c, name in zip(out, NAMES, strict=True)]


def fallback(rows: DataFrame) -> DataFrame:
    """``confidence`` (sum over 8, at most 1) and ``positive`` (0.4 or more), where no model is at hand."""
    total = sum((F.col(n) for n in NAMES), F.lit(0))
    return rows.withColumn("confidence", F.least(total / 8.0, F.lit(1.0))).withColumn("positive", F.col("confidence") >= 0.4)


def split(rows: DataFrame, label: str = "label", share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from and rows to evaluate with, each with that share of either label.

    A hash of the whole row decides, so equal rows are on one side, and a recomputed task agrees.
    """
    drawn = F.pmod(F.xxhash64(F.lit(seed), *rows.columns), F.lit(1 << 20)) < int(share * (1 << 20))
    return rows.where(drawn), rows.where(~drawn)


def train(rows: DataFrame, label: str = "label", seed: int = 42, trees: int = 200):
    """Gradient-boosted trees (depth 6, rate 0.1, each from four fifths of the rows) on the features, weighted for balance. Returns the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    counts = rows.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).first()
    weighted = rows.withColumn("_weight", F.when(F.col(label) == 1, counts.q / max(counts.p, 1)).otherwise(1.0)).withColumn(label, F.col(label).cast("double"))
    trees = GBTClassifier(labelCol=label, featuresCol="_features", weightCol="_weight", maxDepth=6, stepSize=0.1, maxIter=trees, subsamplingRate=0.8, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(NAMES), outputCol="_features"), trees]).fit(weighted)


def predict(model, rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return model.transform(rows).withColumn("confidence", F.get(vector_to_array("probability"), 1)).drop("_features", "rawPrediction", "probability")
