"""Reports over captures, fetches and harvests: grouped counts, top lists, mined rules, context of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import jsons, urls

#: Upper bounds of a fetch's seconds.
BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 45.0)


def capture_totals(captures: DataFrame) -> DataFrame:
    """Seven counts in one pass."""
    label = F.col("label")
    return captures.agg(F.count("*").alias("total"), F.count(label).alias("labelled"), F.count_if(label == 1).alias("positive"), F.count_if(label == 0).alias("negative"), F.count_if(label.isNull()).alias("unlabelled"), F.countDistinct("domain").alias("domains"), F.countDistinct(F.when(label == 1, F.col("domain"))).alias("positive_domains"))


def domain_report(captures: DataFrame, top: int = 30) -> DataFrame:
    """The domains with most captures and each one's commonest URL, the least on a tie.

    Counts of (domain, url) combine before the shuffle, so a hot domain is as many rows as it has URLs.
    """
    by_url = captures.groupBy("domain", "url").agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.count_if(F.col("label") == 1).alias("positive"))
    out = by_url.groupBy("domain").agg(F.sum("n").alias("total"), F.sum("labelled").alias("labelled"), F.sum("positive").alias("positive"), F.min_by("url", F.struct(-F.col("n"), F.col("url"))).alias("top_url"))
    return out.orderBy(F.desc("total"), "domain").limit(top)


def counted(rows: DataFrame, value: Column, name: str, top: int | None = None, least: int = 1) -> DataFrame:
    """How often each value of an array column occurs, most first, then by value."""
    out = rows.select(F.explode(value).alias(name)).where(F.col(name) != "").groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), name)
    return out.limit(top) if top else out


def counts_by(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each value of a column."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def path_segments(rows: DataFrame, url_col: str, top: int | None = 20, least: int = 1) -> DataFrame:
    return counted(rows, urls.segments(urls.path(F.col(url_col))), "segment", top, least)


def word_segments(rows: DataFrame, url_col: str) -> DataFrame:
    """Segments of letters, hyphen and underscore, over two bytes long, that occur twice or more."""
    return counted(rows, F.filter(urls.segments(urls.path(F.col(url_col))), lambda s: s.rlike("^[A-Za-z_-]+$") & (F.octet_length(s) > 2)), "segment", None, 2)


def query_params(rows: DataFrame, url_col: str, top: int | None = 20) -> DataFrame:
    return counted(rows, urls.query_keys(urls.query(F.col(url_col))), "param", top)


def field_census(rows: DataFrame, json_col: str, top: int | None = 30) -> DataFrame:
    return counted(rows, jsons.field_census(F.col(json_col)), "field", top)


def discovered_hosts(captures: DataFrame, url_col: str = "url") -> DataFrame:
    return captures.select(urls.bare_host(F.col(url_col)).alias("host")).where("host <> ''").distinct()


def block_hosts(captures: DataFrame, least: int = 3) -> DataFrame:
    """API hosts of so many negative captures whose URL is nowhere positive."""
    good = captures.where("label = 1").select("url").distinct()
    bad = captures.where("label = 0").join(good, "url", "left_anti")
    return bad.groupBy(urls.api_domain(F.col("url")).alias("host")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def accept_hosts(captures: DataFrame, least: int = 2) -> DataFrame:
    """API hosts with positive captures of so many domains."""
    return captures.where("label = 1").groupBy(urls.api_domain(F.col("url")).alias("host")).agg(F.countDistinct("domain").alias("domains")).where(F.col("domains") >= least)


def feedback(entries: DataFrame) -> DataFrame:
    """Weighted hits, misses and the last hit of each domain."""
    return entries.groupBy("domain").agg(F.coalesce(F.sum(F.when(F.col("hit"), F.col("weight"))), F.lit(0.0)).alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.max(F.when(F.col("hit"), F.col("at"))).alias("last_hit"))


def hit_rate(feedback_rows: DataFrame) -> DataFrame:
    return feedback_rows.agg((F.sum("hits") / F.nullif(F.sum("hits") + F.sum("misses"), F.lit(0))).alias("hit_rate"))


def entry_summary(entries: DataFrame, least: float = 0.25) -> DataFrame:
    """Hits, misses and near misses (no hit, body score above ``least``) of each domain."""
    return entries.groupBy("domain").agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.count("*").alias("total"), F.count_if(~F.col("hit") & (F.col("body_score") > least)).alias("near_misses"))


def histogram(rows: DataFrame, key: str, value: str, bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """Cumulative counts below or at each bound, one row a key and bound, and one with a null bound for all."""
    counts = rows.groupBy(key).agg(*(F.count_if(F.col(value) <= b).alias(f"c{k}") for k, b in enumerate(bounds)), F.count("*").alias("c_all"))
    listed = F.array(*(F.struct(F.lit(b).alias("le"), F.col(f"c{k}").alias("n")) for k, b in enumerate(bounds)), F.struct(F.lit(None).cast("double").alias("le"), F.col("c_all").alias("n")))
    return counts.select(key, F.explode(listed).alias("x")).select(key, "x.le", "x.n")


def status_pivot(rows: DataFrame, key: str, status: str, values: list[str]) -> DataFrame:
    """Counts by status of each key and a TOTAL row."""
    return rows.rollup(key).agg(*(F.count_if(F.col(status) == v).alias(v) for v in values), F.count("*").alias("total")).withColumn(key, F.coalesce(F.col(key), F.lit("TOTAL")))


def harvest_funnel(rows: DataFrame, key: str = "ats") -> DataFrame:
    """Raw, valid and confirmed rows of each platform with the rate of confirmed among valid ones, and a TOTAL row."""
    out = rows.rollup(key).agg(F.count("*").alias("raw"), F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & F.col("confirmed")).alias("confirmed"))
    return out.select(F.coalesce(F.col(key), F.lit("TOTAL")).alias(key), "raw", "valid", "confirmed", F.round(F.col("confirmed") / F.nullif(F.col("valid"), F.lit(0)), 6).alias("rate"))


def source_health(logs: DataFrame) -> DataFrame:
    """Fetches, successes, failures, jobs, the last count and the mean duration of each source."""
    return logs.groupBy("source_id").agg(F.count("*").alias("fetches"), F.count_if("success").alias("successes"), F.count_if(~F.col("success")).alias("failures"), F.sum("jobs_found").alias("jobs"), F.max_by("jobs_found", F.struct("fetched_at", "seq")).alias("last_jobs"), F.round(F.avg("duration"), 6).alias("avg_duration"))


def capture_context(captures: DataFrame) -> DataFrame:
    """Beside each capture, the other ones of its domain: all, positive, negative. Counts join back, so a hot domain splits."""
    counts = captures.groupBy("domain").agg(F.count("*").alias("_n"), F.count_if(F.col("label") == 1).alias("_p"), F.count_if(F.col("label") == 0).alias("_q"))
    is_ = lambda v: F.when(F.col("label") == v, 1).otherwise(0)
    return captures.join(counts, "domain").select(*captures.columns, (F.col("_n") - 1).alias("others"), (F.col("_p") - is_(1)).alias("others_positive"), (F.col("_q") - is_(0)).alias("others_negative"))


def near_miss_context(near: DataFrame, top: int = 3) -> DataFrame:
    """Beside each unlabelled near miss, how many others its domain has and their best scores.

    A domain keeps its top + 1 scores, enough to leave out the row's own; the rank filter
    reaches each task before the shuffle.
    """
    open_ = near.where("label is null")
    ranked = open_.withColumn("_r", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("confidence"), "id"))).where(F.col("_r") <= top + 1)
    best = ranked.groupBy("domain").agg(F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "id"))).alias("_best"))
    counts = open_.groupBy("domain").agg(F.count("*").alias("_n"))
    others = F.transform(F.slice(F.filter("_best", lambda x: x["id"] != F.col("id")), 1, top), lambda x: -x["c"])
    return open_.join(counts, "domain").join(best, "domain").select(*near.columns, (F.col("_n") - 1).alias("others"), others.alias("best_others"))


def best_hits(hits: DataFrame, key: str, score: str, order: str) -> DataFrame:
    """The row of highest score for each key, the first on a tie."""
    own = [c for c in hits.columns if c != key]
    return hits.groupBy(key).agg(F.max_by(F.struct(*own), F.struct(F.col(score), -F.col(order))).alias("_b")).select(key, "_b.*")


def alert_success(ticks: DataFrame, window: str = "5 minutes", slide: str = "1 minute", least: float = 0.8) -> DataFrame:
    """Success ratio in sliding windows of ``at``, ``ok`` and whether it is too low."""
    out = ticks.groupBy(F.window("at", window, slide)).agg(F.count_if("ok").alias("ok"), F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), "ok", "n", F.round(F.col("ok") / F.col("n"), 6).alias("ratio"), (F.col("ok") / F.col("n") < least).alias("low"))


def held_alerts(alerts: DataFrame, minutes: int) -> DataFrame:
    """Stretches of consecutive low minutes that last long enough: first, last, minutes.

    Rows are minutes, not events: a year is half a million, so one ordered window holds them all.
    """
    minute = F.unix_timestamp("start").cast("long") / 60
    island = minute.cast("long") - F.row_number().over(Window.orderBy("start"))
    out = alerts.where("low").withColumn("_i", island).groupBy("_i").agg(F.min("start").alias("first"), F.max("start").alias("last"), F.count("*").alias("minutes"))
    return out.where(F.col("minutes") >= minutes).drop("_i")


#: Minutes that a rule must hold before it alerts.
HOLDS = {"success_rate": 5, "replay_lag": 5, "node_down": 2, "replay_errors": 5, "stalled": 10, "cost": 30}


def alert_minutes(ticks: DataFrame) -> DataFrame:
    """``alert``, ``start`` and ``low`` (whether the rule is broken) for each rule and minute from the first tick to the last.

    Ticks have ``at``, the flags success, failure, replay_error and processed, and the gauges lag
    (seconds), cost (dollars a URL) and up; a gauge is the most (up: the least) of a minute. Ticks
    fold into minutes first; a year of those is half a million rows, which one ordered window holds.
    """
    minute = F.date_trunc("minute", F.col("at"))
    counts = ticks.groupBy(minute.alias("m")).agg(*(F.count_if(c).alias(c) for c in ("success", "failure", "replay_error", "processed")), F.max("lag").alias("lag"), F.max("cost").alias("cost"), F.min("up").alias("up"))
    ends = counts.agg(F.min("m").alias("lo"), F.max("m").alias("hi")).where("lo is not null")
    every = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 minute"))).alias("m"))
    over = lambda c, n: F.coalesce(F.sum(c).over(Window.orderBy("m").rowsBetween(1 - n, 0)), F.lit(0))
    rows = every.join(counts, "m", "left").select("m", over("success", 5).alias("s"), over("failure", 5).alias("f"), over("replay_error", 5).alias("e"), over("processed", 15).alias("p"), "lag", "cost", "up")
    tests = {
        "success_rate": F.col("s") / F.nullif(F.col("s") + F.col("f"), F.lit(0)) < 0.8, "replay_lag": F.col("lag") > 3600, "node_down": F.col("up") == 0,
        "replay_errors": F.col("e") / 300.0 > 10, "stalled": F.col("p") == 0, "cost": F.col("cost") > 0.001,
    }
    listed = F.array(*(F.struct(F.lit(name).alias("alert"), F.coalesce(test, F.lit(False)).alias("low")) for name, test in tests.items()))
    return rows.select(F.col("m").alias("start"), F.explode(listed).alias("x")).select("x.alert", "start", "x.low")


def held_rules(minutes: DataFrame, holds: dict[str, int] = HOLDS) -> DataFrame:
    """Stretches of broken minutes of each alert that last as long as its rule asks: alert, first, last, minutes."""
    number = F.floor(F.unix_seconds(F.col("start").cast("timestamp")) / 60) - F.row_number().over(Window.partitionBy("alert").orderBy("start"))
    out = minutes.where("low").withColumn("_i", number).groupBy("alert", "_i").agg(F.min("start").alias("first"), F.max("start").alias("last"), F.count("*").alias("minutes"))
    hold = F.create_map(*(F.lit(x) for kv in holds.items() for x in kv))
    return out.where(F.col("minutes") >= F.coalesce(F.try_element_at(hold, F.col("alert")), F.lit(1))).drop("_i")


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a parent: none, where references hold."""
    return child.join(parent, keys, "left_anti")


def evaluation(scored: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1, class weight and the area under the ROC curve by ranks, ties at their mean rank.

    Rows fold into counts per score first. Ranks are running sums within 4,096 buckets of the
    score's range, on top of a running sum over the buckets, so no task sorts all scores.
    """
    rows = scored.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    rows = rows.withColumn("b", F.greatest(F.lit(0), F.least(F.lit(4095), F.floor(F.col("s") * 4096))).cast("int"))
    before = Window.unboundedPreceding
    buckets = rows.groupBy("b").agg(F.sum("q").alias("bq"))
    buckets = buckets.select("b", F.coalesce(F.sum("bq").over(Window.orderBy("b").rowsBetween(before, -1)), F.lit(0)).alias("lower"))
    rows = rows.join(F.broadcast(buckets), "b")  # at most 4,096 rows
    below = F.col("lower") + F.coalesce(F.sum("q").over(Window.partitionBy("b").orderBy("s").rowsBetween(before, -1)), F.lit(0))
    hit = lambda c: F.sum(F.when(F.col("s") >= threshold, F.col(c)).otherwise(0))
    out = rows.withColumn("wins", F.col("p") * (below + F.col("q") / 2.0)).agg(F.sum("p").alias("pos"), F.sum("q").alias("neg"), hit("p").alias("tp"), hit("q").alias("fp"), F.sum("wins").alias("wins"))
    ratio = lambda a, b: a / F.nullif(b, F.lit(0))
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("pos"))
    return out.select("pos", "neg", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)), 6).alias("f1"), F.round(ratio(F.col("neg"), F.col("pos")), 6).alias("class_weight"), F.round(ratio(F.col("wins"), F.col("pos") * F.col("neg")), 6).alias("auc"))
