import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from seine.functions import text
from seine.operators import bloom, capturing, features, merge, parse, reports, routing, schedule, urllists
from seine.plans import catalogue
from seine.sources import readers, writers
from seine.streaming import pipelines

SMALL = "/root/testdata/sf0.001"


def as_of():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


def plain(frame):
    text = lambda v: "None" if pd.isna(v) else repr(round(float(v), 6)) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(text, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, SMALL).toPandas(), duck.execute(catalogue.SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def records(spark, rows):
    return spark.createDataFrame(rows, "domain string, status string, consecutive_failures int, api_url string, confidence double, next_replay timestamp, last_error string")


def test_failures_escalate_and_discovery_resets(spark):
    now = records(spark, [("a", "discovered", 1, "u", 0.9, None, None), ("b", "pending", 0, None, None, None, None)])
    failed = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("c", "y")], "domain string, last_error string")
    for want in ({"a": ("discovered", 2), "b": ("pending", 1), "c": ("pending", 1)}, {"a": ("failed", 3), "b": ("pending", 2), "c": ("pending", 2)}):
        now = merge.mark_failed(now, failed, as_of()).cache()
        assert {r.domain: (r.status, r.consecutive_failures) for r in now.collect()} == want
    found = spark.createDataFrame([("a", "new", 0.7)], "domain string, api_url string, confidence double")
    once = merge.mark_discovered(now, found, as_of())
    assert sorted(map(str, once.collect())) == sorted(map(str, merge.mark_discovered(once, found, as_of()).collect()))
    a = once.where("domain = 'a'").first()
    assert (a.status, a.consecutive_failures, a.api_url, a.last_error, str(a.next_replay)) == ("discovered", 0, "new", None, "2024-01-01 01:00:00")


def test_source_degrades_at_the_fifth_failure(spark):
    s = spark.createDataFrame([(1, "active", 3), (2, "active", 0)], "source_id int, status string, consecutive_failures int")
    one = spark.createDataFrame([(1,)], "source_id int")
    s = merge.source_failed(s, one, as_of())
    assert s.where("source_id = 1").first().status == "active"
    assert merge.source_failed(s, one, as_of()).where("source_id = 1").first().status == "degraded"


def test_null_rows_survive_a_purge(spark):
    rows = records(spark, [("a", "discovered", 0, None, None, None, None), ("b", "discovered", 0, "https://x.onetrust.com", 0.9, None, None), ("c", "discovered", 0, "https://ok", 0.5, None, None), ("d", "discovered", 0, "https://ok", 0.6, None, None)])
    assert {r.domain for r in merge.purge_false_positives(rows).collect()} == {"a", "d"}


def test_cleaning_keeps_or_gives_a_reason(spark):
    urls = ["https://www.a.com/careers", "https://a.com", "https://a.com/", "not a url", "https://x.linkedin.com/a", "https://city.gov", "https://bit.ly/x", "https://z.org", "https://Z.org:80"]
    out = {r.url: (r.kept, r.reason) for r in urllists.clean_urls(spark.createDataFrame(list(enumerate(urls)), "ordinal int, url string")).collect()}
    assert len(out) == len(urls) and {u for u, (k, _) in out.items() if k} == {"https://a.com", "https://z.org", "https://Z.org:80"}
    assert out["https://www.a.com/careers"][1] == "duplicate (keeping https://a.com)" and out["not a url"][1] == "invalid" and out["https://city.gov"][1] == "government (.gov)" and out["https://bit.ly/x"][1] == "redirect (bit.ly)"


def test_frontier_and_streaks(spark):
    pushes = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.8, 3), ("d", 0.1, 4), ("e", 0.6, 5), ("f", 0.5, 6)], "url string, score double, seq int")
    assert [r.url for r in schedule.frontier(pushes, 3).collect()] == ["c", "e", "a"]


def test_cooldown_depends_on_what_was_allowed(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [("a", at(0), 1), ("a", at(1), 2), ("a", at(2), 3), ("a", at(3), 4), ("b", at(1), 5), ("a", at(5), 6)]
    out = schedule.allowed_requests(spark.createDataFrame(rows, "host string, at timestamp, id int"), "host", "at", "id", 2.0)
    assert {r.id for r in out.where("allowed").collect()} == {1, 3, 5, 6}
    same = [("x", at(0), k) for k in range(100)]
    assert schedule.allowed_requests(spark.createDataFrame(same, "host string, at timestamp, id int"), "host", "at", "id", 2.0).where("allowed").count() == 1


def test_routing_remembers_tier1_alone(spark):
    messages = spark.createDataFrame([("https://u@new.com:8/x", "new.com"), ("https://old.com", "old.com"), ("https://seen.com", "seen.com"), (None, "bare.com")], "raw_url string, domain string")
    known = spark.createDataFrame([("old.com", "discovered"), ("seen.com", "pending")], "domain string, status string")
    seen = spark.createDataFrame([("old.com",), ("seen.com",)], "domain string")
    assert {(r.domain, r.route) for r in routing.route(messages, known, seen).collect()} == {("new.com", "tier1"), ("old.com", "replay"), ("bare.com", "tier1")}


def test_evaluation_of_ties(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], "score double, label int")
    r = reports.evaluation(rows).first()
    assert (r.auc, r.precision, r.recall) == (0.875, pytest.approx(2 / 3, abs=1e-6), 1.0)


def test_held_alerts(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = spark.createDataFrame([(t(m), m in (1, 2, 3, 7)) for m in range(9)], "start timestamp, low boolean")
    assert [(r.first, r.minutes) for r in reports.held_alerts(rows, 3).collect()] == [(t(1), 3)]


def test_features_and_training(spark):
    rows = spark.createDataFrame([(k, f"https://a.com/{'jobs' if k % 2 else 'x'}?page=1", "GET", {"Authorization": "Bearer x", "X-API-Key": "k"}, '{"limit": 1}', k % 2) for k in range(40)], "id int, url string, method string, headers map<string,string>, body string, label int")
    out = rows.select("id", "label", *features.request_features(F.col("url"), F.col("method"), F.col("headers"), F.col("body")))
    first = out.where("id = 1").first()
    assert [first[n] for n in features.NAMES] == [1, 0, 1, 1, 0, 0, 1, 1, 1, 0, 0, 2, 1, 1, 1, 0]
    model = features.train(out)
    assert features.predict(model, out).where("(confidence >= 0.5) <> (label = 1)").count() == 0


def test_sources_and_sinks(spark, tmp_path):
    at = str(tmp_path)
    (tmp_path / "u.json").write_text('["https://a", "https://b"]')
    assert [r.url for r in readers.url_array(spark, f"{at}/u.json").orderBy("ordinal").collect()] == ["https://a", "https://b"]
    (tmp_path / "c.json").write_text('{"domain": "a", "was_hit": true}\n\nbroken\n{"domain": "b", "request_headers": {"A": "b"}}\n')
    rows = readers.captures(spark, f"{at}/c.json").where("domain is not null")
    assert {r.domain for r in rows.collect()} == {"a", "b"}
    writers.append_json(rows, f"{at}/out")
    writers.append_json(rows, "none")
    assert readers.captures(spark, f"{at}/out").count() == 2
    (tmp_path / "x.csv").write_text('Name, Domain \n"Acme, Inc",acme.com\nNo,\n')
    assert [r.domain for r in readers.companies_csv(spark, f"{at}/x.csv").collect()] == ["acme.com"]
    (tmp_path / "b.txt").write_text("co|Board\nco2|board\nnone\n")
    assert readers.board_list(spark, f"{at}/b.txt", [("z", "other")]).count() == 2
    assert [r.line for r in readers.lines(spark, f"{at}/b.txt").collect()][0] == "co|Board"
    writers.json_array(rows.select("domain"), f"{at}/arr", ["domain"])
    assert spark.read.text(f"{at}/arr").first().value == '[{"domain":"a"},{"domain":"b"}]'
    for _ in range(2):
        writers.new_version(rows.select("domain"), f"{at}/state")
    assert writers.versions(spark, f"{at}/state") == [1, 2] and writers.latest(spark, f"{at}/state").count() == 2
    writers.partitioned(rows.select("domain", F.lit(1).alias("v")), f"{at}/p", ["domain"], ["v"])
    assert spark.read.parquet(f"{at}/p").count() == 2
    assert writers.keyed_messages(rows.select("domain")).first().key in ("a", "b")


def run(query):
    query.processAllAvailable()
    query.stop()


def test_streams_equal_batches(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("at"), F.concat(F.lit("d"), "user_id").alias("domain"), (F.col("event_type") == "purchase").alias("hit"), F.lit(1.0).alias("weight"))
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run(pipelines.feedback(stream()).writeStream.outputMode("complete").format("memory").queryName("fb").start())
    assert sorted(map(str, spark.table("fb").collect())) == sorted(map(str, reports.feedback(events).collect()))
    run(pipelines.first_of_domain(stream(), "at").writeStream.format("memory").queryName("seen").start())
    assert spark.table("seen").count() == events.select("domain").distinct().count()
    run(pipelines.windowed(stream(), "at", ["hit"], "1 hour", "1 day").writeStream.outputMode("complete").format("memory").queryName("win").start())
    assert spark.table("win").agg(F.sum("n")).first()[0] == events.count()


def test_stream_stages(spark, tmp_path):
    rows = spark.createDataFrame([("d", "c", '[{"id": 1, "title": "T"}]'), ("d", "c", "broken")], "domain string, company_id string, raw_json string")
    rows.write.json(f"{tmp_path}/raw")
    source = readers.file_stream(spark, f"{tmp_path}/raw", readers.RAW_JOBS)
    got, dead = [], []
    run(pipelines.normalise(source, lambda b, _: got.extend(b.collect()), lambda b, _: dead.extend(b.collect()), f"{tmp_path}/cp"))
    assert [(r.external_job_id, r.title) for r in got] == [("1", "T")] and [r.raw_json for r in dead] == ["broken"]
    responses = spark.createDataFrame([("https://a.com/jobs", "GET", "application/json", '[{"title":1,"location":1,"description":1}]')], "url string, method string, content_type string, body string")
    assert pipelines.scored(responses).first().shape == "shape1_full_list"


def test_request_shaping(spark):
    rows = spark.createDataFrame([("greenhouse", "https://a/jobs"), ("greenhouse", "https://a/jobs?x=1"), ("greenhouse", "https://a?content=true"), ("lever", "https://a/b/jobs")], "p string, u string")
    assert [r[0] for r in rows.select(capturing.request_url(F.col("p"), F.col("u"))).collect()] == ["https://a/jobs?content=true", "https://a/jobs?x=1&content=true", "https://a?content=true", "https://a/b/jobs"]
    assert rows.select(capturing.board_slug(F.col("u"))).collect()[3][0] == "b"


def test_previews_and_similarity(spark):
    rows = spark.createDataFrame([('{"a": 1}', "word"), ("plain", "words")], "j string, w string")
    assert [r[0] for r in rows.select(text.json_preview(F.col("j"), 8)).collect()] == ['{\n  "a":', "plain"]
    assert rows.select(text.trigram_similarity(F.lit("word"), F.col("w"))).collect()[0][0] == 1.0
    long = spark.createDataFrame([("é" * 1500,), ("ok",)], "s string").select(text.byte_preview(F.col("s"))).collect()
    assert [len(r[0]) for r in long] == [1024, 2]


def test_cooldown_equals_a_row_by_row_walk(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.choice(("a", "b", None)), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(4000), microseconds=rng.randrange(3)), k) for k in range(3000)]
    last, want = {}, set()
    for host, when, k in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if host not in last or (when - last[host]).total_seconds() >= 37:
            last[host] = when
            want.add(k)
    out = schedule.allowed_requests(spark.createDataFrame(rows, "host string, at timestamp, id int"), "host", "at", "id", 37)
    assert {r.id for r in out.where("allowed").collect()} == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        out = schedule.allowed_requests(spark.createDataFrame(rows, "host string, at timestamp, id int"), "host", "at", "id", 37)
        assert {r.id for r in out.where("allowed").collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_touched_buckets_are_written(spark, tmp_path):
    at, empty = f"{tmp_path}/state", spark.createDataFrame([], "k int, v string")
    rows = lambda some, v: spark.createDataFrame([(k, v) for k in some], "k int, v string")
    change = lambda part, source: merge.merge(part, source, ["k"], {"v": F.col("s.v")})
    writers.merge_buckets(at, rows(range(100), "old"), ["k"], change, empty, 8)
    writers.merge_buckets(at, rows([5, 200], "new"), ["k"], change, empty, 8)
    assert {r.k: r.v for r in writers.read_buckets(spark, at, empty).collect()} == {k: "old" for k in range(100)} | {5: "new", 200: "new"}
    assert len(list((tmp_path / "state/data/v00000002").glob("bucket=*"))) <= 2
    writers.merge_buckets(at, rows(range(100), "x"), ["k"], lambda part, _: part.where("k > 99"), empty, 8)
    assert [r.k for r in writers.read_buckets(spark, at, empty).collect()] == [200]
    assert writers.read_buckets(spark, f"{tmp_path}/none", empty).count() == 0


def test_frontier_runs_like_a_plain_list(spark):
    import random

    rng = random.Random(8)
    rows = [(rng.choice("ab"), k, rng.choice(("push", "push", "pop")), f"u{k}", rng.choice((0.1, 0.12, 0.3, 0.5, 0.9)), rng.random() < 0.4) for k in range(600)]
    want, held = [], {"a": [], "b": []}

    def push(queue, score, k, url):
        if len(queue) >= 7:
            worst = min(queue, key=lambda x: (x[0], -x[1]))
            if score <= worst[0]:
                return
            queue.remove(worst)
        queue.append((score, k, url))

    for name, k, op, url, score, refused in rows:
        queue = held[name]
        if op == "push":
            push(queue, score, k, url)
        elif queue:
            best = max(queue, key=lambda x: (x[0], -x[1]))
            queue.remove(best)
            want.append((name, k, best[2], best[0]))
            if refused:
                push(queue, max(best[0] - 0.05, 0.10), k, best[2])
    got = schedule.frontier_run(spark.createDataFrame(rows, "queue string, seq long, op string, url string, score double, refused boolean").repartition(5), 7).collect()
    assert sorted((r.queue, r.seq, r.url, r.score) for r in got) == sorted(want)


def test_bloom_filter(spark):
    size = bloom.size_for(1000, 0.01)
    assert bloom.size_for(10_000_000, 1e-4).bits // 8 // 10**6 == 23 and size.hashes == 7
    keys = spark.createDataFrame([(f"k{k}",) for k in range(1000)] + [(None,)], "key string")
    asked = spark.createDataFrame([(k, f"k{k}") for k in range(3000)] + [(-1, None), (5, "k5")], "n int, key string")
    left = bloom.without_held(asked, "key", bloom.build(keys, "key", size), size).collect()
    assert all(r.n >= 1000 or r.n == -1 for r in left) and len([r for r in left if r.n >= 1000]) > 1930 and sum(r.n == -1 for r in left) == 1
    assert bloom.without_held(asked, "key", bloom.build(keys.limit(0), "key", size), size).count() == 3002


@pytest.mark.parametrize("most", [10, 37, 10_000])
def test_streaks_go_on_over_the_stretches_of_a_hot_key(spark, most):
    import random

    rng = random.Random(most)
    rows = [(rng.choice(("hot", "hot", "hot", "warm")), rng.choice((0, 500, 500, 900)) + rng.randrange(300), k, rng.random() < 0.15) for k in range(400)] + [("same", 3, 2000 + k, False) for k in range(40)] + [("good", k, 3000 + k, True) for k in range(40)]
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), n, ok) for k, t, n, ok in rows]
    got = {r.n: (r.streak, r.status) for r in schedule.failure_streaks(spark.createDataFrame(rows, "key string, at timestamp, n int, success boolean"), "key", ["at", "n"], most=most).collect()}
    streak = {}
    for key, _, n, ok in sorted(rows, key=lambda r: r[:3]):
        streak[key] = 0 if ok else streak.get(key, 0) + 1
        assert got[n] == (streak[key], "degraded" if streak[key] >= 5 else "failed" if streak[key] >= 3 else "ok")
    assert len(got) == len(rows)


@pytest.mark.parametrize("most", [10, 37, 10_000])
def test_hot_keys_are_cut_without_a_change(spark, most):
    """Means and gaps over stretches, uneven and empty ones too, equal those over whole keys."""
    import random

    rng = random.Random(most)
    rows = [(rng.choice(("hot", "hot", "hot", "warm", None)), rng.choice((0, 5, 5, 100, 900)) + rng.randrange(90), k, rng.randrange(100) / 4) for k in range(400)] + [("one", 7, 1000, 1.0), ("same", 3, 1001, 2.0)] + [("same", 3, 1002 + k, 3.0) for k in range(50)]
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), n, v, t * 10_000 + n) for k, t, n, v in rows]
    frame = spark.createDataFrame(rows, "key string, at timestamp, n int, v double, place long")
    means = {r.n: r.rolling_mean for r in schedule.rolling_mean(frame, "key", "place", "v", 20, most).collect()}
    apart = {r.n: r.gap for r in schedule.gaps(frame, "key", "at", "n", most).collect()}
    assert len(means) == len(apart) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[4])
        for k, r in enumerate(own):
            assert means[r[2]] == pytest.approx(sum(x[3] for x in own[max(0, k - 19) : k + 1]) / min(k + 1, 20))
        own.sort(key=lambda r: (r[1], r[2]))
        for k, r in enumerate(own):
            assert apart[r[2]] == ((r[1] - own[k - 1][1]).total_seconds() if k else None)


def test_acquisition_keeps_each_error_with_its_url(spark):
    from seine.sources.acquire import acquire

    def fetch(url):
        if "slow" in url:
            raise TimeoutError("too long")
        return {"big": (200, "text/html", "é" * 40), "none": (204, "", None)}.get(url.rsplit("/", 1)[1], (200, "application/json", "{}"))

    rows = spark.createDataFrame([(u, 1) for u in ("https://a/x", "https://a/x", "https://a/slow", "https://b/big", "https://b/none", None)], "url string, error int")
    got = {r.url: (r.status, r.body, r.timed_out, r.error) for r in acquire(rows, fetch, most_bytes=50).collect()}
    assert got == {"https://a/x": (200, "{}", False, None), "https://a/slow": (None, None, True, "too long"), "https://b/big": (200, None, False, "too large"), "https://b/none": (204, None, False, None)}
    assert acquire(rows.limit(0), fetch).count() == 0


def test_inferred_schema_of_mixed_jobs(spark):
    bodies = ['{"jobs": [{"req_id": 1, "jobTitle": "a", "office": {"name": "x"}}, {"req_id": "", "jobTitle": "b", "url": "u"}]}', '{"data": {"items": [{"req_id": 2, "name": "c", "city": "y"}]}}', "broken", None, "[]"]
    got = {r.field: (r.alias, r.jobs, r.share) for r in parse.infer_schema(spark.createDataFrame([(b,) for b in bodies], "raw_json string")).collect()}
    assert got == {"external_job_id": ("req_id", 2, 0.666667), "title": ("jobTitle", 2, 0.666667)}
    assert parse.infer_schema(spark.createDataFrame([], "raw_json string")).count() == 0
