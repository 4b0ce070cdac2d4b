"""The stages as streams. A restart goes on from the checkpoint, which is stronger than committing offsets before work is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import jsons, scoring
from ..operators.parse import parse_heuristic
from ..operators.routing import route, settle
from ..session import ship_package


def first_of_domain(urls: DataFrame, time_col: str, delay: str | None = None) -> DataFrame:
    """Each domain once; with a delay, state older than the watermark goes."""
    if delay is None:
        return urls.dropDuplicates(["domain"])
    return urls.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["domain"])


def _started(rows: DataFrame, one: Callable[[DataFrame, int], None], checkpoint: str, once: bool, every: str | None = None) -> StreamingQuery:
    """Each batch to a function; ``once`` takes all there is and ends."""
    out = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every} if every else None
    return (out.trigger(**trigger) if trigger else out).start()


def intake(urls: DataFrame, records: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Routes each batch against the records as they are then, and hands it to ``sink`` for fan-out."""
    return _started(urls, lambda batch, number: sink(route(batch, records()), number), checkpoint, once)


def tiered(results: DataFrame, tier: int, confidence: Column, least: float, found: Callable[[DataFrame, int], None], missed: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """A tier's results batch by batch: discoveries to ``found``, messages for the next tier with the reason to ``missed``."""

    def one(batch: DataFrame, number: int) -> None:
        for rows, sink in zip(settle(batch, tier, confidence, least), (found, missed), strict=True):
            sink(rows, number)

    return _started(results, one, checkpoint, once)


def allowed(requests: DataFrame, key: str, at: str, seconds: float, order: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Requests that a cooldown lets through, those of one time by ``order``. One time a key is state, dropped when the watermark is twice the cooldown past it.

    A key's new rows of one batch are sorted together, so a batch must not hold more of a key than a task does.
    """
    ship_package(requests.sparkSession)

    def take(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values([at, order] if order else at, kind="stable")
        flags = []
        for when in rows[at]:
            ok = last is None or when.timestamp() - last >= seconds
            flags.append(ok)
            last = when.timestamp() if ok else last
        state.update((last,))
        state.setTimeoutTimestamp(max(int(1000 * (last + 2 * seconds)), state.getCurrentWatermarkMs() + 1))
        yield rows[flags]

    return requests.withWatermark(at, delay).groupBy(key).applyInPandasWithState(take, requests.schema, "last double", "append", GroupStateTimeout.EventTimeTimeout)


def scored(responses: DataFrame) -> DataFrame:
    """URL, body and final confidence of each landed response; stateless."""
    rows = responses.withColumn("url_score", scoring.url_confidence(F.col("url"), F.col("method"), F.col("content_type"), F.octet_length("body"))).withColumn("_b", scoring.body_confidence(F.col("url"), F.col("body")))
    return rows.withColumn("body_score", F.col("_b.score")).withColumn("shape", F.col("_b.shape")).drop("_b").withColumn("confidence", scoring.final_confidence(F.col("url_score"), F.col("body_score"), F.col("url")))


def normalise(envelopes: DataFrame, upsert: Callable[[DataFrame, int], None], dead: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Job rows of each batch to ``upsert``; envelopes that aren't JSON to ``dead``, without another try."""

    def one(batch: DataFrame, number: int) -> None:
        good = F.coalesce(jsons.is_json(F.col("raw_json")), F.lit(False))
        upsert(parse_heuristic(batch.where(good), ["domain", "company_id"]), number)
        dead(batch.where(~good), number)

    return _started(envelopes, one, checkpoint, once)


def feedback(entries: DataFrame) -> DataFrame:
    """Running hits and misses of each domain, for update mode."""
    return entries.groupBy("domain").agg(F.coalesce(F.sum(F.when(F.col("hit"), F.col("weight"))), F.lit(0.0)).alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.max(F.when(F.col("hit"), F.col("at"))).alias("last_hit"))


def windowed(events: DataFrame, at: str, keys: list[str], delay: str, window: str, slide: str | None = None) -> DataFrame:
    """Counts in tumbling or sliding windows of event time; rows later than the delay are dropped."""
    return events.withWatermark(at, delay).groupBy(F.window(at, window, slide) if slide else F.window(at, window), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, at: str, keys: list[str], delay: str, gap: str) -> DataFrame:
    return events.withWatermark(at, delay).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n"))


def replayed(due: Callable[[], DataFrame], work: Callable[[DataFrame, int], None], ticks: DataFrame, checkpoint: str, every: str = "30 seconds", most: int = 1000, once: bool = False) -> StreamingQuery:
    """On every trigger, the records that are due then, at most so many."""
    return _started(ticks, lambda _, number: work(due().limit(most), number), checkpoint, once, every)


def frontier_state(pushes: DataFrame, capacity: int) -> DataFrame:
    """Per ``queue``, what a bounded priority queue holds after each batch: best first, earlier first on ties."""
    ship_package(pushes.sparkSession)
    schema = "queue string, url string, score double, seq long"

    def take(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in zip(*state.get, strict=True)] if state.exists else []
        for rows in batches:
            held += list(rows[["url", "score", "seq"]].itertuples(index=False, name=None))
        held = sorted(held, key=lambda x: (-x[1], x[2]))[:capacity]
        urls, scores, seqs = (list(x) for x in zip(*held, strict=True))
        state.update((urls, scores, seqs))
        yield pd.DataFrame({"queue": keys[0], "url": urls, "score": scores, "seq": seqs})

    return pushes.groupBy("queue").applyInPandasWithState(take, schema, "urls array<string>, scores array<double>, seqs array<long>", "update", GroupStateTimeout.NoTimeout)
