"""What is due, in which order, and how often: queues, streaks, cooldowns."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship_package


def due(records: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    """Discovered records whose next replay is missing or past, missing ones first."""
    rows = records.where((F.col("status") == "discovered") & (F.col("next_replay").isNull() | (F.col("next_replay") <= as_of))).orderBy(F.asc_nulls_first("next_replay"), "domain")
    return rows.limit(limit) if limit else rows


def due_sources(sources: DataFrame, as_of: Column, platform: str | None = None, limit: int | None = None) -> DataFrame:
    """Active sources whose next fetch is missing or past, earliest first, missing ones last."""
    rows = sources.where(F.col("status").isin("active", "degraded") & (F.col("next_fetch_at").isNull() | (F.col("next_fetch_at") <= as_of)))
    if platform:
        rows = rows.where(F.col("ats_platform") == platform)
    rows = rows.orderBy(F.asc_nulls_last("next_fetch_at"), "source_id")
    return rows.limit(limit) if limit else rows


def pending(companies: DataFrame, records: DataFrame, limit: int | None = None) -> DataFrame:
    """Companies without a record or with one that isn't discovered, oldest first."""
    rows = companies.join(records.select(F.col("domain").alias("_d"), "status"), F.col("domain") == F.col("_d"), "left").where("_d is null or status <> 'discovered'").drop("_d").orderBy("created_at", "domain")
    return rows.limit(limit) if limit else rows


def frontier(scored: DataFrame, capacity: int, score: str = "score", order: str = "seq") -> DataFrame:
    """What a bounded queue holds after all pushes, best first; on ties the earlier stays."""
    return scored.orderBy(F.desc(score), order).limit(capacity)


#: What a refused URL loses when it goes back into the queue, and what it keeps at least.
PENALTY, LEAST_SCORE = 0.05, 0.10


class _Queue:
    """A bounded queue: best score first, of equal ones the earlier; a full one takes only what beats its worst."""

    def __init__(self, capacity: int):
        self.capacity, self.held = capacity, []

    def push(self, score: float, seq: int, url: str) -> None:
        if len(self.held) >= self.capacity:
            if not self.held or score <= self.held[0][0]:
                return
            del self.held[0]
        bisect.insort(self.held, (score, -seq, url))

    def pop(self) -> tuple[str, float] | None:
        if not self.held:
            return None
        score, _, url = self.held.pop()
        return url, score


def frontier_run(operations: DataFrame, capacity: int) -> DataFrame:
    """What each pop gives (queue, seq, url, score), of operations (queue, seq, op, url, score, refused) in order of ``seq``.

    ``op`` is push or pop; a pop that is ``refused`` puts its URL back with a lower score. A pop of
    an empty queue gives no row. Operations stream through sorted partitions, so only a bounded
    queue is in hand, whatever their number.
    """
    ship_package(operations.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, queue = None, _Queue(capacity)
        for batch in batches:
            out = []
            for own, seq, op, url, score, refused in batch.itertuples(index=False, name=None):
                if own != name:
                    name, queue = own, _Queue(capacity)
                if op == "push":
                    queue.push(score, seq, url)
                elif (got := queue.pop()) is not None:
                    out.append((own, seq, *got))
                    if refused:
                        queue.push(max(got[1] - PENALTY, LEAST_SCORE), seq, got[0])
            yield pd.DataFrame(out, columns=["queue", "seq", "url", "score"])

    rows = operations.select(F.col("queue").cast("string"), F.col("seq").cast("long"), "op", "url", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.coalesce("refused", F.lit(False)).alias("refused"))
    return rows.repartition("queue").sortWithinPartitions("queue", "seq").mapInPandas(run, "queue string, seq long, url string, score double")


def with_company(queue: DataFrame, companies: DataFrame, key: str = "url") -> DataFrame:
    """Queued URLs with what is known of their company; of several companies of one URL the last by id counts."""
    own = [c for c in companies.columns if c != key]
    last = companies.groupBy(key).agg(F.max_by(F.struct(*own), F.struct(*own)).alias("_c"))
    return queue.join(last, key).select(*queue.columns, *(F.col(f"_c.{c}").alias(c) for c in own))


def label_queue(captures: DataFrame, limit: int | None = None) -> DataFrame:
    """Unlabelled captures by domain and time."""
    rows = captures.where("label is null").orderBy("domain", "captured_at", "id")
    return rows.limit(limit) if limit else rows


def near_miss_queue(near: DataFrame, limit: int | None = None) -> DataFrame:
    """Unlabelled near misses, the likeliest first."""
    rows = near.where("label is null").orderBy(F.desc("confidence"), "id")
    return rows.limit(limit) if limit else rows


#: Rows of a key in one sorted window; a key with more is cut into stretches of its order.
MOST_ROWS = 1_000_000


def _cut(rows: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """Rows with ``_part`` and ``_hot``: a key of over ``most`` rows is cut at equal widths of its order.

    The first order column, a number or a time, decides, so where a row goes follows from counts
    and bounds alone. A null key is one part.
    """
    first = F.col(order[0])
    at = (F.unix_micros(first.cast("timestamp")) if rows.schema[order[0]].dataType.typeName().startswith("timestamp") else first).cast("double")
    spans = rows.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi")).where(F.col("_n") > most)
    parts = F.ceil(F.col("_n") / most)
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((at - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * parts), parts - 1))
    return rows.join(spans, F.col(key) == F.col("_k"), "left").select(*rows.columns, F.coalesce(place, F.lit(0)).cast("long").alias("_part"), F.col("_n").isNotNull().alias("_hot"))


def _stretches(rows: DataFrame, key: str, order: list[str], before: int, most: int) -> DataFrame:
    """Rows with ``_part``, and before each stretch of a hot key copies (``_copy``) of the rows that precede it.

    What follows may sort each (key, ``_part``) by itself and then leave the copies out.
    """
    cut = _cut(rows, key, order, most)
    hot = cut.where("_hot").drop("_hot")
    counts = hot.groupBy(F.col(key).alias("_k"), "_part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("through", F.sum("n").over(Window.partitionBy("_k").orderBy("_part")))  # a row a stretch
    a, b = counts.alias("a"), counts.alias("b")
    between = F.col("b.through") - F.col("b.n") - F.col("a.through")
    needed = a.join(b, (F.col("a._k") == F.col("b._k")) & (F.col("a._part") < F.col("b._part")) & (between < before)).select("a._k", F.col("a._part").alias("_from"), F.col("b._part").alias("_to"), between.alias("_between"))
    backwards = Window.partitionBy(key, "_part").orderBy(*(F.desc(c) for c in order))
    ends = hot.withColumn("_r", F.row_number().over(backwards)).where(F.col("_r") <= before)
    copies = ends.join(needed, (F.col(key) == F.col("_k")) & (F.col("_part") == F.col("_from"))).where(F.col("_r") + F.col("_between") <= before)
    return cut.select(*rows.columns, "_part", F.lit(False).alias("_copy")).union(copies.select(*rows.columns, "_to", F.lit(True)))


def rolling_mean(rows: DataFrame, key: str, order: str, value: str, last: int = 1000, most: int = MOST_ROWS) -> DataFrame:
    """Mean of the last rows of each key in order. A single global sequence has one key."""
    mean = F.avg(value).over(Window.partitionBy(key, "_part").orderBy(order).rowsBetween(-(last - 1), 0))
    return _stretches(rows, key, [order], last - 1, most).withColumn("rolling_mean", mean).where("not _copy").drop("_part", "_copy")


def failure_streaks(logs: DataFrame, key: str, order: list[str], success: str = "success", most: int = MOST_ROWS) -> DataFrame:
    """Failures in a row up to each log row; a success sets the count to 0.

    Counted in each stretch of a key by itself; a hot key's stretches then get, till their first
    success, what the stretches before ended with.
    """
    island = F.sum(F.col(success).cast("int")).over(Window.partitionBy(key, "_part").orderBy(*order))
    run = F.sum((~F.col(success)).cast("int")).over(Window.partitionBy(key, "_part", "_island").orderBy(*order))
    counted = lambda some: some.withColumn("_island", island).withColumn("_run", run.cast("long"))
    cut = _cut(logs, key, order, most)
    rows = counted(cut)
    ends = counted(cut.where("_hot")).groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.max("_island").alias("good"), F.max_by("_run", F.struct(*order)).alias("last"))
    by = Window.partitionBy("_k").orderBy("_p")  # a row a stretch
    ends = ends.withColumn("since", F.sum((F.col("good") > 0).cast("int")).over(by))
    ends = ends.withColumn("open", F.sum("last").over(Window.partitionBy("_k", "since").orderBy("_p"))).select("_k", "_p", F.lag("open").over(by).alias("_carry"))
    rows = rows.join(ends, (F.col(key) == F.col("_k")) & (F.col("_part") == F.col("_p")), "left")
    rows = rows.withColumn("streak", F.col("_run") + F.when(F.col("_island") == 0, F.coalesce("_carry", F.lit(0))).otherwise(0))
    return rows.select(*logs.columns, "streak", F.when(F.col("streak") >= 5, "degraded").when(F.col("streak") >= 3, "failed").otherwise("ok").alias("status"))


def gaps(rows: DataFrame, key: str, at: str, order: str, most: int = MOST_ROWS) -> DataFrame:
    """Seconds since the key's request before."""
    before = F.lag(at).over(Window.partitionBy(key, "_part").orderBy(at, order))
    gap = (F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))) / 1e6
    return _stretches(rows, key, [at, order], 1, most).withColumn("gap", gap).where("not _copy").drop("_part", "_copy")


def allowed_requests(rows: DataFrame, key: str, at: str, order: str, seconds: float) -> DataFrame:
    """Requests of each key that a cooldown lets through; only those reset it.

    Whether one passes depends on the last that did, so rows of a key are taken in order. They
    stream through sorted partitions with one time a key in hand, whatever a key's size, and a
    binary search leaps from each that passes to the next.
    """
    ship_package(rows.sparkSession)
    columns = rows.columns
    schema = rows.schema.add("allowed", "boolean")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, last = object(), 0
        least = int(seconds * 1_000_000)
        for batch in batches:
            if batch.empty:
                continue
            flags, times = np.zeros(len(batch), bool), batch[at].to_numpy().astype("datetime64[us]").astype("i8")
            codes = pd.factorize(batch[key], use_na_sentinel=False)[0]
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            for lo, hi in zip(starts, np.append(starts[1:], len(batch)), strict=True):
                name = batch[key].iloc[lo]
                same = name == last_key or (pd.isna(name) and pd.isna(last_key))
                k = lo + int(np.searchsorted(times[lo:hi], last + least)) if same else lo
                while k < hi:  # from one that passes to the next
                    flags[k], last = True, times[k]
                    k = max(k + 1, lo + int(np.searchsorted(times[lo:hi], last + least)))
                last_key = name
            yield batch.assign(allowed=flags)[[*columns, "allowed"]]

    return rows.repartition(key).sortWithinPartitions(key, at, order).mapInPandas(take, schema)
